"""Who an event belongs to, and which ids are real."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from nestline.config import PLACEHOLDER_IDS


def is_real_id(column: Column | str, placeholders: Iterable[str] = PLACEHOLDER_IDS) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.isNotNull() & ~column.isin(*placeholders)


def event_user(member: str = "member_id", visitor: str = "visitor_id") -> Column:
    """The member where there is one, the visitor otherwise."""
    return F.coalesce(F.nullif(F.col(member), F.lit("")), F.col(visitor))


def is_identified(member: str = "member_id", visitor: str = "visitor_id") -> Column:
    """A non-empty member, or a visitor that is neither null, blank nor the word null."""
    visitor_known = (F.col(visitor).isNotNull() & (F.trim(F.col(visitor)) != "")
                     & (F.lower(F.col(visitor)) != "null"))
    return (F.col(member) != "") | visitor_known
