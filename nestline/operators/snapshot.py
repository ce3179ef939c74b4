"""Point-in-time views of versioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nestline.operators.eligibility import day_before
from nestline.operators.keyed import first_per_key


def as_of(df: DataFrame, at: Column, valid_from: str = "effective_from_datetime_mst",
          valid_to: str = "effective_to_datetime_mst") -> DataFrame:
    """Versions valid at an instant: the start counts, the end does not."""
    return df.filter((F.col(valid_from) <= at) & (at < F.col(valid_to)))


def within_days(df: DataFrame, column: str, end: str, days: int,
                end_inclusive: bool = True) -> DataFrame:
    """Rows of the last ``days`` days up to ``end``, or of the ``days`` days before it.

    On a partition column this prunes folders. Rows without a day are outside.
    """
    last = end if end_inclusive else day_before(end, 1)
    return df.filter(F.col(column).cast("string").between(day_before(last, days - 1), last))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                   ties: Sequence[str] = ()) -> DataFrame:
    """The newest row of every key; ``ties`` (ascending) makes the choice repeatable."""
    order = [F.col(c).desc() for c in newest] + [F.col(c).asc() for c in ties]
    return first_per_key(df, keys, order)
