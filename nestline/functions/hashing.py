"""Deterministic buckets. The same key lands in the same bucket on every run and engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

TRAFFIC_UNITS = 10_000


def bucket(key: Column, buckets: int) -> Column:
    """First 32 bits of md5, modulo the number of buckets."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(buckets).cast("long"))


def user_group(key: Column | str, groups: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return bucket(key, groups).cast("int")


def variation(user: Column, experiment: Column, allocation: Sequence[tuple[str, int]],
              salt: str = "") -> Column:
    """Variation of a user: ``allocation`` is (name, share out of 10 000); the rest is null."""
    if sum(share for _, share in allocation) > TRAFFIC_UNITS:
        raise ValueError("allocation exceeds the whole traffic")
    slot = bucket(F.concat_ws(":", F.lit(salt), experiment, user), TRAFFIC_UNITS)
    chain, upper = None, 0
    for name, share in allocation:
        upper += share
        chain = (F.when(slot < upper, name) if chain is None else chain.when(slot < upper, name))
    return chain
