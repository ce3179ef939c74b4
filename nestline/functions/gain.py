"""Discounted cumulative gain over a relevance array (an already ranked, short list)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def position_gain(relevance: Column, position: Column, method: int) -> Column:
    """Contribution of one item at a 1-based position.

    Method 0 discounts by log2(position) from the second item on, method 1 by
    log2(position + 1), method 2 does the same with the exponential gain 2^r - 1.
    """
    if method == 0:
        discount = F.when(position == 1, F.lit(1.0)).otherwise(F.log2(position.cast("double")))
        return relevance / discount
    if method == 1:
        return relevance / F.log2(position + F.lit(1.0))
    if method == 2:
        return (F.pow(F.lit(2.0), relevance) - 1) / F.log2(position + F.lit(1.0))
    raise ValueError("method must be 0, 1 or 2")


def dcg(relevance: Column, k: int, method: int = 1) -> Column:
    gains = F.transform(F.slice(relevance, 1, k),
                        lambda r, i: position_gain(r.cast("double"), i + 1, method))
    return F.aggregate(gains, F.lit(0.0), lambda total, gain: total + gain)


def ndcg(relevance: Column, k: int, method: int = 0) -> Column:
    best = dcg(F.sort_array(relevance, asc=False), k, method)
    return F.when(best == 0, F.lit(0.0)).otherwise(F.try_divide(dcg(relevance, k, method), best))


def best_dcg(hits: Column, k: int, method: int) -> Column:
    """Ideal gain of a list with binary relevance: all its hits come first."""
    total = F.lit(0.0)
    for position in range(1, k + 1):
        gain = position_gain(F.lit(1.0), F.lit(position), method)
        total = total + F.when(hits >= position, gain).otherwise(F.lit(0.0))
    return total
