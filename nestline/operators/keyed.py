"""Per-key selection and ranking.

``top_per_key`` keeps the row_number filter next to its window, so Spark plans a
WindowGroupLimit before the shuffle: every task sends at most ``n`` rows of a key, however
large that key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from nestline.sources.scratch import short_list

_RANK = "_row_in_key"
#: Keys whose ranks are sent to every task, some 100 bytes each.
SHORT_LIST = 2_000_000


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                rank_as: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key, optionally with their 1-based position."""
    name = rank_as or _RANK
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return kept if rank_as else kept.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def _rank_order(score: str, ties: Sequence[str]) -> list[Column]:
    return [F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in ties]]


def rank_within_key(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str],
                    rank_as: str = "seq_id") -> DataFrame:
    """Dense 1..n position of every row by score descending, nulls last.

    A key's rows meet in one task; ``deal_by_rank`` and ``rank_dealt`` spread them.
    """
    return df.withColumn(rank_as, F.row_number().over(
        Window.partitionBy(*keys).orderBy(*_rank_order(score, ties))))


def deal_by_rank(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str]) -> DataFrame:
    """Rows in ranges of (keys, score descending, ties), with the number of the range as ``_part``
    and their place in it as ``_row``.

    However many rows a key has and however many of them share a score or have none, they are
    dealt out by size. The result has to be written before ``rank_dealt`` reads it.
    """
    order = [*[F.col(k) for k in keys], *_rank_order(score, ties)]
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
    return (df.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumns({"_part": F.spark_partition_id(), "_row": in_range}))


def rank_dealt(dealt: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str],
               rank_as: str = "seq_id") -> DataFrame:
    """The positions that ``rank_within_key`` gives, for the written rows of ``deal_by_rank``, which
    have been dealt and sorted by ``score`` and ``ties``.

    Where a key begins in a range, and the sizes of its earlier ranges, make a rank of a row's place.
    Rows are not shuffled for it unless there are more than ``SHORT_LIST`` keys.
    """
    keys = list(keys)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(*keys, "_part")
              .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
              .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_part").alias("_of"), "_first",
                      F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")))
    starts, _ = short_list(starts, "starts", SHORT_LIST)
    same = F.col("_part") == F.col("_of")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return (dealt.join(starts, same)
            .withColumn(rank_as, (F.col("_row") - F.col("_first") + F.col("_offset") + 1).cast("int"))
            .drop("_part", "_row", "_of", "_first", "_offset", *[f"_{k}" for k in keys]))


def order_breaks(df: DataFrame, keys: Sequence[str], position: str, value: str,
                 rising: bool, chunk: int = 1000) -> DataFrame:
    """Per key: how many neighbours (by position) have values in the wrong order.

    Neighbours are compared inside chunks of ``chunk`` positions and then between the ends of
    consecutive chunks, so no task needs a whole key at once.
    """
    keys = list(keys)

    def broken(earlier: Column, later: Column) -> Column:
        wrong = later < earlier if rising else later > earlier
        return F.when(wrong, 1).otherwise(0)

    chunked = df.select(*keys, position, value,
                        F.floor(F.col(position) / chunk).alias("_chunk"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(position, value)
    ends = (chunked.withColumn("_broken", broken(F.lag(value).over(inner), F.col(value)))
            .groupBy(*keys, "_chunk")
            .agg(F.sum("_broken").alias("_inside"), F.count(F.lit(1)).alias("_rows"),
                 F.min_by(value, F.struct(position, value)).alias("_first"),
                 F.max_by(value, F.struct(position, value)).alias("_last")))
    outer = Window.partitionBy(*keys).orderBy("_chunk")
    return (ends.withColumn("_between", broken(F.lag("_last").over(outer), F.col("_first")))
            .groupBy(*keys)
            .agg(F.sum("_rows").alias("n_rows"),
                 F.sum(F.col("_inside") + F.col("_between")).alias("n_breaks")))
