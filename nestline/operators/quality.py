"""Data-quality checks over whole tables.

Counts of distinct keys under several conditions are taken in two steps: flags per key (combined
before the shuffle), then one sum. That needs one shuffle of narrow rows where a
count(distinct ...) per condition would repeat the input once for each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nestline.operators.eligibility import day_before
from nestline.operators.keyed import order_breaks

CHECK_COLUMNS = ("check", "n_keys", "n_rows", "n_total", "pct", "passed")


def is_empty(*columns: str) -> Column:
    """Any of the text columns is null or ''."""
    empty = F.lit(False)
    for column in columns:
        empty = empty | F.col(column).isNull() | (F.col(column) == "")
    return empty


def is_zero(*columns: str) -> Column:
    """Any of the numeric columns is null or 0."""
    zero = F.lit(False)
    for column in columns:
        zero = zero | F.col(column).isNull() | (F.col(column).try_cast("double") == 0)
    return zero


def dq_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a null part are not compared."""
    return (df.dropna(subset=list(keys)).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def dq_counts(df: DataFrame, key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Distinct keys and rows per condition, and distinct keys overall: (check, n_keys, ...)."""
    names = list(conditions)
    hits = {name: F.coalesce(conditions[name], F.lit(False)) for name in names}
    per_key = df.groupBy(key).agg(*[
        F.count_if(hits[name]).alias(f"_{i}") for i, name in enumerate(names)])
    is_key = F.col(key).isNotNull()
    sums = [F.count_if(is_key).alias("n_total")]
    for i, _ in enumerate(names):
        sums += [F.count_if(is_key & (F.col(f"_{i}") > 0)).alias(f"_k{i}"),
                 F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_r{i}")]
    rows = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_k{i}").alias("n_keys"),
                              F.col(f"_r{i}").alias("n_rows"))
                     for i, name in enumerate(names)])
    return per_key.agg(*sums).select(F.inline(rows), "n_total")


def dq_rate(df: DataFrame, key: str, conditions: Mapping[str, Column],
            max_pct: Mapping[str, float]) -> DataFrame:
    """``dq_counts`` judged by a limit per check, in percent of the distinct keys.

    A limit of 0 tolerates no row at all, so rows whose key itself is missing count too.
    """
    limits = F.create_map(*[F.lit(x) for name in conditions
                            for x in (name, float(max_pct.get(name, 0.0)))])
    limit = limits[F.col("check")]
    pct = F.coalesce(F.try_divide(100.0 * F.col("n_keys"), F.col("n_total")), F.lit(0.0))
    return (dq_counts(df, key, conditions)
            .withColumn("pct", pct)
            .withColumn("passed", F.when(limit == 0, F.col("n_rows") == 0)
                        .otherwise(F.col("pct") <= limit))
            .select(*CHECK_COLUMNS))


def dq_age(df: DataFrame, start: str, run_date: Column, max_days: int) -> DataFrame:
    """Rows whose start lies more than ``max_days`` days before the run."""
    age = F.datediff(run_date, F.to_date(F.col(start)))
    return df.withColumn("age_days", age).filter(F.col("age_days") > max_days)


def loaded_day(df: DataFrame, day: str, newest: str, back: int) -> DataFrame:
    """The newest day with data among ``newest`` and the ``back`` days before it (one row)."""
    return (df.filter(F.col(day).between(day_before(newest, back), newest))
            .agg(F.max(day).alias(day)))


def dq_drift(df: DataFrame, day: str, key: str, current: str, previous: str,
             max_pct: float = 20.0, condition: Column | None = None) -> DataFrame:
    """Distinct keys of two days and their difference in percent of the earlier one."""
    kept = df if condition is None else df.filter(condition)
    flags = (kept.filter(F.col(day).isin(current, previous) & F.col(key).isNotNull())
             .groupBy(key)
             .agg(F.bool_or(F.col(day) == current).alias("_now"),
                  F.bool_or(F.col(day) == previous).alias("_then"))
             .agg(F.count_if("_now").alias("n_current"), F.count_if("_then").alias("n_previous")))
    pct = F.try_divide(100.0 * F.abs(F.col("n_current") - F.col("n_previous")),
                       F.col("n_previous"))
    return (flags.withColumn("pct", pct)
            .withColumn("passed", F.coalesce(F.col("pct") <= max_pct, F.lit(False))))


def dq_rank_order(ranked: DataFrame, score: str = "match_score") -> DataFrame:
    """Users whose scores rise with seq_id somewhere: (user_id, n_rows, n_breaks)."""
    return order_breaks(ranked, ["user_id"], "seq_id", score, rising=False)


def dq_sequence(ranked: DataFrame, upstream: DataFrame, position: str = "seq_id") -> DataFrame:
    """Per user and state: ranked rows known upstream, and where their order differs from it.

    Either side is read as its keys and one number, so a table that two such checks read is
    shuffled once, and what ``explode_ranked`` returns is not shuffled again.
    """
    keys = ["user_id", "listing_id", "state"]
    both = ranked.select(*keys, F.col(position).alias("_place")).join(
        upstream.select(*keys, F.col("row_id").alias("_known")), keys)
    return order_breaks(both, ["user_id", "state"], "_place", "_known", rising=True)


def dq_first_slot(ranked: DataFrame, empty: Column | None = None) -> DataFrame:
    """Every user must have a recommendation in the first slot, with its fields filled."""
    first = F.col("seq_id") == 1
    hollow = F.lit(False) if empty is None else empty
    counts = (ranked.groupBy("user_id")
              .agg(F.bool_or(first).alias("_first"), F.bool_or(first & hollow).alias("_hollow"))
              .filter(F.col("user_id").isNotNull())
              .agg(F.count(F.lit(1)).alias("n_users"), F.count_if("_first").alias("n_first"),
                   F.count_if("_hollow").alias("n_empty_first")))
    return counts.withColumn("passed", (F.col("n_users") == F.col("n_first"))
                             & (F.col("n_empty_first") == 0))


def dq_report(checks: Mapping[str, DataFrame], run_date: str,
              volumes: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per check with its result, and whether it passed, ready to be written by day.

    Frames without a ``passed`` column list violations: they pass when they are empty.
    ``volumes`` (from ``dq_counts``) are reported without a verdict.
    """
    report = None
    for name, frame in (volumes or {}).items():
        rows = frame.select(F.concat_ws(".", F.lit(name), "check").alias("check"),
                            F.to_json(F.struct(*frame.columns)).alias("detail"),
                            F.lit(None).cast("boolean").alias("passed"))
        report = rows if report is None else report.unionByName(rows)
    for name, frame in checks.items():
        if "passed" in frame.columns:
            rows = frame.select(
                F.concat_ws(".", F.lit(name), F.col("check") if "check" in frame.columns
                            else F.lit(None).cast("string")).alias("check"),
                F.to_json(F.struct(*frame.columns)).alias("detail"), "passed")
        else:
            rows = frame.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("check"),
                F.to_json(F.struct(F.col("n").alias("n_violations"))).alias("detail"),
                (F.col("n") == 0).alias("passed"))
        report = rows if report is None else report.unionByName(rows)
    return report.withColumn("target_date", F.lit(run_date))
