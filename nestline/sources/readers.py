"""Partitioned reads.

A look-back opens the folders of its days only, however many days the table has; a missing day
simply is not there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from nestline.operators.scoring import Lookup
from nestline.sources import schemas


def read_table(spark: SparkSession, base: str, fmt: str = "parquet",
               schema: str | None = None, **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(base)


def last_days(end: str, days: int) -> list[str]:
    """``end`` and the days before it, ``days`` in all."""
    last = datetime.strptime(end, "%Y%m%d")
    return [(last - timedelta(days=n)).strftime("%Y%m%d") for n in range(days - 1, -1, -1)]


def existing(spark: SparkSession, base: str, folders: Iterable[str]) -> Iterator[str]:
    """Those of the folders below ``base`` that are there, asked for one by one."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    return (name for name in folders if files.exists(path(f"{base.rstrip('/')}/{name}")))


def read_folders(spark: SparkSession, base: str, folders: Sequence[str],
                 schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows of those partition folders of a table that exist, with the partition columns."""
    there = [f"{base.rstrip('/')}/{name}" for name in existing(spark, base, folders)]
    if not there:
        return read_table(spark, base, fmt, schema).limit(0)
    reader = spark.read.format(fmt).option("basePath", base)
    return (reader.schema(schema) if schema else reader).load(there)


def read_lookback(spark: SparkSession, base: str, part_col: str, end: str, days: int,
                  schema: str | None = None, fmt: str = "parquet",
                  end_inclusive: bool = True) -> DataFrame:
    """The last ``days`` daily partitions up to ``end``; the partition column is kept.

    With ``end_inclusive=False`` the window is the ``days`` days before ``end``.
    """
    last = end if end_inclusive else last_days(end, 2)[0]
    return read_folders(spark, base, [f"{part_col}={d}" for d in last_days(last, days)], schema, fmt)


def read_lookback_ymd(spark: SparkSession, base: str, end: str, days: int,
                      schema: str, fmt: str = "parquet") -> DataFrame:
    """The same for tables partitioned by year, month and day."""
    folders = [f"year={d[:4]}/month={d[4:6]}/day={d[6:]}" for d in last_days(end, days)]
    return read_folders(spark, base, folders, schema, fmt)


def union_years(history: DataFrame, run_year: int, years_back: int = 1,
                year: str = "year_yyyy", open_year: int = 9999) -> DataFrame:
    """Open versions plus those closed in the previous year(s): a pruned scan, no union."""
    wanted = [open_year, *range(run_year - years_back, run_year)]
    return history.filter(F.col(year).cast("int").isin(wanted))


def group_range(df: DataFrame, start: int, size: int = 10,
                group: str = "user_group") -> DataFrame:
    """User groups start .. start + size - 1, for scoring in batches."""
    return df.filter(F.col(group).between(start, start + size - 1))


def conform(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename a source's columns to the ones the operators use."""
    return df.withColumnsRenamed(dict(names))


def read_lookups(spark: SparkSession, consumer_city: str, listing_city: str, consumer_zip: str,
                 listing_zip: str) -> list[Lookup]:
    """The four pair tables, as CSV with a header and an explicit schema."""
    def load(path: str, schema: str) -> DataFrame:
        return read_table(spark, path, "csv", schema, header="true")

    city, zips = ("consumer_ip_city", "ldp_city"), ("consumer_ip_zip", "ldp_zip")
    return [
        Lookup(load(consumer_city, schemas.CITY_LOOKUP_CONSUMER), city,
               "con_pct_web_uls_median", "con_pct_web_uls_median_city"),
        Lookup(load(listing_city, schemas.CITY_LOOKUP_LISTING), city,
               "ldp_pct_web_uls_median", "ldp_pct_web_uls_median_city"),
        Lookup(load(consumer_zip, schemas.ZIP_LOOKUP_CONSUMER), zips,
               "con_pct_web_uls_median", "con_pct_web_uls_median_zip"),
        Lookup(load(listing_zip, schemas.ZIP_LOOKUP_LISTING), zips,
               "ldp_pct_web_uls_median", "ldp_pct_web_uls_median_zip"),
    ]
