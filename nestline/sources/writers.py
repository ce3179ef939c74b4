"""Outputs that can be written again without cleaning up first."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str] = ("target_date",),
                      fmt: str = "parquet", rebalance: bool = True) -> None:
    """Replace exactly the partitions that ``df`` contains.

    Rows are rebalanced on the partition columns first: every folder gets few files of even
    size, and a folder that holds most of the rows is still written by many tasks.
    """
    if rebalance:
        df = df.hint("rebalance", *columns)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).format(fmt).save(path))


def write_day(df: DataFrame, path: str, day: str, columns: Sequence[str] = (),
              day_column: str = "target_date", fmt: str = "parquet", rebalance: bool = True) -> None:
    """Replace one day, with further partition columns below it.

    ``rebalance=False`` is for rows that have been dealt out by these columns already.

    The whole folder of the day goes, so nothing is left of an earlier run even where this one
    has no rows for a partition. Other days are not touched.
    """
    if columns and rebalance:
        df = df.hint("rebalance", *columns)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(f"{path.rstrip('/')}/{day_column}={day}")


def materialize(df: DataFrame, path: str, day: str, columns: Sequence[str] = (),
                day_column: str = "target_date", rebalance: bool = True) -> DataFrame:
    """Write a day and read it back: later steps start from files, whatever executor is lost."""
    write_day(df, path, day, columns, day_column, rebalance=rebalance)
    # the day's own folder: no other day is listed, however many there are
    return df.sparkSession.read.schema(df.schema).parquet(f"{path.rstrip('/')}/{day_column}={day}")


def write_messages(messages: DataFrame, path: str) -> int:
    """Write one JSON body per line, gzipped, and count them in the same job."""
    sent = Observation()
    (messages.select(F.col("body").alias("value"))
     .observe(sent, F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").text(path, compression="gzip"))
    return sent.get["n"]


def send_messages(messages: DataFrame,
                  sender: Callable[[Iterable[tuple[str, str]]], Iterable[bool]]) -> int:
    """Hand (message_id, body) to ``sender`` inside the tasks; returns how many it delivered.

    A task that is run again sends again: receivers should drop repeated message ids.
    """
    def deliver(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = sender(zip(batch["message_id"], batch["body"]))
            yield pd.DataFrame({"delivered": [int(bool(ok)) for ok in done]})

    total = (messages.select("message_id", "body").mapInPandas(deliver, "delivered int")
             .agg(F.coalesce(F.sum("delivered"), F.lit(0)).alias("n")))
    return total.first()["n"]


def create_table_as(df: DataFrame, table: str, path: str, fmt: str = "parquet") -> None:
    """External table with the rows of ``df``, replacing one of the same name."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(table)


def register(spark: SparkSession, table: str, path: str, schema: StructType,
             partitions: Sequence[str], fmt: str = "parquet") -> None:
    """Make a partitioned folder queryable by name and pick up partitions added since.

    ``schema`` is that of the rows; no file is opened to find it.
    """
    if not spark.catalog.tableExists(table):
        plain = [f for f in schema.fields if f.name not in partitions]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain)
        parts = ", ".join(f"`{p}` string" for p in partitions)
        spark.sql(f"CREATE TABLE {table} ({columns}, {parts}) USING {fmt} "
                  f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)
