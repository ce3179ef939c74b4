"""Where intermediate tables are written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one the cluster names in spark.checkpoint.dir, else below the
    warehouse; it goes when the session's JVM ends.

    A warehouse on the local disk is refused unless the session runs in one JVM: each executor would
    write to its own disk.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.split("[")[0] == "local"
        where = hadoop(base).getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
        if where == "file" and not local:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{base.rstrip('/')}/scratch"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = hadoop(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and read back: later steps neither repeat the work nor lose it
    with an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def short_list(df: DataFrame, name: str, most: int) -> tuple[DataFrame, bool]:
    """A list written once, and whether it goes whole to every task: with up to ``most`` rows it does."""
    listed = written(df, name)
    short = listed.count() <= most
    return (F.broadcast(listed) if short else listed), short
