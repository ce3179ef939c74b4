"""Session settings the operators are tuned for. Only runtime settings, never required."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # neighbouring rows of one listing compress to a fraction, so a task is to read less than 64 MB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # from this size on a hot key's partition is read by several tasks (Spark's own figure: 256 MB)
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # many-to-one joins split a hot key even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a window or grouping by (user, listing) after a join by user gets a shuffle of its own:
    # one busy user must not stay in one task because the join left it there
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition values such as month=06 and target_date=20200601 stay strings
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
