"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to completion into a sink that discards rows; the better of two runs counts.
The tables come as one file with one row group each, which one task reads; they are laid out in a file
for each core before anything is timed, as larger tables are.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from nestline.sample.queries import QUERIES
from nestline.session import tune
from nestline.sources.scratch import scratch_path

HEADLINE = (
    "candidate_generation", "candidate_generation_split", "price_band", "zip_median",
    "listing_clean", "engagement_counts", "tag_interactions", "filter_recommendations",
    "deviation_features", "lookup_enrich", "rank_candidates", "web_eligible", "email_eligible",
    "bucket_exclusive", "attach_variation", "email_candidates", "assemble", "offline_metrics",
    "dq_empty", "dq_rank_order", "dq_sequence",
)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def laid_out(spark: SparkSession, sf: str, files: int) -> str:
    path = scratch_path(spark, "bench")
    for table in TABLES:
        (spark.read.parquet(f"{sf}/{table}.parquet").repartition(files)
         .write.parquet(f"{path}/{table}.parquet"))
    return path


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("nestline-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    tables = laid_out(spark, sf, int(cpus))
    # start-up of the JVM and of code generation belongs to no query
    QUERIES["scrub_ids"](spark, tables).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
