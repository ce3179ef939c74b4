"""Source formats and SQL functions on whole tables: JSON by month and by state, CSV lookups, features in SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestline.config import FEATURE_ATTRIBUTES, FEATURE_WINDOWS
from nestline.functions.registry import register_functions
from nestline.operators import candidates as cand, profile as prof
from nestline.sample import queries as q, views as v
from nestline.sources import readers, schemas, writers
from nestline.sources.scratch import scratch_path


@q.query("""SELECT p.user_id, target_month AS target_date, round(any_value(overall_mean), 6) AS overall_mean,
                   round(any_value(overall_std_dev), 6) AS overall_std_dev, count(zip_code) AS n_zips,
                   round(sum(score), 6) AS scores
            FROM (SELECT *, substr(target_date, 1, 6) || '01' AS target_month FROM v_profiles) p
            LEFT JOIN v_zip_scores z USING (snapshot_id)
            WHERE target_month BETWEEN '20000617' AND '20010801'
            GROUP BY p.user_id, target_month, snapshot_id""")
def json_profiles(spark, sf):
    """Profiles as JSON in a folder for the first day of each month: the folders of the last 411 days, with
    nested fields as they are declared."""
    path = scratch_path(spark, "profiles")
    made = v.profiles(spark, sf).drop("snapshot_id").withColumn(
        "target_date", F.concat(F.substring("target_date", 1, 6), F.lit("01")))
    writers.write_partitioned(made, path, ["target_date"], "json")
    recent = readers.read_lookback(spark, path, "target_date", v.ORDERS_END, 411, schemas.REAL_PROFILE, "json")
    scores = F.transform(F.coalesce("zip_stats", F.array()), lambda z: F.coalesce(z["score"].try_cast("double"), F.lit(0.0)))
    found = F.size(F.coalesce("zip_stats", F.array())) > 0
    return q.rounded(recent.select(
        "user_id", F.col("target_date").cast("string").alias("target_date"),
        F.col("price_stats.overall_mean").try_cast("double").alias("overall_mean"),
        F.col("price_stats.overall_std_dev").try_cast("double").alias("overall_std_dev"),
        F.size(F.coalesce("zip_stats", F.array())).cast("long").alias("n_zips"),
        F.when(found, F.aggregate(scores, F.lit(0.0), lambda a, b: a + b)).alias("scores")))


@q.query(f"""SELECT user_id, zip_code, round(score, 6) AS score FROM (
               SELECT p.user_id, s.zip_code, s.score, row_number() OVER (
                        PARTITION BY p.user_id ORDER BY s.score DESC NULLS LAST, s.zip_code) AS rn
               FROM v_latest_profile p LEFT JOIN v_zip_scores s USING (snapshot_id)) WHERE rn <= {v.NL.top_zips}""")
def json_users(spark, sf):
    """Users from JSON profiles of all days: the latest profile of each and its best zips."""
    path = scratch_path(spark, "profiles")
    # the id of the snapshot travels as text, as every number of this source does
    made = v.profiles(spark, sf).withColumns({"snapshot_id": F.col("snapshot_id").cast("string"),
                                              "month": F.substring("target_date", 1, 6)})
    writers.write_partitioned(made, path, ["month"], "json")
    read = readers.read_table(spark, path, "json", f"{schemas.REAL_PROFILE}, snapshot_id string")
    read = read.withColumn("snapshot_id", F.col("snapshot_id").cast("long"))
    users = prof.build_users(read, q._medians(spark, sf), v.NL, ("snapshot_id",))
    return q.rounded(users.select("user_id", "zip_code", "score"))


@q.query(f"SELECT * REPLACE (coalesce(row_id, -1) AS row_id) FROM ({q._FLAT})")
def json_recommendations(spark, sf):
    """Upstream recommendations as JSON in a folder for each state, flattened to positions."""
    path = scratch_path(spark, "recommendations")
    writers.write_partitioned(v.recommendations(spark, sf).drop("source_row"), path, ["state"], "json")
    read = readers.read_table(spark, path, "json", schemas.RECOMMENDATIONS)
    return cand.explode_ranked(read).withColumn("row_id", F.coalesce("row_id", F.lit(-1)).cast("long"))


@q.query(q.LOOKUPS_SQL)
def csv_lookups(spark, sf):
    """The four lookup tables as CSV with a header, read with their schemas and joined to all pairs."""
    paths = []
    for lookup, value in zip(q._lookups(spark, sf), ("con", "ldp", "con", "ldp")):
        paths.append(scratch_path(spark, "lookup"))
        (lookup.table.select(*lookup.keys, F.col(lookup.value).alias(f"{value}_pct_web_uls_median"),
                             F.lit("1").alias("web_uus_sum"))
         .write.option("header", "true").csv(paths[-1]))
    return q.enriched(q._joined(spark, sf), readers.read_lookups(spark, *paths))


@q.query(f"""SELECT p.user_id, p.listing_id, {q._deviation_sql()},
                    round(CAST(CAST({q._HAVERSINE} AS FLOAT) AS DOUBLE), 2) AS miles {q._JOINED_SQL}""")
def sql_feature_functions(spark, sf):
    """All deviations and distances in SQL text, by the registered functions."""
    register_functions(spark)
    pairs = q._joined(spark, sf)
    features = ", ".join(
        f"deviation_ratio(cal_{a}_{w}, {a}) AS {a}_ratio_cal_{a}_{w}, deviation_diff(cal_{a}_{w}, {a}) AS {a}_diff_cal_{a}_{w}"
        for a in FEATURE_ATTRIBUTES for w in FEATURE_WINDOWS)
    made = spark.sql(f"""SELECT user_id, listing_id, {features},
                                haversine_miles(lat, lon, cal_lat_t90, cal_lon_t90) AS miles FROM {{pairs}}""", pairs=pairs)
    return q.rounded(made.withColumn("miles", F.round(F.col("miles").cast("double"), 2)))
