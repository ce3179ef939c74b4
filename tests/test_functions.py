import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestline.functions import features, gain, hashing, identity, registry
from tests.helpers import rows


def test_placeholder_ids_are_dropped(spark):
    ids = ["a", "", "unknown", "NULL", "null", "$CUSTOMER_ID_$", "$customer_id_$", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert rows(df.filter(identity.is_real_id("id"))) == [("a",)]


def test_event_user_and_identified(spark):
    data = [("m", "v"), ("", "v"), (None, "v"), ("", " "), ("", "NULL"), ("", None), (None, None)]
    df = spark.createDataFrame(data, "member_id string, visitor_id string")
    got = df.filter(identity.is_identified()).select(identity.event_user().alias("u"))
    assert rows(got) == [("m",), ("v",), ("v",)]


def test_buckets_are_even_and_repeatable(spark):
    df = spark.range(20_000).select(hashing.user_group(F.col("id"), 50).alias("g"))
    counts = [r["count"] for r in df.groupBy("g").count().collect()]
    assert len(counts) == 50 and min(counts) > 300 and max(counts) < 500


def test_variation_follows_allocation_and_leaves_the_rest_out(spark):
    users = spark.range(20_000).select(F.col("id").cast("string").alias("u"))
    got = users.select(hashing.variation(F.col("u"), F.lit("e"), [("A", 5000), ("B", 3000)])
                       .alias("v")).groupBy("v").count().collect()
    share = {r["v"]: r["count"] / 20_000 for r in got}
    assert abs(share["A"] - 0.5) < 0.02 and abs(share["B"] - 0.3) < 0.02
    assert abs(share[None] - 0.2) < 0.02
    with pytest.raises(ValueError):
        hashing.variation(F.col("u"), F.lit("e"), [("A", 9000), ("B", 3000)])


def test_deviation_guards_nulls_zero_and_nan(spark):
    nan = float("nan")
    data = [(1, 2.0, 4.0), (2, None, 4.0), (3, 2.0, None), (4, 2.0, 0.0), (5, -1.0, 4.0),
            (6, nan, 4.0), (7, nan, 0.0)]
    df = spark.createDataFrame(data, "k int, u double, f double")
    got = {r["k"]: (r["ratio"], r["diff"]) for r in df.select(
        "k", features.deviation_ratio(F.col("u"), F.col("f")).alias("ratio"),
        features.deviation_diff(F.col("u"), F.col("f")).alias("diff")).collect()}
    assert got[1] == (0.5, 2.0)
    assert got[2] == (None, None) and got[3] == (None, None)
    assert got[4] == (None, -2.0)
    assert got[5][0] == pytest.approx(0.0002)
    assert math.isnan(got[6][0]) and got[7][0] is None


def test_haversine_against_numpy(spark):
    points = [(40.7, -74.0, 34.05, -118.25), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0),
              (90.0, 0.0, -90.0, 0.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)],
                               "k int, a double, b double, c double, d double")
    got = {r["k"]: r["m"] for r in df.select("k", features.haversine_miles(
        *[F.col(c) for c in "abcd"]).alias("m")).collect()}
    for i, (a, b, c, d) in enumerate(points):
        la, lb = np.radians(a), np.radians(c)
        h = np.sin((lb - la) / 2) ** 2 + np.cos(la) * np.cos(lb) * np.sin(np.radians(d - b) / 2) ** 2
        want = 2 * 3958.76 * np.arcsin(min(1.0, np.sqrt(h)))
        assert got[i] == pytest.approx(want, rel=1e-5, abs=1e-3)
    missing = df.select(features.haversine_miles(F.lit(None).cast("double"), F.col("b"),
                                                 F.col("c"), F.col("d")).alias("m"))
    assert all(r["m"] is None for r in missing.collect())


def dcg_by_hand(rel, k, method):
    rel = rel[:k]
    if method == 0:
        return sum(r / (1 if i == 0 else math.log2(i + 1)) for i, r in enumerate(rel))
    if method == 1:
        return sum(r / math.log2(i + 2) for i, r in enumerate(rel))
    return sum((2 ** r - 1) / math.log2(i + 2) for i, r in enumerate(rel))


@pytest.mark.parametrize("method", [0, 1, 2])
def test_gain_by_hand(spark, method):
    lists = [[3, 2, 3, 0, 0, 1, 2, 2, 3, 0], [0, 0], [], [1], [0, 1, 0, 1, 1]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(lists)], "k int, rel array<int>")
    got = {r["k"]: r for r in df.select(
        "k", gain.dcg(F.col("rel"), 4, method).alias("d"),
        gain.ndcg(F.col("rel"), 4, method).alias("n")).collect()}
    for i, rel in enumerate(lists):
        best = dcg_by_hand(sorted(rel, reverse=True), 4, method)
        assert got[i]["d"] == pytest.approx(dcg_by_hand(rel, 4, method))
        assert got[i]["n"] == pytest.approx(dcg_by_hand(rel, 4, method) / best if best else 0.0)


def test_unknown_gain_method_is_refused(spark):
    with pytest.raises(ValueError):
        gain.position_gain(F.lit(1.0), F.lit(1), 3)


def test_functions_in_sql_equal_the_columns(spark):
    registry.register_functions(spark)
    df = spark.createDataFrame([(1, 2.0, 4.0, 10.0, 170.0), (2, None, 4.0, 0.0, 0.0), (3, 1.0, 0.0, -90.0, 5.0)],
                               "k int, u double, f double, a double, b double")
    df.createOrReplaceTempView("sql_functions_demo")
    got = spark.sql("""SELECT k, deviation_ratio(u, f), deviation_diff(u, f), haversine_miles(u, f, a, b)
                       FROM sql_functions_demo""")
    want = df.select("k", features.deviation_ratio(F.col("u"), F.col("f")),
                     features.deviation_diff(F.col("u"), F.col("f")),
                     features.haversine_miles(*[F.col(c) for c in "ufab"]))
    assert rows(got) == rows(want)
