import random

import pytest
from pyspark.sql import functions as F

from nestline.functions import cuts
from nestline.operators import keyed, skew, snapshot
from nestline.sources.scratch import written
from tests.helpers import plan, rows


def test_latest_per_key_takes_newest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", "1", 5), ("a", "2", 9), ("a", "2", 3), ("b", None, 1), ("b", "0", 2)],
        "k string, d string, t int")
    assert rows(snapshot.latest_per_key(df, ["k"], ["d"], ["t"])) == [("a", "2", 3), ("b", "0", 2)]


def test_top_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    top = keyed.top_per_key(df, ["k"], [F.col("v").desc()], 2, rank_as="r")
    assert rows(top) == [(0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2),
                         (2, 998, 1)]
    text = plan(top)
    assert "Partial" in text.split("Exchange")[1], text


def test_as_of_includes_start_and_excludes_end(spark):
    df = spark.createDataFrame([(1, "2000-01-01", "2000-01-02"), (2, "2000-01-02", "2000-01-03")],
                               "k int, f string, t string").selectExpr(
        "k", "cast(f as timestamp) f", "cast(t as timestamp) t")
    at = F.lit("2000-01-02").cast("timestamp")
    assert rows(snapshot.as_of(df, at, "f", "t"), "k") == [(2,)]


def random_scores(seed, n=3000):
    rng = random.Random(seed)
    # one key holds most rows; scores tie often and are sometimes missing
    return [("hot" if rng.random() < 0.7 else f"k{rng.randrange(20)}", i,
             None if rng.random() < 0.05 else float(rng.randrange(40))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_dealt_ranking_equals_plain_ranking(spark, seed):
    df = spark.createDataFrame(random_scores(seed), "k string, id int, s double")
    plain = keyed.rank_within_key(df, ["k"], "s", ["id"])
    dealt = written(keyed.deal_by_rank(df, ["k"], "s", ["id"]), "dealt")
    spread = keyed.rank_dealt(dealt, ["k"], "s", ["id"])
    assert rows(plain, "k", "id", "s", "seq_id") == rows(spread, "k", "id", "s", "seq_id")


def test_equal_and_missing_scores_of_one_key_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).selectExpr("'one' AS k", "id", "if(id < 4000, 1.0D, NULL) AS s")
        dealt = written(keyed.deal_by_rank(df, ["k"], "s", ["id"]), "dealt")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in dealt.groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000
    ranked = keyed.rank_dealt(dealt, ["k"], "s", ["id"])
    assert ranked.where("seq_id != id + 1").isEmpty() and ranked.count() == 8000


def test_dealt_rows_are_ranked_where_they_lie(spark, monkeypatch):
    df = spark.createDataFrame(random_scores(3), "k string, id int, s double")
    dealt = written(keyed.deal_by_rank(df, ["k"], "s", ["id"]), "dealt")
    ranked = keyed.rank_dealt(dealt, ["k"], "s", ["id"])
    assert "Exchange hashpartitioning" not in plan(ranked) and "Window" not in plan(ranked)
    monkeypatch.setattr(keyed, "SHORT_LIST", 3)  # the list of keys is too long to be sent out
    assert rows(keyed.rank_dealt(dealt, ["k"], "s", ["id"])) == rows(ranked)


@pytest.mark.parametrize("rising", [True, False])
def test_order_breaks_in_chunks_equals_plain_scan(spark, rising):
    rng = random.Random(5)
    data = [(k, i + 1, rng.randrange(100)) for k in "ab" for i in range(57)]
    df = spark.createDataFrame(data, "k string, p int, v int")
    got = {r["k"]: (r["n_rows"], r["n_breaks"])
           for r in keyed.order_breaks(df, ["k"], "p", "v", rising, chunk=10).collect()}
    for key in "ab":
        values = [v for k, _, v in data if k == key]
        wrong = sum((b < a) if rising else (b > a) for a, b in zip(values, values[1:]))
        assert got[key] == (57, wrong)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rng = random.Random(3)
    left = spark.createDataFrame(
        [(None if rng.random() < 0.1 else "hot" if rng.random() < 0.6 else f"k{rng.randrange(9)}",
          i) for i in range(800)], "k string, id int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)],
                                  "k string, w int")
    hot = skew.hot_keys(left, ["k"], 100)
    assert rows(hot, "k") == [("hot",)]
    split = skew.salted_join(left, right, ["k"], how, hot, ["id"])
    assert rows(split) == rows(left.join(right, "k", how))


def test_salted_join_refuses_right_joins(spark):
    df = spark.range(1).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        skew.salted_join(df, df, ["k"], "right", df, ["k"])


@pytest.mark.parametrize("seed", [1, 2])
def test_split_band_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)

    def key():
        return None if rng.random() < 0.05 else "hot" if rng.random() < 0.6 else f"z{rng.randrange(5)}"

    queries = [(i, key(), lo := rng.uniform(-20, 90), lo + rng.uniform(-5, 60)) for i in range(300)]
    queries.append((999, "hot", None, 5.0))
    points = [(i, key(), float(rng.randrange(100))) for i in range(300)] + [(998, "hot", None)]
    q = spark.createDataFrame(queries, "q int, zip string, low double, high double")
    p = spark.createDataFrame(points, "p int, zip string, price double")
    want = sorted((a, c) for a, z, lo, hi in queries for c, y, v in points
                  if z is not None and z == y and None not in (lo, v) and lo <= v <= hi)
    hot = skew.hot_bands(q, p, "zip", "price", max_queries=50, max_points=40, slices=8)
    assert rows(hot, "zip") == [("hot",)]
    for bands in (None, hot):
        joined = skew.band_join(q, p, "zip", "price", "low", "high", bands, ["q"], slices=8)
        assert rows(joined, "q", "p") == want
        assert set(joined.columns) == {"q", "zip", "low", "high", "p", "price"}


def test_points_of_one_value_are_split_too(spark):
    queries = [(i, "hot", 1.0 * (i % 9), 5.0 + i % 3) for i in range(120)] + [(200, "z", 0.0, 9.0)]
    points = [(i, "hot", 5.0) for i in range(200)] + [(300, "z", 3.0), (301, "hot", 8.0)]
    q = spark.createDataFrame(queries, "q int, zip string, low double, high double")
    p = spark.createDataFrame(points, "p int, zip string, price double")
    hot = skew.hot_bands(q, p, "zip", "price", max_queries=50, max_points=40, slices=8)
    split = hot.first()
    assert split["_parts"] == 3 and max(split["_slices"]) in (5, 6)
    want = sorted((a, c) for a, z, lo, hi in queries for c, y, v in points if z == y and lo <= v <= hi)
    joined = skew.band_join(q, p, "zip", "price", "low", "high", hot, ["q"], slices=8)
    assert rows(joined, "q", "p") == want


def test_cuts_below_by_halving(spark):
    edges = [1.0, 1.0, 2.0, 5.0, 5.0, 5.0, 9.0]
    values = [0.0, 1.0, 1.5, 2.0, 5.0, 6.0, 9.0, 10.0]
    df = spark.createDataFrame([(v, edges) for v in values], "v double, e array<double>")
    got = {r["v"]: (r["below"], r["upto"]) for r in df.select(
        "v", cuts.cuts_below(F.col("e"), F.col("v"), 8).alias("below"),
        cuts.cuts_below(F.col("e"), F.col("v"), 8, or_equal=True).alias("upto")).collect()}
    for v in values:
        assert got[v] == (sum(e < v for e in edges), sum(e <= v for e in edges))
    with pytest.raises(ValueError):
        cuts.quantiles(6)


def test_the_same_key_is_split_in_a_table_of_any_size(spark):
    hot = spark.range(300).selectExpr("'hot' AS k", "id")
    rest = spark.range(60_000).selectExpr("cast(id AS string) AS k", "id")
    for df in (hot, hot.union(rest)):
        assert rows(skew.hot_keys(df, ["k"], 100)) == [("hot", 3)]


def test_pieces_of_a_hot_key_do_not_grow_with_its_pairs(spark):
    q = spark.range(20_000).selectExpr("id AS q", "'hot' AS zip", "id % 900 - 5.0D AS low", "id % 900 + 5.0D AS high")
    p = spark.range(4000).selectExpr("id AS p", "'hot' AS zip", "cast(id % 1000 AS double) AS price")
    hot = skew.hot_bands(q, p, "zip", "price", max_queries=100, max_points=10)
    split = hot.first()
    assert split["_parts"] == skew.MAX_PARTS and len(split["_slices"]) == len(split["_cuts"]) + 1 == 8
    joined = skew.band_join(q, p, "zip", "price", "low", "high", hot, ["q"])
    plain = skew.band_join(q, p, "zip", "price", "low", "high")
    assert joined.count() == plain.count() and joined.exceptAll(plain.select(joined.columns)).isEmpty()


def test_a_key_is_hot_by_its_pairs_alone(spark):
    q = spark.range(300).selectExpr("id AS q", "if(id < 200, 'hot', 'z') AS zip", "0.0D AS low", "60.0D AS high")
    p = spark.range(150).selectExpr("id AS p", "if(id < 100, 'hot', 'z') AS zip", "cast(id AS double) AS price")
    hot = skew.hot_bands(q, p, "zip", "price", max_queries=1000, max_points=1000, max_pairs=6000)
    assert rows(hot, "zip", "_parts", "_cuts", "_slices") == [("hot", 4, [], [1])]
    joined = skew.band_join(q, p, "zip", "price", "low", "high", hot, ["q"])
    plain = skew.band_join(q, p, "zip", "price", "low", "high")
    assert joined.count() == plain.count() == 200 * 61 and joined.exceptAll(plain.select(joined.columns)).isEmpty()


@pytest.mark.parametrize("block", [7, 256])
def test_a_point_meets_queries_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(skew, "BLOCK", block)
    q = spark.range(600).selectExpr("if(id % 9 = 0, NULL, id % 50) AS q", "if(id % 7 = 0, NULL, if(id % 3 = 0, 'z', 'hot')) AS zip",
                                    "if(id % 11 = 0, NULL, id % 40 - 1.0D) AS low", "id % 40 + id % 13 - 3.0D AS high",
                                    "array(id, NULL) AS rest")
    p = spark.range(300).selectExpr("if(id % 5 = 0, NULL, id % 30) AS p", "if(id % 4 = 0, 'z', if(id % 17 = 0, NULL, 'hot')) AS zip",
                                    "if(id % 19 = 0, NULL, cast(id % 60 AS double)) AS price")
    hot = skew.hot_bands(q, p, "zip", "price", max_queries=200, max_points=100, slices=8)
    assert rows(hot, "zip") == [("hot",)]
    joined = skew.band_join(q, p, "zip", "price", "low", "high", hot, ["q"], slices=8)
    plain = skew.band_join(q, p, "zip", "price", "low", "high")
    assert joined.columns == ["q", "zip", "low", "high", "rest", "p", "price"]
    assert joined.dtypes == plain.select(joined.columns).dtypes
    assert rows(joined) == rows(plain, *joined.columns) and joined.count() > 1000
    # a row of the join holds a point and a block; pairs are made from it row by row
    assert "Generate inline" in plan(joined)


def test_a_part_of_a_hot_key_has_a_bounded_number_of_queries(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_PARTS", 2)
    q = spark.range(1000).selectExpr("id AS q", "'hot' AS zip", "0.0D AS low", "9.0D AS high")
    p = spark.range(20).selectExpr("id AS p", "'hot' AS zip", "cast(id AS double) AS price")
    for most, parts in ((600, 2), (90, 12)):
        monkeypatch.setattr(skew, "PART_QUERIES", most)
        hot = skew.hot_bands(q, p, "zip", "price", max_queries=50, max_points=50)
        assert hot.first()["_parts"] == parts
        assert skew.band_join(q, p, "zip", "price", "low", "high", hot, ["q"]).count() == 10_000
