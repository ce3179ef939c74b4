import math
import random

import pytest
from pyspark.sql import functions as F

from nestline.operators import candidates as cand, metrics, quality as dq
from tests.helpers import plan, rows
from tests.test_candidates import RECS


def test_ground_truth_cleaning(spark):
    day = "20200601"
    df = spark.createDataFrame([
        ("m", None, "l1", "87101", day), ("m", "v", "l1", "87102", day), ("", "v", "l2", "87101", "20200607"),
        ("m", None, "late", "87101", "20200608"), ("m", None, "early", "87101", "20200531"),
        ("m", None, "UNKNOWN", "87101", day), ("m", None, "l3", "8710", day), ("m", None, "l4", None, day),
        ("m", None, "l5", " ", day), ("$CUSTOMER_ID_$", None, "l1", "87101", day), ("", None, "l1", "87101", day),
        ("", "UNKNOWN", "l1", "87101", day)],
        "member_id string, visitor_id string, listing_id_persist string, zip string, event_date string")
    assert rows(metrics.ground_truth(df, day, 7)) == [("m", "l1"), ("v", "l2")]


def scores_by_hand(pred, truth, k):
    """Plain Python: lists per user, means over users on both sides."""
    out = {}
    for user, items in pred.items():
        listed = [i for i, r in sorted(items.items(), key=lambda x: (x[1], x[0])) if r <= k]
        relevant = truth.get(user)
        if not listed or not relevant:
            continue
        hits = [1 if i in relevant else 0 for i in listed]
        gain = sum(h / math.log2(p + 2) for p, h in enumerate(hits[:k]))
        best = sum(h / math.log2(p + 2) for p, h in enumerate(sorted(hits, reverse=True)[:k]))
        out[user] = (sum(hits) / len(listed), sum(hits) / len(relevant), gain / best if best else 0.0)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_by_hand(spark, seed):
    rng = random.Random(seed)
    pred, truth = {}, {}
    for u in range(40):
        if rng.random() < 0.9:
            # ranks repeat and have gaps, as with several states per user
            pred[f"u{u}"] = {f"l{i}": rng.randrange(1, 15) for i in rng.sample(range(30), 12)}
        if rng.random() < 0.9:
            truth[f"u{u}"] = set(f"l{i}" for i in rng.sample(range(30), rng.randrange(1, 12)))
    p = spark.createDataFrame([(u, i, r) for u, x in pred.items() for i, r in x.items()],
                              "user_id string, listing_id string, rank int")
    t = spark.createDataFrame([(u, i) for u, x in truth.items() for i in x], "user_id string, listing_id string")
    got = {r["rank"]: r for r in metrics.offline_metrics(p, t).collect()}
    for k in (1, 3, 12):
        want = scores_by_hand(pred, truth, k)
        assert got[k]["user_coverage"] == len(want)
        for i, name in enumerate(("mean_precision", "mean_recall", "mean_ndcg")):
            assert got[k][name] == pytest.approx(sum(w[i] for w in want.values()) / len(want))
    users = metrics.user_scores(p, t).filter("k = 12")
    assert {r["user_id"] for r in users.collect()} == set(scores_by_hand(pred, truth, 12))


def test_repeated_predictions_and_truth_count_once(spark):
    p = spark.createDataFrame([("u", "a", 1), ("u", "a", 2), ("u", "b", 3)],
                              "user_id string, listing_id string, rank int")
    t = spark.createDataFrame([("u", "a"), ("u", "a")], "user_id string, listing_id string")
    row = metrics.user_scores(p, t, (3,)).first()
    assert (row["predicted"], row["hits"], row["precision"], row["recall"], row["ndcg"]) == (2, 1, 0.5, 1.0, 1.0)


def test_dcg_of_rows(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 2, 2), ("a", 9, 3)], "k string, rel int, at int")
    assert metrics.dcg_by_group(df, "k", "rel", "at", 2).first()["dcg"] == pytest.approx(3 + 2 / math.log2(3))


DATA = "k string, a string, n double, d string"


def test_rates_count_nulls_which_equality_with_null_misses(spark):
    df = spark.createDataFrame([("k1", "x", 1.0, "1"), ("k2", None, 0.0, "1"), ("k3", "", None, "1"),
                                ("k3", "x", 1.0, "1"), (None, None, 1.0, "1")], DATA)
    checks = {"a": dq.is_empty("a"), "n": dq.is_zero("n"), "key": dq.is_empty("k")}
    got = {r["check"]: r for r in dq.dq_rate(df, "k", checks, {"a": 70.0, "n": 60.0}).collect()}
    assert (got["a"]["n_keys"], got["a"]["n_rows"], got["a"]["n_total"]) == (2, 3, 3)
    assert got["a"]["passed"] and not got["n"]["passed"]
    assert got["key"]["n_keys"] == 0 and got["key"]["n_rows"] == 1 and not got["key"]["passed"]


def test_rates_of_an_empty_table(spark):
    df = spark.createDataFrame([], DATA)
    row = dq.dq_rate(df, "k", {"a": dq.is_empty("a")}, {}).first()
    assert (row["n_keys"], row["n_rows"], row["n_total"], row["pct"], row["passed"]) == (0, 0, 0, 0.0, True)


def test_duplicates(spark):
    df = spark.createDataFrame([("k", "a", 1.0, "1"), ("k", "a", 2.0, "1"), ("k", "b", 1.0, "1"),
                                (None, "a", 1.0, "1"), (None, "a", 1.0, "1")], DATA)
    assert rows(dq.dq_duplicates(df, ["k", "a"])) == [("k", "a", 2)]


def test_drift_finds_days_and_judges_change(spark):
    df = spark.createDataFrame([(f"k{i}", "", 0.0, d) for d, n in (("20200601", 10), ("20200530", 8), ("20200101", 99))
                                for i in range(n)], DATA)
    now = dq.loaded_day(df, "d", "20200603", 14).first()["d"]
    then = dq.loaded_day(df, "d", "20200531", 10).first()["d"]
    assert (now, then) == ("20200601", "20200530")
    row = dq.dq_drift(df, "d", "k", now, then).first()
    assert (row["n_current"], row["n_previous"], row["pct"], row["passed"]) == (10, 8, 25.0, False)
    assert dq.dq_drift(df, "d", "k", now, then, 30.0).first()["passed"]
    assert dq.dq_drift(df, "d", "k", now, "20200529").first()["passed"] is False
    assert dq.loaded_day(df, "d", "20190101", 14).first()["d"] is None


def test_rank_order_and_sequence(spark):
    ranked = spark.createDataFrame(
        [("u", "a", "NM", 1, 9.0), ("u", "b", "NM", 2, 7.0), ("u", "c", "NM", 3, 8.0), ("w", "a", "NM", 1, 1.0)],
        "user_id string, listing_id string, state string, seq_id int, match_score double")
    assert rows(dq.dq_rank_order(ranked)) == [("u", 3, 1), ("w", 1, 0)]
    upstream = spark.createDataFrame([("u", "a", "NM", 4), ("u", "b", "NM", 2), ("u", "c", "NM", 6)],
                                     "user_id string, listing_id string, state string, row_id int")
    assert rows(dq.dq_sequence(ranked, upstream)) == [("u", "NM", 3, 1)]


def test_upstream_is_shuffled_once_for_both_order_checks(spark, tmp_path):
    recs = spark.createDataFrame([("u", [("1", "c"), ("2", "a"), ("3", "b")], "NM"), ("w", None, "NM")], RECS)
    cand.explode_ranked(recs).withColumn("row_id", F.col("row_id") * 7 % 5).write.parquet(str(tmp_path / "up"))
    upstream = spark.read.parquet(str(tmp_path / "up"))
    ranked = spark.createDataFrame([("u", "a", "NM", 1), ("u", "b", "NM", 2), ("u", "c", "NM", 3)],
                                   "user_id string, listing_id string, state string, seq_id int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = dq.dq_sequence(ranked, upstream).unionAll(
            dq.dq_sequence(upstream, cand.explode_ranked(recs), position="row_id"))
        assert rows(both) == [("u", "NM", 3, 0), ("u", "NM", 3, 1)]
        final = plan(both).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert final.count("ReusedExchange") == 1


def test_first_slot(spark):
    df = spark.createDataFrame([("u", 1, "x"), ("u", 2, ""), ("w", 2, "x")], "user_id string, seq_id int, t string")
    row = dq.dq_first_slot(df, dq.is_empty("t")).first()
    assert (row["n_users"], row["n_first"], row["n_empty_first"], row["passed"]) == (2, 1, 0, False)
    assert dq.dq_first_slot(df.filter("user_id = 'u'"), dq.is_empty("t")).first()["passed"]


def test_age_compares_with_the_run_date(spark):
    df = spark.createDataFrame([("a", "2020-05-27 23:00:00"), ("b", "2020-05-28 01:00:00")], "k string, s string")
    late = dq.dq_age(df, "s", F.to_date(F.lit("20200602"), "yyyyMMdd"), 5)
    assert rows(late, "k", "age_days") == [("a", 6)]


def test_report_lists_every_check(spark):
    df = spark.createDataFrame([("k", "", 1.0, "1"), ("k", "", 2.0, "1")], DATA)
    report = dq.dq_report({"dup": dq.dq_duplicates(df, ["k"]),
                           "rate": dq.dq_rate(df, "k", {"a": dq.is_empty("a")}, {}),
                           "none": dq.dq_duplicates(df, ["n"])}, "20200601",
                          {"size": dq.dq_counts(df, "k", {"all": F.lit(True)})})
    assert rows(report, "check", "passed", "target_date") == [
        ("dup", False, "20200601"), ("none", True, "20200601"), ("rate.a", False, "20200601"),
        ("size.all", None, "20200601")]
