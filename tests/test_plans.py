"""Whole campaign days on the test tables, and what the physical plans look like."""

import json
from dataclasses import replace
from functools import partial
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from nestline.operators import candidates as cand, eligibility as elig, experiment as exp, listings as lst
from nestline.plans import daily
from nestline.plans.store import Store
from nestline.sample import campaigns, queries as q, views as v
from tests.helpers import plan, rows

ALLOCATION = (("V1", 4000), ("V2", 4000), ("C", 2000))


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    """One day of both campaigns; limits are so low that every split path is used."""
    sf, root = "/root/testdata/sf0.001", tmp_path_factory.mktemp("day")
    history, events = v.listing_history(spark, sf), q._day(spark, sf)["events"]
    profiles = v.profiles(spark, sf)
    nl, rh = Store(f"{root}/nl", v.RUN_DATE), Store(f"{root}/rh", v.RUN_DATE)
    config = replace(v.NL, listing_age_days=180)
    limits = daily.Skew(users_per_zip=5, listings_per_zip=3, rows_per_listing=5)

    def score(features):
        return F.coalesce(F.nanvl("price_ratio_cal_price_t90", F.lit(0.0)), F.lit(0.0)) * 100

    new = daily.new_listings(nl, config, history, events, profiles,
                             v.user_features(spark, sf).drop("snapshot_id"),
                             v.listing_features(spark, sf), q._lookups(spark, sf), score, limits,
                             url="property_url")
    recommendations = v.recommendations(spark, sf).drop("source_row")

    def run_homes():
        return daily.recommended_homes(rh, v.RH, history, events, profiles, recommendations,
                                       url="property_url")

    first = rows(run_homes(), "user_id", "state", "listing_id", "seq_id")
    homes = run_homes()
    assert rows(homes, "user_id", "state", "listing_id", "seq_id") == first  # safe to run again
    return spark, sf, nl, rh, new, homes


def test_new_listings_day(day):
    spark, sf, nl, _, ranked, _ = day
    candidates = nl.all_days(spark, "candidates")
    features = nl.all_days(spark, "features")
    assert candidates.count() > 100
    assert candidates.count() == nl.all_days(spark, "candidate_pairs").count()
    assert {"listing_address", "viewed", "dom"} <= set(candidates.columns)
    assert {"listing_address", "match_score", "seq_id"} <= set(ranked.columns)
    assert len(ranked.columns) == len(set(ranked.columns))
    assert candidates.groupBy("user_id", "listing_id").count().filter("count > 1").count() == 0
    # pairs without a feature row on either side drop out, nothing else
    assert ranked.count() == features.count() <= candidates.count()
    bad = (ranked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("seq_id").alias("m"),
                                         F.countDistinct("seq_id").alias("d"))
           .filter("n != m or n != d"))
    assert bad.count() == 0


def test_rows_of_a_listing_are_written_side_by_side(day):
    spark, _, nl, _, ranked, _ = day
    for name in ("features", "candidates_ranked"):
        df = nl.all_days(spark, name)
        for file in df.inputFiles():
            ids = [r["listing_id"] for r in spark.read.parquet(file).select("listing_id").collect()]
            assert ids == sorted(ids), name


def test_listings_too_many_to_send_out(day, tmp_path, monkeypatch):
    spark, sf, _, _, ranked, _ = day
    monkeypatch.setattr(cand, "SHORT_LIST", 3)
    features = v.user_features(spark, sf).drop("snapshot_id")
    again = daily.new_listings(
        Store(str(tmp_path), v.RUN_DATE), replace(v.NL, listing_age_days=180), v.listing_history(spark, sf),
        q._day(spark, sf)["events"], v.profiles(spark, sf), features, v.listing_features(spark, sf),
        q._lookups(spark, sf), lambda f: F.coalesce(F.nanvl("price_ratio_cal_price_t90", F.lit(0.0)), F.lit(0.0)) * 100,
        daily.Skew(users_per_zip=5, listings_per_zip=3, rows_per_listing=5), url="property_url")
    assert rows(again.select(*ranked.columns)) == rows(ranked)


def test_recommended_homes_day(day):
    _, _, _, _, _, ranked = day
    assert ranked.count() > 0
    assert ranked.filter("seq_id > 10").count() == 0
    assert {r[0] for r in ranked.select("viewed").distinct().collect()} <= {"y", "n"}


def test_channels_and_delivery(day, tmp_path):
    spark, sf, nl, rh, new, homes = day
    web = Store(str(tmp_path / "web"), v.RUN_DATE)
    sent = daily.web_bucketing(
        web, new, v.opt_ins(spark, sf),
        v.search_profiles(spark, sf).filter("member_id = '3'"),
        partial(exp.bucket_all, experiment="AB", allocation=ALLOCATION), "V2")
    assert {r[0] for r in sent.select("variation").distinct().collect()} == {"V2"}
    n = daily.deliver(web, sent, "new_listings", "id", "name", None)
    assert n == sent.select("user_id").distinct().count() > 0
    body = json.loads(spark.read.text(web.path("messages_new_listings")).first()["value"])
    ranks = [r["seq_id"] for r in body["payload"]["content"]["recommendations"]]
    assert ranks == sorted(ranks)

    app = Store(str(tmp_path / "app"), v.ORDERS_END)
    users = daily.app_users(app, v.dominant_zips(spark, sf), v.push_sent(spark, sf),
                            v.opt_ins(spark, sf), ["purchase"], ["canvas5"], "APP", ALLOCATION)
    picked = daily.app_bucketing(app, homes, users, "V1")
    assert picked.filter("variation != 'V1'").count() == 0
    control = users.filter("variation = 'C'").select("user_id").distinct().count()
    assert daily.deliver_control(app, users, "dom_zip_app", "id", "name") == control

    mail = Store(str(tmp_path / "mail"), v.EVENTS_END)
    mailable = daily.email_users(mail, v.email_sent(spark, sf), ["signup"])
    letters = daily.email_bucketing(mail, homes, mailable, "V1", "mail-v1")
    assert daily.deliver(mail, letters, "recommended_homes_email", "i", "n", None) == \
        letters.select("user_id").distinct().count()


def test_metrics_and_validation(day, tmp_path):
    spark, sf, nl, rh, new, homes = day
    events = v.biz_events(spark, sf).withColumn("event_date", F.lit(v.RUN_DATE))
    report = daily.offline_metrics(rh, v.RH, homes, events)
    assert {r["rank"] for r in report.collect()} <= {1, 3, 12}
    tables = {n: nl.all_days(spark, n) for n in ("listings", "users", "candidates")}
    checks = daily.validate(nl, **tables, ranked=new, max_age_days=180, previous_day="20000114")
    verdict = {r["check"]: r["passed"] for r in checks.collect()}
    assert verdict["duplicate_ranked"] and verdict["rank_order"] and verdict["listing_age"]
    assert verdict["drift_users"] is False and verdict["listings_listing_id.for_sale"] is None
    homes_tables = {n: rh.all_days(spark, n) for n in ("listings", "users")}
    checks = daily.validate(rh, **homes_tables, candidates=homes, ranked=homes, max_age_days=180,
                            upstream=rh.all_days(spark, "recommendations"), score=None,
                            source=v.recommendations(spark, sf))
    verdict = {r["check"]: r["passed"] for r in checks.collect()}
    assert verdict["upstream_order"] and verdict["source_order"] and "rank_order" not in verdict


def test_loaded_days_are_found(spark, tmp_path):
    store = Store(str(tmp_path), "20200610")
    for day in ("20200401", "20200530", "20200601"):
        replace(store, day=day).save("users", spark.createDataFrame([(day,)], "user_id string"))
    assert store.newest_day(spark, "users", "20200610", 60) == "20200601"
    assert store.newest_day(spark, "users", "20200531", 10) == "20200530"
    assert store.newest_day(spark, "users", "20200520", 10) is None
    assert store.at_newest(spark, "users", 14).day == "20200601"
    with pytest.raises(ValueError):
        store.at_newest(spark, "users", 5)
    both = store.days(spark, "users", ["20200530", "20200601", "20200602"])
    assert rows(both.select("user_id")) == [("20200530",), ("20200601",)]


def test_two_days_are_written_side_by_side(spark, tmp_path, monkeypatch):
    store = Store(str(tmp_path), "20200601")
    ranked = spark.createDataFrame([("u", 1), ("u", 2), ("w", None)], "user_id string, seq_id int")
    users = spark.createDataFrame([("u", 3), ("w", 4)], "user_id string, user_group int")
    begun, save = Barrier(3), Store.save

    def together(self, name, df, columns=()):
        if self.day == store.day:
            begun.wait(60)  # breaks if one table waits for another
        return save(self, name, df, columns)

    monkeypatch.setattr(Store, "save", together)
    campaigns._two_days(spark, store, {"users": users},
                        {"candidates": ranked, "candidates_ranked": ranked})
    for name, df, earlier in (("users", users, [("w", 4)]), ("candidates", ranked, [("u", 1)]),
                              ("candidates_ranked", ranked, [("u", 2)])):
        assert rows(store.days(spark, name, ["20200601"]).drop("target_date")) == rows(df)
        assert rows(store.days(spark, name, ["20200531"]).drop("target_date")) == earlier


def test_a_table_that_cannot_be_written_raises(spark, tmp_path):
    store = Store(str(tmp_path), "20200601")
    broken = spark.createDataFrame([("u", 1)], "user_id string, seq_id int").withColumn(
        "user_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        campaigns._two_days(spark, store, {}, {"candidates": broken})


def test_validation_reads_the_history_once(spark, sf, monkeypatch):
    read, history = [], v.listing_history
    monkeypatch.setattr(v, "listing_history", lambda *args: read.append(args) or history(*args))
    monkeypatch.setattr(campaigns.daily, "validate", lambda store, listings, users, *rest: listings)
    monkeypatch.setattr(campaigns, "_report", lambda report: report)
    listings = q.QUERIES["validation_new_listings"](spark, sf)
    assert len(read) == 1
    assert rows(listings) == rows(q._listings(spark, sf, 60).select(*listings.columns))


# ------------------------------------------------------------------ physical plans

@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - {
    "lookback_scan", "lookback_scan_ymd", "union_years", "write_partitioned",
    "register_partitions", "message_sink", "new_listings_day", "recommended_homes_day",
    "member_map_table"}))
def test_no_python_no_cartesian_no_global_window(spark, sf, name):
    text = plan(q.QUERIES[name](spark, sf))
    for bad in ("Python", "CartesianProduct", "ObjectHashAggregate(keys=[]"):
        assert bad not in text
    for line in text.splitlines():
        assert not ("Window [" in line and "SinglePartition" in line)
        if "BroadcastNestedLoopJoin" in line:
            raise AssertionError(line)


def test_latest_rows_are_limited_before_their_shuffle(spark, sf):
    for name in ("latest_profile", "latest_listing", "filter_recommendations", "member_map"):
        assert "WindowGroupLimit" in plan(q.QUERIES[name](spark, sf)), name


def test_scans_read_only_needed_columns_and_push_filters(spark, sf):
    text = plan(lst.engagement_counts(v.biz_events(spark, sf)))
    assert "value:double" not in text and "ts:timestamp" not in text
    direct = spark.read.parquet(f"{sf}/customer.parquet").filter("c_acctbal > 9000").select("c_custkey")
    assert "PushedFilters: [IsNotNull(c_acctbal)" in plan(direct)


def test_email_eligibility_reads_the_log_once(spark, sf):
    text = plan(elig.email_eligible(v.email_sent(spark, sf), v.EVENTS_END, ["signup"]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_exclusive_bucketing_reads_each_input_once(spark, sf):
    text = plan(exp.bucket_exclusive(
        v.ranked(spark, sf), v.assignments(spark, sf, 0), v.assignments(spark, sf, 4), "NM", "H",
        "M", "O", ALLOCATION))
    assert text.count("FileScan") == 3
