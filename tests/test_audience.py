import json

import pytest
from pyspark.sql import functions as F

from nestline.config import EMAIL_FIELDS, ENVELOPES, PUSH_FIELDS
from nestline.operators import channels, eligibility as elig, experiment as exp, messages as msg
from tests.helpers import plan, rows

ALL_A = (("A", 10_000),)
HISTORY = "user_id string, experiment_name string, variation string"


def pairs(spark, *data):
    return spark.createDataFrame(data, "user_id string, listing_id string, state string, "
                                       "listing_state string, listing_city string, seq_id int")


def test_scrub_keeps_the_best_placed_row(spark):
    df = pairs(spark, ("u", "a", "NM", "NM", "x", 2), ("u", "a", "AK", "NM", "x", 1),
               ("unknown", "a", "NM", "NM", "x", 1), ("$CUSTOMER_ID_$", "a", "NM", "NM", "x", 1),
               ("u", "unknown", "NM", "NM", "x", 1), (None, "a", "NM", "NM", "x", 1),
               ("u", None, "NM", "NM", "x", 1))
    assert rows(elig.scrub_pairs(df), "user_id", "listing_id", "state", "seq_id") == [
        ("u", "a", "AK", 1)]


def test_saved_search_window_and_ids(spark):
    df = spark.createDataFrame(
        [("m1", "y", "20200601"), ("m1", "y", "20200502"), ("m2", "y", "20200501"),
         ("m", "y", "20200601"), ("m3", "n", "20200601"), (None, "y", "20200601")],
        "member_id string, is_saved_search string, snapshot_date_mst_yyyymmdd string")
    assert rows(elig.saved_search_users(df, "20200601")) == [("m1",)]


def test_opted_in_channels(spark):
    df = spark.createDataFrame([("visitor_1", (True, True)), ("1", (False, True)), ("2", (True, None)),
                                ("3", None)], "userId string, optIns struct<app: boolean, web: boolean>")
    assert rows(elig.opted_in(df, "web", "visitor_")) == [("1",)]
    assert rows(elig.opted_in(df, "app")) == [("2",), ("visitor_1",)]


def test_web_eligible_never_multiplies(spark):
    df = pairs(spark, ("u", "a", "NM", "NM", "x", 1), ("w", "a", "NM", "NM", "x", 1),
               ("z", "a", "NM", "NM", "x", 1))
    opted = spark.createDataFrame([("u",), ("u",), ("w",)], "user_id string")
    saved = spark.createDataFrame([("w",)], "user_id string")
    assert rows(elig.web_eligible(df, opted, saved), "user_id") == [("u",)]


def test_app_eligibility(spark):
    domzip = spark.createDataFrame(
        [("a", "87101", "NM", "20200601"), ("a", "87102", "NM", "20200503"), ("a", "1", "TX", "20200502"),
         ("b", "1", "NM", "20200601"), ("c", "1", "NM", "20200601")],
        "member_id string, ldp_dominant_zip string, listing_state string, run_date_yyyymmdd string")
    sent = spark.createDataFrame(
        [("b", "other", "canvas", "2020", "05", "03"), ("c", "camp", None, "2020", "05", "02"),
         ("a", None, None, "2020", "06", "01")],
        "external_user_id string, campaign_id string, canvas_id string, year string, month string, day string")
    told = elig.recently_notified(sent, "20200601", ["camp"], ["canvas"])
    assert rows(told) == [("b",)]
    opted = spark.createDataFrame([("a",), ("b",), ("c",)], "user_id string")
    got = elig.app_eligible(elig.domzip_users(domzip, "20200601"), told, opted)
    assert rows(got) == [("a", "NM"), ("c", "NM")]


SENT = "customer_id string, campaign_id string, email string, year string, month string, day string"


def test_email_cap_boundaries_and_null_addresses(spark):
    df = spark.createDataFrame([
        ("d2", "cap", "d2@x", "2020", "06", "08"), ("d3", "cap", "d3@x", "2020", "06", "07"),
        ("two", "cap", "a@x", "2020", "06", "10"), ("two", "news", "b@x", "2020", "06", "10"),
        ("nul", "news", None, "2020", "05", "01"), ("nul", "cap", None, "2020", "06", "09"),
        ("ok", "news", None, "2020", "05", "01"), ("ok", "news", None, "2020", "05", "01"),
        ("old", "news", "o@x", "2019", "12", "13"), ("in", "news", "i@x", "2019", "12", "14"),
        (" ", "news", "x@x", "2020", "06", "01"), ("nc", " ", "x@x", "2020", "06", "01"),
        ("nn", None, "x@x", "2020", "06", "01")], SENT)
    assert rows(elig.email_eligible(df, "20200610", ["cap"])) == [
        ("d3", "d3@x"), ("in", "i@x"), ("ok", None), ("two", "b@x")]


def test_email_eligible_equals_the_set_difference(spark):
    df = spark.range(5000).selectExpr(
        "if(id % 50 = 0, '', cast(id % 97 AS string)) customer_id",
        "if(id % 11 = 0, 'cap', if(id % 13 = 0, '', 'news')) campaign_id",
        "if(id % 7 = 0, null, concat('m', id % 5)) email", "'2020' year", "'06' month",
        "lpad(cast(1 + id % 10 AS string), 2, '0') day")
    known = df.filter("customer_id is not null and trim(customer_id) != ''")
    ever = known.filter("campaign_id is not null and trim(campaign_id) != ''")
    capped = known.filter("campaign_id = 'cap' and concat(year, month, day) between '20200608' and '20200610'")
    want = ever.select("customer_id", "email").distinct().exceptAll(
        capped.select("customer_id", "email").distinct())
    assert rows(elig.email_eligible(df, "20200610", ["cap"])) == rows(want)


def test_exclusive_buckets(spark):
    df = pairs(spark, *[(u, "a", s, s, "x", 1) for u, s in [
        ("rest", "TX"), ("held", "NM"), ("both", "TX"), ("both", "NM"), ("other", "TX"),
        ("was_main", "NM"), ("was_hold", "TX"), ("swap", "TX"), ("swap", "NM"), ("none", None)]])
    own = spark.createDataFrame([("was_main", "MAIN", "A"), ("was_hold", "HOLD", "A"), ("swap", "HOLD", "A"),
                                 ("rest", "MAIN", "A"), ("held", "HOLD", "A")], HISTORY)
    other = spark.createDataFrame([("other", "OTHER", "A"), ("rest", "MAIN", "A")], HISTORY)
    got = exp.bucket_exclusive(df, own, other, "NM", "HOLD", "MAIN", "OTHER", ALL_A)
    assert rows(got) == [("both", "MAIN", "A"), ("held", "HOLD", "A"), ("rest", "MAIN", "A"),
                         ("swap", "HOLD", "A")]


def test_sticky_buckets_keep_history(spark):
    df = pairs(spark, *[(u, "a", "NM", "NM", "x", i) for u in
                        ("kept", "elsewhere", "mixed", "own", "fresh", "own_fresh") for i in (1, 2)])
    shared = spark.createDataFrame(
        [("kept", "ABC", "V2"), ("kept", "ABC", "V2"), ("elsewhere", "AAA", "V1"), ("mixed", "ABC", "V1"),
         ("mixed", "AAA", "V1"), ("own", "ABC", "V1"), ("absent", "ABC", "V1")], HISTORY)
    own = spark.createDataFrame([("own", "AB", "A"), ("own_fresh", "AB", "A"), ("kept", "X", "A")], HISTORY)
    got = exp.bucket_sticky(df, shared, own, "ABC", "AB", ALL_A)
    assert rows(got) == [("fresh", "AB", "A"), ("kept", "ABC", "V2"), ("own_fresh", "AB", "A")]


def test_bucketing_an_empty_side_keeps_its_schema(spark):
    none = pairs(spark).limit(0)
    assert exp.bucket_all(none, "AB", ALL_A).columns == ["user_id", "experiment_name", "variation"]
    assert exp.bucket_all(none, "AB", ALL_A).count() == 0


def test_app_buckets_keep_state(spark):
    df = spark.createDataFrame([("u", "NM"), ("u", "TX"), ("u", "TX"), (None, "NM")],
                               "user_id string, listing_state string")
    assert rows(exp.bucket_app(df, "APP", ALL_A)) == [("u", "NM", "APP", "A"), ("u", "TX", "APP", "A")]


def test_attach_variation(spark):
    df = pairs(spark, *[(u, "a", "NM", "NM", "x", 1) for u in "abcd"])
    bucketed = spark.createDataFrame([("a", "AAA", "C"), ("b", "ABC", "V1"), ("c", "ABC", "V2"),
                                      ("d", "AB", "V1")], HISTORY)
    assert rows(channels.attach_variation(df, bucketed, "V1", "AAA", "ABC"), "user_id") == [("a",), ("b",)]
    assert rows(channels.attach_variation(df, bucketed, "V1"), "user_id") == [("b",), ("d",)]


def test_app_candidates_match_user_and_state(spark):
    df = pairs(spark, ("u", "a", "NM", "NM", "x", 1), ("u", "b", "NM", "TX", "x", 2), ("w", "a", "NM", "NM", "x", 1))
    bucketed = spark.createDataFrame([("u", "NM", "APP", "V1"), ("w", "NM", "APP", "V2")],
                                     "user_id string, listing_state string, experiment_name string, variation string")
    assert rows(channels.app_candidates(df, bucketed, "V1"), "user_id", "listing_id") == [("u", "a")]


def test_email_candidates_take_the_first_place(spark):
    df = pairs(spark, ("u", "b", "NM", "NM", "Taos", 1), ("u", "a", "TX", "TX", "Waco", 1),
               ("u", "c", "NM", "NM", "Raton", 2), ("w", "a", "TX", "TX", "Waco", 1))
    users = spark.createDataFrame([("u", "1@x"), ("u", "2@x")], "customer_id string, email string")
    got = channels.email_candidates(df, users, "V1", "mail-v1")
    assert got.count() == 6
    assert rows(got.select("reccity", "recstate", "variation", "experiment_name").distinct()) == [
        ("Taos", "NM", "V1", "mail-v1")]


def listing_rows(spark, data):
    """Candidates with every message column; seq_id drives order."""
    df = spark.createDataFrame(data, "user_id string, listing_id string, seq_id int, variation string")
    text = {c: F.concat(F.lit(c + "-"), "listing_id") for c in set(PUSH_FIELDS + EMAIL_FIELDS)
            - {"listing_id", "seq_id", "listing_square_feet"}}
    return df.withColumns({**text, "experiment_name": F.lit("E"),
                           "listing_square_feet": F.lit(None).cast("string")})


def test_messages_are_ordered_complete_and_bounded(spark):
    df = listing_rows(spark, [("u", f"l{i}", i, "V1") for i in (3, 1, 2, 5, 4)] + [("w", "l1", 1, None)])
    whole = msg.assemble(df, PUSH_FIELDS, None)
    assert [(r["part"], r["parts"]) for r in whole.collect()] == [(0, 1)]
    assert [r["seq_id"] for r in whole.first()["recommendations"]] == [1, 2, 3, 4, 5]
    assert list(whole.first()["recommendations"][0].asDict()) == list(PUSH_FIELDS)
    parts = {r["part"]: [x["seq_id"] for x in r["recommendations"]]
             for r in msg.assemble(df, PUSH_FIELDS, 2).collect()}
    assert parts == {0: [1, 2], 1: [3, 4], 2: [5]}
    # places repeat per state and may be missing: the user's own rows are counted, not the places
    odd = listing_rows(spark, [("u", f"l{i}", None if i < 3 else 1, "V1") for i in range(6)])
    sizes = {(r["part"], r["parts"]): len(r["recommendations"]) for r in msg.assemble(odd, PUSH_FIELDS, 4).collect()}
    assert sizes == {(0, 2): 4, (1, 2): 2}


def test_envelope_routes_by_length_and_shows_the_other_id_as_null(spark):
    df = listing_rows(spark, [("m" * 24, "l1", 1, "V1"), ("v" * 25, "l1", 1, "V1")])
    sent = msg.envelope(msg.assemble(df, msg.message_fields("new_listings_email"), None),
                        "new_listings_email", "id", "name")
    bodies = {r["user_id"][0]: json.loads(r["body"]) for r in sent.collect()}
    assert bodies["m"]["payload"]["recipients"] == [{"memberId": "m" * 24, "visitorId": None}]
    assert bodies["v"]["payload"]["recipients"] == [{"memberId": None, "visitorId": "v" * 25}]
    assert bodies["m"]["meta"] == {"version": "2.1", "clientId": "id", "clientName": "name",
                                   "notificationType": "recommended_homes_email-v2",
                                   "experiment": {"key": "E", "variation": "V1"}}
    item = bodies["m"]["payload"]["content"]["recommendations"][0]
    assert item["reccity"] == "reccity-l1" and "listing_square_feet" not in item
    assert len(item) == len(EMAIL_FIELDS) - 1
    ids = [r["message_id"] for r in sent.collect()]
    assert len(set(ids)) == 2 and sorted(ids) == sorted(r["message_id"] for r in sent.collect())


def test_every_event_type_has_its_envelope(spark):
    df = spark.createDataFrame([("u", "", "C", "E")],
                               "user_id string, recommendations string, variation string, experiment_name string")
    for event, (version, kind) in [*ENVELOPES.items(), ("else", ENVELOPES["recommended_homes"])]:
        meta = json.loads(msg.envelope(df, event, "i", "n").first()["body"])["meta"]
        assert (meta["version"], meta["notificationType"]) == (version, kind)
    assert len(ENVELOPES) == 7 and len(PUSH_FIELDS) == 22 and len(EMAIL_FIELDS) == 27


def test_control_messages_are_empty_and_distinct(spark):
    df = spark.createDataFrame([("u", "NM", "APP", "C"), ("u", "TX", "APP", "C"), ("w", "NM", "APP", "V1")],
                               "user_id string, listing_state string, experiment_name string, variation string")
    control = msg.control_messages(df)
    assert rows(control) == [("u", "", "C", "APP")]
    body = json.loads(msg.envelope(control, "dom_zip_app", "i", "n").first()["body"])
    assert body["payload"]["content"] == {"recommendations": ""}


def test_repeated_pairs_leave_the_same_row_however_they_are_dealt(spark):
    made = spark.createDataFrame(
        [("1", "7", s, "NM", "CA", status, score) for s in (2, 1) for status in ("sold", "for sale", None) for score in (5.0, 3.0)],
        "user_id string, listing_id string, seq_id int, state string, listing_state string, listing_status string, match_score double")
    for n in (1, 3, 7):
        kept = elig.scrub_pairs(made.repartition(n).orderBy(F.rand(n))).collect()
        assert [tuple(r) for r in kept] == [("1", "7", 1, "NM", "CA", None, 3.0)]


def test_scrubbed_and_assembled_rows_are_shuffled_side_by_side_with_their_listing(spark):
    df = spark.createDataFrame([("u", "l", 1, "V1", "x")], "user_id string, listing_id string, "
                               "seq_id int, variation string, experiment_name string")
    scrubbed = plan(elig.scrub_pairs(df))
    assert "hashpartitioning(listing_id" in scrubbed
    assert "Sort [listing_id" in scrubbed and "Sort [user_id" not in scrubbed
    fields = ("listing_id",)
    built = plan(msg.assemble(df.withColumn("listing_state", F.lit("NM")), fields, None))
    assert built.count("Exchange hashpartitioning") == 1
    assert built.index("partial_collect_list") < built.index("Exchange")


def test_messages_in_parts_are_made_where_the_rows_of_their_user_are_numbered(spark):
    df = listing_rows(spark, [(u, f"l{i:03d}", i // 2 if i % 5 else None, "V1") for u in "ab" for i in range(57)])
    built = msg.assemble(df.repartition(3), ("listing_id", "seq_id"), 4)
    assert plan(built).count("Exchange hashpartitioning") == 1
    got = {(r["user_id"], r["part"], r["parts"]): [tuple(x) for x in r["recommendations"]] for r in built.collect()}
    wanted = sorted(((f"l{i:03d}", i // 2 if i % 5 else None) for i in range(57)), key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
    assert got == {(u, p, 15): wanted[4 * p:4 * p + 4] for u in "ab" for p in range(15)}


@pytest.mark.parametrize("most", [0, 10])
def test_candidates_of_a_long_list_of_users_are_the_same(spark, monkeypatch, most):
    monkeypatch.setattr(elig, "SHORT_LIST", most)
    df = spark.createDataFrame(
        [("u", "l1", 2, "NM"), ("u", "l1", 1, "TX"), ("u", "l2", None, "NM"), ("w", "l1", 1, "NM"),
         ("unknown", "l1", 1, "NM")], "user_id string, listing_id string, seq_id int, state string")
    users, short = elig.settled(spark.createDataFrame([("u",), ("unknown",), (None,)], "user_id string"))
    assert short == (most == 10)
    got = elig.scrub_pairs_of(df, users, short)
    assert rows(got) == [("u", "l1", 1, "TX"), ("u", "l2", None, "NM")]


def test_candidates_of_a_short_list_are_not_shuffled_to_it(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pairs(spark, ("u", "l1", "NM", "NM", "City", 1), ("w", "l1", "NM", "NM", "City", 2))
        users = spark.createDataFrame([("u", "u@mail")], "customer_id string, email string")
        made = plan(channels.email_candidates(df, users, "V1", "mail-v1"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert made.count("LeftSemi") == 2 and "SortMergeJoin [user_id" not in "".join(
        line for line in made.splitlines() if "LeftSemi" in line)
