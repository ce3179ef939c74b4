"""Channel days and validation reports: the daily plans run through their written tables, next to SQL."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from nestline.config import EMAIL_FIELDS, PUSH_FIELDS
from nestline.operators import (candidates as cand, eligibility as elig, experiment as exp, listings as lst,
                                profile as prof)
from nestline.plans import daily
from nestline.plans.store import Store
from nestline.sample import queries as q, views as v
from nestline.sources.scratch import scratch_path

CLIENT = ("client", "client name")


def _sent(spark: SparkSession, store: Store, event_type: str, fields: Sequence[str], delivered: int) -> DataFrame:
    """Every field of the messages that were written, and the number that the delivery reported."""
    lines = spark.read.text(f"{store.path('messages_' + event_type)}/target_date={store.day}")
    return q.parsed_bodies(lines, "value", fields).withColumn("delivered", F.lit(delivered).cast("long"))


def _delivered(sql: str) -> str:
    """With the number of all messages, each of which has one first place."""
    return f"SELECT *, count(*) FILTER (place = 0) OVER () AS delivered FROM ({sql})"


# ------------------------------------------------------------------ web

v.SQL["v_web_eligible"] = f"""
    SELECT * FROM v_clean_ranked WHERE user_id IN (SELECT user_id FROM {q._WEB_OPTED})
      AND user_id NOT IN (SELECT member_id FROM v_search WHERE is_saved_search = 'y'
                            AND length(member_id) > 1 AND day BETWEEN '20010702' AND '20010801')"""
v.SQL["v_web_users"] = q._EXCLUSIVE.replace("v_clean_ranked", "v_web_eligible")
v.SQL["v_web_all"] = f"""
    SELECT user_id, 'AB' AS experiment_name, {q._variation_sql("'AB'")} AS variation
    FROM (SELECT DISTINCT user_id FROM v_web_eligible)"""


@q.query(_delivered(q.bodies_sql("""
    SELECT c.*, b.experiment_name, b.variation FROM v_web_eligible c JOIN v_web_users b USING (user_id)
    WHERE b.experiment_name = 'HOLD' OR (b.experiment_name = 'MAIN' AND b.variation = 'V1')""",
    "recommended_homes", PUSH_FIELDS)))
def web_push_day(spark, sf):
    """First campaign on the web: eligibility, exclusive experiments, and all messages of a day."""
    store = Store(scratch_path(spark, "web"), v.ORDERS_END)
    picked = daily.web_bucketing(
        store, v.ranked(spark, sf), v.opt_ins(spark, sf), v.search_profiles(spark, sf),
        lambda eligible: exp.bucket_exclusive(
            eligible, v.assignments(spark, sf, 0), v.assignments(spark, sf, 4), "NM", q.HOLD, q.MAIN,
            q.OTHER, q.ALLOCATION, q.HOLDOUT_ALLOCATION), "V1", q.HOLD, q.MAIN)
    n = daily.deliver(store, picked, "recommended_homes", *CLIENT, v.RH.recs_per_message)
    return _sent(spark, store, "recommended_homes", PUSH_FIELDS, n)


@q.query(_delivered(q.bodies_sql("""
    SELECT c.*, b.experiment_name, b.variation FROM v_web_eligible c JOIN v_web_all b USING (user_id)
    WHERE b.variation = 'V2'""", "new_listings", PUSH_FIELDS)))
def web_push_day_full_ramp(spark, sf):
    """Second campaign on the web: every eligible user takes part in one experiment."""
    store = Store(scratch_path(spark, "web"), v.ORDERS_END)
    picked = daily.web_bucketing(
        store, v.ranked(spark, sf), v.opt_ins(spark, sf), v.search_profiles(spark, sf),
        lambda eligible: exp.bucket_all(eligible, "AB", q.ALLOCATION), "V2")
    n = daily.deliver(store, picked, "new_listings", *CLIENT, v.NL.recs_per_message)
    return _sent(spark, store, "new_listings", PUSH_FIELDS, n)


# ------------------------------------------------------------------ app

#: Notifications of January 2024, as if of the month before ORDERS_END.
v.SQL["v_app_users"] = f"""
    SELECT user_id, listing_state, 'APP' AS experiment_name, {q._variation_sql("'APP'")} AS variation
    FROM (SELECT DISTINCT member_id AS user_id, listing_state FROM v_domzip
          WHERE day BETWEEN '20010703' AND '20010801'
            AND member_id IN (SELECT user_id FROM {q._APP_OPTED})
            AND member_id NOT IN (
              SELECT external_user_id FROM v_push_sent
              WHERE '200107' || substr(day, 7) BETWEEN '20010703' AND '20010801'
                AND (campaign_id = 'purchase' OR canvas_id = 'canvas5')))"""


def _app_users(spark: SparkSession, sf: str, store: Store) -> DataFrame:
    sent = v.push_sent(spark, sf).withColumns({"year": F.lit("2001"), "month": F.lit("07")})
    return daily.app_users(store, v.dominant_zips(spark, sf), sent, v.opt_ins(spark, sf), ["purchase"],
                           ["canvas5"], "APP", q.ALLOCATION)


@q.query(_delivered(q.bodies_sql("""
    SELECT c.*, b.experiment_name, b.variation
    FROM v_clean_ranked c JOIN v_app_users b USING (user_id, listing_state) WHERE b.variation = 'V1'""",
    "recommended_homes_app", PUSH_FIELDS)))
def app_push_day(spark, sf):
    """App users of the day, the candidates of one variation in their states, and all messages."""
    store = Store(scratch_path(spark, "app"), v.ORDERS_END)
    picked = daily.app_bucketing(store, v.ranked(spark, sf), _app_users(spark, sf, store), "V1")
    n = daily.deliver(store, picked, "recommended_homes_app", *CLIENT, v.RH.recs_per_message)
    return _sent(spark, store, "recommended_homes_app", PUSH_FIELDS, n)


@q.query(q._CONTROL_BODIES.replace(q._BUCKET_APP, "v_app_users"))
def app_control_day(spark, sf):
    """Messages of the control cell, as they were written."""
    store = Store(scratch_path(spark, "app"), v.ORDERS_END)
    n = daily.deliver_control(store, _app_users(spark, sf, store), "dom_zip_app", *CLIENT)
    lines = spark.read.text(f"{store.path('messages_dom_zip_app')}/target_date={store.day}")
    return lines.select(F.col("value").alias("body"), F.lit(n).cast("long").alias("delivered"))


# ------------------------------------------------------------------ e-mail

@q.query(_delivered(q.bodies_sql(q.EMAIL_SOURCE, "new_listings_email", EMAIL_FIELDS, ", email NULLS FIRST")))
def email_push_day(spark, sf):
    """Mailable users of the day, their candidates with the first place, and all messages."""
    store = Store(scratch_path(spark, "email"), v.EVENTS_END)
    users = daily.email_users(store, v.email_sent(spark, sf), q.CAP_CAMPAIGNS)
    picked = daily.email_bucketing(store, v.ranked(spark, sf), users, "V1", "mail-v1")
    n = daily.deliver(store, picked, "new_listings_email", *CLIENT, v.NL.recs_per_message)
    return _sent(spark, store, "new_listings_email", EMAIL_FIELDS, n)


# ------------------------------------------------------------------ offline metrics

@q.query(f"""SELECT CAST(k AS INTEGER) AS rank, round(avg(precision), 5) AS mean_precision,
                    round(avg(recall), 5) AS mean_recall, round(avg(ndcg), 5) AS mean_ndcg,
                    count(*) AS user_coverage FROM ({q._USER_METRICS}) GROUP BY k""")
def offline_metrics_day(spark, sf):
    """The report as it is written, a folder for each cut-off."""
    store = Store(scratch_path(spark, "metrics"), "20240101")
    daily.offline_metrics(store, v.NL, v.ranked(spark, sf), v.biz_events(spark, sf))
    written = spark.read.parquet(f"{store.path('metrics')}/target_date={store.day}")
    return written.withColumns({"rank": F.col("rank").cast("int"), **{
        c: F.round(c, 5) for c in ("mean_precision", "mean_recall", "mean_ndcg")}})


# ------------------------------------------------------------------ validation

_NUMBERS = ("n_keys", "n_rows", "n_total", "n_violations", "n_users", "n_first", "n_empty_first",
            "n_current", "n_previous")
_KEYS = ("listing_id", "property_id", "listing_status")
_PLACE = ("listing_type", "listing_city", "listing_state", "listing_postal_code")


def _report(report: DataFrame) -> DataFrame:
    """Every check with its verdict and all numbers of its detail, -1 where it has none."""
    shape = ", ".join(f"{n} long" for n in _NUMBERS) + ", pct double"
    return (report.select("check", "passed", F.from_json("detail", shape).alias("d"))
            .select("check", q.verdict("passed"), "d.*").withColumn("pct", F.round("pct", 6))
            .fillna(-1, [*_NUMBERS, "pct"]))


def _empty(*columns: str) -> str:
    return " OR ".join(f"coalesce({c}, '') = ''" for c in columns)


def _zero(*columns: str) -> str:
    return " OR ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0) = 0" for c in columns)


_DETAILS = f"""{_empty("ldp_url", "listing_photo_url")} OR {_zero(
    "listing_number_of_bath_rooms", "listing_number_of_bed_rooms", "listing_current_price",
    "listing_lot_square_feet", "listing_square_feet", "listing_photo_count")}"""


def _rates(name: str, table: str, key: str, conditions: dict[str, str], limits: dict[str, float]) -> list[str]:
    return [f"""SELECT '{name}.' || "check" AS "check", passed, n_keys, n_rows, n_total, pct
                FROM ({q._rate_sql(table, key, conditions, limits)})"""]


def _violations(name: str, rows: str) -> list[str]:
    return [f"""SELECT '{name}' AS "check", count(*) = 0 AS passed, count(*) AS n_violations FROM ({rows})"""]


def _duplicates(name: str, table: str, *keys: str) -> list[str]:
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return _violations(name, f"SELECT 1 FROM {table} WHERE {known} GROUP BY {', '.join(keys)} HAVING count(*) > 1")


def _breaks(name: str, table: str, keys: str, value: str, order: str, rising: bool) -> list[str]:
    """Groups of a table in which a value falls (or rises) along the order."""
    return _violations(name, f"""
        SELECT 1 FROM (SELECT {keys}, {value} {'<' if rising else '>'}
                         lag({value}) OVER (PARTITION BY {keys} ORDER BY {order}, {value}) AS broken FROM {table})
        GROUP BY {keys} HAVING bool_or(broken)""")


def _drift(name: str, table: str, key: str, earlier: str) -> list[str]:
    return [f"""SELECT 'drift_{name}' AS "check", 100.0 * abs(n_current - n_previous) / n_previous <= 20 AS passed,
                       n_current, n_previous, round(100.0 * abs(n_current - n_previous) / n_previous, 6) AS pct
                FROM (SELECT count(DISTINCT {key}) AS n_current,
                             count(DISTINCT {key}) FILTER ({earlier}) AS n_previous FROM {table})"""]


def _volume(name: str, table: str, key: str, label: str, condition: str) -> list[str]:
    return [f"""SELECT '{name}_{key}.{label}' AS "check", NULL AS passed,
                       count(DISTINCT {key}) FILTER ({condition}) AS n_keys,
                       count(*) FILTER ({condition}) AS n_rows, count(DISTINCT {key}) AS n_total FROM {table}"""]


def _volumes(listings: str, users: str, candidates: str, ranked: str) -> list[str]:
    for_sale = ("listing_id", "for_sale", "listing_status = 'for sale'")
    everyone = ("user_id", "all", "TRUE")
    return (_volume("listings", listings, *for_sale) + _volume("users", users, *everyone)
            + _volume("candidates", candidates, *for_sale) + _volume("candidates", candidates, *everyone)
            + _volume("ranked", ranked, *for_sale) + _volume("ranked", ranked, *everyone))


def _first_slot(ranked: str) -> list[str]:
    return [f"""SELECT 'first_slot' AS "check", n_users = n_first AND n_empty_first = 0 AS passed, n_users, n_first,
                       n_empty_first
                FROM (SELECT count(DISTINCT user_id) AS n_users,
                             count(DISTINCT user_id) FILTER (seq_id = 1) AS n_first,
                             count(DISTINCT user_id) FILTER (seq_id = 1 AND ({_empty(*_PLACE)})) AS n_empty_first
                      FROM {ranked})"""]


def _common(listings: str, users: str, candidates: str, ranked: str, slot: Sequence[str], days: int) -> list[str]:
    """The checks of both campaigns."""
    return (
        _duplicates("duplicate_listings", listings, "listing_id")
        + _duplicates("duplicate_properties", listings, "listing_id", "property_id")
        + _duplicates("duplicate_candidates", candidates, "user_id", "listing_id")
        + _duplicates("duplicate_ranked", ranked, *slot)
        + _rates("listings", listings, "listing_id",
                 {"key_fields": _empty(*_KEYS), "fields": _empty(*_KEYS, *_PLACE)}, {"fields": 10.0})
        + _rates("users", users, "user_id", {
            "user_id": _empty("user_id"), "score": _zero("score"), "zip_code": _empty("zip_code"),
            "mean": _zero("overall_mean"), "ceiling": _zero("price_ceiling"),
            "std_dev": _zero("overall_std_dev"),
            "std_dev_below_67": "coalesce(overall_std_dev < 67, false)"}, q._USER_LIMITS)
        + _rates("candidates", candidates, "listing_id", {"fields": _empty(*_KEYS, *_PLACE)}, {})
        + _rates("ranked", ranked, "listing_id", {
            "fields": f"{_empty(*_KEYS, *_PLACE)} OR {_zero('seq_id')}", "details": _DETAILS}, {"details": 10.0})
        + _first_slot(ranked)
        + _violations("listing_age", f"SELECT 1 FROM {listings} WHERE dom > {days}")
        + _volumes(listings, users, candidates, ranked))


def _united(parts: list[str]) -> str:
    blank = ", ".join([f"CAST(NULL AS BIGINT) AS {n}" for n in _NUMBERS] + ["CAST(NULL AS DOUBLE) AS pct"])
    parts = [f"""SELECT '' AS "check", true AS passed, {blank} WHERE false""", *parts]
    numbers = ", ".join(f"coalesce({n}, -1) AS {n}" for n in (*_NUMBERS, "pct"))
    return f'SELECT "check", {q.VERDICT_SQL}, {numbers} FROM (' + " UNION ALL BY NAME ".join(parts) + ")"


#: Which rows of a table were there the day before.
_EARLIER = {"users": "user_group % 3 <> 0", "candidates": "seq_id % 2 = 1", "listings": "dom % 2 = 0",
            "candidates_ranked": "seq_id > 1"}


def _two_days(spark: SparkSession, store: Store, shuffled: dict[str, DataFrame],
              rows: dict[str, DataFrame]) -> None:
    """Writes the tables for the store's day, and what was there the day before.

    Tables made by shuffles are read back for the day before; those made row by row are made again,
    which costs less than to read them. No table waits for the slowest task of another one.
    """
    before = replace(store, day=elig.day_before(store.day, 1))

    def earlier(name: str, df: DataFrame) -> None:
        before.save(name, df.where(_EARLIER[name]))

    def both(name: str, df: DataFrame) -> None:
        earlier(name, store.save(name, df))

    # the longest first
    steps = [(step, *table) for step in (store.save, earlier) for table in rows.items()]
    steps += [(both, *table) for table in shuffled.items()]
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step), *table) for step, *table in steps]
    for step in started:
        step.result()


v.SQL["v_moved"] = f"""
    SELECT u.*, u.row_id * 7 % 5 AS moved FROM ({q._FLAT}) u WHERE row_id IS NOT NULL"""


@q.query(_united(
    _common("v_listings_60", "v_users_nl", "v_ranked", "v_ranked", ("user_id", "listing_id"), 5)
    + _breaks("rank_order", "v_ranked", "user_id", "match_score", "seq_id", False)
    + _drift("users", "v_users_nl", "user_id", _EARLIER["users"])
    + _drift("candidates", "v_ranked", "user_id", _EARLIER["candidates"])
    + _drift("listings", "v_listings_60", "listing_id", _EARLIER["listings"])
    + _drift("candidates_ranked", "v_ranked", "listing_id", _EARLIER["candidates_ranked"])))
def validation_new_listings(spark, sf):
    """All checks of a day of the campaign that a model ranks, with those against the day before."""
    store = Store(scratch_path(spark, "validation"), v.RUN_DATE)
    # as in the daily job, the history is read once for both windows
    current = store.save("current_listings", q._listings(spark, sf, 180))
    shuffled = {"listings": lst.listings_within(current, 60),
                "users": q._users(spark, sf, medians=prof.group_median(current))}
    ranked = v.ranked(spark, sf)
    rows = {"candidates": ranked, "candidates_ranked": ranked}
    _two_days(spark, store, shuffled, rows)
    listings, users, candidates, ranked = (
        store.days(spark, name, [store.day]).drop("target_date") for name in (*shuffled, *rows))
    return _report(daily.validate(store, listings, users, candidates, ranked, 5))


@q.query(_united(
    _common("v_listings_180", "v_users_rh", "v_ranked", "v_clean_ranked", ("user_id", "listing_id", "state"), 90)
    + _breaks("upstream_order", "(SELECT r.user_id, r.state, r.seq_id, u.moved FROM v_clean_ranked r "
              "JOIN v_moved u USING (user_id, listing_id, state))", "user_id, state", "moved", "seq_id", True)
    + _breaks("source_order", "(SELECT * FROM v_moved)", "user_id, state", "row_id", "moved", True)
    + _rates("upstream", f"(SELECT *, row_id * 7 % 5 AS moved FROM ({q._FLAT}))", "user_id", {
        "fields": f"{_empty('user_id', 'listing_id', 'state')} OR moved IS NULL"}, {"fields": 100.0})))
def validation_recommended_homes(spark, sf):
    """All checks of a day of the campaign that keeps upstream's order, which is shuffled on purpose."""
    store = Store(scratch_path(spark, "validation"), v.RUN_DATE)
    upstream = cand.explode_ranked(v.recommendations(spark, sf)).withColumn("row_id", F.col("row_id") * 7 % 5)
    listings = store.save("listings", q._listings(spark, sf, 180))
    users = store.save("users", q._users(spark, sf, v.RH))
    ranked = store.save("candidates_ranked", elig.scrub_pairs(v.ranked(spark, sf)))
    return _report(daily.validate(
        store, listings, users, v.ranked(spark, sf), ranked, 90, score=None,
        upstream=store.save("recommendations", upstream), source=v.recommendations(spark, sf)))
