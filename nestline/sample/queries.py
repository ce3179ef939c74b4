"""Every operator as a query on whole test tables, next to the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from nestline.config import EMAIL_FIELDS, ENVELOPES, PUSH_FIELDS
from nestline.functions import gain
from nestline.functions.hashing import user_group
from nestline.functions.identity import is_real_id
from nestline.operators import (candidates as cand, channels, eligibility as elig,
                                experiment as exp, keyed, listings as lst, messages as msg,
                                metrics, profile as prof, quality as dq, scoring, skew, snapshot)
from nestline.plans import daily
from nestline.plans.store import Store
from nestline.sample import views as v
from nestline.session import tune
from nestline.sources import readers, writers
from nestline.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ALLOCATION = (("V1", 4000), ("V2", 4000), ("C", 1500))
HOLDOUT_ALLOCATION = (("A1", 5000), ("A2", 5000))
CAP_CAMPAIGNS = ("signup", "error")
MAIN, HOLD, OTHER = "MAIN", "HOLD", "OTHER"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        @wraps(function)
        def tuned(spark: SparkSession, sf: str) -> DataFrame:
            return function(tune(spark), sf)

        QUERIES[function.__name__] = tuned
        if sql is not None:
            ORACLE[function.__name__] = v.with_views(sql)
        return function
    return add


def rounded(df: DataFrame) -> DataFrame:
    """Real numbers to 6 decimals (4 for single precision), so engines can be compared."""
    exact = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, DoubleType):
            exact[field.name] = F.round(field.name, 6)
        elif isinstance(field.dataType, FloatType):
            exact[field.name] = F.round(F.col(field.name).cast("double"), 4)
    return df.withColumns(exact) if exact else df


# ------------------------------------------------------------------ profiles and users

def _listings(spark: SparkSession, sf: str, days: int) -> DataFrame:
    return lst.build_listings(v.listing_history(spark, sf), v.RUN_DATE, days,
                              url="property_url")


def _medians(spark: SparkSession, sf: str) -> DataFrame:
    return prof.group_median(_listings(spark, sf, 180))


def _users(spark: SparkSession, sf: str, config=v.NL,
           medians: DataFrame | None = None) -> DataFrame:
    # ties between snapshots of one day go to the smaller snapshot id
    medians = _medians(spark, sf) if medians is None else medians
    return prof.build_users(v.profiles(spark, sf), medians, config, ("snapshot_id",))


def _written(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A step several others start from, as the daily plans write it."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query("""SELECT user_id, snapshot_id, target_date, round(overall_mean, 6) AS overall_mean
          FROM v_latest_profile""")
def latest_profile(spark, sf):
    profiles = v.profiles(spark, sf).filter(is_real_id("user_id"))
    return rounded(snapshot.latest_per_key(profiles, ["user_id"], ["target_date"],
                                           ["snapshot_id"])
                   .select("user_id", "snapshot_id", "target_date",
                           F.col("price_stats.overall_mean").try_cast("double")
                           .alias("overall_mean")))


@query("""SELECT user_id, snapshot_id FROM v_profiles
          WHERE user_id NOT IN ('unknown', 'NULL', 'null', '$CUSTOMER_ID_$', '$customer_id_$', '')
          """)
def scrub_ids(spark, sf):
    return (v.profiles(spark, sf).filter(is_real_id("user_id")).select("user_id", "snapshot_id"))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS user_id,
                 CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 50
                   AS user_group, count(*) AS n_orders
          FROM orders GROUP BY 1, 2""")
def user_groups(spark, sf):
    user = F.col("o_custkey").cast("string")
    return (v.table(spark, sf, "orders").groupBy(user.alias("user_id"))
            .agg(F.count(F.lit(1)).alias("n_orders"))
            .withColumn("user_group", user_group("user_id", 50).cast("long")))


@query("""SELECT snapshot_id, user_id, zip_code, round(score, 6) AS score FROM (
            SELECT p.snapshot_id, p.user_id, s.zip_code, s.score,
                   row_number() OVER (PARTITION BY p.snapshot_id
                                      ORDER BY s.score DESC NULLS LAST, s.zip_code) AS rn
            FROM v_profiles p LEFT JOIN v_zip_scores s USING (snapshot_id))
          WHERE rn <= 3""")
def top_zips(spark, sf):
    """Best zips of every profile snapshot, ordered inside the nested array."""
    rows = v.profiles(spark, sf).select("snapshot_id", "user_id", "zip_stats")
    return rounded(prof.top_n_from_array(rows, "zip_stats", "category_name", "score", 3))


@query("""SELECT user_id, brand, CAST(n AS BIGINT) AS n FROM (
            SELECT o_custkey AS user_id, p_brand AS brand, count(*) AS n,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, p_brand) AS rn
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                          JOIN part ON l_partkey = p_partkey
            GROUP BY 1, 2) WHERE rn <= 4""")
def top_n_categories(spark, sf):
    """Best brands of every customer from rows: counts, then a limited ranking."""
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = v.table(spark, sf, "part").select("p_partkey", "p_brand")
    counts = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy(F.col("o_custkey").alias("user_id"), F.col("p_brand").alias("brand"))
              .agg(F.count(F.lit(1)).alias("n")))
    return prof.top_n_categories(counts, ["user_id"], "n", "brand", 4)


@query("SELECT zip_code, round(listing_price_median, 6) AS listing_price_median FROM v_medians")
def zip_median(spark, sf):
    return rounded(_medians(spark, sf))


_USER_COLUMNS = """user_id, CAST(user_group AS BIGINT) AS user_group, zip_code,
    round(score, 6) AS score, round(overall_mean, 6) AS overall_mean,
    round(overall_std_dev, 6) AS overall_std_dev,
    round(listing_price_median, 6) AS listing_price_median,
    round(price_floor, 6) AS price_floor, round(price_ceiling, 6) AS price_ceiling"""


@query(f"SELECT {_USER_COLUMNS} FROM v_users_nl")
def price_band(spark, sf):
    """Complete user profiles of the first campaign: zips, clamped deviation, band."""
    return rounded(_users(spark, sf).withColumn("user_group", F.col("user_group").cast("long")))


@query(f"SELECT {_USER_COLUMNS} FROM v_users_rh")
def price_band_wide(spark, sf):
    """The same with four zips and three deviations."""
    return rounded(_users(spark, sf, v.RH)
                   .withColumn("user_group", F.col("user_group").cast("long")))


# ------------------------------------------------------------------ listings

@query("""SELECT listing_id, listing_status, strftime(vf, '%Y-%m-%d %H:%M:%S') AS valid_from
          FROM v_history WHERE vf <= TIMESTAMP '2000-01-15 23:59:59'
            AND vt > TIMESTAMP '2000-01-15 23:59:59'""")
def as_of_snapshot(spark, sf):
    current = snapshot.as_of(v.listing_history(spark, sf), lst.end_of_day(v.RUN_DATE))
    return current.select("listing_id", "listing_status", F.date_format(
        "effective_from_datetime_mst", "yyyy-MM-dd HH:mm:ss").alias("valid_from"))


@query("""SELECT property_id, listing_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started,
                 round(listing_current_price, 6) AS listing_current_price
          FROM (SELECT *, row_number() OVER (PARTITION BY property_id
                            ORDER BY started DESC, vf DESC, listing_id) AS rn FROM v_history)
          WHERE rn = 1""")
def latest_listing(spark, sf):
    newest = snapshot.latest_per_key(
        v.listing_history(spark, sf), ["property_id"],
        ["listing_start_datetime_mst", "listing_end_datetime_mst",
         "effective_from_datetime_mst"], ["listing_id"])
    return rounded(newest.select(
        "property_id", "listing_id", "listing_current_price",
        F.date_format("listing_start_datetime_mst", "yyyy-MM-dd HH:mm:ss").alias("started")))


@query("""SELECT * REPLACE (round(listing_current_price, 6) AS listing_current_price)
          FROM v_listings_180""")
def listing_clean(spark, sf):
    return rounded(_listings(spark, sf, 180))


_ENGAGEMENT = """
    SELECT listing_id, count(*) FILTER (page_type_group = 'ldp') AS ldp_pageview_count,
           count(*) FILTER (lower(social_shares) = 'y') AS shares_count,
           count(*) FILTER (lower(saved_items) = 'y') AS saves_count
    FROM v_events
    WHERE listing_id IS NOT NULL AND trim(listing_id) <> '' AND lower(listing_id) <> 'null'
    GROUP BY listing_id"""


@query(_ENGAGEMENT)
def engagement_counts(spark, sf):
    return lst.engagement_counts(v.biz_events(spark, sf))


@query(f"""SELECT l.listing_id, l.listing_state, l.dom,
                  coalesce(e.ldp_pageview_count, -1) AS ldp_pageview_count,
                  coalesce(e.shares_count, -1) AS shares_count,
                  coalesce(e.saves_count, -1) AS saves_count
           FROM v_listings_180 l LEFT JOIN ({_ENGAGEMENT}) e USING (listing_id)""")
def listing_engagement(spark, sf):
    """Counters joined back; listings without events keep nulls, shown as -1 here."""
    merged = lst.attach_engagement(_listings(spark, sf, 180),
                                   lst.engagement_counts(v.biz_events(spark, sf)))
    counters = ("ldp_pageview_count", "shares_count", "saves_count")
    return merged.select("listing_id", "listing_state", "dom", *[
        F.coalesce(c, F.lit(-1)).alias(c) for c in counters])


@query("""SELECT member_id, email_address FROM (
            SELECT *, row_number() OVER (PARTITION BY member_id
                        ORDER BY updated_at DESC, account_row) AS rn
            FROM v_accounts WHERE email_address NOT LIKE '%staff.example%') WHERE rn = 1""")
def member_map(spark, sf):
    return lst.member_email_map(v.accounts(spark, sf), "staff.example", ("account_row",))


# ------------------------------------------------------------------ candidates

_CANDIDATES = """
    SELECT u.user_id, CAST(u.user_group AS BIGINT) AS user_group, l.listing_id, l.property_id,
           l.listing_postal_code, l.listing_state, l.dom,
           round(u.listing_price_median, 6) AS listing_price_median,
           round(l.listing_current_price, 6) AS listing_current_price
    FROM v_users_nl u JOIN v_listings_{days} l ON u.zip_code = l.listing_postal_code
      AND l.listing_current_price BETWEEN u.price_floor AND u.price_ceiling"""
_CANDIDATE_COLUMNS = ("user_id", "user_group", "listing_id", "property_id",
                      "listing_postal_code", "listing_state", "dom", "listing_price_median",
                      "listing_current_price")


def _candidates(spark: SparkSession, users: DataFrame, listings: DataFrame, *limits: int) -> DataFrame:
    """Candidates from written users and listings, hot zips split. There are far more of them than
    of either, so what is shown of both is rounded here; prices are compared as they are."""
    hot = _written(spark, "hot", cand.hot_zips(users, listings, *limits))
    users = users.withColumns({"listing_price_median": F.round("listing_price_median", 6),
                               "user_group": F.col("user_group").cast("long")})
    listings = listings.withColumn("_price", F.round("listing_current_price", 6))
    made = cand.generate_candidates(users, listings, hot)
    return made.withColumn("listing_current_price", F.col("_price")).select(*_CANDIDATE_COLUMNS)


@query(_CANDIDATES.format(days=60))
def candidate_generation(spark, sf):
    """Flagship: current listings x active users, by favourite zip and price band.

    The history is read once, for the longer window of the medians.
    """
    current = _written(spark, "listings", _listings(spark, sf, 180))
    users = _written(spark, "users", _users(spark, sf, medians=prof.group_median(current)))
    return _candidates(spark, users, lst.listings_within(current, 60))


@query(_CANDIDATES.format(days=180))
def candidate_generation_split(spark, sf):
    """The same join with every busy zip cut into price ranges and user parts."""
    listings = _written(spark, "listings", _listings(spark, sf, 180))
    users = _written(spark, "users", _users(spark, sf, medians=prof.group_median(listings)))
    return _candidates(spark, users, listings, 100, 10)


@query(_CANDIDATES.format(days=60))
def listings_within(spark, sf):
    """Candidates once more, with the shorter window built from the history itself."""
    users = _written(spark, "users", _users(spark, sf))
    return _candidates(spark, users, _written(spark, "listings", _listings(spark, sf, 60)))


@query("""SELECT DISTINCT uid AS user_id, listing_id FROM v_events
          WHERE page_type LIKE '%ldp%' AND on_sale""")
def interactions(spark, sf):
    return cand.interactions(v.biz_events(spark, sf))


@query("""SELECT DISTINCT uid AS user_id, listing_id, 'y' AS saved_items FROM v_events
          WHERE lower(saved_items) = 'y' AND on_sale""")
def saved_items(spark, sf):
    return cand.saved_items(v.biz_events(spark, sf))


@query("""SELECT r.user_id, r.listing_id, r.state, r.seq_id,
                 CASE WHEN s.listing_id IS NOT NULL THEN 'y' END AS saved_items,
                 CASE WHEN i.listing_id IS NOT NULL THEN 'y' ELSE 'n' END AS viewed,
                 CASE WHEN s.listing_id IS NOT NULL THEN 'y' ELSE 'n' END AS saved_home
          FROM v_ranked r
          LEFT JOIN (SELECT DISTINCT uid, listing_id FROM v_events
                     WHERE page_type LIKE '%ldp%' AND on_sale) i
            ON i.uid = r.user_id AND i.listing_id = r.listing_id AND r.user_id <> 'null'
          LEFT JOIN (SELECT DISTINCT uid, listing_id FROM v_events
                     WHERE lower(saved_items) = 'y' AND on_sale) s
            ON s.uid = r.user_id AND s.listing_id = r.listing_id""")
def tag_interactions(spark, sf):
    flags = cand.interaction_flags(v.biz_events(spark, sf))
    pairs = v.ranked(spark, sf).select("user_id", "listing_id", "state", "seq_id")
    return cand.tag_interactions(pairs, flags)


_FLAT = "SELECT user_id, listing_id, state, min(row_id) AS row_id FROM v_recs GROUP BY ALL"


@query(f"SELECT * REPLACE (coalesce(row_id, -1) AS row_id) FROM ({_FLAT})")
def flatten_ranked(spark, sf):
    """Users without recommendations keep one row without a position, shown as -1 here."""
    return (cand.explode_ranked(v.recommendations(spark, sf))
            .withColumn("row_id", F.coalesce("row_id", F.lit(-1)).cast("long")))


_FILTERED = f"""
    SELECT user_id, state, listing_id, seq_id FROM (
      SELECT f.user_id, f.state, f.listing_id, row_number() OVER (
               PARTITION BY f.user_id, f.state ORDER BY f.row_id, f.listing_id) AS seq_id
      FROM ({_FLAT}) f JOIN v_listings_180 l USING (listing_id)
      JOIN v_users_rh u ON u.user_id = f.user_id AND u.zip_code = l.listing_postal_code
      WHERE {{band}})
    WHERE seq_id <= 10"""


def _filtered(spark: SparkSession, sf: str, banded: bool) -> DataFrame:
    flat = cand.explode_ranked(v.recommendations(spark, sf))
    listings = _written(spark, "listings", _listings(spark, sf, 180))
    users = _users(spark, sf, v.RH, prof.group_median(listings))
    kept = cand.filter_recommendations(flat, listings, users, 10, banded)
    return kept.select("user_id", "state", "listing_id", F.col("seq_id").cast("long"))


@query(_FILTERED.format(band="TRUE"))
def filter_recommendations(spark, sf):
    return _filtered(spark, sf, False)


@query(_FILTERED.format(
    band="l.listing_current_price BETWEEN u.price_floor AND u.price_ceiling"))
def filter_recommendations_in_band(spark, sf):
    return _filtered(spark, sf, True)


# ------------------------------------------------------------------ features and ranking

_PAIRS = """(SELECT DISTINCT user_id, listing_id FROM v_ranked)"""
_LATEST_FEATURES = """(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY target_date DESC, snapshot_id) AS frn FROM v_user_features)
    WHERE frn = 1)"""


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return v.ranked(spark, sf).select("user_id", "listing_id").distinct()


def _latest_features(spark: SparkSession, sf: str) -> DataFrame:
    return (snapshot.latest_per_key(v.user_features(spark, sf), ["user_id"], ["target_date"],
                                    ["snapshot_id"]).drop("snapshot_id"))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.join_features(_pairs(spark, sf), _latest_features(spark, sf),
                                 v.listing_features(spark, sf))


_JOINED_SQL = (f"FROM {_PAIRS} p JOIN v_listing_features l USING (listing_id) "
               f"JOIN {_LATEST_FEATURES} u USING (user_id)")
_JOIN_COLUMNS = """p.user_id, p.listing_id, round(l.price, 6) AS price,
    round(u.cal_price_t90, 6) AS cal_price_t90, u.consumer_ip_city, l.ldp_zip"""


@query(f"SELECT {_JOIN_COLUMNS} {_JOINED_SQL}")
def join_features(spark, sf):
    return rounded(_joined(spark, sf).select("user_id", "listing_id", "price", "cal_price_t90",
                                             "consumer_ip_city", "ldp_zip"))


@query(f"SELECT {_JOIN_COLUMNS} {_JOINED_SQL}")
def join_features_split(spark, sf):
    """The same join with the busiest listings split over several tasks."""
    pairs = _written(spark, "pairs", _pairs(spark, sf))
    hot = _written(spark, "hot", skew.hot_keys(pairs, ["listing_id"], 100))
    joined = scoring.join_features(pairs, _latest_features(spark, sf),
                                   v.listing_features(spark, sf), hot)
    return rounded(joined.select("user_id", "listing_id", "price", "cal_price_t90",
                                 "consumer_ip_city", "ldp_zip"))


def _deviation_sql() -> str:
    out = []
    for a in ("price", "lot_sqft", "bath", "bed", "sqft"):
        for w in ("t90", "t90_20"):
            usual = f"cal_{a}_t90" if w == "t90" else f"(cal_{a}_t90 * 0.75)"
            out.append(f"round(CAST(CAST(CASE WHEN {usual} IS NOT NULL AND {a} IS NOT NULL "
                       f"AND {a} <> 0 THEN greatest({usual} / {a}, 0.0002) END AS FLOAT) "
                       f"AS DOUBLE), 4) AS {a}_ratio_cal_{a}_{w}")
            out.append(f"round(CAST(CAST({a} - {usual} AS FLOAT) AS DOUBLE), 4) "
                       f"AS {a}_diff_cal_{a}_{w}")
    return ", ".join(out)


@query(f"SELECT p.user_id, p.listing_id, {_deviation_sql()} {_JOINED_SQL}")
def deviation_features(spark, sf):
    wide = scoring.deviation_features(_joined(spark, sf))
    added = [c for c in wide.columns if "_ratio_cal_" in c or "_diff_cal_" in c]
    return rounded(wide.select("user_id", "listing_id", *added))


_HAVERSINE = """2 * 3958.76 * asin(sqrt(pow(sin(radians(cal_lat_t90 - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(cal_lat_t90)) * pow(sin(radians(cal_lon_t90 - lon) / 2), 2)))
"""


@query(f"""SELECT p.user_id, p.listing_id, round(CAST(CAST({_HAVERSINE} AS FLOAT) AS DOUBLE), 2) AS miles
           {_JOINED_SQL}""")
def haversine(spark, sf):
    near = scoring.distance_feature(_joined(spark, sf))
    return near.select("user_id", "listing_id", F.round(
        F.col("listing_to_interest_distance").cast("double"), 2).alias("miles"))


def _lookups(spark: SparkSession, sf: str) -> list[scoring.Lookup]:
    city, zips = ("consumer_ip_city", "ldp_city"), ("consumer_ip_zip", "ldp_zip")
    cities = v.pair_lookup(spark, sf, *city, "m", ("City", "Town"), 10)
    zones = v.pair_lookup(spark, sf, *zips, "m", ("Z", "Z"), 12)
    def listing_side(table: DataFrame) -> DataFrame:
        return table.withColumn("n", F.col("m").try_cast("double") + 1).drop("m")

    return [scoring.Lookup(cities, city, "m", "con_pct_web_uls_median_city"),
            scoring.Lookup(listing_side(cities), city, "n", "ldp_pct_web_uls_median_city"),
            scoring.Lookup(zones, zips, "m", "con_pct_web_uls_median_zip"),
            scoring.Lookup(listing_side(zones), zips, "n", "ldp_pct_web_uls_median_zip")]


LOOKUPS_SQL = f"""SELECT p.user_id, p.listing_id,
                  round(c.m, 6) AS con_pct_web_uls_median_city,
                  round(c.m + 1, 6) AS ldp_pct_web_uls_median_city,
                  round(z.m, 6) AS con_pct_web_uls_median_zip,
                  round(z.m + 1, 6) AS ldp_pct_web_uls_median_zip,
                  CAST(CASE WHEN c.m IS NULL THEN 2 ELSE 0 END
                       + CASE WHEN z.m IS NULL THEN 2 ELSE 0 END AS BIGINT) AS n_filled
           {_JOINED_SQL}
           LEFT JOIN v_con_city c ON c.consumer_ip_city = u.consumer_ip_city
                                 AND c.ldp_city = l.ldp_city
           LEFT JOIN v_con_zip z ON z.consumer_ip_zip = u.consumer_ip_zip
                                AND z.ldp_zip = l.ldp_zip"""


def enriched(pairs: DataFrame, lookups: Sequence[scoring.Lookup]) -> DataFrame:
    """The four lookups of every pair, and how many of them were filled with NaN."""
    keys = pairs.select("user_id", "listing_id", "consumer_ip_city", "ldp_city", "consumer_ip_zip", "ldp_zip")
    names = [x.name for x in lookups]
    found = scoring.lookup_enrich(keys, lookups)
    filled = sum((F.isnan(n).cast("long") for n in names), F.lit(0).cast("long"))
    return rounded(found.select("user_id", "listing_id", *[
        F.nanvl(n, F.lit(None).cast("double")).alias(n) for n in names], filled.alias("n_filled")))


@query(LOOKUPS_SQL)
def lookup_enrich(spark, sf):
    return enriched(_joined(spark, sf), _lookups(spark, sf))


_RANK_SQL = """
    SELECT user_id, listing_id, match_score, row_number() OVER (
             PARTITION BY user_id ORDER BY match_score DESC, listing_id) AS seq_id
    FROM (SELECT user_id, listing_id, max(match_score) AS match_score FROM v_ranked GROUP BY ALL)"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return (v.ranked(spark, sf).groupBy("user_id", "listing_id")
            .agg(F.max("match_score").alias("match_score")))


@query(_RANK_SQL)
def rank_candidates(spark, sf):
    ranked = scoring.rank_candidates(_scored(spark, sf), F.col("match_score"))
    return ranked.withColumn("seq_id", F.col("seq_id").cast("long"))


@query(_RANK_SQL)
def rank_candidates_split(spark, sf):
    """The same ranking with all rows dealt out in ranges of user, score and listing."""
    scored = _scored(spark, sf)
    order = (["user_id"], "match_score", ["listing_id"])
    dealt = _written(spark, "dealt", keyed.deal_by_rank(scored, *order))
    return keyed.rank_dealt(dealt, *order).withColumn("seq_id", F.col("seq_id").cast("long"))


@query("""SELECT user_id, zip_code, CAST(user_group AS BIGINT) AS user_group FROM v_users_nl
          WHERE user_group BETWEEN 10 AND 19""")
def group_range(spark, sf):
    batch = readers.group_range(_users(spark, sf), 10, 10)
    return batch.select("user_id", "zip_code", F.col("user_group").cast("long"))


# ------------------------------------------------------------------ eligibility

_SAVED_SEARCH = """(SELECT DISTINCT member_id AS user_id FROM v_search
    WHERE is_saved_search = 'y' AND length(member_id) > 1
      AND day BETWEEN '20000802' AND '20010801')"""
_WEB_OPTED = "(SELECT DISTINCT replace(userId, 'visitor_', '') AS user_id FROM v_opt_ins WHERE web)"
_APP_OPTED = "(SELECT DISTINCT userId AS user_id FROM v_opt_ins WHERE app)"
_DOMZIP = """(SELECT DISTINCT member_id, listing_state FROM v_domzip
    WHERE day BETWEEN '20000802' AND '20010801')"""
_NOTIFIED = """(SELECT DISTINCT external_user_id AS member_id FROM v_push_sent
    WHERE day BETWEEN '20240101' AND '20240130'
      AND (campaign_id IN ('purchase') OR canvas_id IN ('canvas5')))"""


def _saved_search(spark: SparkSession, sf: str) -> DataFrame:
    return elig.saved_search_users(v.search_profiles(spark, sf), v.ORDERS_END, days=364)


def _domzip(spark: SparkSession, sf: str) -> DataFrame:
    return elig.domzip_users(v.dominant_zips(spark, sf), v.ORDERS_END, days=365)


def _notified(spark: SparkSession, sf: str) -> DataFrame:
    return elig.recently_notified(v.push_sent(spark, sf), v.EVENTS_END, ["purchase"],
                                  ["canvas5"])


@query(f"SELECT * FROM {_SAVED_SEARCH}")
def saved_search(spark, sf):
    return _saved_search(spark, sf)


@query(f"SELECT * FROM {_WEB_OPTED}")
def opted_in_web(spark, sf):
    return elig.opted_in(v.opt_ins(spark, sf), "web", "visitor_")


@query(f"SELECT * FROM {_APP_OPTED}")
def opted_in_app(spark, sf):
    return elig.opted_in(v.opt_ins(spark, sf), "app")


@query(f"""SELECT user_id, listing_id, state, seq_id FROM v_clean_ranked
           WHERE user_id IN (SELECT user_id FROM {_WEB_OPTED})
             AND user_id NOT IN (SELECT user_id FROM {_SAVED_SEARCH})""")
def web_eligible(spark, sf):
    kept = elig.web_eligible(v.ranked(spark, sf),
                             elig.opted_in(v.opt_ins(spark, sf), "web", "visitor_"),
                             _saved_search(spark, sf))
    return kept.select("user_id", "listing_id", "state", F.col("seq_id").cast("long"))


@query(f"SELECT * FROM {_DOMZIP}")
def domzip(spark, sf):
    return _domzip(spark, sf)


@query(f"SELECT * FROM {_NOTIFIED}")
def notified(spark, sf):
    return _notified(spark, sf)


_APP_ELIGIBLE = f"""(SELECT DISTINCT member_id AS user_id, listing_state FROM {_DOMZIP}
    WHERE member_id NOT IN (SELECT member_id FROM {_NOTIFIED})
      AND member_id IN (SELECT user_id FROM {_APP_OPTED}))"""


def _app_eligible(spark: SparkSession, sf: str) -> DataFrame:
    return elig.app_eligible(_domzip(spark, sf), _notified(spark, sf),
                             elig.opted_in(v.opt_ins(spark, sf), "app"))


@query(f"SELECT * FROM {_APP_ELIGIBLE}")
def app_eligible(spark, sf):
    return _app_eligible(spark, sf)


_EMAIL_ELIGIBLE = """(
    SELECT DISTINCT customer_id, email FROM v_email_sent
    WHERE customer_id IS NOT NULL AND trim(customer_id) <> '' AND campaign_id IS NOT NULL
      AND trim(campaign_id) <> ''
    EXCEPT ALL
    SELECT DISTINCT customer_id, email FROM v_email_sent
    WHERE customer_id IS NOT NULL AND trim(customer_id) <> ''
      AND campaign_id IN ('signup', 'error') AND day BETWEEN '20240128' AND '20240130')"""


def _email_eligible(spark: SparkSession, sf: str) -> DataFrame:
    return elig.email_eligible(v.email_sent(spark, sf), v.EVENTS_END, CAP_CAMPAIGNS)


@query(f"SELECT * FROM {_EMAIL_ELIGIBLE}")
def email_eligible(spark, sf):
    return _email_eligible(spark, sf)


# ------------------------------------------------------------------ experiments and channels

def _slot_sql(experiment: str) -> str:
    return f"(CAST('0x' || substr(md5(':' || {experiment} || ':' || user_id), 1, 8) AS BIGINT) % 10000)"


def _variation_sql(experiment: str, allocation=ALLOCATION) -> str:
    upper, cases = 0, []
    for name, share in allocation:
        upper += share
        cases.append(f"WHEN {_slot_sql(experiment)} < {upper} THEN '{name}'")
    return f"CASE {' '.join(cases)} END"


@query(f"""SELECT user_id, 'AB' AS experiment_name, {_variation_sql("'AB'")} AS variation
           FROM (SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer)""")
def assign_variation(spark, sf):
    users = v.table(spark, sf, "customer").select(F.col("c_custkey").cast("string")
                                                  .alias("user_id"))
    return exp.assign_variation(users, "AB", ALLOCATION)


_EXCLUSIVE = f"""(
    SELECT user_id, experiment_name,
           CASE WHEN experiment_name = 'MAIN' THEN {_variation_sql("'MAIN'")}
                ELSE {_variation_sql("'HOLD'", HOLDOUT_ALLOCATION)} END AS variation
    FROM (
      SELECT user_id, min(experiment_name) AS experiment_name, max(side) AS side FROM (
        SELECT DISTINCT user_id, 'MAIN' AS experiment_name, 1 AS side FROM v_clean_ranked
        WHERE state <> 'NM' AND user_id NOT IN (
          SELECT user_id FROM v_own_hist WHERE experiment_name = 'HOLD')
        UNION ALL
        SELECT DISTINCT user_id, 'HOLD', 0 FROM v_clean_ranked
        WHERE state = 'NM' AND user_id NOT IN (
          SELECT user_id FROM v_own_hist WHERE experiment_name = 'MAIN')
        ) WHERE user_id NOT IN (SELECT user_id FROM v_other_hist WHERE experiment_name = 'OTHER')
      GROUP BY user_id HAVING count(*) = 1
      UNION ALL
      SELECT user_id, 'MAIN', 1 FROM v_clean_ranked
      WHERE user_id NOT IN (SELECT user_id FROM v_other_hist WHERE experiment_name = 'OTHER')
        AND user_id NOT IN (SELECT user_id FROM v_own_hist
                            WHERE experiment_name IN ('HOLD', 'MAIN'))
      GROUP BY user_id HAVING bool_or(state = 'NM') AND bool_or(state <> 'NM')))"""


def _exclusive(spark: SparkSession, sf: str) -> DataFrame:
    return exp.bucket_exclusive(
        elig.scrub_pairs(v.ranked(spark, sf)), v.assignments(spark, sf, 0),
        v.assignments(spark, sf, 4), "NM", HOLD, MAIN, OTHER, ALLOCATION, HOLDOUT_ALLOCATION)


@query(f"SELECT * FROM {_EXCLUSIVE}")
def bucket_exclusive(spark, sf):
    return _exclusive(spark, sf)


@query(f"""
    SELECT c.user_id, h.experiment_name, h.variation
    FROM (SELECT DISTINCT user_id FROM v_clean_ranked) c
    JOIN (SELECT DISTINCT * FROM v_own_hist WHERE experiment_name = 'MAIN') h USING (user_id)
    WHERE c.user_id NOT IN (SELECT user_id FROM v_own_hist WHERE experiment_name <> 'MAIN')
      AND c.user_id NOT IN (SELECT user_id FROM v_other_hist WHERE experiment_name = 'OTHER')
    UNION ALL
    SELECT user_id, 'OTHER', {_variation_sql("'OTHER'")}
    FROM (SELECT DISTINCT user_id FROM v_clean_ranked)
    WHERE user_id NOT IN (SELECT user_id FROM v_own_hist)""")
def bucket_sticky(spark, sf):
    return exp.bucket_sticky(elig.usable_pairs(v.ranked(spark, sf)),
                             v.assignments(spark, sf, 0), v.assignments(spark, sf, 4), MAIN,
                             OTHER, ALLOCATION)


@query(f"""SELECT user_id, 'AB' AS experiment_name, {_variation_sql("'AB'")} AS variation
           FROM (SELECT DISTINCT user_id FROM v_clean_ranked)""")
def bucket_all(spark, sf):
    return exp.bucket_all(elig.usable_pairs(v.ranked(spark, sf)), "AB", ALLOCATION)


_BUCKET_APP = f"""(SELECT user_id, listing_state, 'APP' AS experiment_name,
    {_variation_sql("'APP'")} AS variation FROM {_APP_ELIGIBLE})"""


def _bucket_app(spark: SparkSession, sf: str) -> DataFrame:
    return exp.bucket_app(_app_eligible(spark, sf), "APP", ALLOCATION)


@query(f"SELECT * FROM {_BUCKET_APP}")
def bucket_app(spark, sf):
    return _bucket_app(spark, sf)


@query(f"""SELECT c.user_id, c.listing_id, c.seq_id, b.experiment_name, b.variation
           FROM v_clean_ranked c JOIN (
             WITH bucketed AS MATERIALIZED (SELECT * FROM {_EXCLUSIVE}) SELECT * FROM bucketed
           ) b USING (user_id)
           WHERE b.experiment_name = 'HOLD'
              OR (b.experiment_name = 'MAIN' AND b.variation = 'V1')""")
def attach_variation(spark, sf):
    joined = channels.attach_variation(elig.scrub_pairs(v.ranked(spark, sf)),
                                       _exclusive(spark, sf), "V1", HOLD, MAIN)
    return joined.select("user_id", "listing_id", F.col("seq_id").cast("long"),
                         "experiment_name", "variation")


_APP_CANDIDATES = f"""SELECT c.user_id, c.listing_id, c.listing_state, c.seq_id,
    b.experiment_name, b.variation
    FROM v_clean_ranked c JOIN {_BUCKET_APP} b USING (user_id, listing_state)
    WHERE b.variation = '{{group}}'"""


def _app_candidates(spark: SparkSession, sf: str, group: str) -> DataFrame:
    joined = channels.app_candidates(v.ranked(spark, sf), _bucket_app(spark, sf), group)
    return joined.select("user_id", "listing_id", "listing_state",
                         F.col("seq_id").cast("long"), "experiment_name", "variation")


@query(_APP_CANDIDATES.format(group="V1"))
def app_candidates(spark, sf):
    return _app_candidates(spark, sf, "V1")


@query(_APP_CANDIDATES.format(group="V2"))
def app_candidates_v2(spark, sf):
    return _app_candidates(spark, sf, "V2")


_EMAIL_CANDIDATES = f"""SELECT c.user_id, c.listing_id, c.seq_id, e.email,
    first_value(c.listing_city) OVER w AS reccity, first_value(c.listing_state) OVER w AS recstate,
    'V1' AS variation, 'mail-v1' AS experiment_name
    FROM v_clean_ranked c JOIN {_EMAIL_ELIGIBLE} e ON e.customer_id = c.user_id
    WINDOW w AS (PARTITION BY c.user_id ORDER BY c.seq_id, c.listing_state, c.listing_id)"""


def _email_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return channels.email_candidates(v.ranked(spark, sf), _email_eligible(spark, sf), "V1",
                                     "mail-v1")


@query(_EMAIL_CANDIDATES)
def email_candidates(spark, sf):
    return _email_candidates(spark, sf).select(
        "user_id", "listing_id", F.col("seq_id").cast("long"), "email", "reccity", "recstate",
        "variation", "experiment_name")


# ------------------------------------------------------------------ messages

def _bucketed_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return exp.assign_variation(elig.scrub_pairs(v.ranked(spark, sf)), "AB", ALLOCATION)


_ASSEMBLED = f"""
    SELECT user_id, variation, experiment_name, CAST(place // {{size}} AS INTEGER) AS part,
           CAST(ceil(max(mine) / {{size}}) AS INTEGER) AS parts,
           {", ".join(f"string_agg(coalesce(CAST({f} AS VARCHAR), ''), ',' ORDER BY place) AS {f}" for f in PUSH_FIELDS)},
           count(*) AS n
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                      ORDER BY seq_id NULLS FIRST, listing_state, listing_id) - 1 AS place,
                 count(*) OVER (PARTITION BY user_id) AS mine
          FROM (SELECT *, 'AB' AS experiment_name, {_variation_sql("'AB'")} AS variation
                FROM v_clean_ranked)
          WHERE variation IS NOT NULL)
    GROUP BY user_id, variation, experiment_name, part"""


def _assembled(spark: SparkSession, sf: str, per_message: int | None) -> DataFrame:
    """All fields of a message's recommendations, those of one name joined in order."""
    built = msg.assemble(_bucketed_candidates(spark, sf), PUSH_FIELDS, per_message)
    return built.select(
        "user_id", "variation", "experiment_name", "part", "parts",
        *[F.array_join(F.transform(f"recommendations.{f}", lambda x: F.coalesce(x.cast("string"), F.lit(""))),
                       ",").alias(f) for f in PUSH_FIELDS],
        F.size("recommendations").cast("long").alias("n"))


@query(_ASSEMBLED.format(size=1_000_000_000))
def assemble(spark, sf):
    return _assembled(spark, sf, None)


@query(_ASSEMBLED.format(size=4))
def assemble_in_parts(spark, sf):
    """Long lists leave in several bounded messages."""
    return _assembled(spark, sf, 4)


_BODY = ("struct<meta: struct<version: string, clientId: string, clientName: string, "
         "notificationType: string, experiment: struct<key: string, variation: string>>, "
         "payload: struct<content: struct<recommendations: array<struct<{fields}>>>, "
         "recipients: array<struct<memberId: string, visitorId: string>>>>")


def parsed_bodies(bodies: DataFrame, body: str, fields: Sequence[str]) -> DataFrame:
    """Bodies parsed back, so that what is checked is what would be sent: a row for each
    recommendation with its place, all of its fields and all that the envelope says, as text."""
    shape = _BODY.format(fields=", ".join(f"{f}: string" for f in fields))
    content = F.col("b.payload.content.recommendations")
    return (bodies.select(F.from_json(body, shape).alias("b"))
            .select("b", F.size(content).cast("long").alias("n"),
                    F.posexplode(content).alias("place", "item"))
            .select(F.col("b.payload.recipients")[0]["memberId"].alias("member_id"),
                    F.col("b.payload.recipients")[0]["visitorId"].alias("visitor_id"),
                    F.size("b.payload.recipients").cast("long").alias("n_recipients"),
                    F.col("b.meta.version").alias("version"),
                    F.col("b.meta.clientId").alias("client_id"),
                    F.col("b.meta.clientName").alias("client_name"),
                    F.col("b.meta.notificationType").alias("notification_type"),
                    F.col("b.meta.experiment.key").alias("experiment_key"),
                    F.col("b.meta.experiment.variation").alias("variation"), "n",
                    F.col("place").cast("long"), "item.*"))


def bodies_sql(source: str, event_type: str, fields: Sequence[str], ties: str = "") -> str:
    """What ``parsed_bodies`` gives for the messages of the candidates in ``source``."""
    version, kind = ENVELOPES[event_type]
    return f"""
    SELECT CASE WHEN length(user_id) <= 24 THEN user_id END AS member_id,
           CASE WHEN length(user_id) > 24 THEN user_id END AS visitor_id,
           CAST(1 AS BIGINT) AS n_recipients, '{version}' AS version, 'client' AS client_id,
           'client name' AS client_name, '{kind}' AS notification_type,
           experiment_name AS experiment_key, variation, count(*) OVER message AS n,
           row_number() OVER (message ORDER BY seq_id NULLS FIRST, listing_state, listing_id{ties})
             - 1 AS place, {", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in fields)}
    FROM ({source}) WHERE variation IS NOT NULL
    WINDOW message AS (PARTITION BY user_id, variation, experiment_name)"""


# the first place is that of the user's best position, whatever the address
EMAIL_SOURCE = f"""SELECT c.*, e.email, 'V1' AS variation, 'mail-v1' AS experiment_name,
    first_value(c.listing_city) OVER w AS reccity, first_value(c.listing_state) OVER w AS recstate
    FROM v_clean_ranked c JOIN {_EMAIL_ELIGIBLE} e ON e.customer_id = c.user_id
    WINDOW w AS (PARTITION BY c.user_id ORDER BY c.seq_id, c.listing_state, c.listing_id)"""


@query(bodies_sql(f"""SELECT * REPLACE (CASE WHEN CAST(user_id AS BIGINT) % 2 = 0
                                  THEN 'visitor-with-a-long-id-' || lpad(user_id, 8, '0')
                                  ELSE user_id END AS user_id) FROM ({EMAIL_SOURCE})""",
                  "recommended_homes_email", EMAIL_FIELDS, ", email NULLS FIRST"))
def envelope(spark, sf):
    """Every field of every body, of members and of visitors with long ids."""
    user = F.col("user_id")
    routed = _email_candidates(spark, sf).withColumn("user_id", F.when(
        user.cast("long") % 2 == 0, F.concat(F.lit("visitor-with-a-long-id-"),
                                             F.lpad(user, 8, "0"))).otherwise(user))
    sent = msg.envelope(msg.assemble(routed, EMAIL_FIELDS, None), "recommended_homes_email",
                        "client", "client name")
    return parsed_bodies(sent, "body", EMAIL_FIELDS)


@query(f"""SELECT DISTINCT user_id, '' AS recommendations, variation, experiment_name
           FROM {_BUCKET_APP} WHERE variation = 'C'""")
def control_messages(spark, sf):
    return msg.control_messages(_bucket_app(spark, sf))


_CONTROL_BODIES = f"""
    SELECT '{{"meta":{{"version":"{ENVELOPES["dom_zip_app"][0]}","clientId":"client",'
           || '"clientName":"client name","notificationType":"{ENVELOPES["dom_zip_app"][1]}",'
           || '"experiment":{{"key":"' || experiment_name || '","variation":"C"}}}},"payload":'
           || '{{"content":{{"recommendations":""}},"recipients":[{{"memberId":"' || user_id
           || '","visitorId":null}}]}}}}' AS body, count(*) OVER () AS delivered
    FROM (SELECT DISTINCT user_id, experiment_name FROM {_BUCKET_APP} WHERE variation = 'C')"""


@query(_CONTROL_BODIES)
def message_sink(spark, sf):
    """Bodies written as lines of text and read back, next to the number reported by the write."""
    sent = msg.envelope(msg.control_messages(_bucket_app(spark, sf)), "dom_zip_app", "client",
                        "client name")
    path = scratch_path(spark, "messages")
    delivered = writers.write_messages(sent, path)
    return spark.read.text(path).select(F.col("value").alias("body"),
                                        F.lit(delivered).cast("long").alias("delivered"))


# ------------------------------------------------------------------ offline metrics

_TRUTH = """(SELECT DISTINCT uid AS user_id, listing_id_persist AS listing_id FROM v_events
    WHERE event_date BETWEEN '20240101' AND '20240107'
      AND uid IS NOT NULL AND uid NOT IN ('unknown', 'UNKNOWN', 'NULL', 'null', '', ' ',
                                          '$CUSTOMER_ID_$', '$customer_id_$')
      AND listing_id_persist IS NOT NULL
      AND listing_id_persist NOT IN ('unknown', 'UNKNOWN', 'NULL', 'null', '', ' ')
      AND zip IS NOT NULL AND length(zip) = 5)"""
_USER_METRICS = f"""
    SELECT user_id, k, CAST(count(*) AS BIGINT) AS predicted, CAST(sum(hit) AS BIGINT) AS hits,
           round(sum(hit) / count(*), 6) AS precision, round(sum(hit) / any_value(n), 6) AS recall,
           round(CASE WHEN sum(hit) = 0 THEN 0 ELSE
             sum(CASE WHEN spot <= k THEN hit / log2(spot + 1) ELSE 0 END)
             / list_sum(list_transform(range(1, CAST(least(k, sum(hit)) AS BIGINT) + 1),
                                       lambda p: 1 / log2(p + 1))) END, 6) AS ndcg
    FROM (
      SELECT p.*, CASE WHEN t.user_id IS NULL THEN 0 ELSE 1 END AS hit,
             row_number() OVER (PARTITION BY p.user_id ORDER BY p.rank, p.listing_id) AS spot
      FROM (SELECT user_id, listing_id, seq_id AS rank FROM v_clean_ranked WHERE seq_id <= 12) p
      LEFT JOIN {_TRUTH} t USING (user_id, listing_id))
    JOIN (SELECT user_id, count(*) AS n FROM {_TRUTH} GROUP BY 1) g USING (user_id)
    CROSS JOIN (SELECT unnest([1, 3, 12]) AS k)
    WHERE rank <= k GROUP BY user_id, k"""


def _truth(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.ground_truth(v.biz_events(spark, sf), "20240101", 7)


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return (elig.usable_pairs(v.ranked(spark, sf))
            .select("user_id", "listing_id", F.col("seq_id").alias("rank")))


@query(f"SELECT * FROM {_TRUTH}")
def ground_truth(spark, sf):
    return _truth(spark, sf)


@query(_USER_METRICS)
def user_metrics(spark, sf):
    """Precision, recall and nDCG per user and cut-off."""
    return rounded(metrics.user_scores(_predictions(spark, sf), _truth(spark, sf)))


@query(f"""SELECT k AS rank, round(avg(precision), 5) AS mean_precision,
                  round(avg(recall), 5) AS mean_recall, round(avg(ndcg), 5) AS mean_ndcg,
                  count(*) AS user_coverage FROM ({_USER_METRICS}) GROUP BY k""")
def offline_metrics(spark, sf):
    report = metrics.offline_metrics(_predictions(spark, sf), _truth(spark, sf))
    means = {c: F.round(c, 5) for c in ("mean_precision", "mean_recall", "mean_ndcg")}
    return report.withColumns(means)


@query(f"""SELECT rank, round(avg(precision), 5) AS mean_precision,
                  round(avg(recall), 5) AS mean_recall
           FROM (SELECT k AS rank, precision, recall FROM ({_USER_METRICS})) GROUP BY rank""")
def precision_recall(spark, sf):
    report = metrics.offline_metrics(_predictions(spark, sf), _truth(spark, sf))
    return report.select("rank", F.round("mean_precision", 5).alias("mean_precision"),
                         F.round("mean_recall", 5).alias("mean_recall"))


_GRADED = """(SELECT o_orderkey, spot, (o_orderkey * 5 + spot * spot * 3) % 4 AS rel
    FROM orders, unnest(range(1, 2 + o_orderkey % 9)) AS u(spot))"""


def _gain_sql(method: int, rel: str, at: str) -> str:
    return {0: f"({rel} / CASE WHEN {at} = 1 THEN 1 ELSE log2({at}) END)",
            1: f"({rel} / log2({at} + 1))",
            2: f"((pow(2, {rel}) - 1) / log2({at} + 1))"}[method]


def _relevance_lists(spark: SparkSession, sf: str) -> DataFrame:
    """A short list of graded relevance per order."""
    key = F.col("o_orderkey")
    spots = F.sequence(F.lit(1).cast("long"), 1 + key % 9)
    return v.table(spark, sf, "orders").select("o_orderkey", F.transform(
        spots, lambda i: (key * 5 + i * i * 3) % 4).alias("rel"))


@query("SELECT o_orderkey, " + ", ".join(
    f"round(sum({_gain_sql(m, 'rel', 'spot')}), 5) AS dcg{m}" for m in (0, 1, 2))
    + f" FROM {_GRADED} WHERE spot <= 3 GROUP BY 1")
def dcg(spark, sf):
    lists = _relevance_lists(spark, sf)
    return lists.select("o_orderkey", *[
        F.round(gain.dcg(F.col("rel"), 3, m), 5).alias(f"dcg{m}") for m in (0, 1, 2)])


@query("SELECT o_orderkey, " + ", ".join(
    f"round(CASE WHEN sum({_gain_sql(m, 'rel', 'best')}) FILTER (best <= 3) = 0 THEN 0 ELSE "
    f"sum({_gain_sql(m, 'rel', 'spot')}) FILTER (spot <= 3) "
    f"/ sum({_gain_sql(m, 'rel', 'best')}) FILTER (best <= 3) END, 5) AS ndcg{m}"
    for m in (0, 1, 2))
    + f""" FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY rel DESC) AS best
                 FROM {_GRADED}) GROUP BY 1""")
def ndcg(spark, sf):
    lists = _relevance_lists(spark, sf)
    return lists.select("o_orderkey", *[
        F.round(gain.ndcg(F.col("rel"), 3, m), 5).alias(f"ndcg{m}") for m in (0, 1, 2)])


# ------------------------------------------------------------------ data quality

@query("""SELECT user_id, listing_id, count(*) AS n_rows FROM v_ranked
          WHERE listing_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_duplicates(spark, sf):
    return dq.dq_duplicates(v.ranked(spark, sf), ["user_id", "listing_id"])


@query("""SELECT property_id, listing_id, count(*) AS n_rows FROM v_history
          GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_duplicate_listings(spark, sf):
    return dq.dq_duplicates(v.listing_history(spark, sf), ["property_id", "listing_id"])


def _empty_conditions() -> dict:
    return {
        "key_fields": dq.is_empty("listing_id", "property_id", "listing_status"),
        "descriptive_fields": dq.is_empty("listing_type", "listing_address", "listing_city"),
        "attributes": dq.is_zero("listing_number_of_bath_rooms", "listing_number_of_bed_rooms",
                                 "listing_square_feet", "listing_lot_square_feet",
                                 "listing_photo_count", "listing_current_price"),
    }


_EMPTY_SQL = {
    "key_fields": "coalesce(listing_id, '') = '' OR coalesce(property_id, '') = '' "
                  "OR coalesce(listing_status, '') = ''",
    "descriptive_fields": "coalesce(listing_type, '') = '' OR coalesce(listing_address, '') = '' "
                          "OR coalesce(listing_city, '') = ''",
    "attributes": "coalesce(listing_number_of_bath_rooms, 0) = 0 "
                  "OR coalesce(listing_number_of_bed_rooms, 0) = 0 "
                  "OR coalesce(CAST(listing_square_feet AS DOUBLE), 0) = 0 "
                  "OR coalesce(CAST(listing_lot_square_feet AS DOUBLE), 0) = 0 "
                  "OR coalesce(listing_photo_count, 0) = 0 "
                  "OR coalesce(listing_current_price, 0) = 0",
}


def _rate_sql(table: str, key: str, conditions: dict[str, str], limits: dict[str, float]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", n_keys, n_rows, n_total,
                   round(100.0 * n_keys / n_total, 6) AS pct,
                   CASE WHEN {limits.get(name, 0)} = 0 THEN n_rows = 0
                        ELSE 100.0 * n_keys / n_total <= {limits.get(name, 0)} END AS passed
            FROM (SELECT count(DISTINCT CASE WHEN {cond} THEN {key} END) AS n_keys,
                         count(*) FILTER ({cond}) AS n_rows,
                         count(DISTINCT {key}) AS n_total FROM {table})"""
        for name, cond in conditions.items())


_EMPTY_LIMITS = {"descriptive_fields": 10.0, "attributes": 10.0}


@query(_rate_sql("v_ranked", "listing_id", _EMPTY_SQL, _EMPTY_LIMITS))
def dq_empty(spark, sf):
    return rounded(dq.dq_rate(v.ranked(spark, sf), "listing_id", _empty_conditions(),
                              _EMPTY_LIMITS))


_USER_LIMITS = {"score": 15.0, "zip_code": 15.0, "mean": 10.0, "ceiling": 10.0, "std_dev": 5.0}


@query(_rate_sql("v_users_nl", "user_id", {
    "user_id": "coalesce(user_id, '') = ''", "score": "coalesce(score, 0) = 0",
    "zip_code": "coalesce(zip_code, '') = ''", "mean": "coalesce(overall_mean, 0) = 0",
    "ceiling": "coalesce(price_ceiling, 0) = 0", "std_dev": "coalesce(overall_std_dev, 0) = 0"},
    _USER_LIMITS))
def dq_empty_users(spark, sf):
    """Six checks on users in one pass over them."""
    return rounded(dq.dq_rate(_users(spark, sf), "user_id", {
        "user_id": dq.is_empty("user_id"), "score": dq.is_zero("score"),
        "zip_code": dq.is_empty("zip_code"), "mean": dq.is_zero("overall_mean"),
        "ceiling": dq.is_zero("price_ceiling"), "std_dev": dq.is_zero("overall_std_dev")},
        _USER_LIMITS))


@query(_rate_sql("v_users_nl", "user_id", {
    "std_dev_below_67": "coalesce(overall_std_dev < 67, false)"}, {}))
def dq_range(spark, sf):
    return rounded(dq.dq_rate(_users(spark, sf), "user_id",
                              {"std_dev_below_67": F.col("overall_std_dev") < 67}, {}))


@query("""SELECT * FROM (
    SELECT 'for_sale' AS "check", count(DISTINCT listing_id) FILTER (listing_status = 'for sale')
             AS n_keys, count(*) FILTER (listing_status = 'for sale') AS n_rows,
           count(DISTINCT listing_id) AS n_total FROM v_ranked
    UNION ALL
    SELECT 'any', count(DISTINCT listing_id), count(*), count(DISTINCT listing_id)
    FROM v_ranked)""")
def dq_counts(spark, sf):
    return dq.dq_counts(v.ranked(spark, sf), "listing_id", {
        "for_sale": F.col("listing_status") == "for sale", "any": F.lit(True)})


def _two_days(spark: SparkSession, sf: str) -> tuple[str, str, DataFrame]:
    """The newest loaded day and the one before it, found within 60 and 10 days."""
    events = v.biz_events(spark, sf)
    newest = dq.loaded_day(events, "event_date", "20240215", 60).first()["event_date"]
    earlier = dq.loaded_day(events, "event_date", elig.day_before(newest, 1), 10)
    return newest, earlier.first()["event_date"], events


@query("""SELECT n_current, n_previous, round(100.0 * abs(n_current - n_previous) / n_previous, 6)
                   AS pct, 100.0 * abs(n_current - n_previous) / n_previous <= 20 AS passed
          FROM (SELECT count(DISTINCT listing_id) FILTER (event_date = '20240130') AS n_current,
                       count(DISTINCT listing_id) FILTER (event_date = '20240129') AS n_previous
                FROM v_events)""")
def dq_drift(spark, sf):
    current, previous, events = _two_days(spark, sf)
    return rounded(dq.dq_drift(events, "event_date", "listing_id", current, previous))


@query("""SELECT user_id, CAST(count(*) AS BIGINT) AS n_rows,
                 CAST(sum(CASE WHEN match_score > before THEN 1 ELSE 0 END) AS BIGINT) AS n_breaks
          FROM (SELECT user_id, match_score, lag(match_score) OVER (
                         PARTITION BY user_id ORDER BY seq_id, match_score) AS before
                FROM v_ranked) GROUP BY 1""")
def dq_rank_order(spark, sf):
    return dq.dq_rank_order(v.ranked(spark, sf))


_UPSTREAM = f"(SELECT f.*, f.row_id * 7 % 5 AS moved FROM ({_FLAT}) f)"


@query(f"""SELECT user_id, state, CAST(count(*) AS BIGINT) AS n_rows,
                  CAST(sum(CASE WHEN moved < before THEN 1 ELSE 0 END) AS BIGINT) AS n_breaks
           FROM (SELECT r.user_id, r.state, u.moved, lag(u.moved) OVER (
                          PARTITION BY r.user_id, r.state ORDER BY r.seq_id, u.moved) AS before
                 FROM v_clean_ranked r
                 JOIN {_UPSTREAM} u USING (user_id, listing_id, state)) GROUP BY 1, 2""")
def dq_sequence(spark, sf):
    """Upstream positions are shuffled on purpose, so that there is something to find."""
    upstream = cand.explode_ranked(v.recommendations(spark, sf)).withColumn(
        "row_id", F.col("row_id") * 7 % 5)
    return dq.dq_sequence(elig.scrub_pairs(v.ranked(spark, sf)), upstream)


@query("""SELECT n_users, n_first, n_empty_first,
                 n_users = n_first AND n_empty_first = 0 AS passed
          FROM (SELECT count(DISTINCT user_id) AS n_users,
                       count(DISTINCT user_id) FILTER (seq_id = 1) AS n_first,
                       count(DISTINCT user_id) FILTER (seq_id = 1
                         AND coalesce(listing_type, '') = '') AS n_empty_first
                FROM v_ranked)""")
def dq_first_slot(spark, sf):
    return dq.dq_first_slot(v.ranked(spark, sf), dq.is_empty("listing_type"))


@query("""SELECT listing_id, listing_start_datetime_mst, dom AS age_days FROM v_listings_180
          WHERE dom > 5""")
def dq_age(spark, sf):
    late = dq.dq_age(_listings(spark, sf, 180), "listing_start_datetime_mst",
                     F.to_date(F.lit(v.RUN_DATE), "yyyyMMdd"), 5)
    return late.select("listing_id", "listing_start_datetime_mst", "age_days")


VERDICT_SQL = "CASE passed WHEN true THEN 'passed' WHEN false THEN 'failed' ELSE 'none' END AS verdict"


def verdict(passed: str) -> Column:
    """A check's result as text; volumes have none."""
    return (F.when(F.col(passed), "passed").when(~F.col(passed), "failed").otherwise("none")
            .alias("verdict"))


@query(f"SELECT * EXCLUDE (passed), {VERDICT_SQL} FROM (" + """
          SELECT 'duplicates' AS "check", count(*) = 0 AS passed, '20000115' AS target_date,
                 '{"n_violations":' || count(*) || '}' AS detail
          FROM (SELECT 1 FROM v_ranked WHERE listing_id IS NOT NULL
                GROUP BY user_id, listing_id HAVING count(*) > 1)
          UNION ALL
          SELECT 'first_slot', n_users = n_first, '20000115',
                 '{"n_users":' || n_users || ',"n_first":' || n_first
                 || ',"n_empty_first":0,"passed":' || (n_users = n_first) || '}'
          FROM (SELECT count(DISTINCT user_id) AS n_users,
                       count(DISTINCT user_id) FILTER (seq_id = 1) AS n_first FROM v_ranked)
          UNION ALL
          SELECT 'users.user_id', n_rows = 0, '20000115',
                 '{"check":"user_id","n_keys":' || n_keys || ',"n_rows":' || n_rows || ',"n_total":'
                 || n_total || ',"pct":' || CAST(100 * n_keys / n_total AS DOUBLE) || ',"passed":'
                 || (n_rows = 0) || '}'
          FROM (SELECT count(DISTINCT user_id) FILTER (user_id = '') AS n_keys,
                       count(*) FILTER (coalesce(user_id, '') = '') AS n_rows,
                       count(DISTINCT user_id) AS n_total FROM v_ranked)
          UNION ALL
          SELECT 'listings.for_sale', NULL, '20000115',
                 '{"check":"for_sale","n_keys":' || n_keys || ',"n_rows":' || n_rows
                 || ',"n_total":' || n_total || '}'
          FROM (SELECT count(DISTINCT listing_id) FILTER (listing_status = 'for sale') AS n_keys,
                       count(*) FILTER (listing_status = 'for sale') AS n_rows,
                       count(DISTINCT listing_id) AS n_total FROM v_ranked))""")
def dq_report(spark, sf):
    """Verdicts and the text of every detail, for checks and for volumes."""
    ranked = v.ranked(spark, sf)
    report = dq.dq_report({
        "duplicates": dq.dq_duplicates(ranked, ["user_id", "listing_id"]),
        "first_slot": dq.dq_first_slot(ranked),
        "users": dq.dq_rate(ranked, "user_id", {"user_id": dq.is_empty("user_id")}, {}),
    }, v.RUN_DATE, {"listings": dq.dq_counts(ranked, "listing_id", {
        "for_sale": F.col("listing_status") == "for sale"})})
    return report.select("check", verdict("passed"), "target_date", "detail")


# ------------------------------------------------------------------ partitioned tables

@query("""SELECT event_date, count(*) AS n, round(sum(event_id), 0) AS ids
          FROM v_events WHERE event_date BETWEEN '20240121' AND '20240130' GROUP BY 1""")
def lookback_scan(spark, sf):
    """Events written by day; the last ten days are read by pruning folders."""
    path = scratch_path(spark, "events")
    writers.write_partitioned(v.biz_events(spark, sf), path, ["event_date"])
    recent = readers.read_lookback(spark, path, "event_date", v.EVENTS_END, 10)
    return recent.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").cast("double").alias("ids"))


@query("""SELECT year || month || day AS day, count(*) AS n FROM (
            SELECT substr(day, 1, 4) AS year, substr(day, 5, 2) AS month, substr(day, 7, 2) AS day
            FROM v_push_sent) GROUP BY 1 HAVING day BETWEEN '20240116' AND '20240130'""")
def lookback_scan_ymd(spark, sf):
    """The same for year / month / day folders, whose leading zeros must survive."""
    path = scratch_path(spark, "push")
    writers.write_partitioned(v.push_sent(spark, sf), path, ["year", "month", "day"])
    recent = readers.read_lookback_ymd(spark, path, v.EVENTS_END, 15, """
        external_user_id string, campaign_id string, canvas_id string,
        year string, month string, day string""")
    return (recent.groupBy(F.concat("year", "month", "day").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT listing_id, listing_status, count(*) AS n FROM v_history
          WHERE year(vt) IN (9999, 1999) GROUP BY 1, 2""")
def union_years(spark, sf):
    """Open listing versions and those closed last year, by pruning on the year folder."""
    path = scratch_path(spark, "history")
    history = v.listing_history(spark, sf).withColumn(
        "year_yyyy", F.year("effective_to_datetime_mst"))
    writers.write_partitioned(history, path, ["year_yyyy"])
    versions = readers.union_years(readers.read_table(spark, path), 2000)
    return versions.groupBy("listing_id", "listing_status").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(user_group AS BIGINT) AS user_group, count(*) AS n FROM v_users_nl
          GROUP BY 1""")
def write_partitioned(spark, sf):
    """Users written by group twice: the second run replaces the first."""
    path = scratch_path(spark, "users")
    users = _users(spark, sf)
    writers.write_day(users.limit(0).unionByName(users), path, v.RUN_DATE, ["user_group"])
    again = writers.materialize(users, path, v.RUN_DATE, ["user_group"])
    return (again.groupBy(F.col("user_group").cast("long").alias("user_group"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("""SELECT event_date, count(*) AS n FROM v_events GROUP BY 1""")
def register_partitions(spark, sf):
    """A partitioned folder queried by table name."""
    path = scratch_path(spark, "registered")
    writers.write_partitioned(v.biz_events(spark, sf), path, ["event_date"])
    name = "registered_" + path.rsplit("-", 1)[-1]
    writers.register(spark, name, path, v.biz_events(spark, sf).schema, ["event_date"])
    return spark.table(name).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT member_id, email_address FROM (
            SELECT *, row_number() OVER (PARTITION BY member_id
                        ORDER BY updated_at DESC, account_row) AS rn
            FROM v_accounts WHERE email_address NOT LIKE '%staff.example%') WHERE rn = 1""")
def member_map_table(spark, sf):
    """The address map as an external table, created anew and read by name."""
    path = scratch_path(spark, "members")
    name = "members_" + path.rsplit("-", 1)[-1]
    mapped = lst.member_email_map(v.accounts(spark, sf), "staff.example", ("account_row",))
    writers.create_table_as(mapped, name, path)
    return spark.table(name)


# ------------------------------------------------------------------ whole days

def _tagged(first_day: str) -> str:
    """Tags from the events of first_day up to the day before the run, which is 24 years after RUN_DATE."""
    return f"""
    LEFT JOIN (SELECT DISTINCT uid, listing_id FROM v_events
               WHERE page_type LIKE '%ldp%' AND on_sale
                 AND event_date BETWEEN '{first_day}' AND '20240114') i
      ON i.uid = c.user_id AND i.listing_id = c.listing_id
    LEFT JOIN (SELECT DISTINCT uid, listing_id FROM v_events
               WHERE lower(saved_items) = 'y' AND on_sale
                 AND event_date BETWEEN '{first_day}' AND '20240114') s
      ON s.uid = c.user_id AND s.listing_id = c.listing_id"""


_TAGS = """CASE WHEN i.uid IS NOT NULL THEN 'y' ELSE 'n' END AS viewed,
           CASE WHEN s.uid IS NOT NULL THEN 'y' ELSE 'n' END AS saved_home"""


def _day(spark: SparkSession, sf: str) -> dict:
    # the events of 2024, as if of the year of the run
    events = v.biz_events(spark, sf).withColumn(
        "event_date", F.concat(F.lit("2000"), F.substring("event_date", 5, 4)))
    return {"history": v.listing_history(spark, sf), "events": events,
            "profiles": v.profiles(spark, sf), "url": "property_url", "ties": ("snapshot_id",)}


@query(f"""SELECT c.user_id, c.listing_id, c.listing_state, round(f.price, 6) AS match_score,
                  row_number() OVER (PARTITION BY c.user_id
                                     ORDER BY f.price DESC, c.listing_id) AS seq_id, {_TAGS}
           FROM ({_CANDIDATES.format(days=60)}) c
           JOIN v_listing_features f USING (listing_id)
           JOIN {_LATEST_FEATURES} u USING (user_id) {_tagged("20240105")}""")
def new_listings_day(spark, sf):
    """A complete day of the first campaign through its written tables, scored by price."""
    ranked = daily.new_listings(
        Store(scratch_path(spark, "day"), v.RUN_DATE), v.NL,
        user_features=v.user_features(spark, sf),
        listing_features=v.listing_features(spark, sf), lookups=_lookups(spark, sf),
        score=lambda features: F.col("price"),
        limits=daily.Skew(users_per_zip=100, listings_per_zip=10, rows_per_listing=50), **_day(spark, sf))
    return rounded(ranked.select("user_id", "listing_id", "listing_state", "match_score",
                                 F.col("seq_id").cast("long"), "viewed", "saved_home"))


@query(f"""SELECT c.user_id, c.state, c.listing_id, c.seq_id, {_TAGS}
           FROM ({_FILTERED.format(band="TRUE")}) c {_tagged("20240109")}""")
def recommended_homes_day(spark, sf):
    """A complete day of the second campaign through its written tables."""
    ranked = daily.recommended_homes(
        Store(scratch_path(spark, "day"), v.RUN_DATE), v.RH,
        recommendations=v.recommendations(spark, sf).drop("source_row"), **_day(spark, sf))
    return ranked.select("user_id", "state", "listing_id", F.col("seq_id").cast("long"),
                         "viewed", "saved_home")


def _cut_days(name: str, config) -> None:
    """The windows of a campaign's daily job, put into the views its SQL starts from."""
    for view, days in (("v_profiles", config.profile_days), ("v_user_features", config.feature_days)):
        first = readers.last_days(v.RUN_DATE, days)[0]
        cut = f"SELECT * FROM ({v.SQL[view]}) WHERE target_date BETWEEN '{first}' AND '{v.RUN_DATE}'"
        ORACLE[name] = ORACLE[name].replace(v.SQL[view], cut)


_cut_days("new_listings_day", v.NL)
_cut_days("recommended_homes_day", v.RH)
