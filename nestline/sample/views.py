"""Domain tables derived row by row from the test tables.

Every table exists twice: as a DataFrame here and as SQL text in ``SQL``, so that operator and
oracle start from the same rows. Ids, dates and values include the awkward cases: placeholder
ids, text that is no number, null and empty arrays, zero deviations, blank members.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nestline.config import NEW_LISTINGS, RECOMMENDED_HOMES

RUN_DATE = "20000115"
ORDERS_END = "20010801"
EVENTS_END = "20240130"
# the sample tables span years, so the windows of profiles and features do
NL = replace(NEW_LISTINGS, listing_age_days=60, event_days=10, profile_days=2000, feature_days=1500)
RH = replace(RECOMMENDED_HOMES, listing_age_days=180, event_days=6, profile_days=2500)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _pick(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def _customer(key: str) -> Column:
    """Customer key as a user id; one customer in 97 carries a placeholder instead."""
    junk = _pick(["unknown", "NULL", "$CUSTOMER_ID_$", ""], F.floor(F.col(key) / 97) % 4)
    return F.when(F.col(key) % 97 == 0, junk).otherwise(_text(F.col(key)))


def _day(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    numbers = F.sequence(F.lit(1).cast("long"), 2 + key % 9)
    entries = F.transform(numbers, lambda i: F.struct(
        F.concat(F.lit("Brand#"), _text(1 + (key * 3 + i * 7) % 25)).alias("category_name"),
        F.when((key + i) % 37 == 0, "n/a").otherwise(_text((key * 13 + i * 17) % 1000))
        .alias("score")))
    mean = F.col("o_totalprice") / 5
    return table(spark, sf, "orders").select(
        _customer("o_custkey").alias("user_id"),
        F.when(key % 41 == 0, F.lit(None)).when(key % 43 == 0, F.slice(entries, 1, 0))
        .otherwise(entries).alias("zip_stats"),
        F.struct(_text(mean).alias("overall_mean"),
                 F.when(key % 10 != 1, _text(mean * (key % 10) / 10)).alias("overall_std_dev"))
        .alias("price_stats"),
        _day("o_orderdate").alias("target_date"),
        key.alias("snapshot_id"))


def listing_history(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
        "l_linestatus", "l_shipdate")
    rows = lines.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    start = F.expr("timestampadd(SECOND, (l_orderkey * 7 + l_linenumber) % 86400, l_shipdate)")
    part, size, line = F.col("p_partkey"), F.col("p_size"), F.col("l_linenumber")
    listed = F.expr("timestampadd(DAY, cast(-l_quantity as int), valid_from)")
    return rows.withColumn("valid_from", start.cast("timestamp")).select(
        _text(F.floor(part / 2)).alias("property_id"),
        _text(part).alias("listing_id"),
        F.when((F.col("l_returnflag") == "R") & (line > 3), "y").otherwise("n")
        .alias("is_contingent"),
        F.when(line == 6, "y").when(line != 7, "n").alias("is_da_pending"),
        F.when(part % 50 == 0, "").otherwise(F.col("p_name")).alias("listing_address"),
        F.when(F.col("l_linestatus") == "O", "for sale").otherwise("off market")
        .alias("listing_status"),
        F.when(F.col("p_type") == "LARGE", "Land").when(F.col("p_type") == "SMALL", "Condos")
        .when(F.col("p_type") == "MEDIUM", "Townhomes").otherwise("Single Family Home")
        .alias("listing_type"),
        F.when(F.col("l_discount") > 0.06, F.concat(F.lit("http://img/xjpg/"), _text(part),
                                                    F.lit(".jpg")))
        .when(F.col("l_discount") > 0.04, "photo not available here")
        .otherwise("http://img/plain.png").alias("listing_photo_url"),
        size.alias("listing_photo_count"),
        F.when(size % 10 == 0, "0.0").otherwise(_text(size * 50)).alias("listing_square_feet"),
        F.when(size % 7 == 0, "0.0").otherwise(_text(size * 400))
        .alias("listing_lot_square_feet"),
        F.concat(F.lit("https://home/"), _text(part)).alias("property_url"),
        F.concat(F.lit("City "), _text(part % 20)).alias("listing_city"),
        _pick(["nm", "dc", "tx", "ca", "zz", "ny"], size % 6).alias("listing_state"),
        F.col("p_brand").alias("listing_postal_code"),
        (F.col("p_retailprice") * size * 2 + F.col("l_quantity")).alias("listing_current_price"),
        listed.alias("listing_start_datetime_mst"),
        F.expr("timestampadd(DAY, 400, valid_from)").alias("listing_end_datetime_mst"),
        F.col("valid_from").alias("effective_from_datetime_mst"),
        F.when(line % 4 == 0, F.lit("9999-12-31 00:00:00").cast("timestamp"))
        .otherwise(F.expr("timestampadd(DAY, cast(l_quantity * 10 as int), valid_from)"))
        .alias("effective_to_datetime_mst"),
        (size % 4).alias("listing_number_of_bath_rooms"),
        (size % 6).alias("listing_number_of_bed_rooms"))


def biz_events(spark: SparkSession, sf: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    kind = F.col("event_type")
    listing = _text(k * 2 + event % 2)
    return table(spark, sf, "events").select(
        event.alias("event_id"),
        F.when((user % 2 == 0) | (event % 97 == 0) | (event % 89 == 0), "")
        .otherwise(_text(user)).alias("member_id"),
        F.when(event % 97 == 0, F.lit(None)).when(event % 89 == 0, "null")
        .when(event % 83 == 0, "$CUSTOMER_ID_$").otherwise(_text(user)).alias("visitor_id"),
        F.when(event % 101 == 0, "unknown").when(event % 103 == 0, "")
        .when(event % 107 != 0, listing).alias("listing_id"),
        F.when(event % 101 == 0, "UNKNOWN").otherwise(listing).alias("listing_id_persist"),
        F.when(kind == "view", "for_sale_ldp").when(kind == "click", "ldp")
        .when(kind != "signup", "srp").alias("page_type"),
        F.when(kind.isin("view", "click"), "ldp").otherwise("srp").alias("page_type_group"),
        F.when(kind == "click", F.when(event % 2 == 0, "Y").otherwise("y")).otherwise("n")
        .alias("social_shares"),
        F.when(kind == "purchase", F.when(event % 3 == 0, "Y").otherwise("y"))
        .alias("saved_items"),
        F.when(event % 10 == 0, "sold").otherwise("for_sale").alias("property_status"),
        F.when(event % 13 == 0, "1234").when(event % 17 != 0, F.lpad(_text(k), 5, "9"))
        .alias("zip"),
        _day("ts").alias("event_date"))


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    numbers = F.sequence(F.lit(1).cast("long"), 1 + key % 12)
    entries = F.transform(numbers, lambda i: F.struct(
        _text(i).alias("mpr_id"),
        F.when((key + i) % 53 == 0, "unknown").otherwise(_text((key * 7 + i * i * 31) % 200))
        .alias("listing_id")))
    return table(spark, sf, "orders").select(
        _customer("o_custkey").alias("user_id"),
        F.when(key % 29 != 0, entries).alias("recommendations"),
        _pick(["NM", "DC", "TX", "CA", "NY"],
              F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("state"),
        key.alias("source_row"))


def ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked candidates with listing attributes, several positions per pair included.

    The same positions as in ``recommendations``, straight as rows.
    """
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        "o_custkey", key.alias("row"),
        _pick(["NM", "DC", "TX", "CA", "NY"],
              F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("state"),
        F.explode(F.when(key % 29 != 0, F.sequence(F.lit(1).cast("long"), 1 + key % 12))).alias("seq"))
    rows = rows.withColumn("known", (F.col("row") + F.col("seq")) % 53 != 0).withColumn(
        "number", F.when(F.col("known"), (F.col("row") * 7 + F.col("seq") * F.col("seq") * 31)
                         % 200).otherwise(7))
    seq, row, number = F.col("seq").cast("int"), F.col("row"), F.col("number")
    return rows.select(
        _customer("o_custkey").alias("user_id"),
        F.when(F.col("known"), _text(number)).otherwise("unknown").alias("listing_id"), "state",
        seq.alias("seq_id"),
        (1000 - seq * 10 + (row * seq) % 14).cast("double").alias("match_score"),
        _text(F.floor(number / 2)).alias("property_id"),
        F.when(number % 50 == 0, "").otherwise(F.concat(_text(number), F.lit(" Main St")))
        .alias("listing_address"),
        F.when(row % 11 == 0, "off market").otherwise("for sale").alias("listing_status"),
        F.when(number % 31 != 0, "condos").alias("listing_type"),
        F.concat(F.lit("https://img/"), _text(number)).alias("listing_photo_url"),
        (number % 9).alias("listing_photo_count"),
        F.when(number % 10 != 0, _text(number * 50)).alias("listing_square_feet"),
        F.when(number % 7 != 0, _text(number * 400)).alias("listing_lot_square_feet"),
        F.concat(F.lit("https://home/"), _text(number)).alias("ldp_url"),
        F.concat(F.lit("City "), _text(number % 20)).alias("listing_city"),
        _pick(["NM", "DC", "TX", "CA", "NY"], number % 5).alias("listing_state"),
        F.lpad(_text(number), 5, "0").alias("listing_postal_code"),
        (number * 1000.0).alias("listing_current_price"),
        F.lit("2000-01-10 00:00:00").alias("listing_start_datetime_mst"),
        (number % 4).alias("listing_number_of_bath_rooms"),
        (number % 6).alias("listing_number_of_bed_rooms"),
        (number % 30).alias("dom"), (number % 12).alias("ldp_pageview_count"),
        (number % 3).alias("shares_count"), (number % 5).alias("saves_count"),
        F.when(number % 2 == 0, "y").otherwise("n").alias("viewed"),
        F.when(number % 3 == 0, "y").otherwise("n").alias("saved_home"))


def user_features(spark: SparkSession, sf: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    usual = {
        "cal_price": F.when(key % 11 != 0, price / 5), "cal_lot_sqft": price / 40,
        "cal_bath": (key % 4).cast("double"), "cal_bed": (key % 5).cast("double"),
        "cal_sqft": F.when(key % 13 != 0, price / 90)}
    columns = [c.alias(f"{name}_t90") for name, c in usual.items()]
    columns += [(c * 0.75).alias(f"{name}_t90_20") for name, c in usual.items()]
    return table(spark, sf, "orders").select(
        _customer("o_custkey").alias("user_id"), _day("o_orderdate").alias("target_date"),
        key.alias("snapshot_id"), *columns,
        ((key % 170) - 85).cast("double").alias("cal_lat_t90"),
        F.when(key % 19 != 0, ((key % 350) - 175).cast("double")).alias("cal_lon_t90"),
        F.when(key % 23 != 0, F.concat(F.lit("City"), _text(key % 10))).alias("consumer_ip_city"),
        F.concat(F.lit("Z"), _text(key % 12)).alias("consumer_ip_zip"))


def listing_features(spark: SparkSession, sf: str) -> DataFrame:
    part, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf, "part").select(
        _text(part).alias("listing_id"),
        (F.col("p_retailprice") * size * 2).alias("price"),
        F.when(size % 9 != 0, (size * 100).cast("double")).alias("lot_sqft"),
        (size % 4).cast("double").alias("bath"), (size % 5).cast("double").alias("bed"),
        (size * 50).cast("double").alias("sqft"),
        ((part % 160) - 80).cast("double").alias("lat"),
        ((part % 340) - 170).cast("double").alias("lon"),
        F.concat(F.lit("Town"), _text(part % 10)).alias("ldp_city"),
        F.concat(F.lit("Z"), _text(part % 12)).alias("ldp_zip"))


def pair_lookup(spark: SparkSession, sf: str, left: str, right: str, value: str,
                prefixes: tuple[str, str], width: int) -> DataFrame:
    key = F.col("s_suppkey")
    return (table(spark, sf, "supplier")
            .groupBy(F.concat(F.lit(prefixes[0]), _text(key % width)).alias(left),
                     F.concat(F.lit(prefixes[1]), _text(F.floor(key / width) % width))
                     .alias(right))
            .agg(_text(F.min("s_acctbal")).alias(value)))


def opt_ins(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.when(key % 3 == 0, F.concat(F.lit("visitor_"), _text(key))).otherwise(_text(key))
        .alias("userId"),
        F.struct((F.col("c_acctbal") > 2000).alias("app"),
                 F.when(key % 17 != 0, F.col("c_acctbal") > 0).alias("web")).alias("optIns"))


def search_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        _text(F.col("o_custkey")).alias("member_id"),
        F.when(F.col("o_orderstatus") == "F", "y").otherwise("n").alias("is_saved_search"),
        _day("o_orderdate").alias("snapshot_date_mst_yyyymmdd"))


def dominant_zips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        _text(F.col("o_custkey")).alias("member_id"),
        F.lpad(_text(F.col("o_orderkey") % 100), 5, "0").alias("ldp_dominant_zip"),
        _pick(["NM", "DC", "TX", "CA", "NY"], F.col("o_orderkey") % 5).alias("listing_state"),
        _day("o_orderdate").alias("run_date_yyyymmdd"))


def _ymd() -> list[Column]:
    return [F.date_format("ts", p).alias(n)
            for p, n in (("yyyy", "year"), ("MM", "month"), ("dd", "day"))]


def push_sent(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        _text(F.col("user_id") * 3).alias("external_user_id"),
        F.col("event_type").alias("campaign_id"),
        F.concat(F.lit("canvas"), _text(F.col("event_id") % 40)).alias("canvas_id"), *_ymd())


def email_sent(spark: SparkSession, sf: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    return table(spark, sf, "events").select(
        F.when(user % 50 == 0, " ").when(event % 71 != 0, _text(user)).alias("customer_id"),
        F.when(event % 61 == 0, "").otherwise(F.col("event_type")).alias("campaign_id"),
        F.when(user % 7 != 0, F.concat(_text(user), F.lit("@mail"), _text(event % 3)))
        .alias("email"), *_ymd())


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        _text(F.col("o_custkey")).alias("member_id"),
        F.when(key % 31 == 0, F.concat(_text(key), F.lit("@staff.example")))
        .when(key % 37 != 0, F.concat(_text(key), F.lit("@mail"))).alias("email_address"),
        F.col("o_orderdate").alias("updated_at"), key.alias("account_row"))


def assignments(spark: SparkSession, sf: str, shift: int) -> DataFrame:
    """Past experiment assignments, null for some customers, repeated once per order."""
    user = F.col("o_custkey")
    place = (user + shift) % 9
    return table(spark, sf, "orders").select(
        _text(user).alias("user_id"),
        F.when(place < 5, _pick(["HOLD", "MAIN", "MAIN", "OTHER", "OLD"], place % 5))
        .alias("experiment_name"),
        _pick(["V1", "V2", "C"], user % 3).alias("variation"))


# ------------------------------------------------------------------ the same tables as SQL

def _sql_customer(key: str) -> str:
    return (f"CASE WHEN {key} % 97 = 0 THEN (['unknown', 'NULL', '$CUSTOMER_ID_$', ''])"
            f"[({key} // 97) % 4 + 1] ELSE CAST({key} AS VARCHAR) END")


def _sql_lookup(left: str, right: str, value: str, prefixes: tuple[str, str], width: int) -> str:
    return f"""
      SELECT '{prefixes[0]}' || (s_suppkey % {width}) AS {left},
             '{prefixes[1]}' || ((s_suppkey // {width}) % {width}) AS {right},
             min(s_acctbal) AS {value}
      FROM supplier GROUP BY 1, 2"""


def _sql_assignments(shift: int) -> str:
    return f"""
      SELECT CAST(o_custkey AS VARCHAR) AS user_id,
             (['HOLD', 'MAIN', 'MAIN', 'OTHER', 'OLD'])[(o_custkey + {shift}) % 9 + 1]
               AS experiment_name,
             (['V1', 'V2', 'C'])[o_custkey % 3 + 1] AS variation
      FROM orders"""


SQL = {
    "v_profiles": f"""
      SELECT {_sql_customer('o_custkey')} AS user_id, o_orderkey AS snapshot_id,
             strftime(o_orderdate, '%Y%m%d') AS target_date,
             o_totalprice / 5 AS overall_mean,
             CASE WHEN o_orderkey % 10 <> 1
                  THEN o_totalprice / 5 * (o_orderkey % 10) / 10 END AS overall_std_dev
      FROM orders""",
    "v_zip_scores": """
      SELECT o_orderkey AS snapshot_id,
             'Brand#' || (1 + (o_orderkey * 3 + i * 7) % 25) AS zip_code,
             CASE WHEN (o_orderkey + i) % 37 <> 0
                  THEN CAST((o_orderkey * 13 + i * 17) % 1000 AS DOUBLE) END AS score
      FROM orders, unnest(range(1, 3 + o_orderkey % 9)) AS u(i)
      WHERE o_orderkey % 41 <> 0 AND o_orderkey % 43 <> 0""",
    "v_history": """
      SELECT CAST(p_partkey // 2 AS VARCHAR) AS property_id,
             CAST(p_partkey AS VARCHAR) AS listing_id,
             CASE WHEN l_returnflag = 'R' AND l_linenumber > 3 THEN 'y' ELSE 'n' END
               AS is_contingent,
             CASE WHEN l_linenumber = 6 THEN 'y' WHEN l_linenumber <> 7 THEN 'n' END
               AS is_da_pending,
             CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_name END AS listing_address,
             CASE WHEN l_linestatus = 'O' THEN 'for sale' ELSE 'off market' END AS listing_status,
             CASE p_type WHEN 'LARGE' THEN 'Land' WHEN 'SMALL' THEN 'Condos'
                  WHEN 'MEDIUM' THEN 'Townhomes' ELSE 'Single Family Home' END AS listing_type,
             CASE WHEN l_discount > 0.06 THEN 'http://img/xjpg/' || p_partkey || '.jpg'
                  WHEN l_discount > 0.04 THEN 'photo not available here'
                  ELSE 'http://img/plain.png' END AS listing_photo_url,
             p_size AS listing_photo_count,
             CASE WHEN p_size % 10 = 0 THEN '0.0' ELSE CAST(p_size * 50 AS VARCHAR) END
               AS listing_square_feet,
             CASE WHEN p_size % 7 = 0 THEN '0.0' ELSE CAST(p_size * 400 AS VARCHAR) END
               AS listing_lot_square_feet,
             'https://home/' || p_partkey AS ldp_url, 'City ' || (p_partkey % 20) AS listing_city,
             (['nm', 'dc', 'tx', 'ca', 'zz', 'ny'])[p_size % 6 + 1] AS listing_state,
             p_brand AS listing_postal_code,
             p_retailprice * p_size * 2 + l_quantity AS listing_current_price,
             l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400) AS vf,
             l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400)
               - to_days(CAST(l_quantity AS INTEGER)) AS started,
             CASE WHEN l_linenumber % 4 = 0 THEN TIMESTAMP '9999-12-31'
                  ELSE l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400)
                       + to_days(CAST(l_quantity * 10 AS INTEGER)) END AS vt,
             p_size % 4 AS listing_number_of_bath_rooms, p_size % 6 AS listing_number_of_bed_rooms
      FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_events": """
      SELECT *, coalesce(nullif(member_id, ''), visitor_id) AS uid,
             (member_id <> '' OR (visitor_id IS NOT NULL AND trim(visitor_id) <> ''
               AND lower(visitor_id) <> 'null')) AND property_status = 'for_sale'
               AND listing_id IS NOT NULL AND listing_id NOT IN ('null', '', 'unknown') AS on_sale
      FROM (
        SELECT event_id,
               CASE WHEN user_id % 2 = 0 OR event_id % 97 = 0 OR event_id % 89 = 0 THEN ''
                    ELSE CAST(user_id AS VARCHAR) END AS member_id,
               CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'null'
                    WHEN event_id % 83 = 0 THEN '$CUSTOMER_ID_$'
                    ELSE CAST(user_id AS VARCHAR) END AS visitor_id,
               CASE WHEN event_id % 101 = 0 THEN 'unknown' WHEN event_id % 103 = 0 THEN ''
                    WHEN event_id % 107 <> 0
                    THEN CAST(CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) * 2
                              + event_id % 2 AS VARCHAR) END AS listing_id,
               CASE WHEN event_id % 101 = 0 THEN 'UNKNOWN'
                    ELSE CAST(CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) * 2
                              + event_id % 2 AS VARCHAR) END AS listing_id_persist,
               CASE event_type WHEN 'view' THEN 'for_sale_ldp' WHEN 'click' THEN 'ldp'
                    WHEN 'signup' THEN NULL ELSE 'srp' END AS page_type,
               CASE WHEN event_type IN ('view', 'click') THEN 'ldp' ELSE 'srp' END
                 AS page_type_group,
               CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'y' END
                    ELSE 'n' END AS social_shares,
               CASE WHEN event_type = 'purchase'
                    THEN CASE WHEN event_id % 3 = 0 THEN 'Y' ELSE 'y' END END AS saved_items,
               CASE WHEN event_id % 10 = 0 THEN 'sold' ELSE 'for_sale' END AS property_status,
               CASE WHEN event_id % 13 = 0 THEN '1234' WHEN event_id % 17 <> 0
                    THEN lpad(regexp_extract(props, '(\\d+)', 1), 5, '9') END AS zip,
               strftime(ts, '%Y%m%d') AS event_date
        FROM events)""",
    "v_recs": f"""
      SELECT {_sql_customer('o_custkey')} AS user_id, o_orderkey AS source_row, i - 1 AS row_id,
             (['NM', 'DC', 'TX', 'CA', 'NY'])[CAST(substr(o_orderpriority, 1, 1) AS INTEGER)]
               AS state,
             CASE WHEN i IS NULL THEN NULL WHEN (o_orderkey + i) % 53 = 0 THEN 'unknown'
                  ELSE CAST((o_orderkey * 7 + i * i * 31) % 200 AS VARCHAR) END AS listing_id
      FROM (SELECT *, unnest(CASE WHEN o_orderkey % 29 = 0 THEN [NULL]
                             ELSE range(1, 2 + o_orderkey % 12) END) AS i FROM orders)""",
    "v_ranked": """
      SELECT user_id, listing_id, state, row_id + 1 AS seq_id,
             CAST(1000 - (row_id + 1) * 10 + (source_row * (row_id + 1)) % 14 AS DOUBLE)
               AS match_score, number,
             CAST(number // 2 AS VARCHAR) AS property_id,
             CASE WHEN number % 50 = 0 THEN '' ELSE number || ' Main St' END AS listing_address,
             CASE WHEN source_row % 11 = 0 THEN 'off market' ELSE 'for sale' END
               AS listing_status,
             CASE WHEN number % 31 <> 0 THEN 'condos' END AS listing_type,
             number % 9 AS listing_photo_count,
             CASE WHEN number % 10 <> 0 THEN CAST(number * 50 AS VARCHAR) END
               AS listing_square_feet,
             CASE WHEN number % 7 <> 0 THEN CAST(number * 400 AS VARCHAR) END
               AS listing_lot_square_feet,
             'https://img/' || number AS listing_photo_url, 'https://home/' || number AS ldp_url,
             'City ' || (number % 20) AS listing_city,
             (['NM', 'DC', 'TX', 'CA', 'NY'])[number % 5 + 1] AS listing_state,
             lpad(CAST(number AS VARCHAR), 5, '0') AS listing_postal_code,
             CAST(number * 1000 AS DOUBLE) AS listing_current_price,
             '2000-01-10 00:00:00' AS listing_start_datetime_mst,
             number % 4 AS listing_number_of_bath_rooms, number % 6 AS listing_number_of_bed_rooms,
             number % 30 AS dom, number % 12 AS ldp_pageview_count, number % 3 AS shares_count,
             number % 5 AS saves_count, CASE WHEN number % 2 = 0 THEN 'y' ELSE 'n' END AS viewed,
             CASE WHEN number % 3 = 0 THEN 'y' ELSE 'n' END AS saved_home
      FROM (SELECT *, coalesce(TRY_CAST(listing_id AS BIGINT), 7) AS number
            FROM v_recs WHERE row_id IS NOT NULL)""",
    "v_user_features": f"""
      SELECT {_sql_customer('o_custkey')} AS user_id, strftime(o_orderdate, '%Y%m%d') AS target_date,
             o_orderkey AS snapshot_id,
             CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice / 5 END AS cal_price_t90,
             o_totalprice / 40 AS cal_lot_sqft_t90,
             CAST(o_orderkey % 4 AS DOUBLE) AS cal_bath_t90,
             CAST(o_orderkey % 5 AS DOUBLE) AS cal_bed_t90,
             CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice / 90 END AS cal_sqft_t90,
             CAST(o_orderkey % 170 - 85 AS DOUBLE) AS cal_lat_t90,
             CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 350 - 175 AS DOUBLE) END
               AS cal_lon_t90,
             CASE WHEN o_orderkey % 23 <> 0 THEN 'City' || (o_orderkey % 10) END
               AS consumer_ip_city,
             'Z' || (o_orderkey % 12) AS consumer_ip_zip
      FROM orders""",
    "v_listing_features": """
      SELECT CAST(p_partkey AS VARCHAR) AS listing_id, p_retailprice * p_size * 2 AS price,
             CASE WHEN p_size % 9 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS lot_sqft,
             CAST(p_size % 4 AS DOUBLE) AS bath, CAST(p_size % 5 AS DOUBLE) AS bed,
             CAST(p_size * 50 AS DOUBLE) AS sqft, CAST(p_partkey % 160 - 80 AS DOUBLE) AS lat,
             CAST(p_partkey % 340 - 170 AS DOUBLE) AS lon, 'Town' || (p_partkey % 10) AS ldp_city,
             'Z' || (p_partkey % 12) AS ldp_zip
      FROM part""",
    "v_con_city": _sql_lookup("consumer_ip_city", "ldp_city", "m", ("City", "Town"), 10),
    "v_con_zip": _sql_lookup("consumer_ip_zip", "ldp_zip", "m", ("Z", "Z"), 12),
    "v_opt_ins": """
      SELECT CASE WHEN c_custkey % 3 = 0 THEN 'visitor_' || c_custkey
                  ELSE CAST(c_custkey AS VARCHAR) END AS userId,
             c_acctbal > 2000 AS app, CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal > 0 END AS web
      FROM customer""",
    "v_search": """
      SELECT CAST(o_custkey AS VARCHAR) AS member_id,
             CASE WHEN o_orderstatus = 'F' THEN 'y' ELSE 'n' END AS is_saved_search,
             strftime(o_orderdate, '%Y%m%d') AS day
      FROM orders""",
    "v_domzip": """
      SELECT CAST(o_custkey AS VARCHAR) AS member_id,
             (['NM', 'DC', 'TX', 'CA', 'NY'])[o_orderkey % 5 + 1] AS listing_state,
             strftime(o_orderdate, '%Y%m%d') AS day
      FROM orders""",
    "v_push_sent": """
      SELECT CAST(user_id * 3 AS VARCHAR) AS external_user_id, event_type AS campaign_id,
             'canvas' || (event_id % 40) AS canvas_id, strftime(ts, '%Y%m%d') AS day
      FROM events""",
    "v_email_sent": """
      SELECT CASE WHEN user_id % 50 = 0 THEN ' '
                  WHEN event_id % 71 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
             CASE WHEN event_id % 61 = 0 THEN '' ELSE event_type END AS campaign_id,
             CASE WHEN user_id % 7 <> 0 THEN user_id || '@mail' || (event_id % 3) END AS email,
             strftime(ts, '%Y%m%d') AS day
      FROM events""",
    "v_accounts": """
      SELECT CAST(o_custkey AS VARCHAR) AS member_id,
             CASE WHEN o_orderkey % 31 = 0 THEN o_orderkey || '@staff.example'
                  WHEN o_orderkey % 37 <> 0 THEN o_orderkey || '@mail' END AS email_address,
             o_orderdate AS updated_at, o_orderkey AS account_row
      FROM orders""",
    "v_own_hist": _sql_assignments(0),
    "v_other_hist": _sql_assignments(4),
}


def _listing_sql(days: int) -> str:
    """Current listings at the run date, written as the rules read."""
    return f"""
      SELECT property_id, listing_id, listing_address, listing_status, listing_type,
             CASE WHEN listing_photo_url LIKE '%.jpg'
                  THEN replace(left(listing_photo_url, length(listing_photo_url) - 4)
                               || 'od-w640_h480_q80_r4.jpg', 'http://', 'https://')
                  WHEN listing_photo_url LIKE '%not available%' THEN 'not available'
                  ELSE replace(listing_photo_url, 'http://', 'https://') END AS listing_photo_url,
             listing_photo_count, nullif(listing_square_feet, '0.0') AS listing_square_feet,
             nullif(listing_lot_square_feet, '0.0') AS listing_lot_square_feet, ldp_url,
             listing_city, upper(listing_state) AS listing_state, listing_postal_code,
             listing_current_price, strftime(started, '%Y-%m-%d %H:%M:%S')
               AS listing_start_datetime_mst,
             listing_number_of_bath_rooms, listing_number_of_bed_rooms,
             date_diff('day', CAST(started AS DATE), DATE '2000-01-15') AS dom
      FROM (
        SELECT *, row_number() OVER (PARTITION BY property_id
                    ORDER BY started DESC, vf DESC, listing_id) AS rn
        FROM v_history
        WHERE vf <= TIMESTAMP '2000-01-15 23:59:59' AND vt > TIMESTAMP '2000-01-15 23:59:59'
          AND listing_status = 'for sale' AND is_contingent <> 'y' AND is_da_pending <> 'y'
          AND length(listing_address) > 0 AND length(listing_city) > 0
          AND lower(listing_type) IN ('condos', 'townhomes', 'single family home')
          AND started BETWEEN TIMESTAMP '2000-01-15' - to_days({days})
                          AND TIMESTAMP '2000-01-15 23:59:59')
      WHERE rn = 1 AND upper(listing_state) <> 'ZZ'"""


def _users_sql(groups: int, zips: int, k: float) -> str:
    """Users: latest profile, best zips, clamped price band."""
    return f"""
      SELECT user_id, user_group, zip_code, score, overall_mean, sd3 AS overall_std_dev,
             listing_price_median, overall_mean - {k} * sd3 AS price_floor,
             overall_mean + {k} * sd3 AS price_ceiling
      FROM (
        SELECT *, CASE WHEN sd2 = 0 THEN 0.1 * overall_mean ELSE sd2 END AS sd3 FROM (
          SELECT *, CASE WHEN sd1 > 0.67 * overall_mean
                         THEN least(0.67 * overall_mean, listing_price_median)
                         ELSE sd1 END AS sd2 FROM (
            SELECT z.*, coalesce(m.listing_price_median, 0) AS listing_price_median,
                   CASE WHEN overall_std_dev < 0.1 * overall_mean
                        THEN least(0.1 * overall_mean, coalesce(m.listing_price_median, 0))
                        ELSE overall_std_dev END AS sd1
            FROM (
              SELECT p.user_id, p.overall_mean, p.overall_std_dev, s.zip_code, s.score,
                     CAST('0x' || substr(md5(p.user_id), 1, 8) AS BIGINT) % {groups}
                       AS user_group,
                     row_number() OVER (PARTITION BY p.user_id
                       ORDER BY s.score DESC NULLS LAST, s.zip_code) AS rn
              FROM v_latest_profile p LEFT JOIN v_zip_scores s USING (snapshot_id)) z
            LEFT JOIN v_medians m USING (zip_code)
            WHERE rn <= {zips})))"""


SQL |= {
    "v_listings_180": _listing_sql(180),
    "v_listings_60": _listing_sql(60),
    "v_medians": """
      SELECT listing_postal_code AS zip_code,
             quantile_disc(listing_current_price, 0.5) AS listing_price_median
      FROM v_listings_180 GROUP BY 1 HAVING quantile_disc(listing_current_price, 0.5) > 9999""",
    "v_latest_profile": """
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
                                     ORDER BY target_date DESC, snapshot_id) AS prn
        FROM v_profiles
        WHERE user_id NOT IN ('unknown', 'NULL', 'null', '$CUSTOMER_ID_$', '$customer_id_$', ''))
      WHERE prn = 1""",
    "v_users_nl": _users_sql(50, 3, 1.5),
    "v_users_rh": _users_sql(12, 4, 3.0),
    "v_clean_ranked": """
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, listing_id
                                     ORDER BY seq_id, state, listing_state, match_score,
                                              listing_status) AS crn
        FROM v_ranked WHERE user_id NOT IN ('$CUSTOMER_ID_$', 'unknown')
                        AND listing_id <> 'unknown')
      WHERE crn = 1""",
}


def with_views(sql: str) -> str:
    """Prefix a query with the tables it uses, directly or through other tables."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in SQL and name not in needed:
                visit(SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    # materialised: a table used twice is computed once
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({SQL[name]})" for name in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql
