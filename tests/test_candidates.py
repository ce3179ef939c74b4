import pytest
from pyspark.sql import functions as F

from nestline.operators import candidates as cand, scoring, skew
from nestline.sample.queries import QUERIES
from tests.helpers import plan, rows

EVENTS = ("member_id string, visitor_id string, listing_id string, page_type string, "
          "property_status string, saved_items string")


def events(spark):
    sale = "for_sale"
    return spark.createDataFrame([
        ("m", None, "l1", "for_sale_ldp", sale, None), ("m", "v", "l1", "ldp", sale, "Y"),
        ("m", None, "l1", "srp", sale, "y"), ("", "v", "l2", "ldp", sale, None),
        ("", None, "l3", "ldp", sale, "y"), ("", "null", "l3", "ldp", sale, "y"),
        ("m", None, "unknown", "ldp", sale, "y"), ("m", None, None, "ldp", sale, "y"),
        ("m", None, "l4", "ldp", "sold", "y"), ("m", None, "l5", None, sale, "Y"),
        ("null", None, "l1", "ldp", sale, "y")], EVENTS)


def test_interactions_and_saved_items(spark):
    assert rows(cand.interactions(events(spark))) == [("m", "l1"), ("null", "l1"), ("v", "l2")]
    assert rows(cand.saved_items(events(spark))) == [("m", "l1", "y"), ("m", "l5", "y"),
                                                     ("null", "l1", "y")]


def test_tags_keep_one_row_per_candidate(spark):
    pairs = spark.createDataFrame([("m", "l1"), ("m", "l5"), ("m", "l9"), ("v", "l2"),
                                   ("null", "l1")], "user_id string, listing_id string")
    tagged = cand.tag_interactions(pairs, cand.interaction_flags(events(spark)))
    assert rows(tagged, "user_id", "listing_id", "viewed", "saved_items", "saved_home") == [
        ("m", "l1", "y", "y", "y"), ("m", "l5", "n", "y", "y"), ("m", "l9", "n", None, "n"),
        ("null", "l1", "n", "y", "y"), ("v", "l2", "y", None, "n")]


def test_candidates_need_zip_and_price(spark):
    users = spark.createDataFrame(
        [("u", 1, "z1", 1.0, 5.0, 1.0, 0.0, 10.0, 20.0), ("w", 2, "z1", 1.0, 5.0, 1.0, 0.0, None, None)],
        "user_id string, user_group int, zip_code string, score double, overall_mean double, "
        "overall_std_dev double, listing_price_median double, price_floor double, "
        "price_ceiling double")
    listings = spark.createDataFrame(
        [("a", "z1", 10.0), ("b", "z1", 20.0), ("c", "z1", 20.5), ("d", "z2", 15.0), ("e", None, 15.0)],
        "listing_id string, listing_postal_code string, listing_current_price double")
    got = cand.generate_candidates(users, listings)
    assert rows(got, "user_id", "listing_id") == [("u", "a"), ("u", "b")]
    assert set(got.columns) == {"user_id", "user_group", "listing_price_median", "listing_id",
                                "listing_postal_code", "listing_current_price"}
    hot = cand.hot_zips(users, listings, max_users=1, max_listings=1)
    assert rows(cand.generate_candidates(users, listings, hot), "user_id", "listing_id") == [
        ("u", "a"), ("u", "b")]


RECS = "user_id string, recommendations array<struct<mpr_id: string, listing_id: string>>, state string"


def test_explode_ranked_keeps_first_position_per_state(spark):
    df = spark.createDataFrame([("u", [("1", "a"), ("2", "b"), ("3", "a")], "NM"),
                                ("u", [("1", "b")], "NM"), ("u", [("1", "a")], "TX"),
                                ("w", None, "NM")], RECS)
    assert rows(cand.explode_ranked(df)) == [("u", "a", "NM", 0), ("u", "a", "TX", 0),
                                             ("u", "b", "NM", 0), ("w", None, "NM", None)]


def test_filter_recommendations(spark):
    recs = spark.createDataFrame(
        [("u", f"l{i:02}", "NM", i) for i in range(14)] + [("u", "l03", "TX", 5), ("w", "l00", "NM", 0)],
        "user_id string, listing_id string, state string, row_id int")
    listings = spark.createDataFrame(
        [(f"l{i:02}", None if i == 4 else f"p{i}", "z1" if i != 2 else "z2", float(i), f"{i} Main St")
         for i in range(14)], "listing_id string, property_id string, listing_postal_code string, "
                              "listing_current_price double, listing_address string")
    users = spark.createDataFrame([("u", 3, "z1", 4.0, 9.0)], "user_id string, user_group int, "
                                  "zip_code string, price_floor double, price_ceiling double")
    got = cand.filter_recommendations(recs, listings, users)
    want = [("NM", f"l{i:02}", s + 1) for s, i in enumerate([0, 1, 3, 4, 5, 6, 7, 8, 9, 10])]
    assert rows(got, "state", "listing_id", "seq_id") == want + [("TX", "l03", 1)]
    assert rows(got.filter("listing_id = 'l04'"), "listing_address", "user_group") == [("4 Main St", 3)]
    assert len(got.columns) == len(set(got.columns)) and "price_floor" not in got.columns
    banded = cand.filter_recommendations(recs, listings, users, 3, apply_price_band=True)
    assert rows(banded, "state", "listing_id", "seq_id") == [("NM", f"l0{4 + i}", i + 1)
                                                             for i in range(3)]


def test_lookups_fill_real_columns_with_nan_and_leave_others(spark):
    df = spark.createDataFrame([("c", "t", 1, None), ("x", "t", None, 2.0), (None, "t", 3, 1.0)],
                               "consumer_ip_city string, ldp_city string, n int, d double")
    table = spark.createDataFrame([("c", "t", "0.5", "9"), ("c", "q", "bad", "9")],
                                  "consumer_ip_city string, ldp_city string, m string, web_uus_sum string")
    lookup = scoring.Lookup(table, ("consumer_ip_city", "ldp_city"), "m", "median")
    got = {r["consumer_ip_city"]: r for r in scoring.lookup_enrich(df, [lookup]).collect()}
    assert got["c"]["median"] == 0.5 and got["c"]["d"] != got["c"]["d"]
    assert got["x"]["median"] != got["x"]["median"] and got["x"]["n"] is None
    assert "web_uus_sum" not in got["c"].asDict()


def test_feature_vector_columns(spark):
    attributes = ("price", "lot_sqft", "bath", "bed", "sqft")
    users = spark.createDataFrame([("u", "20200601", *[2.0] * 10, 10.0, 20.0, "c", "z")],
                                  "user_id string, target_date string, " + ", ".join(
        f"cal_{a}_{w} double" for a in attributes for w in ("t90", "t90_20"))
        + ", cal_lat_t90 double, cal_lon_t90 double, consumer_ip_city string, consumer_ip_zip string")
    listings = spark.createDataFrame([("l", "20200601", *[4.0] * 5, 10.0, 20.0, "t", "z")],
                                     "listing_id string, target_date string, " + ", ".join(
        f"{a} double" for a in attributes) + ", lat double, lon double, ldp_city string, ldp_zip string")
    pairs = spark.createDataFrame([("u", "l", 7), ("u", "gone", 7), ("gone", "l", 7)],
                                  "user_id string, listing_id string, user_group int")
    row = scoring.build_features(pairs, users, listings, []).collect()
    assert len(row) == 1
    row = row[0].asDict()
    assert sum("_cal_" in k and k.split("_cal_")[0].endswith(("ratio", "diff")) for k in row) == 20
    assert row["price_ratio_cal_price_t90"] == 0.5 and row["bed_diff_cal_bed_t90_20"] == 2.0
    assert row["listing_to_interest_distance"] == 0.0
    assert not {"target_date", "ldp_city", "ldp_zip", "consumer_ip_city"} & set(row)
    hot = skew.hot_keys(pairs, ["listing_id"], 1)
    assert scoring.build_features(pairs, users, listings, [], hot).count() == 1


def test_pairs_are_dealt_out_before_their_numbers_are_worked_out(spark):
    usual = ", ".join(f"id + 2.0D AS cal_{a}_{w}" for a in ("price", "lot_sqft", "bath", "bed", "sqft")
                      for w in ("t90", "t90_20"))
    users = spark.sql(f"""
        SELECT 'u' || id AS user_id, {usual}, 10D AS cal_lat_t90, 20D AS cal_lon_t90, 'c' || id AS consumer_ip_city
        FROM range(2)""")
    listings = spark.sql("""SELECT 'l' || id AS listing_id, 4D AS price, 4D AS lot_sqft, 4D AS bath, 4D AS bed,
                            4D AS sqft, 10D AS lat, 20D AS lon, 't' AS ldp_city FROM range(2)""")
    pairs = spark.sql("""SELECT 'u' || u.id AS user_id, 'l' || l.id AS listing_id, u.id AS user_group
                         FROM range(2) u, range(2) l""")
    cities = spark.sql("SELECT 'c0' AS consumer_ip_city, 't' AS ldp_city, '3' AS m")
    lookup = scoring.Lookup(cities, ("consumer_ip_city", "ldp_city"), "m", "con_pct_web_uls_median_city")
    plain = scoring.build_features(pairs, users, listings, [lookup])
    dealt = scoring.build_features(pairs, users, listings, [lookup], deal_by=["user_group"])
    after, before = plan(dealt).split("REBALANCE_PARTITIONS_BY_COL")
    assert "_ratio_cal_" in after and "_ratio_cal_" not in before
    assert dealt.columns == plain.columns and repr(rows(dealt)) == repr(rows(plain)) and dealt.count() == 4


def test_rank_candidates_numbers_from_the_best(spark):
    df = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 3.0), ("u", "c", 3.0), ("w", "a", 0.0)],
                               "user_id string, listing_id string, x double")
    ranked = scoring.rank_candidates(df, F.col("x") * 2)
    assert rows(ranked, "user_id", "listing_id", "match_score", "seq_id") == [
        ("u", "a", 2.0, 3), ("u", "b", 6.0, 1), ("u", "c", 6.0, 2), ("w", "a", 0.0, 1)]


@pytest.mark.parametrize("name", ["candidate_generation", "candidate_generation_split", "listings_within"])
def test_candidates_are_rounded_before_they_are_made(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join Inner") < plan.index("round(")
