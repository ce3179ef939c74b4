from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from nestline.config import NEW_LISTINGS
from nestline.operators import listings as lst, profile as prof
from nestline.operators import snapshot
from tests.helpers import rows

PROFILE = ("user_id string, zip_stats array<struct<category_name: string, score: string>>, "
           "price_stats struct<overall_mean: string, overall_std_dev: string>, target_date string")


def test_top_n_orders_numbers_not_text_and_keeps_users_without_zips(spark):
    df = spark.createDataFrame([
        ("a", [("z1", "9.5"), ("z2", "10.2"), ("z3", "100"), ("z4", "100"), ("z5", "n/a"),
               ("z6", None)]),
        ("b", []), ("c", None)],
        "user_id string, z array<struct<category_name: string, score: string>>")
    got = prof.top_n_from_array(df, "z", "category_name", "score", 3)
    assert rows(got, "user_id", "zip_code", "score") == [
        ("a", "z2", 10.2), ("a", "z3", 100.0), ("a", "z4", 100.0), ("b", None, None),
        ("c", None, None)]
    every = prof.top_n_from_array(df, "z", "category_name", "score", 9).filter("user_id = 'a'")
    assert every.count() == 6


@pytest.mark.parametrize("mean, std, median, want", [
    ("1000", "200", 500.0, 200.0),      # inside the clamp
    ("1000", "50", 500.0, 100.0),       # too small -> 10 % of the mean
    ("1000", "50", 60.0, 60.0),         # ... but not above the local median
    ("1000", "900", 800.0, 670.0),      # too large -> 67 %
    ("1000", "900", 500.0, 500.0),
    ("1000", "50", None, 100.0),        # unknown median counts as 0, and 0 becomes 10 %
    ("1000", "900", None, 100.0),
    ("1000", "0", 500.0, 100.0),
    ("1000", None, 500.0, None),
    ("bad", "50", 500.0, 50.0),         # no mean: nothing to compare with
])
def test_price_band_rules_in_order(spark, mean, std, median, want):
    df = spark.createDataFrame([(mean, std, median)], "overall_mean string, overall_std_dev string,"
                                                      " listing_price_median double")
    row = prof.price_band(df, 1.5).first()
    assert row["overall_std_dev"] == want
    if want is not None and row["overall_mean"] is not None:
        assert row["price_floor"] == 1000 - 1.5 * want
        assert row["price_ceiling"] == 1000 + 1.5 * want


def test_median_is_a_real_price_and_small_medians_are_left_out(spark):
    df = spark.createDataFrame([("a", 10000.0), ("a", 20000.0), ("a", 90000.0), ("b", 9999.0),
                                ("c", 10000.0), ("c", 30000.0)],
                               "listing_postal_code string, listing_current_price double")
    assert rows(prof.group_median(df)) == [("a", 20000.0), ("c", 10000.0)]


def test_build_users_end_to_end(spark):
    stats = ("1000", "200")
    df = spark.createDataFrame([
        ("u", [("z1", "1"), ("z2", "2")], stats, "20200601"),
        ("u", [("z9", "1")], stats, "20200530"),
        ("unknown", [("z1", "1")], stats, "20200601"),
        ("null", [("z1", "1")], stats, "20200601")], PROFILE)
    medians = spark.createDataFrame([("z1", 10000.0)], "zip_code string, listing_price_median double")
    users = prof.build_users(df, medians, NEW_LISTINGS)
    assert rows(users, "user_id", "zip_code", "score", "listing_price_median", "price_floor") == [
        ("u", "z1", 1.0, 10000.0, 700.0), ("u", "z2", 2.0, 0.0, 700.0)]
    assert all(0 <= r["user_group"] < 50 for r in users.collect())


BASE = dict(property_id="p", listing_id="l", is_contingent="n", is_da_pending="n",
            listing_address="1 Main St", listing_status="for sale", listing_type="Condos",
            listing_photo_url="http://x/ajpg/b.jpg", listing_photo_count=3,
            listing_square_feet="0.0", listing_lot_square_feet="120.0", page_url="u",
            listing_city="C", listing_state="nm", listing_postal_code="87101",
            listing_current_price=100.0, start="2020-06-01 10:00:00", end="2020-07-01 00:00:00",
            valid_from="2020-06-01 10:00:00", valid_to="9999-12-31 00:00:00", bath=1.0, bed=2.0)
NAMES = {"start": "listing_start_datetime_mst",
         "end": "listing_end_datetime_mst", "valid_from": "effective_from_datetime_mst",
         "valid_to": "effective_to_datetime_mst", "bath": "listing_number_of_bath_rooms",
         "bed": "listing_number_of_bed_rooms"}


def history(spark, *changes):
    records = [{**BASE, "property_id": f"p{i}", "listing_id": f"l{i}", **c}
               for i, c in enumerate(changes)]
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}"
                       for k, v in BASE.items())
    df = spark.createDataFrame([tuple(r[k] for k in BASE) for r in records], schema)
    times = [c for c in ("start", "end", "valid_from", "valid_to")]
    df = df.withColumns({c: F.col(c).cast("timestamp") for c in times})
    return df.withColumnsRenamed(NAMES)


def kept(spark, *changes, days=5):
    found = lst.build_listings(history(spark, *changes), "20200603", days, url="page_url")
    return [r[0] for r in rows(found, "listing_id")]


def test_listing_filters(spark):
    assert kept(spark, {}, {"is_contingent": "y"}, {"is_contingent": None}, {"is_da_pending": "y"},
                {"listing_address": ""}, {"listing_city": None}, {"listing_status": "sold"},
                {"listing_type": "land"}, {"listing_state": "zz"}, {"is_contingent": "Y"}) == \
        ["l0", "l9"]


def test_listing_age_and_validity_boundaries(spark):
    assert kept(spark,
                {"start": "2020-05-29 00:00:00"}, {"start": "2020-05-28 23:59:59"},
                {"start": "2020-06-03 23:59:59"}, {"start": "2020-06-04 00:00:00"},
                {"valid_from": "2020-06-03 23:59:59"}, {"valid_to": "2020-06-03 23:59:59"},
                {"valid_to": "2020-06-04 00:00:00"}) == ["l0", "l2", "l4", "l6"]


def test_latest_listing_of_a_property(spark):
    assert kept(spark, {"property_id": "p", "start": "2020-06-01 00:00:00"},
                {"property_id": "p", "start": "2020-06-02 00:00:00"},
                {"property_id": "p", "start": "2020-06-02 00:00:00",
                 "end": "2020-08-01 00:00:00"}) == ["l2"]


def test_state_filter_comes_after_the_latest_listing(spark):
    assert kept(spark, {"property_id": "p", "start": "2020-06-01 00:00:00"},
                {"property_id": "p", "start": "2020-06-02 00:00:00", "listing_state": "zz"}) == []


def test_shorter_window_from_a_longer_one(spark):
    changes = [{"property_id": f"p{i % 4}", "start": f"2020-05-{20 + i} 0{i % 10}:00:00",
                "valid_from": f"2020-05-{20 + i} 10:00:00"} for i in range(12)]
    longer = lst.build_listings(history(spark, *changes), "20200603", 30, url="page_url")
    for days in (2, 4, 5, 8, 30):
        cut = [r[0] for r in rows(lst.listings_within(longer, days), "listing_id")]
        assert cut == kept(spark, *changes, days=days)


def test_listing_cleanup(spark):
    photos = ["http://x/ajpg/b.jpg", "photo not available", "http://x/c.png", "http://x/cjpg"]
    df = lst.build_listings(history(spark, *[{"listing_photo_url": p} for p in photos]),
                            "20200603", 5, url="page_url")
    assert rows(df, "listing_id", "listing_photo_url") == [
        ("l0", "https://x/ajpg/bod-w640_h480_q80_r4.jpg"), ("l1", "not available"),
        ("l2", "https://x/c.png"), ("l3", "https://x/cjpg")]
    first = df.filter("listing_id = 'l0'").first()
    assert first["listing_square_feet"] is None and first["listing_lot_square_feet"] == "120.0"
    assert first["listing_state"] == "NM" and first["dom"] == 2 and first["ldp_url"] == "u"
    assert first["listing_start_datetime_mst"] == "2020-06-01 10:00:00"
    assert "effective_to_datetime_mst" not in df.columns


def test_engagement_counts(spark):
    df = spark.createDataFrame(
        [("a", "ldp", "Y", None), ("a", "ldp", "n", "y"), ("a", "srp", "y", "Y"), ("", "ldp", "y", "y"),
         (" ", "ldp", "y", "y"), ("NULL", "ldp", "y", "y"), (None, "ldp", "y", "y")],
        "listing_id string, page_type_group string, social_shares string, saved_items string")
    counts = lst.engagement_counts(df)
    assert rows(counts) == [("a", 2, 2, 2)]
    both = spark.createDataFrame([("a",), ("b",)], "listing_id string")
    assert rows(lst.attach_engagement(both, counts)) == [("a", 2, 2, 2), ("b", None, None, None)]


def test_member_email_map(spark):
    df = spark.createDataFrame(
        [("m", "old@x", 1), ("m", "new@x", 2), ("m", "z@corp.example", 3), ("n", None, 1)],
        "member_id string, email_address string, updated_at int")
    assert rows(lst.member_email_map(df, "corp.example")) == [("m", "new@x")]


def test_campaigns_differ_only_in_parameters():
    assert NEW_LISTINGS.top_zips == 3 and NEW_LISTINGS.user_groups == 50
    assert replace(NEW_LISTINGS, top_zips=5).std_factor == 1.5
    assert len(NEW_LISTINGS.states) == 54 and len(NEW_LISTINGS.listing_types) == 10


def test_daily_windows_are_exact(spark):
    days = spark.createDataFrame([(d,) for d in ("20200502", "20200503", "20200527", "20200531", "20200601", "20200602", None)], "d string")
    assert rows(snapshot.within_days(days, "d", "20200601", 30)) == [("20200503",), ("20200527",), ("20200531",), ("20200601",)]
    assert rows(snapshot.within_days(days, "d", "20200601", 5, end_inclusive=False)) == [("20200527",), ("20200531",)]
