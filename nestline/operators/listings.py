"""Listings that may be recommended today, and how much attention they get."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from nestline.config import LISTING_TYPES, RESIZED_PHOTO, STATES
from nestline.operators.snapshot import as_of, latest_per_key


def end_of_day(yyyymmdd: str) -> Column:
    return F.to_timestamp(F.lit(f"{yyyymmdd} 23:59:59"), "yyyyMMdd HH:mm:ss")


def photo_url(url: Column) -> Column:
    """Ask for the resized photo, name missing ones uniformly, always use https."""
    resized = F.regexp_replace(url, r"\.jpg$", RESIZED_PHOTO)
    cleaned = (F.when(url.like("%.jpg"), resized)
               .when(url.like("%not available%"), "not available").otherwise(url))
    return F.replace(cleaned, F.lit("http://"), F.lit("https://"))


def area(value: Column) -> Column:
    """'0.0' stands for an unknown area."""
    return F.when(value != "0.0", value)


def build_listings(history: DataFrame, run_date: str, max_age_days: int,
                   status: str = "for sale", types: Iterable[str] = LISTING_TYPES,
                   states: Iterable[str] = STATES, url: str = "ldp_url") -> DataFrame:
    """Current, complete, unencumbered listings started within the age window.

    One listing per property survives: the one that started last.
    """
    run = end_of_day(run_date)
    started = F.col("listing_start_datetime_mst")
    usable = (
        (F.col("listing_status") == status)
        & (F.col("is_contingent") != "y") & (F.col("is_da_pending") != "y")
        & (F.length("listing_address") > 0) & (F.length("listing_city") > 0)
        & (F.length("listing_state") > 0)
        & F.lower("listing_type").isin(*types)
        & started.between(F.date_sub(run, max_age_days).cast("timestamp"), run))
    current = as_of(history, run).filter(usable)
    newest = latest_per_key(current, ["property_id"],
                            ["listing_start_datetime_mst", "listing_end_datetime_mst",
                             "effective_from_datetime_mst"], ["listing_id"])
    cleaned = newest.withColumns({
        "dom": F.datediff(run, started),
        "listing_photo_url": photo_url(F.col("listing_photo_url")),
        "listing_square_feet": area(F.col("listing_square_feet")),
        "listing_lot_square_feet": area(F.col("listing_lot_square_feet")),
        "listing_state": F.upper("listing_state"),
        "listing_photo_count": F.col("listing_photo_count").cast("long"),
        "listing_current_price": F.col("listing_current_price").cast("double"),
        "listing_start_datetime_mst": started.cast("string"),
    })
    return (cleaned.filter(F.col("listing_state").isin(*states))
            .withColumnRenamed(url, "ldp_url")
            .drop("is_contingent", "is_da_pending", "listing_end_datetime_mst",
                  "effective_from_datetime_mst", "effective_to_datetime_mst", "year_yyyy"))


def listings_within(listings: DataFrame, max_age_days: int) -> DataFrame:
    """``build_listings`` for a shorter window, from the result for a longer one.

    The survivor of a property started last, so it is the same one wherever it is young enough:
    several windows cost one pass over the history.
    """
    return listings.filter(F.col("dom") <= max_age_days)


def _says_yes(column: str) -> Column:
    return F.lower(F.col(column)) == "y"


def engagement_counts(events: DataFrame) -> DataFrame:
    """Page views, shares and saves per listing."""
    named = (F.col("listing_id").isNotNull() & (F.trim("listing_id") != "")
             & (F.lower("listing_id") != "null"))
    return (events.filter(named).groupBy("listing_id")
            .agg(F.count_if(F.col("page_type_group") == "ldp").alias("ldp_pageview_count"),
                 F.count_if(_says_yes("social_shares")).alias("shares_count"),
                 F.count_if(_says_yes("saved_items")).alias("saves_count")))


def attach_engagement(listings: DataFrame, counts: DataFrame) -> DataFrame:
    return listings.join(counts, "listing_id", "left")


def member_email_map(accounts: DataFrame, internal_domain: str, ties: tuple[str, ...] = (),
                     email: str = "email_address", updated: str = "updated_at") -> DataFrame:
    """Latest address of every member, leaving out addresses of an internal domain."""
    external = accounts.filter(~F.col(email).like(f"%{internal_domain}%"))
    return (latest_per_key(external, ["member_id"], [updated], (*ties, email))
            .select("member_id", email))
