"""Who may be contacted today, per channel."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from nestline.functions.identity import is_real_id
from nestline.operators.keyed import first_per_key
from nestline.sources.scratch import short_list

#: Users that are sent to every task, some 100 bytes each.
SHORT_LIST = 2_000_000
_PAIR_BLOCKLIST = ("unknown", "$CUSTOMER_ID_$")


def day_before(yyyymmdd: str, days: int) -> str:
    return (datetime.strptime(yyyymmdd, "%Y%m%d") - timedelta(days=days)).strftime("%Y%m%d")


def ymd() -> Column:
    """Day of a table that is partitioned by year, month and day."""
    return F.concat("year", "month", "day")


def usable_pairs(candidates: DataFrame) -> DataFrame:
    """Candidates with usable ids; repeated pairs stay."""
    return candidates.filter(
        is_real_id("user_id", _PAIR_BLOCKLIST) & is_real_id("listing_id", ("unknown",)))


def scrub_pairs(candidates: DataFrame) -> DataFrame:
    """Candidates with usable ids, one row per (user, listing): the best placed one.

    Of equally placed rows the smaller state, listing state, score and status count: all else that
    a candidate carries belongs to its listing, so the row that stays is the same however the
    input is dealt out, and columns nobody asks for are not read. Rows are sorted by listing first:
    neighbours in what is shuffled then share their listing's columns, and compress to a fraction.
    """
    usable = usable_pairs(candidates)
    order = [F.col("seq_id").asc_nulls_last()]
    order += [F.col(c).asc() for c in ("state", "listing_state", "match_score", "listing_status")
              if c in candidates.columns]
    return first_per_key(usable, ["listing_id", "user_id"], order)


def settled(users: DataFrame) -> tuple[DataFrame, bool]:
    """A list of users written once, and whether it goes whole to every task that looks users up.

    Candidates are wide and many times more: joined to a short list they need no shuffle, whatever
    the size of the tables the list comes from.
    """
    return short_list(users, "users", SHORT_LIST)


def scrub_pairs_of(candidates: DataFrame, users: DataFrame, short: bool) -> DataFrame:
    """``scrub_pairs`` of the candidates of ``settled`` users.

    A short list cuts the candidates first. For a long one they are scrubbed first, which leaves
    them side by side with others of their listing when they are shuffled to the users.
    """
    if short:
        return scrub_pairs(candidates.join(users, "user_id", "left_semi"))
    return scrub_pairs(candidates).join(users, "user_id", "left_semi")


def saved_search_users(profile: DataFrame, run_date: str, days: int = 30,
                       day: str = "snapshot_date_mst_yyyymmdd") -> DataFrame:
    recent = F.col(day).between(day_before(run_date, days), run_date)
    return (profile.filter(recent & (F.col("is_saved_search") == "y")
                           & (F.length("member_id") > 1))
            .select(F.col("member_id").alias("user_id")).distinct())


def opted_in(opt_ins: DataFrame, channel: str, strip_prefix: str | None = None) -> DataFrame:
    """Users that accept messages on ``channel`` ('web' or 'app')."""
    user = F.col("userId")
    if strip_prefix:
        user = F.replace(user, F.lit(strip_prefix), F.lit(""))
    return opt_ins.filter(F.col(f"optIns.{channel}")).select(user.alias("user_id")).distinct()


def web_eligible(candidates: DataFrame, opted: DataFrame, saved_search: DataFrame) -> DataFrame:
    """Candidates of opted-in users without a saved search.

    Users are settled first, on narrow rows, and cut the candidates before repeated pairs are
    looked for, unless they are too many.
    """
    return scrub_pairs_of(candidates, *settled(opted.join(saved_search, "user_id", "left_anti")))


def domzip_users(domzip: DataFrame, run_date: str, days: int = 30,
                 day: str = "run_date_yyyymmdd") -> DataFrame:
    """Members and the states of their dominant zips over the last ``days`` days."""
    recent = F.col(day).between(day_before(run_date, days - 1), run_date)
    return domzip.filter(recent).select("member_id", "listing_state").distinct()


def recently_notified(sent: DataFrame, run_date: str, campaigns: Iterable[str],
                      canvases: Iterable[str], days: int = 30) -> DataFrame:
    recent = ymd().between(day_before(run_date, days - 1), run_date)
    ours = F.col("campaign_id").isin(*campaigns) | F.col("canvas_id").isin(*canvases)
    return (sent.filter(recent & ours)
            .select(F.col("external_user_id").alias("member_id")).distinct())


def app_eligible(domzip: DataFrame, notified: DataFrame, opted: DataFrame) -> DataFrame:
    """(user, state) of opted-in members not notified lately."""
    return (domzip.join(notified, "member_id", "left_anti")
            .withColumnRenamed("member_id", "user_id")
            .join(opted, "user_id", "left_semi")
            .select("user_id", "listing_state").distinct())


def email_eligible(sent: DataFrame, run_date: str, campaigns: Iterable[str],
                   cap_days: int = 2, days: int = 180) -> DataFrame:
    """(customer, address) mailed within ``days`` but not by ``campaigns`` within the cap.

    "Ever mailed" minus "capped" over distinct pairs is one grouping with two flags: the send
    log is read and shuffled once, and null addresses compare equal as in a set difference.
    """
    known = F.col("customer_id").isNotNull() & (F.trim("customer_id") != "")
    in_window = ymd().between(day_before(run_date, days - 1), run_date)
    mailed = F.col("campaign_id").isNotNull() & (F.trim("campaign_id") != "")
    capped = (F.col("campaign_id").isin(*campaigns)
              & ymd().between(day_before(run_date, cap_days), run_date))
    return (sent.filter(known & in_window)
            .groupBy("customer_id", "email")
            .agg(F.bool_or(F.coalesce(mailed, F.lit(False))).alias("_mailed"),
                 F.bool_or(F.coalesce(capped, F.lit(False))).alias("_capped"))
            .filter(F.col("_mailed") & ~F.col("_capped"))
            .select("customer_id", "email"))
