"""The daily jobs.

Steps that are read more than once, or that end a long chain of shuffles, are written and read
back: a lost executor then costs one step, and the skew statistics are taken from files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from nestline.config import CampaignConfig
from nestline.operators import (candidates as cand, channels, eligibility as elig,
                                experiment as exp, keyed, listings as lst, messages as msg,
                                metrics, profile as prof, quality as dq, scoring, skew, snapshot)
from nestline.operators.eligibility import day_before
from nestline.plans.store import Store
from nestline.sources import writers


# how far back the day is looked for that a day is compared with
DRIFT_DAYS = 10


@dataclass(frozen=True)
class Skew:
    """Rows from which on a key is split, whatever the size of its table."""

    users_per_zip: int = 50_000
    listings_per_zip: int = 20_000
    rows_per_listing: int = 2_000_000


def listings_and_users(store: Store, config: CampaignConfig, history: DataFrame,
                       events: DataFrame, profiles: DataFrame, url: str = "ldp_url",
                       ties: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Today's listings with their engagement, and today's user profiles.

    The history is read once, for the longest window; the others are cut from its result.
    """
    profiles = snapshot.within_days(profiles, "target_date", store.day, config.profile_days)
    longest = max(config.median_age_days, config.listing_age_days)
    current = store.save("current_listings", lst.build_listings(
        history, store.day, longest, config.status, config.listing_types, config.states, url))
    medians = prof.group_median(lst.listings_within(current, config.median_age_days),
                                min_value=config.min_median_price)
    listings = store.save("listings", lst.attach_engagement(
        lst.listings_within(current, config.listing_age_days), lst.engagement_counts(events)))
    users = store.save("users", prof.build_users(profiles, medians, config, ties))
    return listings, users


def new_listings(store: Store, config: CampaignConfig, history: DataFrame, events: DataFrame,
                 profiles: DataFrame, user_features: DataFrame, listing_features: DataFrame,
                 lookups: Sequence[scoring.Lookup], score: Callable[[DataFrame], Column],
                 limits: Skew = Skew(), url: str = "ldp_url",
                 ties: tuple[str, ...] = ()) -> DataFrame:
    """Candidates by zip and price, their features, and the ranking a model gives them.

    Pairs stay narrow through tagging, features and ranking. The tables others read, candidates
    and candidates_ranked, get the listing attributes when they are written. ``ties`` names
    columns that choose between several profiles or feature rows of a user on one day.
    """
    events = snapshot.within_days(events, "event_date", store.day, config.event_days, False)
    listings, users = listings_and_users(store, config, history, events, profiles, url, ties)
    # lists of hot keys are written because they are used twice
    hot = store.save("hot_zips", cand.hot_zips(
        users, listings, limits.users_per_zip, limits.listings_per_zip))
    made = cand.generate_candidates(users, cand.slim_listings(listings), hot)
    pairs = store.save("candidate_pairs", cand.tag_interactions(
        made, cand.interaction_flags(events)))
    store.save("candidates", cand.attach_listings(pairs, listings))

    user_features = snapshot.within_days(user_features, "target_date", store.day,
                                         config.feature_days)
    rest = [c for c in user_features.columns if c not in ("user_id", "target_date", *ties)]
    latest = snapshot.latest_per_key(user_features, ["user_id"], ["target_date"],
                                     (*ties, *rest)).drop(*ties)
    busy = store.save("hot_listings", skew.hot_keys(
        pairs, ["listing_id"], limits.rows_per_listing))
    features = store.save("features", scoring.build_features(
        pairs, latest, listing_features, lookups, busy, ["user_group"]), ["user_group"], rebalance=False)

    # the model runs once for each pair: what it says is written, and ranked from there
    carried = [c for c in pairs.columns if c in features.columns]
    scored = features.select(*carried, score(features).cast("double").alias("match_score"))
    by_score = (["user_id"], "match_score", ["listing_id"])
    dealt = store.save("scores", keyed.deal_by_rank(scored, *by_score))
    ranked = keyed.rank_dealt(dealt, *by_score)
    group, few = ["user_group"], listings.count() <= cand.SHORT_LIST
    if few:
        # sent to every task, listings are joined to rows that lie where they are written
        ranked, listings = ranked.hint("rebalance", *group), F.broadcast(listings)
    return store.save("candidates_ranked", cand.attach_listings(ranked, listings)
                      .sortWithinPartitions(*group, "listing_id"), group, rebalance=not few)


def recommended_homes(store: Store, config: CampaignConfig, history: DataFrame,
                      events: DataFrame, profiles: DataFrame, recommendations: DataFrame,
                      apply_price_band: bool = False, url: str = "ldp_url",
                      ties: tuple[str, ...] = ()) -> DataFrame:
    """Upstream recommendations narrowed to favourite zips: the best of every user and state."""
    events = snapshot.within_days(events, "event_date", store.day, config.event_days, False)
    listings, users = listings_and_users(store, config, history, events, profiles, url, ties)
    wanted = recommendations.filter(F.col("state").isin(*config.states))
    flat = store.save("recommendations", cand.explode_ranked(wanted), ["state"])
    kept = cand.filter_recommendations(flat, listings, users, config.max_per_state,
                                       apply_price_band)
    tagged = cand.tag_interactions(kept, cand.interaction_flags(events))
    return store.save("candidates_ranked", tagged, ["user_group"])


def web_bucketing(store: Store, ranked: DataFrame, opt_ins: DataFrame,
                  search_profiles: DataFrame, assign: Callable[[DataFrame], DataFrame],
                  group: str, holdout_experiment: str | None = None,
                  main_experiment: str | None = None) -> DataFrame:
    """Eligible candidates, assigned users, and the candidates of one variation.

    ``assign`` is one of the ``experiment.bucket_*`` operators with its parameters bound.
    """
    eligible = store.save("eligible_candidates", elig.web_eligible(
        ranked, elig.opted_in(opt_ins, "web", "visitor_"),
        elig.saved_search_users(search_profiles, store.day)))
    bucketed = store.save("eligible_users", assign(eligible))
    return store.save("bucketed_candidates", channels.attach_variation(
        eligible, bucketed, group, holdout_experiment, main_experiment))


def app_users(store: Store, dominant_zips: DataFrame, push_sent: DataFrame, opt_ins: DataFrame,
              campaigns: Iterable[str], canvases: Iterable[str], experiment: str,
              allocation: exp.Allocation) -> DataFrame:
    """App users of all campaigns; runs before any campaign picks its own from them."""
    eligible = store.save("app_eligible_users", elig.app_eligible(
        elig.domzip_users(dominant_zips, store.day),
        elig.recently_notified(push_sent, store.day, campaigns, canvases),
        elig.opted_in(opt_ins, "app")))
    return store.save("app_bucketed_users", exp.bucket_app(eligible, experiment, allocation))


def app_bucketing(store: Store, ranked: DataFrame, bucketed: DataFrame,
                  variation: str) -> DataFrame:
    return store.save("eligible_candidates_app",
                      channels.app_candidates(ranked, bucketed, variation))


def email_users(store: Store, email_sent: DataFrame, campaigns: Iterable[str]) -> DataFrame:
    return store.save("email_eligible_users",
                      elig.email_eligible(email_sent, store.day, campaigns))


def email_bucketing(store: Store, ranked: DataFrame, users: DataFrame, variation: str,
                    experiment: str) -> DataFrame:
    return store.save("eligible_candidates_email",
                      channels.email_candidates(ranked, users, variation, experiment))


def deliver(store: Store, candidates: DataFrame, event_type: str, client_id: str,
            client_name: str, per_message: int | None) -> int:
    """Write the messages and return how many there are.

    ``per_message`` is the campaign's ``recs_per_message``: None for one message per user.
    """
    built = msg.assemble(candidates, msg.message_fields(event_type), per_message)
    sent = msg.envelope(built, event_type, client_id, client_name)
    return writers.write_messages(sent, f"{store.path('messages_' + event_type)}/"
                                        f"target_date={store.day}")


def deliver_control(store: Store, bucketed: DataFrame, event_type: str, client_id: str,
                    client_name: str, control: str = "C") -> int:
    sent = msg.envelope(msg.control_messages(bucketed, control), event_type, client_id,
                        client_name)
    return writers.write_messages(sent, f"{store.path('messages_' + event_type)}/"
                                        f"target_date={store.day}")


def offline_metrics(store: Store, config: CampaignConfig, ranked: DataFrame,
                    events: DataFrame) -> DataFrame:
    """Compare the ranking of the store's day with what users did in the days after."""
    predictions = (elig.usable_pairs(ranked)
                   .select("user_id", "listing_id", F.col("seq_id").alias("rank")))
    truth = metrics.ground_truth(events, store.day, config.ground_truth_days)
    return store.save("metrics", metrics.offline_metrics(predictions, truth,
                                                         config.metric_ranks), ["rank"])


def validate(store: Store, listings: DataFrame, users: DataFrame, candidates: DataFrame,
             ranked: DataFrame, max_age_days: int, previous_day: str | None = None,
             upstream: DataFrame | None = None, score: str | None = "match_score",
             source: DataFrame | None = None) -> DataFrame:
    """All checks of a campaign day as one report; every failure is in it, none stops it.

    Drift is measured against ``previous_day``, or for each table against its newest day in the
    ``DRIFT_DAYS`` days before; a table without one has no such check. To check the newest day that
    is loaded, pass ``store.at_newest(...)``.
    """
    run = F.to_date(F.lit(store.day), "yyyyMMdd")
    slot = ["user_id", "listing_id"] if upstream is None else ["user_id", "listing_id", "state"]
    details = dq.is_empty("ldp_url", "listing_photo_url") | dq.is_zero(
        "listing_number_of_bath_rooms", "listing_number_of_bed_rooms", "listing_current_price",
        "listing_lot_square_feet", "listing_square_feet", "listing_photo_count")
    place = ("listing_type", "listing_city", "listing_state", "listing_postal_code")
    keys = ("listing_id", "property_id", "listing_status")
    checks = {
        "duplicate_listings": dq.dq_duplicates(listings, ["listing_id"]),
        "duplicate_properties": dq.dq_duplicates(listings, ["listing_id", "property_id"]),
        "duplicate_candidates": dq.dq_duplicates(candidates, ["user_id", "listing_id"]),
        "duplicate_ranked": dq.dq_duplicates(ranked, slot),
        "listings": dq.dq_rate(listings, "listing_id", {
            "key_fields": dq.is_empty(*keys), "fields": dq.is_empty(*keys, *place)},
            {"fields": 10.0}),
        "users": dq.dq_rate(users, "user_id", {
            "user_id": dq.is_empty("user_id"), "score": dq.is_zero("score"),
            "zip_code": dq.is_empty("zip_code"), "mean": dq.is_zero("overall_mean"),
            "ceiling": dq.is_zero("price_ceiling"), "std_dev": dq.is_zero("overall_std_dev"),
            "std_dev_below_67": F.col("overall_std_dev") < 67},
            {"score": 15.0, "zip_code": 15.0, "mean": 10.0, "ceiling": 10.0, "std_dev": 5.0}),
        "candidates": dq.dq_rate(candidates, "listing_id",
                                 {"fields": dq.is_empty(*keys, *place)}, {}),
        "ranked": dq.dq_rate(ranked, "listing_id", {
            "fields": dq.is_empty(*keys, *place) | dq.is_zero("seq_id"), "details": details},
            {"details": 10.0}),
        "first_slot": dq.dq_first_slot(ranked, dq.is_empty(*place)),
        "listing_age": dq.dq_age(listings, "listing_start_datetime_mst", run, max_age_days),
    }
    if score is not None:
        breaks = dq.dq_rank_order(ranked, score)
        checks["rank_order"] = breaks.filter(F.col("n_breaks") > 0)
    if upstream is not None:
        breaks = dq.dq_sequence(ranked, upstream)
        checks["upstream_order"] = breaks.filter(F.col("n_breaks") > 0)
    if upstream is not None and source is not None:
        breaks = dq.dq_sequence(upstream, cand.explode_ranked(source), position="row_id")
        checks["source_order"] = breaks.filter(F.col("n_breaks") > 0)
        checks["upstream"] = dq.dq_rate(upstream, "user_id", {
            "fields": dq.is_empty("user_id", "listing_id", "state") | F.col("row_id").isNull()},
            {"fields": 100.0})
    spark = listings.sparkSession
    for name, key in (("users", "user_id"), ("candidates", "user_id"),
                      ("listings", "listing_id"), ("candidates_ranked", "listing_id")):
        before = previous_day or store.newest_day(spark, name, day_before(store.day, 1), DRIFT_DAYS - 1)
        if before is not None:
            days = store.days(spark, name, [before, store.day]).withColumn(
                "target_date", F.col("target_date").cast("string"))
            checks[f"drift_{name}"] = dq.dq_drift(days, "target_date", key, store.day, before)
    for_sale = {"for_sale": F.col("listing_status") == "for sale"}
    volumes = {f"{name}_{key}": dq.dq_counts(df, key, conditions)
               for name, df in (("listings", listings), ("candidates", candidates),
                                ("ranked", ranked))
               for key, conditions in (("listing_id", for_sale), ("user_id", {"all": F.lit(True)}))
               if key in df.columns}
    volumes["users_user_id"] = dq.dq_counts(users, "user_id", {"all": F.lit(True)})
    report = dq.dq_report(checks, store.day, volumes).drop("target_date")
    return store.save("validation", report)
