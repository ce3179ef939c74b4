"""Candidates of the users picked for a channel and variation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nestline.operators.eligibility import scrub_pairs, scrub_pairs_of, settled, usable_pairs


def attach_variation(candidates: DataFrame, bucketed: DataFrame, group: str,
                     holdout_experiment: str | None = None,
                     main_experiment: str | None = None) -> DataFrame:
    """Candidates of one variation.

    With the two experiment names given, everyone in the hold-out experiment is sent to as
    well and the variation counts within the main experiment only.
    """
    chosen = F.col("variation") == group
    if holdout_experiment is not None:
        name = F.col("experiment_name")
        chosen = (name == holdout_experiment) | ((name == main_experiment) & chosen)
    return candidates.join(bucketed.filter(chosen), "user_id")


def app_candidates(candidates: DataFrame, bucketed: DataFrame, variation: str) -> DataFrame:
    """Candidates of one variation in the state a user was bucketed in."""
    users = bucketed.filter(F.col("variation") == variation)
    mine = candidates.join(users, "user_id", "left_semi")
    return scrub_pairs(mine).join(users, ["user_id", "listing_state"])


def email_candidates(candidates: DataFrame, email_users: DataFrame, variation: str,
                     experiment: str) -> DataFrame:
    """Candidates of mailable users with the place of each user's first recommendation.

    The first place is an aggregate per user, joined to the user list before the candidates:
    a user with very many candidates is never sorted in one task.
    """
    mailable, short = settled(email_users.withColumnRenamed("customer_id", "user_id"))
    mine = candidates.join(mailable, "user_id", "left_semi")
    # city and state belong to the listing, so repeated pairs cannot change the first place
    first = F.min_by(F.struct("listing_city", "listing_state"),
                     F.struct("seq_id", "listing_state", "listing_id"))
    places = usable_pairs(mine).groupBy("user_id").agg(first.alias("_first")).select(
        "user_id", F.col("_first.listing_city").alias("reccity"),
        F.col("_first.listing_state").alias("recstate"))
    return (scrub_pairs_of(candidates, mailable, short)
            .join(mailable.join(places, "user_id"), "user_id")
            .withColumns({"variation": F.lit(variation), "experiment_name": F.lit(experiment)}))
