"""Assigning users to experiment variations, with and without history.

Each assignment reads every input once: membership in the histories is reduced to flags per
user and joined once, instead of one anti join per rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nestline.functions.hashing import variation

Allocation = Sequence[tuple[str, int]]
_ASSIGNED = ("user_id", "experiment_name", "variation")


def assign_variation(users: DataFrame, experiment: Column | str, allocation: Allocation,
                     salt: str = "") -> DataFrame:
    """Add experiment_name and variation. The hash depends on user and experiment only."""
    name = F.lit(experiment) if isinstance(experiment, str) else experiment
    return users.withColumns({
        "experiment_name": name,
        "variation": variation(F.col("user_id"), name, allocation, salt)})


def _any(condition: Column) -> Column:
    return F.bool_or(F.coalesce(condition, F.lit(False)))


def bucket_exclusive(candidates: DataFrame, own_history: DataFrame, other_history: DataFrame,
                     holdout_state: str, holdout_experiment: str, main_experiment: str,
                     other_experiment: str, allocation: Allocation,
                     holdout_allocation: Allocation | None = None, salt: str = "") -> DataFrame:
    """Two experiments nobody may share: the hold-out state and the rest.

    Users ever in ``other_experiment`` are out. The hold-out side excludes users ever in the
    main experiment and the other way round. A user eligible on both sides goes to the main one.
    """
    users = candidates.groupBy("user_id").agg(
        _any(F.col("state") == holdout_state).alias("_held"),
        _any(F.col("state") != holdout_state).alias("_rest"))
    name = F.col("experiment_name")
    seen = (own_history.select("user_id", "experiment_name", F.lit(True).alias("_own"))
            .unionByName(other_history.select("user_id", "experiment_name",
                                              F.lit(False).alias("_own")))
            .groupBy("user_id")
            .agg(_any(~F.col("_own") & (name == other_experiment)).alias("_in_other"),
                 _any(F.col("_own") & (name == holdout_experiment)).alias("_in_holdout"),
                 _any(F.col("_own") & (name == main_experiment)).alias("_in_main")))

    def never(flag: str) -> Column:
        return ~F.coalesce(F.col(flag), F.lit(False))

    open_users = users.join(seen, "user_id", "left").filter(never("_in_other"))
    chosen = (F.when(F.col("_rest") & never("_in_holdout"), main_experiment)
              .when(F.col("_held") & never("_in_main"), holdout_experiment))
    placed = (open_users.withColumn("experiment_name", chosen)
              .filter(F.col("experiment_name").isNotNull()))
    main = variation(F.col("user_id"), F.col("experiment_name"), allocation, salt)
    held = variation(F.col("user_id"), F.col("experiment_name"),
                     holdout_allocation or allocation, salt)
    return placed.withColumn("variation", F.when(
        F.col("experiment_name") == main_experiment, main).otherwise(held)).select(*_ASSIGNED)


def bucket_sticky(candidates: DataFrame, shared_history: DataFrame, own_history: DataFrame,
                  shared_experiment: str, own_experiment: str, allocation: Allocation,
                  salt: str = "") -> DataFrame:
    """Users known to the shared experiment keep its variation, unknown users get a new one.

    Users with any other shared-side experiment, or already in the own one, keep nothing; users
    with any shared-side history are not assigned anew.
    """
    users = candidates.select("user_id").distinct()
    name = F.col("experiment_name")
    kept = F.collect_set(F.when(name == shared_experiment, F.struct("variation")))
    shared = shared_history.groupBy("user_id").agg(
        F.lit(True).alias("_known"), _any(name != shared_experiment).alias("_elsewhere"),
        kept.alias("_kept"))
    own = (own_history.filter(name == own_experiment).select("user_id").distinct()
           .withColumn("_own", F.lit(True)))
    known = users.join(shared, "user_id", "left").join(own, "user_id", "left")
    returning = (known.filter(~F.col("_elsewhere") & F.col("_own").isNull())
                 .select("user_id", F.lit(shared_experiment).alias("experiment_name"),
                         F.explode("_kept").alias("_kept"))
                 .select("user_id", "experiment_name", "_kept.variation"))
    fresh = assign_variation(known.filter(F.col("_known").isNull()).select("user_id"),
                             own_experiment, allocation, salt)
    return returning.unionByName(fresh.select(*_ASSIGNED))


def bucket_all(candidates: DataFrame, experiment: str, allocation: Allocation,
               salt: str = "") -> DataFrame:
    """Every user with a candidate takes part in one experiment."""
    return assign_variation(candidates.select("user_id").distinct(), experiment, allocation, salt)


def bucket_app(eligible: DataFrame, experiment: str, allocation: Allocation,
               salt: str = "") -> DataFrame:
    """App users keep the state they are eligible in."""
    users = (eligible.filter(F.col("user_id").isNotNull())
             .select("user_id", "listing_state").distinct())
    return assign_variation(users, experiment, allocation, salt)
