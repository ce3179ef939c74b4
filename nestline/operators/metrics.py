"""How well a day's ranking predicted what users looked at afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from nestline.config import PLACEHOLDER_EVENT_USERS, PLACEHOLDER_EVENT_VALUES
from nestline.functions.gain import best_dcg, position_gain
from nestline.functions.identity import event_user, is_real_id
from nestline.operators.eligibility import day_before


def ground_truth(events: DataFrame, start: str, days: int, listing: str = "listing_id_persist",
                 zip_code: str = "zip", day: str = "event_date") -> DataFrame:
    """Distinct (user, listing) looked at on ``days`` days from ``start`` on."""
    clean = (events.filter(F.col(day).between(start, day_before(start, 1 - days)))
             .select(event_user().alias("user_id"), F.col(listing).alias("listing_id"),
                     F.col(zip_code).alias("_zip")))
    usable = (is_real_id("user_id", PLACEHOLDER_EVENT_VALUES + PLACEHOLDER_EVENT_USERS)
              & is_real_id("listing_id", PLACEHOLDER_EVENT_VALUES)
              & is_real_id("_zip", PLACEHOLDER_EVENT_VALUES) & (F.length("_zip") == 5))
    return clean.filter(usable).select("user_id", "listing_id").distinct()


def user_scores(predictions: DataFrame, truth: DataFrame, ks: Sequence[int] = (1, 3, 12),
                method: int = 2) -> DataFrame:
    """Precision, recall and nDCG of every user present on both sides, one row per user and k.

    Hits come from a join on (user, listing) and all cut-offs from one grouping, so no list of
    a user's items is ever built. A repeated prediction counts at its best rank. Predictions up
    to the largest cut-off are short by contract; the truth of a user may be any size.
    """
    listed = (predictions.filter(F.col("rank") <= max(ks))
              .groupBy("user_id", "listing_id").agg(F.min("rank").alias("rank")))
    # left_semi-style flag: truth is distinct, so a prediction matches at most once
    marked = listed.join(truth.select("user_id", "listing_id").distinct()
                         .withColumn("_hit", F.lit(1)), ["user_id", "listing_id"], "left")
    order = Window.partitionBy("user_id").orderBy("rank", "listing_id")
    placed = marked.select("user_id", "rank", F.coalesce("_hit", F.lit(0)).alias("_hit"),
                           F.row_number().over(order).alias("_at"))
    sums = []
    for k in ks:
        within = F.col("rank") <= k
        gain = position_gain(F.col("_hit").cast("double"), F.col("_at"), method)
        sums += [F.count_if(within).alias(f"_n{k}"),
                 F.sum(F.when(within, F.col("_hit")).otherwise(0)).alias(f"_h{k}"),
                 F.sum(F.when(within & (F.col("_at") <= k), gain).otherwise(0.0)).alias(f"_g{k}")]
    per_user = placed.groupBy("user_id").agg(*sums)
    relevant = (truth.select("user_id", "listing_id").distinct()
                .groupBy("user_id").agg(F.count(F.lit(1)).alias("_truth")))

    def cut(k: int):
        best = best_dcg(F.col(f"_h{k}"), k, method)
        return F.struct(
            F.lit(k).alias("k"), F.col(f"_n{k}").alias("predicted"),
            F.col(f"_h{k}").alias("hits"),
            F.try_divide(f"_h{k}", f"_n{k}").alias("precision"),
            F.try_divide(f"_h{k}", "_truth").alias("recall"),
            F.coalesce(F.try_divide(F.col(f"_g{k}"), best), F.lit(0.0)).alias("ndcg"))

    return (per_user.join(relevant, "user_id")
            .select("user_id", F.inline(F.array(*[cut(k) for k in ks])))
            .filter(F.col("predicted") > 0))


def offline_metrics(predictions: DataFrame, truth: DataFrame, ks: Sequence[int] = (1, 3, 12),
                    method: int = 2) -> DataFrame:
    """One row per cut-off: mean precision, recall and nDCG, and the users they cover."""
    return (user_scores(predictions, truth, ks, method)
            .groupBy(F.col("k").alias("rank"))
            .agg(F.avg("precision").alias("mean_precision"),
                 F.avg("recall").alias("mean_recall"),
                 F.count(F.lit(1)).alias("user_coverage"),
                 F.avg("ndcg").alias("mean_ndcg")))


def dcg_by_group(ranked: DataFrame, key: str, relevance: str, position: str, k: int,
                 method: int = 1) -> DataFrame:
    """DCG of lists stored as rows with 1-based positions."""
    gain = position_gain(F.col(relevance).cast("double"), F.col(position), method)
    return (ranked.filter(F.col(position) <= k).groupBy(key).agg(F.sum(gain).alias("dcg")))
