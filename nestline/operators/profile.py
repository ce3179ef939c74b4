"""Active users: latest profile, favourite zips and the price band they shop in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nestline.config import CampaignConfig
from nestline.functions.hashing import user_group
from nestline.functions.identity import is_real_id
from nestline.operators.keyed import top_per_key
from nestline.operators.snapshot import latest_per_key


def best_entries(array: str, category: str, score: str, n: int) -> Column:
    """The ``n`` best entries of an array of structs, ordered and cut inside the row.

    Scores arrive as text and are compared as numbers; entries without one come last, ties go
    to the smaller category.
    """
    def sortable(entry: Column) -> Column:
        number = entry[score].try_cast("double")
        return F.struct(number.isNull().alias("unscored"), (-number).alias("down"),
                        entry[category].alias("category"))

    return F.slice(F.sort_array(F.transform(array, sortable)), 1, n)


def entry_rows(df: DataFrame, best: str, category_as: str = "zip_code",
               score_as: str = "score") -> DataFrame:
    """``best_entries`` as rows; a row without any entry stays, with nulls."""
    return (df.withColumn("_entry", F.explode_outer(best))
            .withColumn(category_as, F.col("_entry.category"))
            .withColumn(score_as, -F.col("_entry.down"))
            .drop("_entry", best))


def top_n_from_array(df: DataFrame, array: str, category: str, score: str, n: int,
                     category_as: str = "zip_code", score_as: str = "score") -> DataFrame:
    """One row per best entry of every array. Nothing is shuffled."""
    cut = df.withColumn(array, best_entries(array, category, score, n))
    return entry_rows(cut, array, category_as, score_as)


def top_n_categories(df: DataFrame, keys: list[str], score: str, category: str,
                     n: int) -> DataFrame:
    """The same choice for preferences that are stored as rows."""
    return top_per_key(df, keys, [F.col(score).desc_nulls_last(), F.col(category).asc()], n)


def group_median(df: DataFrame, key: str = "listing_postal_code",
                 value: str = "listing_current_price", min_value: float = 9999.0,
                 key_as: str = "zip_code", median_as: str = "listing_price_median",
                 accuracy: int = 10_000) -> DataFrame:
    """Median per group where it exceeds ``min_value``. Sketches merge before the shuffle."""
    return (df.groupBy(F.col(key).alias(key_as))
            .agg(F.percentile_approx(value, 0.5, accuracy).alias(median_as))
            .filter(F.col(median_as) > min_value))


def price_band(df: DataFrame, k: float, mean: str = "overall_mean",
               std: str = "overall_std_dev", median: str = "listing_price_median") -> DataFrame:
    """Clamp the deviation to 10-67 % of the mean, then floor/ceiling = mean -/+ k * deviation.

    The three corrections apply one after the other: too small, too large, exactly zero. A
    clamp never exceeds the local median, which is 0 where it is unknown.
    """
    centre, spread, local = F.col(mean), F.col(std), F.col(median)
    # one step per correction: a later one reads the column an earlier one has set
    return (df.withColumns({mean: centre.try_cast("double"), std: spread.try_cast("double"),
                            median: F.coalesce(local, F.lit(0.0))})
            .withColumn(std, F.when(spread < 0.1 * centre, F.least(0.1 * centre, local))
                        .otherwise(spread))
            .withColumn(std, F.when(spread > 0.67 * centre, F.least(0.67 * centre, local))
                        .otherwise(spread))
            .withColumn(std, F.when(spread == 0, 0.1 * centre).otherwise(spread))
            .withColumns({"price_floor": centre - k * spread,
                          "price_ceiling": centre + k * spread}))


def build_users(profiles: DataFrame, medians: DataFrame, config: CampaignConfig,
                ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per active user and favourite zip, with price band and user group.

    Profiles are cut to their best zips and two numbers before the latest one is looked for:
    what is shuffled is a few values per profile, not its whole statistics.
    """
    slim = profiles.filter(is_real_id("user_id", config.placeholder_ids)).select(
        "user_id", "target_date", *ties,
        best_entries("zip_stats", "category_name", "score", config.top_zips).alias("_best"),
        F.col("price_stats.overall_mean").alias("overall_mean"),
        F.col("price_stats.overall_std_dev").alias("overall_std_dev"))
    # the values themselves decide last, so that a second run picks the same profile
    latest = latest_per_key(slim, ["user_id"], ["target_date"],
                            (*ties, "overall_mean", "overall_std_dev", "_best"))
    zips = entry_rows(latest, "_best").withColumn(
        "user_group", user_group("user_id", config.user_groups))
    return (price_band(zips.join(medians, "zip_code", "left"), config.std_factor)
            .select("user_id", "user_group", "zip_code", "score", "overall_mean",
                    "overall_std_dev", "listing_price_median", "price_floor", "price_ceiling"))
