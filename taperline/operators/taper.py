"""Taper plans: how training looked on each day before matches strong in every metric."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.functions.expressions import md_key, percent_of
from taperline.operators.features import split_features
from taperline.operators.hotspots import Split
from taperline.operators.quantiles import grouped_quantiles
from taperline.operators.rules import PRE_MATCH_DAYS
from taperline.operators.zones import KEY

MIN_DAY_SESSIONS = 2
# Fixed values, by session or match count of a player.
ELIGIBLE = {
    "has_history": ("n_sessions", 5),
    "has_taper_history": ("n_sessions", 15),
    "has_zone_matches": ("n_matches", 5),
    "can_train_match": ("n_matches", 20),
    "can_train_training": ("n_trainings", 20),
}


def taper_features(sessions: DataFrame, only: Iterable[str] | None = None) -> Split:
    return split_features(sessions, ["taper_matches"], only=only)


def good_matches_all(features: DataFrame) -> DataFrame:
    return features.filter("taper_good").select(*KEY, "distance_per_min", "sprints_per_min")


def taper_sessions(features: DataFrame) -> DataFrame:
    """Training ``days_before`` a strong match; ``copies`` counts the matches that far ahead."""
    days = range(1, PRE_MATCH_DAYS + 1)
    ahead = F.array(*[F.struct(F.lit(k).alias("days_before"), F.col(f"ahead_{k}").alias("copies")) for k in days])
    columns = [c for c in features.columns if not c.startswith("ahead_")]
    training = features.filter("session_type = 'training'").filter(
        F.greatest(*[F.col(f"ahead_{k}") for k in days]) > 0
    )
    return training.select(*columns, F.inline(ahead)).filter("copies > 0")


def _mean(column: str) -> Column:
    """Mean over rows repeated ``copies`` times, missing values left out."""
    present = F.when(F.col(column).isNotNull(), F.col("copies"))
    return F.try_divide(F.sum(F.col(column) * F.col("copies")).cast("double"), F.sum(present))


def taper_plan(features: Split) -> DataFrame:
    """Per player and day: load and intensity relative to the player's mean training."""
    days = grouped_quantiles(
        features.each(taper_sessions),
        ["player", "days_before"],
        {"recommended_duration": ("duration", 0.5)},
        weight="copies",
        extra={
            "sample_count": F.sum("copies"),
            "_load": _mean("player_load"),
            "_hsd": _mean("high_speed_distance"),
            "high_acceleration_count": _mean("high_accel_count"),
            "high_deceleration_count": _mean("high_decel_count"),
            "_mean_load": F.max("mean_load"),
            "_mean_hsd": F.max("mean_hsd"),
        },
    )
    return days.filter(F.col("sample_count") >= MIN_DAY_SESSIONS).select(
        "player",
        F.col("days_before").alias("md"),
        md_key(F.col("days_before")).alias("md_key"),
        percent_of(F.col("_load"), F.col("_mean_load")).alias("load_percentage"),
        percent_of(F.col("_hsd"), F.col("_mean_hsd")).alias("high_intensity"),
        "high_acceleration_count",
        "high_deceleration_count",
        "recommended_duration",
        "sample_count",
    )


def training_means(features: DataFrame) -> DataFrame:
    """Mean load and high-speed distance of a player's training; summed before the shuffle."""
    return (
        features.filter("session_type = 'training'")
        .groupBy("player")
        .agg(F.avg("player_load").alias("mean_load"), F.avg("high_speed_distance").alias("mean_hsd"))
    )


def eligibility(tidy: DataFrame) -> DataFrame:
    """Session counts per player and which artefacts they allow."""
    counts = tidy.groupBy("player").agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.count_if(F.col("session_type") == "match").alias("n_matches"),
        F.count_if(F.col("session_type") == "training").alias("n_trainings"),
    )
    return counts.withColumns({name: F.col(n) >= least for name, (n, least) in ELIGIBLE.items()})
