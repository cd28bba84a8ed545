"""Load ranges that came before, and values reached in, a player's strong matches."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.functions.expressions import md_key
from taperline.operators.features import split_features
from taperline.operators.hotspots import Split
from taperline.operators.quantiles import grouped_quantiles
from taperline.schema import PERFORMANCE_METRICS, TIE_BREAK

# Target -> the session column its range is taken from.
TRAINING_TARGETS = {
    "daily_load": "player_load",
    "acwr": "training_acwr",
    "high_speed_dist": "high_speed_distance",
    "high_intensity_actions": "high_accel_count",
}
MATCH_TARGETS = {
    "distance_per_min": "distance_per_min",
    "sprint_count": "sprints",
    "high_intensity_distance": "high_speed_distance",
}
LOW, HIGH = 0.25, 0.75
MIN_ZONE_SESSIONS = 3
KEY = ["player", "session_date", *TIE_BREAK]


#: The columns of the sessions that ranges are taken from.
ZONE_INPUTS = ("player_load", "high_speed_distance", "high_accel_count", "distance_per_min", "sprints")


def zone_features(sessions: DataFrame, only: Iterable[str] | None = None) -> Split:
    return split_features(sessions, ["training_load", "good_matches"], only=only)


def per_metric(*fields: str) -> Column:
    """One entry per performance metric; ``x_`` names a column ending in the metric."""
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    F.lit(i).alias("metric_rank"),
                    F.col(m).alias("value"),
                    *[F.col(f"{f}{m}").alias(f.rstrip("_")) for f in fields],
                )
                for i, m in enumerate(PERFORMANCE_METRICS)
            ]
        )
    )


def good_matches_any(features: DataFrame) -> DataFrame:
    """Matches in the player's best quarter, per metric, if there are three of at least five."""
    return features.select(*KEY, per_metric("good_")).filter("good").select(*KEY, "metric", "value")


def pre_match_sessions(features: DataFrame) -> DataFrame:
    """Training in the week before a strong match.

    ``copies`` says how many strong matches of the metric the session comes before, which
    stands for that many repeats of the row; the pairs themselves are never made.
    """
    training = features.filter("session_type = 'training'")
    columns = [c for c in features.columns if not c.startswith(("good_", "ahead_", "prepared_"))]
    return (
        training.select(*columns, per_metric("ahead_"))
        .filter("ahead > 0")
        .withColumnRenamed("ahead", "copies")
        .drop("value")
    )


def zone_ranges(features: Split) -> DataFrame:
    """All ranges of both session types from one pass over the features.

    Training before strong matches is grouped by days to the next match (``md``); strong
    matches, if training came before any of them, by metric alone (``md`` 0).
    """
    training = F.col("session_type") == "training"
    pairs = list(zip_longest(TRAINING_TARGETS.values(), MATCH_TARGETS.values()))
    values = {
        f"v{i}": F.when(training, F.col(t)).otherwise(F.col(m).cast("double") if m else F.lit(None))
        for i, (t, m) in enumerate(pairs)
    }
    own_copies = F.when(training, F.col("ahead")).otherwise((F.col("good") & F.col("prepared")).cast("int"))
    days = F.when(training, F.col("days_until_match")).otherwise(0)
    rows = features.each(
        lambda df: df.select(
            "player",
            "session_type",
            days.alias("md"),
            *[v.cast("double").alias(n) for n, v in values.items()],
            per_metric("ahead_", "good_", "prepared_"),
        )
        .withColumn("copies", own_copies)
        .filter((F.col("copies") > 0) & F.col("md").between(0, 7) & ((F.col("md") > 0) | (F.col("session_type") == "match")))
    )
    bounds = {f"{n}_{b}": (n, p) for n in values for b, p in (("lo", LOW), ("hi", HIGH))}
    keys = ["player", "session_type", "md", "metric", "metric_rank"]
    return grouped_quantiles(rows, keys, bounds, weight="copies", extra={"n": F.sum("copies")})


def _named(targets: dict[str, str]) -> list[Column]:
    return [F.col(f"v{i}_{b}").alias(f"{t}_{b}") for i, t in enumerate(targets) for b in ("lo", "hi")]


def training_zones_by_metric(ranges: DataFrame) -> DataFrame:
    """Ranges per player, metric and days to the next match."""
    own = ranges.filter((F.col("session_type") == "training") & (F.col("n") >= MIN_ZONE_SESSIONS))
    return own.select("player", "md", "metric", "metric_rank", "n", *_named(TRAINING_TARGETS))


def zone_precedence(by_metric: DataFrame) -> DataFrame:
    """One range per player and day: the last metric that set it wins."""
    last = W.partitionBy("player", "md").orderBy(F.desc("metric_rank"))
    return (
        by_metric.withColumn("_rank", F.row_number().over(last))
        .filter("_rank = 1")
        .drop("_rank", "metric_rank")
        .withColumn("md_key", md_key(F.col("md")))
    )


def training_zones(ranges: DataFrame) -> DataFrame:
    return zone_precedence(training_zones_by_metric(ranges))


def match_zones(ranges: DataFrame) -> DataFrame:
    return ranges.filter("session_type = 'match'").select("player", "metric", "n", *_named(MATCH_TARGETS))


def zone_players(training: DataFrame, match: DataFrame) -> DataFrame:
    return training.select("player").union(match.select("player")).distinct()
