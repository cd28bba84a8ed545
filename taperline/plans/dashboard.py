"""Flat tables for dashboards and the data behind charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.operators.hotspots import max_group_rows
from taperline.operators.running import in_pieces, running
from taperline.plans.insights import WEEK

# Colour of a risk score in percent, highest first.
RISK_COLOURS = ((70, "red"), (50, "orange"), (30, "yellow"))
STATUSES = ("optimal", "underloaded", "overloaded", "unknown")
DEFAULT_CONFIDENCE = 50


def _status() -> Column:
    return F.coalesce(F.lower("load_status"), F.lit("unknown"))


def player_status(insights: DataFrame) -> DataFrame:
    if "error" in insights.columns:
        insights = insights.filter("error is null")
    return insights.select(
        "player", _status().alias("status"), "session_type", F.coalesce("load_message", F.lit("")).alias("message")
    )


def fatigue_risk(insights: DataFrame) -> DataFrame:
    return insights.filter("risk_score is not null").select(
        "player", "risk_score", "interpretation", "session_type", "confidence", "key_factors"
    )


def match_preparation(insights: DataFrame) -> DataFrame:
    near = insights.filter(F.col("days_until_next_match") <= WEEK)
    return near.select("player", F.col("days_until_next_match").alias("days_until_match"), _status().alias("load_status"))


def taper_recommendations(insights: DataFrame) -> DataFrame:
    near = insights.filter((F.col("days_until_next_match") <= WEEK) & F.col("load_target").isNotNull())
    return near.select(
        "player",
        F.col("days_until_next_match").alias("days_before_match"),
        F.col("load_target").alias("load_percentage"),
        F.col("high_intensity_target").alias("high_intensity"),
        F.col("duration_target").alias("duration"),
        F.coalesce("taper_confidence", F.lit(DEFAULT_CONFIDENCE).cast("bigint")).alias("confidence"),
        F.col("actual_load_pct").alias("actual_load"),
        "load_difference",
        "within_target",
    )


def risk_colour(risk: Column) -> Column:
    colour = F.lit("green")
    for above, name in reversed(RISK_COLOURS):
        colour = F.when(risk > above, name).otherwise(colour)
    return colour


def rank_by_risk(risks: DataFrame) -> DataFrame:
    """Players by falling risk; equal scores share a rank.

    The rank is one more than the number of players with a higher score, from counts per distinct score
    in pieces of consecutive ones, whatever range the scores lie in. A player without a score has no rank.
    """
    counts = risks.filter("risk_score is not null").groupBy("risk_score").agg(F.count(F.lit(1)).alias("_n"))
    pieces = in_pieces(counts, ["risk_score"], max_group_rows(risks.sparkSession))
    higher = running(pieces, [], ["risk_score"], {"_above": ("sum", F.col("_n"))}, backwards=True, own=False)
    ranks = higher.select("risk_score", (F.coalesce("_above", F.lit(0)) + 1).alias("risk_rank"))
    return risks.join(ranks, "risk_score").orderBy(F.desc("risk_score"), "player")


def risk_ranking(risks: DataFrame) -> DataFrame:
    return rank_by_risk(risks).select(
        "player", "risk_score", "risk_rank", risk_colour(F.col("risk_score")).alias("colour")
    )


def readiness_summary(insights: DataFrame) -> DataFrame:
    """Sessions and their share per status; a status nobody has is left out."""
    counts = insights.agg(*[F.count_if(_status() == s).alias(s) for s in STATUSES])
    total = sum((F.col(s) for s in STATUSES), F.lit(0))
    entries = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in STATUSES])
    return (
        counts.select(total.alias("_total"), F.inline(entries))
        .filter("n > 0")
        .select("status", "n", (F.col("n") / F.col("_total") * 100).alias("share"))
    )


def taper_series(taper: DataFrame, insights: DataFrame) -> DataFrame:
    """Bars of the taper chart, farthest day first, with the day each player is at."""
    today = insights.select("player", F.col("days_until_next_match").alias("_today"))
    return (
        today.join(taper, "player")
        .select(
            "player",
            "md",
            "md_key",
            "load_percentage",
            "high_intensity",
            F.coalesce(F.col("md") == F.col("_today"), F.lit(False)).alias("is_today"),
        )
        .orderBy("player", F.desc("md"))
    )
