"""Constants of the load model and the expressions both plans of a feature share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

# Fixed values of the load model.
MIN_SESSIONS = 5
ACUTE_DAYS, CHRONIC_DAYS = 7, 28
ACUTE_ROWS, CHRONIC_ROWS = 7, 28
SPEED_DAYS = 7
BASELINE_PROB, MIN_BASELINE_ROWS = 0.75, 5
DROP_BELOW = -0.05
TARGET_ROWS, TARGET_SHARE = 5, 0.9
PRE_MATCH_DAYS = 7
ZONE_MIN_MATCHES, ZONE_MIN_GOOD = 5, 3
TAPER_PROB, TAPER_MIN_SESSIONS, TAPER_MIN_MATCHES, TAPER_MIN_GOOD = 0.67, 15, 5, 3


def row_load(rows: WindowSpec) -> dict[str, Column]:
    """Load over the last 7 and 28 sessions, and its relative spread over the last 7."""
    load = F.col("player_load")
    recent = rows.rowsBetween(1 - ACUTE_ROWS, 0)
    return {
        "acute_load": F.sum(load).over(recent),
        "chronic_load": F.sum(load).over(rows.rowsBetween(1 - CHRONIC_ROWS, 0)),
        "load_monotony": F.coalesce(
            F.try_divide(F.stddev_samp(load).over(recent), F.avg(load).over(recent)), F.lit(0.0)
        ),
    }


def good_match(is_match: Column, n_matches: Column, above: Column) -> Column:
    return F.coalesce(is_match & (n_matches >= ZONE_MIN_MATCHES) & above, F.lit(False))


def taper_eligible(sessions: Column, matches: Column, good: Column) -> Column:
    return (sessions >= TAPER_MIN_SESSIONS) & (matches >= TAPER_MIN_MATCHES) & (good >= TAPER_MIN_GOOD)


def days_before_frame(k: int, unit: int) -> tuple[int, int]:
    """Where a match k whole days ahead lies, within the seven-day window."""
    return k * unit, min((k + 1) * unit - 1, PRE_MATCH_DAYS * unit)


def with_match_days(df: DataFrame, unit: int) -> DataFrame:
    since = F.floor((F.col("t") - F.col("prev_match")) / unit).cast("int")
    until = F.floor((F.col("next_match") - F.col("t")) / unit).cast("int")
    return df.withColumns({"days_since_match": since, "days_until_match": until}).drop("prev_match", "next_match")


def speed_decline() -> Column:
    """Share lost against the fastest like session of the week; needs a second one to compare."""
    lost = F.when(
        F.col("_fastest") > 0, F.try_divide(F.col("top_speed") - F.col("_fastest"), F.col("_fastest"))
    ).otherwise(0.0)
    return F.when(F.col("_peers") > 1, lost)


def vs_baseline(value: Column, bar: Column, like: Column) -> Column:
    return F.when((like >= MIN_BASELINE_ROWS) & (bar > 0), F.try_divide(value, bar))
