"""Insight record of a session: readiness, match preparation, fatigue and taper advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.functions.expressions import one_decimal, percent_of
from taperline.operators.features import latest_session
from taperline.operators.hotspots import Split, lookup
from taperline.schema import TIE_BREAK, TRAINING_FEATURES

# Texts and limits of the insight record.
STATUS_MESSAGES = {
    "UNDERLOADED": "Current load below optimal zone for match preparation",
    "OVERLOADED": "Current load above optimal zone for match preparation",
    "OPTIMAL": "Current load within optimal zone for match preparation",
    "UNKNOWN": "Insufficient historical data for this session type",
}
INCREASE = "Consider increasing load by %.1f%%"
DECREASE = "Consider decreasing load by %.1f%%"
HIGH_RISK, MODERATE_RISK = 0.7, 0.3
ACWR_HIGH, ACWR_LOW = 1.5, 0.8
MONOTONY_HIGH = 2
RECENT_DAYS = 3
IMPACTS = {
    ("acwr", "HIGH"): "increasing fatigue risk",
    ("acwr", "LOW"): "potentially insufficient stimulus",
    ("acwr", "OPTIMAL"): "well-balanced workload",
    ("monotony", "HIGH"): "training lacks variability",
    ("monotony", "OPTIMAL"): "good training variation",
    ("volume", "PRESENT"): "contributing to fatigue accumulation",
    ("recovery", "RECENT"): "insufficient recovery time",
    ("recovery", "SUFFICIENT"): "adequate recovery period",
    ("other", "NOTEWORTHY"): "influencing fatigue levels",
}
FACTOR_KINDS = {
    "acwr": "acwr",
    "training_acwr": "acwr",
    "load_monotony": "monotony",
    "high_speed_distance": "volume",
    "high_accel_count": "volume",
    "high_decel_count": "volume",
    "days_since_match": "recovery",
}
TOP_FACTORS = 3
WEEK = 7
FULL_CONFIDENCE, CONFIDENCE_PER_SAMPLE = 100, 20
WITHIN_PERCENT = 15


def insight_rows(features: Split, as_of: Column | None = None, all_sessions: bool = False) -> Split:
    """The sessions to report on.

    By default each player's last one, which has no later match, so nothing that looks
    ahead to a match applies. ``as_of`` takes the last session up to a date while the
    next match still comes from the whole calendar; ``all_sessions`` reports on every one.
    """
    return report_columns(features if all_sessions else Split(latest_session(features.union(), as_of)))


def report_columns(rows: Split) -> Split:
    """The date as text, and the next match if it is near."""
    ahead = F.col("days_until_match")
    return rows.each(
        lambda df: df.withColumns(
            {
                "latest_date": F.date_format("session_date", "yyyy-MM-dd"),
                "days_until_next_match": ahead.cast("int"),
                "md": F.when(ahead <= WEEK, ahead).cast("int"),
            }
        )
    )


def by_day(table: DataFrame, day: str, columns: list[str], name: str) -> DataFrame:
    """One row per player: a map from the day before a match (at most seven) to the columns."""
    entries = F.collect_list(F.struct(F.col(day).cast("int"), F.struct(*columns)))
    return table.groupBy("player").agg(F.map_from_entries(entries).alias(name))


def add_zones(rows: Split, training_zones: DataFrame, match_zones: DataFrame) -> Split:
    """Targets of the day before a match, and whether zones exist for the session's type.

    One row per player is joined, so sessions stay in the exchange that made their features.
    """
    columns = [c for c in training_zones.columns if c.endswith(("_lo", "_hi"))]
    known = (
        training_zones.select("player", F.lit(True).alias("t"), F.lit(False).alias("m"))
        .union(match_zones.select("player", F.lit(False), F.lit(True)))
        .groupBy("player")
        .agg(F.max("t").alias("has_training_zones"), F.max("m").alias("has_match_zones"))
    )
    known = known.join(by_day(training_zones, "md", columns, "_targets"), "player", "left")
    day = F.when(F.col("session_type") == "training", F.col("md").cast("int"))
    targets = {c: F.col("_targets")[day][c] for c in columns}
    rows = lookup(rows, known, ["player"]).each(lambda df: df.withColumns(targets).drop("_targets"))
    return rows.each(lambda df: df.withColumns(load_status()))


def load_status() -> dict[str, Column]:
    """Load against the range of the day; UNKNOWN where only the other session type has zones."""
    load, low, high = F.col("player_load"), F.col("daily_load_lo"), F.col("daily_load_hi")
    own = F.when(F.col("session_type") == "training", F.col("has_training_zones")).otherwise(F.col("has_match_zones"))
    status = (
        F.when(low.isNotNull() & (load < low), "UNDERLOADED")
        .when(low.isNotNull() & (load > high), "OVERLOADED")
        .when(low.isNotNull(), "OPTIMAL")
        .when(~own, "UNKNOWN")
    )
    message = F.create_map(*[F.lit(x) for pair in STATUS_MESSAGES.items() for x in pair])

    def advice(text: str, gap: Column) -> Column:
        percent = F.try_divide(gap, load) * 100
        return F.when(percent.isNotNull(), F.format_string(text.replace("%.1f", "%s"), one_decimal(percent)))

    adjustment = F.when(status == "UNDERLOADED", advice(INCREASE, low - load)).when(
        status == "OVERLOADED", advice(DECREASE, load - high)
    )
    return {"load_status": status, "load_message": message[status], "load_adjustment": adjustment}


def player_zones(training_zones: DataFrame, match_zones: DataFrame) -> DataFrame:
    """All zones per player and session type as one array of (key, target, lo, hi): at most 7 x 4 or 3 x 3 entries."""
    zone = F.sort_array(F.collect_list(F.struct("zone_key", "target", "lo", "hi")))
    return _long_zones(training_zones, match_zones).groupBy("player", "session_type").agg(zone.alias("optimal_zones"))


def add_strategies(rows: Split, training_zones: DataFrame, match_zones: DataFrame, taper: DataFrame) -> Split:
    """The zones of the session's type, and the whole taper plan within a week of a match."""
    rows = lookup(rows, player_zones(training_zones, match_zones), ["player", "session_type"])
    rows = lookup(rows, taper_strategies(taper), ["player"])
    near = F.when(F.col("md").isNotNull(), F.col("taper_strategy"))
    return rows.each(lambda df: df.withColumn("taper_strategy", near))


def add_taper(rows: Split, taper: DataFrame, needs_model: bool = False) -> Split:
    """Advice for the day from the player's taper plan, within a week of a match.

    ``needs_model`` withholds it where the session has no fatigue model.
    """
    columns = ["load_target", "high_intensity_target", "duration_target", "taper_confidence"]
    plan = taper.select(
        "player",
        "md",
        F.col("load_percentage").alias("load_target"),
        F.col("high_intensity").alias("high_intensity_target"),
        F.col("recommended_duration").alias("duration_target"),
        F.least(F.lit(FULL_CONFIDENCE), F.col("sample_count") * CONFIDENCE_PER_SAMPLE).alias("taper_confidence"),
    )
    day = F.when(F.col("model_type").isNotNull(), F.col("md")) if needs_model else F.col("md")
    advice = {c: F.col("_plan")[day.cast("int")][c] for c in columns}
    rows = lookup(rows, by_day(plan, "md", columns, "_plan"), ["player"])
    return rows.each(lambda df: df.withColumns(advice).drop("_plan").withColumns(today_comparison()))


def today_comparison() -> dict[str, Column]:
    actual = F.when(F.col("load_target").isNotNull(), percent_of(F.col("player_load"), F.col("mean_load")))
    gap = actual - F.col("load_target")
    return {"actual_load_pct": actual, "load_difference": gap, "within_target": F.abs(gap) < WITHIN_PERCENT}


def taper_strategies(taper: DataFrame) -> DataFrame:
    """A player's whole plan as an array of at most seven days."""
    day = F.struct(*[c for c in taper.columns if c not in ("player", "md_key")])
    return taper.groupBy("player").agg(F.sort_array(F.collect_list(day)).alias("taper_strategy"))


def with_risk_columns(rows: DataFrame) -> DataFrame:
    """Rows of a squad without any model carry no risk."""
    kinds = {
        "risk_score": "double",
        "interpretation": "string",
        "confidence": "double",
        "key_factors": "array<struct<feature:string,importance:double,value:double,status:string,impact:string>>",
    }
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in rows.columns})


def risk_band(risk: Column) -> Column:
    return (
        F.when(risk > HIGH_RISK, "HIGH RISK")
        .when(risk > MODERATE_RISK, "MODERATE RISK")
        .when(risk.isNotNull(), "LOW RISK")
    )


def top_factors(importances: Column, features: tuple[str, ...] = TRAINING_FEATURES) -> Column:
    """Array of the most important features; equal ones keep the order of ``features``."""
    entries = F.array(
        *[F.struct(importances[f].alias("importance"), F.lit(-i).alias("at"), F.lit(f).alias("feature")) for i, f in enumerate(features)]
    )
    entries = F.filter(entries, lambda e: e["importance"].isNotNull())
    return F.slice(F.sort_array(entries, asc=False), 1, TOP_FACTORS)


def factor_status(feature: Column, value: Column) -> tuple[Column, Column]:
    """Status and meaning of a feature's value."""
    kinds = F.create_map(*[F.lit(x) for pair in FACTOR_KINDS.items() for x in pair])
    kind = F.coalesce(kinds[feature], F.lit("other"))
    status = (
        F.when((kind == "acwr") & (value > ACWR_HIGH), "HIGH")
        .when((kind == "acwr") & (value < ACWR_LOW), "LOW")
        .when((kind == "monotony") & (value > MONOTONY_HIGH), "HIGH")
        .when(kind.isin("acwr", "monotony"), "OPTIMAL")
        .when(kind == "volume", "PRESENT")
        .when((kind == "recovery") & (value < RECENT_DAYS), "RECENT")
        .when(kind == "recovery", "SUFFICIENT")
        .otherwise("NOTEWORTHY")
    )
    impacts = F.create_map(*[x for (k, s), text in IMPACTS.items() for x in (F.lit(f"{k}/{s}"), F.lit(text))])
    return status, impacts[F.concat_ws("/", kind, status)]


def key_factors(importances: Column) -> Column:
    """Array of (feature, importance in percent, value, status, impact), strongest first."""
    values = F.create_map(*[x for f in TRAINING_FEATURES for x in (F.lit(f), F.col(f).cast("double"))])

    def describe(entry: Column) -> Column:
        value = values[entry["feature"]]
        status, impact = factor_status(entry["feature"], value)
        return F.struct(
            entry["feature"].alias("feature"),
            (entry["importance"] * 100).alias("importance"),
            value.alias("value"),
            status.alias("status"),
            impact.alias("impact"),
        )

    return F.transform(top_factors(importances), describe)


def _long_zones(training_zones: DataFrame, match_zones: DataFrame) -> DataFrame:
    def long(zones: DataFrame, kind: str, key: str) -> DataFrame:
        targets = [c[:-3] for c in zones.columns if c.endswith("_lo")]
        entries = F.array(
            *[
                F.struct(F.lit(t).alias("target"), F.col(f"{t}_lo").alias("lo"), F.col(f"{t}_hi").alias("hi"))
                for t in targets
            ]
        )
        return zones.select("player", F.lit(kind).alias("session_type"), F.col(key).alias("zone_key"), F.inline(entries))

    return long(training_zones, "training", "md_key").union(long(match_zones, "match", "metric"))


def applicable_zones(rows: Split, training_zones: DataFrame, match_zones: DataFrame) -> DataFrame:
    """All zones of the session's own type, as (key, target, lo, hi)."""
    return lookup(rows, _long_zones(training_zones, match_zones), ["player", "session_type"], how="inner").union()


def insight_record(rows: DataFrame) -> DataFrame:
    """Nested record, one row per reported session; blocks that do not apply are NULL."""

    def block(present: str, *columns: str) -> Column:
        present = [c for c in (present,) if c in rows.columns]
        if not present:
            return F.lit(None)
        return F.when(F.col(present[0]).isNotNull(), F.struct(*[c for c in columns if c in rows.columns]))

    targets = [c for c in rows.columns if c.endswith(("_lo", "_hi"))]
    return rows.select(
        "player",
        "session_date",
        *TIE_BREAK,
        "session_type",
        "latest_date",
        F.struct(F.col("player").alias("name"), "position").alias("player_info"),
        "days_until_next_match",
        *[c for c in ("optimal_zones", "taper_strategy") if c in rows.columns],
        block("daily_load_lo", *targets).alias("match_prep_targets"),
        block("load_status", "load_status", "load_message", "load_adjustment").alias("readiness"),
        block("risk_score", "risk_score", "interpretation", "confidence", "key_factors", "confusion").alias(
            "fatigue_prediction"
        ),
        block("load_target", "load_target", "high_intensity_target", "duration_target", "taper_confidence").alias(
            "today_recommended"
        ),
        block("load_target", "actual_load_pct", "load_difference", "within_target").alias("today_comparison"),
    )


