"""The session table: one row per player per session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Export header -> (our column, type).
EXPORT_COLUMNS: dict[str, tuple[str, T.DataType]] = {
    "Player Name": ("player", T.StringType()),
    "Date": ("session_ts", T.TimestampNTZType()),
    "Tags": ("tags", T.StringType()),
    "Position": ("position", T.StringType()),
    "Player Load": ("player_load", T.DoubleType()),
    "Distance Per Min (m/min)": ("distance_per_min", T.DoubleType()),
    "Sprints Per Min": ("sprints_per_min", T.DoubleType()),
    "Power Score (w/kg)": ("power_score", T.DoubleType()),
    "Top Speed (m/s)": ("top_speed", T.DoubleType()),
    "Sprints": ("sprints", T.LongType()),
    "Duration": ("duration", T.DoubleType()),
    "Distance in Speed Zone 4  (metres)": ("dist_speed_z4", T.DoubleType()),
    "Distance in Speed Zone 5  (metres)": ("dist_speed_z5", T.DoubleType()),
    "Accelerations Zone Count: 3 - 4 m/s/s": ("accel_3_4", T.LongType()),
    "Accelerations Zone Count: > 4 m/s/s": ("accel_gt4", T.LongType()),
    "Deceleration Zone Count: 3 - 4 m/s/s": ("decel_3_4", T.LongType()),
    "Deceleration Zone Count: > 4 m/s/s": ("decel_gt4", T.LongType()),
    "Impact Zones: 10 - 15 G (Impacts)": ("impact_10_15", T.LongType()),
    "Impact Zones: 15 - 20 G (Impacts)": ("impact_15_20", T.LongType()),
    "Impact Zones: > 20 G (Impacts)": ("impact_gt20", T.LongType()),
    "Distance in Power Zone: 25 - 30 w/kg  (metres)": ("dist_power_25_30", T.DoubleType()),
    "Distance in Power Zone: 30 - 35 w/kg  (metres)": ("dist_power_30_35", T.DoubleType()),
    "Distance in Power Zone: 35 - 40 w/kg  (metres)": ("dist_power_35_40", T.DoubleType()),
    "Distance in Power Zone: 40 - 45 w/kg  (metres)": ("dist_power_40_45", T.DoubleType()),
    "Distance in Power Zone: 45 - 50 w/kg  (metres)": ("dist_power_45_50", T.DoubleType()),
    "Distance in Power Zone: > 50 w/kg  (metres)": ("dist_power_gt50", T.DoubleType()),
}

# An input without one of these is refused.
REQUIRED_COLUMNS = ("session_ts", "player", "tags", "player_load", "distance_per_min")

# Tie-break of sessions sharing a date; (date, k1, k2, k3) is a total order per player.
TIE_BREAK = ("k1", "k2", "k3")

POWER_ZONES = (
    "dist_power_25_30",
    "dist_power_30_35",
    "dist_power_35_40",
    "dist_power_40_45",
    "dist_power_45_50",
)

# Fixed values, in order: a later metric wins where two set the same target.
PERFORMANCE_METRICS = ("distance_per_min", "sprints_per_min", "power_score")
TAPER_METRICS = ("distance_per_min", "sprints_per_min")

SESSION_TYPES = ("match", "training")

# Fixed values, in order: inputs of the fatigue classifiers.
MATCH_FEATURES = (
    "acwr",
    "load_monotony",
    "load_strain",
    "high_speed_distance",
    "high_accel_count",
    "high_decel_count",
    "high_impact_count",
    "days_since_match",
)
TRAINING_FEATURES = MATCH_FEATURES + ("training_acwr", "days_until_match")
FATIGUE_FEATURES = {"match": MATCH_FEATURES, "training": TRAINING_FEATURES}

SESSION_SCHEMA = T.StructType(
    [T.StructField(name, dtype, name not in ("player", "session_ts")) for name, dtype in EXPORT_COLUMNS.values()]
    + [T.StructField("session_date", T.DateType(), False)]
    + [T.StructField(k, T.LongType(), False) for k in TIE_BREAK]
)


def require_columns(sessions: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Fail while the plan is built, before any job, when a needed column is absent."""
    present = set(sessions.columns)
    if "session_date" in present:
        present.add("session_ts")
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return sessions
