"""Small hand-made session tables."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from taperline.schema import SESSION_SCHEMA

DEFAULTS = {
    "player": "A",
    "tags": None,
    "position": "GK",
    "player_load": 1.0,
    "distance_per_min": 1.0,
    "sprints_per_min": 1.0,
    "power_score": 1.0,
    "top_speed": 1.0,
    "sprints": 1,
    "duration": 60.0,
}


def make_sessions(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rows give ``date`` ('2024-01-02' or with a time) and what differs from DEFAULTS."""
    fields = SESSION_SCHEMA.fieldNames()
    data = []
    for i, row in enumerate(rows):
        row = DEFAULTS | row
        ts = dt.datetime.fromisoformat(row["date"])
        for f in SESSION_SCHEMA:
            if f.name not in row and f.name not in ("session_ts", "session_date", "k1", "k2", "k3"):
                row[f.name] = 1.0 if f.dataType.typeName() == "double" else 1
        row |= {"session_ts": ts, "session_date": ts.date(), "k1": row.get("k1", i), "k2": 0, "k3": 0}
        data.append(tuple(row[f] for f in fields))
    return spark.createDataFrame(data, SESSION_SCHEMA)


def column(df: DataFrame, name: str) -> list:
    """Values of a column in session order."""
    return [r[name] for r in sorted(df.collect(), key=lambda r: (r.player, r.session_ts, r.k1))]
