"""Fit on history, report on new sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taperline.operators.fatigue import (
    FATIGUE_GROUPS,
    FatigueModels,
    ModelSizes,
    fatigue_inputs,
    score_sessions,
    train_fatigue,
)
from taperline.operators.features import latest_features, performance_target, split_features
from taperline.operators.hotspots import Split, stored
from taperline.operators.taper import taper_plan
from taperline.operators.zones import KEY, match_zones, training_zones, zone_players, zone_ranges
from taperline.plans import dashboard, insights
from taperline.schema import EXPORT_COLUMNS
from taperline.sources.artifacts import load_artifacts, save_artifacts
from taperline.sources.ingest import train_test_split

TABLES = ["training_zones", "match_zones", "taper"]
# Input columns that nothing reads once the features are there.
UNREAD = [
    name
    for name, _ in EXPORT_COLUMNS.values()
    if name.startswith(("dist_", "accel_", "decel_", "impact_")) or name in ("session_ts", "tags", "position", "top_speed")
]
PREDICT_GROUPS = ["training_load", "row_load", "match_days", "means"]


class LoadAnalytics:
    """Zones, taper plans and fatigue models of a squad, and the insights drawn from them."""

    def __init__(self, sizes: ModelSizes | None = None, with_fatigue: bool = True):
        self.sizes = sizes or ModelSizes()
        self.with_fatigue = with_fatigue
        self.tables: dict[str, DataFrame] = {}
        self.fatigue = FatigueModels()

    @property
    def is_trained(self) -> bool:
        return bool(self.tables)

    def fit(self, sessions: DataFrame) -> LoadAnalytics:
        """Learn from history.

        One pass computes all features and writes them; zones, tapers and classifiers read
        that. What is learned is small and kept, so reports do not redo the work.
        """
        groups = {"training_load", "match_days", "good_matches", "taper_matches"}
        if self.with_fatigue:
            groups.update(FATIGUE_GROUPS)
        features = split_features(sessions, groups)
        features = features.each(lambda df: stored(df.drop(*UNREAD)))
        ranges = stored(zone_ranges(features))
        self.tables = {
            "training_zones": training_zones(ranges),
            "match_zones": match_zones(ranges),
            "taper": stored(taper_plan(features)),
        }
        if self.with_fatigue:
            self.fatigue = train_fatigue(fatigue_inputs(features), self.sizes)
        return self

    def profile(self) -> DataFrame:
        """Players with zones, with a taper plan, and with a model per session type."""
        self._need_training()
        zoned = zone_players(self.tables["training_zones"], self.tables["match_zones"])
        counts = [
            zoned.agg(F.count(F.lit(1)).alias("n")).select(F.lit("zones").alias("artefact"), "n"),
            self.tables["taper"].agg(F.count_distinct("player").alias("n")).select(F.lit("taper"), "n"),
        ]
        if self.fatigue.registry is not None:
            models = self.fatigue.registry.groupBy("session_type").count()
            counts.append(models.select(F.concat(F.lit("models_"), "session_type"), "count"))
        out = counts[0]
        for part in counts[1:]:
            out = out.union(part)
        return out

    def predict(
        self,
        sessions: DataFrame,
        as_of: Column | None = None,
        all_sessions: bool = False,
        players: DataFrame | None = None,
        taper_needs_model: bool = False,
    ) -> DataFrame:
        """Flat insight rows; see ``insights.insight_rows`` for which sessions they cover.

        ``players`` asks for certain players: one without usable sessions gets a row whose
        ``error`` says so.
        """
        self._need_training()
        if sessions.isEmpty():
            raise ValueError("There are no sessions to report on")
        # One session per player needs only the end of each history.
        features = split_features(sessions, PREDICT_GROUPS) if all_sessions else Split(latest_features(sessions, as_of))
        rows = insights.report_columns(features)
        if self.fatigue.models is not None:
            rows = self._add_fatigue(rows)
        elif taper_needs_model:
            rows = rows.each(lambda df: df.withColumn("model_type", F.lit(None).cast("string")))
        zoned = self.tables["training_zones"], self.tables["match_zones"]
        rows = insights.add_zones(rows, *zoned)
        rows = insights.add_strategies(rows, *zoned, self.tables["taper"])
        out = insights.add_taper(rows, self.tables["taper"], taper_needs_model).union()
        if players is None:
            return out
        missing = F.when(F.col("latest_date").isNull(), F.concat(F.lit("no sessions of player "), F.col("player")))
        return players.select("player").distinct().join(out, "player", "left").withColumn("error", missing)

    def _add_fatigue(self, rows: Split) -> Split:
        scored = score_sessions(rows, self.fatigue).drop("session_type")

        def attach(df: DataFrame) -> DataFrame:
            # One row per session on either side.
            df = df.join(scored, KEY, "left")
            factors = F.when(F.col("importances").isNotNull(), insights.key_factors(F.col("importances")))
            return df.withColumns(
                {"interpretation": insights.risk_band(F.col("risk")), "key_factors": factors}
            ).drop("importances", "risk")

        return rows.each(attach)

    def dashboard(self, rows: DataFrame) -> dict[str, DataFrame]:
        """Four tables; that of risks is empty where no model passed the gate."""
        return {
            "player_status": dashboard.player_status(rows),
            "match_preparation": dashboard.match_preparation(rows),
            "taper_recommendations": dashboard.taper_recommendations(rows),
            "fatigue_risk": dashboard.fatigue_risk(insights.with_risk_columns(rows)),
        }

    def save(self, path: str) -> None:
        self._need_training()
        save_artifacts(path, self.tables, self.fatigue)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LoadAnalytics:
        out = cls()
        out.tables, out.fatigue = load_artifacts(spark, path, TABLES)
        return out

    def _need_training(self) -> None:
        if not self.is_trained:
            raise ValueError("fit() comes first: nothing has been learned yet")


def train_and_report(
    sessions: DataFrame, analytics: LoadAnalytics | None = None, as_of: Column | None = None
) -> tuple[LoadAnalytics, DataFrame]:
    """Mark the performance target, fit on the training part, report on the rest."""
    train, test = train_test_split(performance_target(sessions))
    analytics = (analytics or LoadAnalytics()).fit(train)
    return analytics, analytics.predict(test, as_of=as_of)
