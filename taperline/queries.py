"""One runnable query per operator over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taperline.functions import expressions as E
from taperline.operators import fatigue as M
from taperline.operators import features as C
from taperline.operators import metrics, pairs, taper, zones
from taperline.operators.hotspots import MAX_GROUP_ROWS, Split, shared_folder, stored
from taperline.operators.quantiles import grouped_quantiles
from taperline.plans import dashboard, insights
from taperline.plans.analytics import UNREAD, LoadAnalytics
from taperline.schema import EXPORT_COLUMNS, PERFORMANCE_METRICS, SESSION_TYPES, TRAINING_FEATURES
from taperline.sources import ingest
from taperline.sources.bindings import DENSE_PLAYER, event_sessions, sessions, sparse_sessions

Query = Callable[[SparkSession, str], DataFrame]

KEY = zones.KEY
AS_OF = "1998-07-01"
# Queries that also run by the plan for oversized players.
HEAVY = (
    "good_matches_any",
    "good_matches_all",
    "training_zones",
    "match_zones",
    "taper_plan",
    "exact_quantile",
    "vs_baseline",
    "load_status",
    "training_acwr",
    "next_speed_decline",
    "subday_training_load",
    "subday_match_days",
    "dense_training_load",
    "dense_match_days",
    "zone_pairs",
    "taper_pairs",
    "standardize_per_player",
)


# The classifiers as the library has them.
QUERY_SIZES = M.ModelSizes()


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals where two engines may differ in the last bits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _features(groups: list[str], *columns: str, digits: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(C.build_features(sessions(spark, sf_dir), groups, only=KEY).select(*KEY, *columns), *digits)

    return run


# -- ingest ---------------------------------------------------------------------------


def read_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write an export with its original headers and day numbers as CSV, then read it back."""
    headers = {name: header for header, (name, _) in EXPORT_COLUMNS.items()}
    table = sessions(spark, sf_dir)
    day_number = F.datediff("session_date", F.lit("1899-12-30").cast("date")).alias("Date")
    path = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    columns = [F.col(c).alias(headers[c]) for c in table.columns if c in headers]
    table.select(*columns, day_number, "k1", "k2", "k3").write.option("header", True).csv(path)
    back = ingest.read_sessions(spark, path)
    return back.select(
        *KEY, "session_ts", "tags", "position", "player_load", "sprints", "duration", "dist_power_25_30", "impact_gt20"
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export in which some dates and players were lost: the rows that cannot be sessions."""
    headers = {name: header for header, (name, _) in EXPORT_COLUMNS.items()}
    table = sessions(spark, sf_dir)
    day = F.datediff("session_date", F.lit("1899-12-30").cast("date")).cast("string")
    day = F.when(F.col("k1") % 13 == 0, "soon").otherwise(day).alias("Date")
    player = F.when(F.col("k1") % 11 != 0, F.col("player")).alias("Player Name")
    rest = [F.col(c).alias(headers[c]) for c in table.columns if c in headers and c != "player"]
    path = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    table.select(player, day, *rest, "k1", "k2", "k3").write.option("header", True).csv(path)
    _, bad = ingest.read_with_quarantine(spark, path)
    keys = [F.get_json_object("row", f"$.{k}").cast("bigint").alias(k) for k in ("k1", "k2", "k3")]
    return bad.select(*keys, "reason")


def default_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.default_position(sessions(spark, sf_dir).drop("position")).select(*KEY, "position")


def excel_serial_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    serial = days + (F.col("o_orderkey") % 96) / 96.0
    return orders.select("o_orderkey", E.excel_serial_to_ts(serial).alias("session_ts"))


def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy")
    text = F.when(F.col("o_orderkey") % 10 == 0, "n/a").otherwise(text)
    return orders.select("o_orderkey", E.parse_date(text, "dd/MM/yyyy").alias("session_ts"))


def order_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.order_sessions(sessions(spark, sf_dir).select(*KEY, "player_load"))


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.dataset_profile(sessions(spark, sf_dir))


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = ingest.train_test_split(sessions(spark, sf_dir).select(*KEY))
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


def union_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [sessions(spark, sf_dir), sparse_sessions(spark, sf_dir)]
    return ingest.union_sessions(*parts).select(*KEY, "position", "player_load")


def distinct_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.distinct_players(sessions(spark, sf_dir))


# -- row features ---------------------------------------------------------------------


def session_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = ingest.union_sessions(sessions(spark, sf_dir), sparse_sessions(spark, sf_dir))
    return both.select(*KEY, E.session_type(F.col("tags")).alias("session_type"))


def min_history_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.build_features(sparse_sessions(spark, sf_dir), []).select(*KEY, "player_load")


def high_intensity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["high_speed_distance", "high_accel_count", "high_decel_count", "high_impact_count"]
    return E.high_intensity(sessions(spark, sf_dir)).select(*KEY, *columns)


def high_power_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.high_intensity(sessions(spark, sf_dir)).select(*KEY, "high_power_distance")


def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = E.safe_ratio(F.col("player_load"), F.col("sprints_per_min")).alias("ratio")
    return rounded(sessions(spark, sf_dir).select(*KEY, ratio), "ratio")


def drop_null_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.fatigue_features(sessions(spark, sf_dir)).union()
    clean = [M.drop_null_features(rows, kind) for kind in SESSION_TYPES]
    return clean[0].unionByName(clean[1]).select(*KEY, "session_type", "days_since_match", "days_until_match")


def month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(spark, sf_dir).select(*KEY, E.month_bucket(F.col("session_date")).alias("month"))


def md_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(sessions(spark, sf_dir), ["match_days"])
    return rows.select(*KEY, E.md_key(F.col("days_until_match")).alias("md_key")).filter("md_key is not null")


# -- windows --------------------------------------------------------------------------


def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(sessions(spark, sf_dir), ["training_load"]).filter("session_type = 'match'")
    return rows.select(*KEY, "training_acute_load", "training_chronic_load")


def speed_decline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.by_session_type(C.build_features(sessions(spark, sf_dir), ["speed"]), ["speed_decline"])
    columns = ("match_speed_decline", "training_speed_decline")
    return rounded(rows.select(*KEY, *columns), *columns)


def vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [f"{m}_vs_baseline" for m in PERFORMANCE_METRICS]
    rows = C.by_session_type(C.build_features(sessions(spark, sf_dir), ["baseline"]), columns)
    wide = [f"{kind}_{c}" for kind in ("match", "training") for c in columns]
    return rounded(rows.select(*KEY, *wide), *wide)


def rolling_avg_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(sessions(spark, sf_dir), ["target"], min_sessions=0)
    return rounded(rows.select(*KEY, "rolling_avg"), "rolling_avg")


def performance_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.performance_target(sessions(spark, sf_dir)).select(*KEY, "distance_per_min", "target")


def latest_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(sessions(spark, sf_dir), [])
    return C.latest_session(rows).select(*KEY, "session_type", "player_load")


def subday_training_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(event_sessions(spark, sf_dir), ["training_load"], grain="timestamp")
    columns = ["training_acute_load", "training_chronic_load", "training_acwr"]
    return rounded(rows.select("player", "session_ts", "k1", *columns), *columns)


def subday_match_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(event_sessions(spark, sf_dir), ["match_days", "speed"], grain="timestamp")
    columns = ["days_since_match", "days_until_match", "speed_decline"]
    return rounded(rows.select("player", "session_ts", "k1", *columns), "speed_decline")


def dense_training_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants where a third of all users are one player."""
    rows = C.build_features(event_sessions(spark, sf_dir, DENSE_PLAYER), ["training_load"], grain="timestamp")
    columns = ["training_acute_load", "training_chronic_load", "training_acwr"]
    return rounded(rows.select("player", "session_ts", "k1", *columns), *columns)


def dense_match_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.build_features(event_sessions(spark, sf_dir, DENSE_PLAYER), ["match_days", "speed"], grain="timestamp")
    columns = ["days_since_match", "days_until_match", "speed_decline"]
    return rounded(rows.select("player", "session_ts", "k1", *columns), "speed_decline")


# -- zones and tapers -----------------------------------------------------------------


def good_matches_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.good_matches_any(zones.zone_features(sessions(spark, sf_dir), only=KEY).union())


def pre_match_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = zones.pre_match_sessions(zones.zone_features(sessions(spark, sf_dir)).union())
    return rows.select(*KEY, "metric", "copies", "days_until_match")


def zone_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every training session with every strong match of the following week, per metric."""
    features = zones.zone_features(sessions(spark, sf_dir), only=KEY).union()
    training = features.filter("session_type = 'training'").select(*KEY)
    return pairs.session_match_pairs(training, zones.good_matches_any(features).drop("value"))


def taper_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = taper.taper_features(sessions(spark, sf_dir)).union()
    training = features.filter("session_type = 'training'").select(*KEY)
    return pairs.session_match_pairs(training, taper.good_matches_all(features).select(*KEY))


def good_matches_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taper.good_matches_all(taper.taper_features(sessions(spark, sf_dir)).union())


def taper_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = taper.taper_sessions(taper.taper_features(sessions(spark, sf_dir)).union())
    return rows.select(*KEY, "days_before", "copies")


ZONE_COLUMNS = [f"{t}_{b}" for t in zones.TRAINING_TARGETS for b in ("lo", "hi")]
MATCH_ZONE_COLUMNS = [f"{t}_{b}" for t in zones.MATCH_TARGETS for b in ("lo", "hi")]
TAPER_COLUMNS = ["load_percentage", "high_intensity", "high_acceleration_count", "high_deceleration_count"]


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_ranges(zones.zone_features(sessions(spark, sf_dir), only=zones.ZONE_INPUTS))


def zone_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_metric = zones.training_zones_by_metric(_ranges(spark, sf_dir))
    return zones.zone_precedence(by_metric).select("player", "md", "metric", "n")


def training_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = zones.training_zones(_ranges(spark, sf_dir))
    return rounded(table.select("player", "md", "md_key", *ZONE_COLUMNS, "n"), *ZONE_COLUMNS)


def training_zones_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = zones.training_zones_by_metric(_ranges(spark, sf_dir))
    return rounded(table.select("player", "md", "metric", *ZONE_COLUMNS, "n"), *ZONE_COLUMNS)


def match_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = zones.match_zones(_ranges(spark, sf_dir))
    return rounded(table.select("player", "metric", *MATCH_ZONE_COLUMNS, "n"), *MATCH_ZONE_COLUMNS)


def zone_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_players(*_zones(spark, sf_dir))


def training_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = taper.training_means(C.build_features(sessions(spark, sf_dir), []))
    return rounded(table, "mean_load", "mean_hsd")


def taper_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = taper.taper_plan(taper.taper_features(sessions(spark, sf_dir)))
    return rounded(table, *TAPER_COLUMNS, "recommended_duration")


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taper.eligibility(C.tidy_sessions(sparse_sessions(spark, sf_dir)))


def exact_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.split_features(sessions(spark, sf_dir), [])
    probs = {"q25": 0.25, "q50": 0.5, "q67": 0.67, "q75": 0.75}
    wanted = {f"{m}_{q}": (m, p) for m in ("distance_per_min", "top_speed") for q, p in probs.items()}
    return rounded(grouped_quantiles(rows, ["player", "session_type"], wanted), *wanted)


def lookup_player_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each player's last session with what is known about the player."""
    table = sessions(spark, sf_dir)
    last = C.latest_session(C.build_features(table, [])).select(*KEY)
    zoned = zones.training_zones(zones.zone_ranges(zones.zone_features(table))).groupBy("player").agg(F.count(F.lit(1)).alias("n_zones"))
    plans = taper.taper_plan(taper.taper_features(table)).groupBy("player").agg(F.count(F.lit(1)).alias("n_taper_days"))
    return last.join(zoned, "player", "left").join(plans, "player", "left")


# -- metrics on a fixed score column ----------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (F.col("k3") % 97) / 97.0
    return sessions(spark, sf_dir).select(
        "player",
        F.when(F.col("k1") % 3 == 0, 1).otherwise(0).alias("label"),
        score.alias("score"),
        F.when(score > 0.5, 1).otherwise(0).alias("prediction"),
    )


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_counts(_scored(spark, sf_dir), ["player"])


def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_cells(_scored(spark, sf_dir), [])


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(_scored(spark, sf_dir), ["player"]), "auc")


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_balance(_scored(spark, sf_dir), ["player"])


def select_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three kinds with an AUC derived from a supplier's key, the best above the gate."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    entries = [
        F.struct(F.lit(k).alias("model_type"), (((F.col("s_suppkey") * (37 + i) + i * 13) % 50 + 40) / 100.0).alias("auc"))
        for i, k in enumerate(M.CANDIDATES)
    ]
    player = F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("player")
    aucs = suppliers.select(player, F.lit("match").alias("session_type"), F.inline(F.array(*entries)))
    return rounded(M.select_best_model(aucs), "auc")


def _risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A risk score per player from its loads, coarse enough to have ties."""
    risk = (F.sum("k1") % 200 / 2.0).alias("risk_score")
    return sessions(spark, sf_dir).groupBy("player").agg(risk)


def rank_by_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.rank_by_risk(_risks(spark, sf_dir)).select("player", "risk_score", "risk_rank")


def risk_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.risk_ranking(_risks(spark, sf_dir))


def _importances() -> Column:
    """Importances derived from the player's number."""
    number = F.substring("player", 2, 20).cast("bigint")
    pairs = [(F.lit(f), (number * (i + 3) % 17) / 100.0) for i, f in enumerate(TRAINING_FEATURES)]
    return F.create_map(*[x for pair in pairs for x in pair])


def _factor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ["training_load", "row_load", "match_days"]
    rows = C.build_features(sessions(spark, sf_dir), groups)
    return C.latest_session(rows, as_of()).withColumn("importances", _importances())


def top3_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = ingest.distinct_players(sessions(spark, sf_dir)).withColumn("importances", _importances())
    top = players.select("player", F.posexplode(insights.top_factors(F.col("importances"))).alias("pos", "factor"))
    return top.select("player", "pos", "factor.feature", "factor.importance")


def key_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _factor_rows(spark, sf_dir).filter(F.col("days_until_match").isNotNull())
    factors = rows.select("player", F.posexplode(insights.key_factors(F.col("importances"))).alias("pos", "factor"))
    return rounded(factors.select("player", "pos", "factor.*"), "importance", "value")


# -- insights and dashboards without a model --------------------------------------------


def _features_once(spark: SparkSession, sf_dir: str, *learned: str) -> Split:
    """What is learned from and what is reported on, by one pass over all sessions."""
    table = sessions(spark, sf_dir)
    read = [c for c in C.tidy_sessions(table).columns if c not in UNREAD]
    features = C.split_features(table, [*learned, "match_days", "means"], only=read)
    return features.each(lambda df: stored(df.drop(*UNREAD)))


def _reported(spark: SparkSession, sf_dir: str, all_sessions: bool = False) -> Split:
    features = C.split_features(sessions(spark, sf_dir), ["match_days", "means"])
    return insights.insight_rows(features, None if all_sessions else as_of(), all_sessions)


def _zones(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ranges = stored(_ranges(spark, sf_dir))
    return zones.training_zones(ranges), zones.match_zones(ranges)


def _zoned(spark: SparkSession, sf_dir: str, all_sessions: bool = False) -> Split:
    features = _features_once(spark, sf_dir, "training_load", "good_matches")
    ranges = stored(zones.zone_ranges(features))
    rows = insights.insight_rows(features, None if all_sessions else as_of(), all_sessions)
    return insights.add_zones(rows, zones.training_zones(ranges), zones.match_zones(ranges))


def _tapered(spark: SparkSession, sf_dir: str, all_sessions: bool = False) -> DataFrame:
    features = _features_once(spark, sf_dir, "taper_matches")
    plan = stored(taper.taper_plan(features))
    rows = insights.insight_rows(features, None if all_sessions else as_of(), all_sessions)
    return insights.add_taper(rows, plan).union()


def insight_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir).union().select("player", "session_type", "latest_date", "position")


def next_match_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir).union().select("player", "days_until_next_match")


def applicable_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insights.applicable_zones(_reported(spark, sf_dir), *_zones(spark, sf_dir))
    return rounded(rows.select("player", "session_type", "zone_key", "target", "lo", "hi"), "lo", "hi")


def match_prep_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _zoned(spark, sf_dir).union().filter("daily_load_lo is not null")
    return rounded(rows.select("player", "md", *ZONE_COLUMNS), *ZONE_COLUMNS)


def lookup_md_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _zoned(spark, sf_dir, all_sessions=True).union().filter("daily_load_lo is not null")
    return rounded(rows.select(*KEY, "md", "daily_load_lo", "daily_load_hi"), "daily_load_lo", "daily_load_hi")


def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _zoned(spark, sf_dir, all_sessions=True).union().filter("load_status is not null")
    return rows.select(*KEY, "load_status", "load_message", "load_adjustment")


def taper_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _reported(spark, sf_dir).union().filter("md is not null").select("player", "days_until_next_match")
    plans = insights.taper_strategies(taper.taper_plan(taper.taper_features(sessions(spark, sf_dir))))
    days = near.join(plans, "player").select("player", "days_until_next_match", F.inline("taper_strategy"))
    return rounded(days, *TAPER_COLUMNS, "recommended_duration")


def today_recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["load_target", "high_intensity_target", "duration_target"]
    rows = _tapered(spark, sf_dir).filter("load_target is not null")
    return rounded(rows.select("player", *columns, "taper_confidence"), *columns)


def today_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tapered(spark, sf_dir, all_sessions=True).filter("load_target is not null")
    columns = ["actual_load_pct", "load_difference"]
    return rounded(rows.select(*KEY, *columns, "within_target"), *columns)


PREDICT_FLOATS = ["daily_load_lo", "daily_load_hi", "load_target", "actual_load_pct", "load_difference"]


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sessions(spark, sf_dir)
    return LoadAnalytics(with_fatigue=False).fit(table).predict(table, as_of=as_of())


def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["session_type", "latest_date", "position", "days_until_next_match", "load_status", "load_adjustment"]
    rows = _predicted(spark, sf_dir).select("player", *columns, *PREDICT_FLOATS, "taper_confidence", "within_target")
    return rounded(rows, *PREDICT_FLOATS)


def player_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.player_status(_zoned(spark, sf_dir).union())


def match_preparation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.match_preparation(_zoned(spark, sf_dir).union())


def taper_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboard.taper_recommendations(_tapered(spark, sf_dir))
    return rounded(rows, "load_percentage", "high_intensity", "duration", "actual_load", "load_difference")


def readiness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(dashboard.readiness_summary(_zoned(spark, sf_dir).union()), "share")


def taper_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = taper.taper_plan(taper.taper_features(sessions(spark, sf_dir)))
    rows = dashboard.taper_series(plan, _reported(spark, sf_dir).union())
    return rounded(rows, "load_percentage", "high_intensity")


# -- classifiers ----------------------------------------------------------------------


def fatigue_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.fatigue_features(sessions(spark, sf_dir)).union()
    columns = [*KEY, "session_type", "month", *TRAINING_FEATURES, "performance_drop"]
    return rounded(rows.select(*columns), "acwr", "load_monotony", "load_strain", "training_acwr")


def standardize_per_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = M.standardize_own(M.fatigue_features(sessions(spark, sf_dir))).union()
    return rounded(scaled.select(*KEY, "session_type", *TRAINING_FEATURES), *TRAINING_FEATURES)


def incremental_scalers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalers of sessions up to a date, merged with those of the sessions after it."""
    features = M.fatigue_features(sessions(spark, sf_dir)).each(stored).union()
    clean = M.drop_null_features(features, "training")
    inputs = M.FATIGUE_FEATURES["training"]
    older = F.col("session_date") <= as_of()
    parts = [M.player_scalers(clean.filter(c), inputs) for c in (older, ~older)]
    merged = M.merged_scalers(*parts)
    return rounded(merged, *[c for c in merged.columns if c.startswith(("mean_", "std_"))])


# What training learned, by application, folder, kinds and whether all were refitted: one training serves all
# queries of a session that ask for no more.
_TRAINED: dict[tuple, M.FatigueModels] = {}


def _trained(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = M.CANDIDATES, refit_all: bool = False) -> M.FatigueModels:
    """Models of the given kinds at least."""
    session = spark.sparkContext.applicationId, sf_dir
    for (*same, known, refitted), found in _TRAINED.items():
        if tuple(same) == session and set(kinds) <= set(known) and refitted >= refit_all:
            return found
    for key in [k for k in _TRAINED if k[:2] != session]:
        del _TRAINED[key]  # frames of another session or folder are of no use
    features = M.fatigue_features(sessions(spark, sf_dir)).each(stored)
    found = _TRAINED[*session, kinds, refit_all] = M.train_fatigue(features, QUERY_SIZES, kinds, refit_all)
    return found


def month_group_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.fatigue_features(sessions(spark, sf_dir)).each(stored).union()
    parts = []
    for kind in SESSION_TYPES:
        clean = M.drop_null_features(rows, kind)
        placed = clean.withColumn("fold", M.fold_of(M.month_group_folds(clean)))
        parts.append(placed.groupBy("session_type", "month", "fold").agg(F.count(F.lit(1)).alias("n")))
    return parts[0].unionByName(parts[1])


def trainable_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.fatigue_features(sessions(spark, sf_dir)).union()
    parts = [M.trainable_players(rows, kind).withColumn("session_type", F.lit(kind)) for kind in SESSION_TYPES]
    return parts[0].unionByName(parts[1])


def fold_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean over folds on scores that follow from a row's keys; one fold of some players is missing."""
    score = ((F.col("k3") % 97) / 97.0).alias("score")
    label = F.when(F.col("k1") % 3 == 0, 1).otherwise(0).alias("performance_drop")
    fold = (F.col("k2") % 3).cast("int").alias("fold")
    kind = [F.lit("match").alias("session_type"), F.lit("Any").alias("model_type")]
    rows = sessions(spark, sf_dir).select("player", *kind, fold, label, score)
    seen = rows.filter((F.substring("player", 2, 20).cast("bigint") % 7 != 0) | (F.col("fold") != 1))
    return rounded(M.cross_validated_auc(seen), "auc")


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LoadAnalytics(with_fatigue=False).fit(sessions(spark, sf_dir)).profile()


def insight_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested record of each player's session, its blocks spread into columns."""
    rows = insights.insight_record(_predicted(spark, sf_dir))
    strategy = F.transform("taper_strategy", lambda d: F.concat_ws(":", d["md"], d["sample_count"]))
    zones_ = F.transform("optimal_zones", lambda z: F.concat_ws(":", z["zone_key"], z["target"]))
    return rows.select(
        "player",
        "player_info.position",
        "days_until_next_match",
        F.array_join(zones_, ",").alias("zones"),
        F.array_join(strategy, ",").alias("plan"),
        "readiness.load_status",
        F.round("today_recommended.load_target", 6).alias("load_target"),
        "today_comparison.within_target",
    )


def metrics_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of an export without power score."""
    table = sessions(spark, sf_dir).drop("power_score")
    ranges = zones.training_zones_by_metric(zones.zone_ranges(zones.zone_features(table)))
    return ranges.select("player", "md", "metric", "n")


def _crowded(query: Query) -> Query:
    """The query with a limit that makes every player of the table an oversized one."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before = spark.conf.get(MAX_GROUP_ROWS, None)
        spark.conf.set(MAX_GROUP_ROWS, "100")
        try:
            return query(spark, sf_dir)
        finally:
            spark.conf.unset(MAX_GROUP_ROWS) if before is None else spark.conf.set(MAX_GROUP_ROWS, before)

    return run


def _held_out(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = _trained(spark, sf_dir, (kind,)).held_out.filter(F.col("model_type") == kind)
        return scored.select("session_type", *KEY, "fold", "performance_drop", "score")

    return run


def cross_validated_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cross_validated_auc(_trained(spark, sf_dir).held_out)


def refit_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every session that was learned from, scored by its player's models fitted on all months."""
    seen = _trained(spark, sf_dir, refit_all=True).held_out
    scores = [F.max(F.when(F.col("model_type") == k, F.col("refit_score"))).alias(f"score_{k}") for k in M.CANDIDATES]
    return seen.groupBy(*KEY, "session_type").agg(*scores)


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["session_type", "player", "model_type", "auc", "tn", "fp", "fn", "tp"]
    return _trained(spark, sf_dir).registry.select(*columns)


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _trained(spark, sf_dir).registry
    return registry.select("session_type", "player", F.explode("importances").alias("feature", "importance"))


def _scored_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.fatigue_features(sessions(spark, sf_dir))
    return M.score_sessions(rows, _trained(spark, sf_dir))


def score_fatigue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_sessions(spark, sf_dir).select(*KEY, "session_type", "model_type", "risk_score")


def fatigue_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_sessions(spark, sf_dir).withColumn("interpretation", insights.risk_band(F.col("risk")))
    return scored.select(*KEY, "session_type", "risk_score", "interpretation", "confidence")


def confusion_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_sessions(spark, sf_dir).select(*KEY, "session_type", "confusion.*")


def fatigue_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = sessions(spark, sf_dir)
    analytics = LoadAnalytics(with_fatigue=False).fit(table)
    analytics.fatigue = _trained(spark, sf_dir)
    risks = dashboard.fatigue_risk(analytics.predict(table, as_of=as_of()))
    return risks.withColumn("key_factors", F.to_json("key_factors"))


def risk_banding(spark: SparkSession, sf_dir: str) -> DataFrame:
    risks = _risks(spark, sf_dir)
    return risks.withColumn("interpretation", insights.risk_band(F.col("risk_score") / 100))


def all_queries() -> dict[str, Query]:
    load, rows = ["training_load"], ["row_load"]
    out: dict[str, Query] = {
        "training_acute_load": _features(load, "training_acute_load"),
        "training_chronic_load": _features(load, "training_chronic_load"),
        "training_acwr": _features(load, "training_acwr", digits=("training_acwr",)),
        "acute_load": _features(rows, "acute_load"),
        "chronic_load": _features(rows, "chronic_load"),
        "acwr": _features(rows, "acwr", digits=("acwr",)),
        "load_monotony": _features(rows, "load_monotony", digits=("load_monotony",)),
        "load_strain": _features(rows, "load_strain", digits=("load_strain",)),
        "days_since_match": _features(["match_days"], "days_since_match"),
        "days_until_match": _features(["match_days"], "days_until_match"),
        "next_speed_decline": _features(["label"], "next_speed_decline", digits=("next_speed_decline",)),
        "performance_drop_label": _features(["label"], "performance_drop"),
        "random_forest": _held_out("RandomForest"),
        "gradient_boosting": _held_out("GradientBoosting"),
        "neural_net": _held_out("NeuralNetwork"),
    }
    for query in (
        read_sessions, quarantine, default_position, excel_serial_to_ts, parse_date, order_sessions, dataset_profile,
        train_test_split, union_players, distinct_players, session_type, min_history_filter,
        high_intensity_metrics, high_power_distance, safe_ratio, drop_null_features, month_bucket, md_key,
        forward_fill, speed_decline, vs_baseline, rolling_avg_5, performance_target, latest_session,
        subday_training_load, subday_match_days, dense_training_load, dense_match_days, good_matches_any, pre_match_sessions, zone_pairs, taper_pairs, good_matches_all,
        taper_sessions, zone_precedence, training_zones, training_zones_by_metric, match_zones, zone_players,
        training_means, taper_plan, eligibility, exact_quantile, lookup_player_artifacts, lookup_md_target,
        confusion_counts, confusion_cells, roc_auc, class_balance, select_best_model, rank_by_risk, risk_ranking,
        risk_banding, top3_factors, key_factors, insight_header, next_match_info, applicable_zones,
        match_prep_targets, load_status, taper_strategy, today_recommended, today_comparison, predict,
        player_status, match_preparation, taper_recommendations, readiness_summary, taper_series,
        fatigue_features, standardize_per_player, incremental_scalers, month_group_folds, cross_validated_auc, refit_full,
        model_registry, feature_importance, score_fatigue, fatigue_prediction, confusion_details, fatigue_risk,
        trainable_players, fold_auc, profile, insight_record, metrics_absent,
    ):
        out[query.__name__] = query
    return out | {f"{name}_heavy": _crowded(out[name]) for name in HEAVY}
