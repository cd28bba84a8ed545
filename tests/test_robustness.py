"""Ties, uneven exports, saved state, empty data, and what is left behind."""

import random

import pytest
from helpers import make_sessions
from pyspark.sql import functions as F

from taperline.functions.expressions import one_decimal
from taperline.operators import fatigue, metrics, taper, zones
from taperline.operators.features import build_features
from taperline.operators.hotspots import MAX_GROUP_ROWS, Split
from taperline.operators.quantiles import grouped_quantiles
from taperline.plans.analytics import LoadAnalytics
from taperline.sources import bindings, ingest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def limit(spark):
    yield lambda rows: spark.conf.set(MAX_GROUP_ROWS, str(rows))
    spark.conf.unset(MAX_GROUP_ROWS)


def test_tied_quantiles_are_the_tied_value(spark, limit):
    """97 values of 6.3 at 0.67: interpolating between equal ends must not round."""
    df = spark.createDataFrame([("g", 6.3)] * 97 + [("h", x / 7) for x in range(50)], "g string, v double")
    wanted = {f"q{int(100 * p)}": ("v", p) for p in (0.1, 0.25, 0.5, 0.67, 0.75, 0.9)}
    plain = {r["g"]: r for r in grouped_quantiles(Split(df), ["g"], wanted).collect()}
    limit(5)
    heavy = {r["g"]: r for r in grouped_quantiles(Split(df.filter("false"), df), ["g"], wanted).collect()}
    assert heavy == plain and plain["g"]["q67"] == 6.3


def test_strong_matches_with_ties_in_both_plans(spark, limit):
    rows = [
        {"date": f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", "tags": "match" if i % 2 else "gym", "distance_per_min": 6.3, "sprints_per_min": 0.7}
        for i in range(150)
    ]
    table = make_sessions(spark, rows)
    plain = taper.good_matches_all(taper.taper_features(table).union()).count()
    limit(30)
    assert taper.good_matches_all(taper.taper_features(table).union()).count() == plain == 75


def test_narrow_values_are_cut_until_cells_are_small(spark, limit):
    limit(20)
    values = [1e15 + i / 8 for i in range(3000)] + [-1e300, 1e300]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    wanted = {"q25": ("v", 0.25), "q75": ("v", 0.75)}
    heavy = grouped_quantiles(Split(df.filter("false"), df), ["g"], wanted).first()
    assert heavy == grouped_quantiles(Split(df), ["g"], wanted).first()


def test_files_with_columns_in_different_order(spark, tmp_path):
    head = ["Player Name", "Date", "Tags", "Player Load", "Distance Per Min (m/min)"]
    one, two = tmp_path / "one.csv", tmp_path / "two.csv"
    one.write_text(",".join(head) + "\nA,45292,gym,7,3\n")
    two.write_text(",".join([*head[:3], head[4], head[3], "Duration"]) + "\nB,45292,gym,3,7,60\n")
    rows = {r["player"]: r for r in ingest.read_sessions(spark, [str(one), str(two)]).collect()}
    assert [(r["player_load"], r["distance_per_min"]) for r in (rows["A"], rows["B"])] == [(7.0, 3.0)] * 2
    assert (rows["A"]["duration"], rows["B"]["duration"]) == (None, 60.0)


def test_absent_metrics_leave_the_others(spark, limit):
    table = bindings.sessions(spark, SF)

    def ranges(t):
        rows = zones.training_zones_by_metric(zones.zone_ranges(zones.zone_features(t))).collect()
        return sorted((r["player"], r["md"], r["metric"], r["daily_load_lo"]) for r in rows)

    whole = [r for r in ranges(table) if r[2] != "power_score"]
    lacking = table.drop("power_score")
    assert ranges(lacking) == whole
    LoadAnalytics(with_fatigue=False).fit(lacking)
    assert taper.taper_plan(taper.taper_features(table.drop("sprints_per_min"))).count() > 0
    limit(100)
    assert ranges(lacking) == whole


def test_one_decimal_is_that_of_the_binary_value(spark):
    rng = random.Random(1)
    values = [8.35, 8.25, 8.45, 0.05, 99.95, -8.35, 0.0, 1e6 + 0.05] + [round(rng.random() * 100, 2) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(one_decimal(F.col("v"))).collect()] == [f"{v:.1f}" for v in values]


def test_load_and_save_on_one_path(spark, tmp_path):
    path = str(tmp_path / "state")
    table = bindings.sessions(spark, SF)
    analytics = LoadAnalytics(with_fatigue=False).fit(table)
    keys = ["session_type string", "player string", "model_type string", "auc double"]
    analytics.fatigue.registry = spark.createDataFrame([("match", "P1", "RandomForest", 0.9)], ", ".join(keys))
    analytics.save(path)
    loaded = LoadAnalytics.load(spark, path)
    assert loaded.fatigue.registry.count() == 1
    before = loaded.tables["training_zones"].count()
    loaded.fatigue.registry = None
    loaded.save(path)
    again = LoadAnalytics.load(spark, path)
    assert again.tables["training_zones"].count() == before > 0
    assert again.fatigue.registry is None, "nothing of the earlier state survives"
    again.save(path)
    again.save(path)
    assert LoadAnalytics.load(spark, path).tables["taper"].count() == analytics.tables["taper"].count()
    assert len([p for p in (tmp_path / "state").iterdir() if p.is_dir()]) == 2


def test_empty_data_and_whole_reports(spark):
    table = bindings.sessions(spark, SF)
    analytics = LoadAnalytics(with_fatigue=False).fit(table)
    with pytest.raises(ValueError, match="no sessions"):
        analytics.predict(table.limit(0))
    rows = analytics.predict(table, as_of=F.lit("1998-07-01").cast("date"))
    assert set(analytics.dashboard(rows)) == {"player_status", "match_preparation", "taper_recommendations", "fatigue_risk"}
    assert analytics.dashboard(rows)["fatigue_risk"].count() == 0
    assert rows.filter("size(optimal_zones) > 0").count() > 0
    assert rows.filter("taper_strategy is not null and md is null").count() == 0


def test_unknown_status_zero_load_and_taper_without_model(spark):
    from taperline.plans import insights

    def row(**changed):
        base = {"player_load": 5.0, "daily_load_lo": 1.0, "daily_load_hi": 4.0, "session_type": "training", "has_training_zones": True, "has_match_zones": True}
        return base | changed

    rows = [row(), row(player_load=0.0), row(daily_load_lo=None, session_type="match", has_match_zones=False), row(daily_load_lo=None)]
    kinds = "player_load double, daily_load_lo double, daily_load_hi double, session_type string, has_training_zones boolean, has_match_zones boolean"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], kinds).withColumns(insights.load_status())
    found = [(r["load_status"], r["load_adjustment"]) for r in df.collect()]
    assert found == [("OVERLOADED", "Consider decreasing load by 20.0%"), ("UNDERLOADED", None), ("UNKNOWN", None), (None, None)]
    plan = spark.createDataFrame([("A", 1, 90.0, 80.0, 60.0, 9)], "player string, md int, load_percentage double, high_intensity double, recommended_duration double, sample_count long")
    near = spark.createDataFrame([("A", 1, None, 3.0, 4.0), ("A", 1, "RandomForest", 3.0, 4.0)], "player string, md int, model_type string, player_load double, mean_load double")
    said = insights.add_taper(Split(near), plan, needs_model=True).union().collect()
    assert [(r["model_type"], r["load_target"], r["taper_confidence"]) for r in sorted(said, key=lambda r: str(r["model_type"]))] == [(None, None, None), ("RandomForest", 90.0, 100)]


def test_auc_needs_all_folds_and_players_need_three_months(spark):
    rows = [("match", "A", "X", f, y, s) for f in range(3) for y, s in ((0, 0.1), (1, 0.9))]
    rows += [("match", "B", "X", 0, y, s) for y, s in ((0, 0.1), (1, 0.9))]
    kinds = "session_type string, player string, model_type string, fold int, performance_drop int, score double"
    aucs = {r["player"]: r["auc"] for r in fatigue.cross_validated_auc(spark.createDataFrame(rows, kinds)).collect()}
    assert aucs == {"A": 1.0, "B": 0.0}
    inputs = fatigue.FATIGUE_FEATURES["match"]
    data = [(p, "match", f"2024-{1 + i % m:02d}", i % 2, *[1.0] * len(inputs)) for p, m in (("A", 3), ("B", 2)) for i in range(24)]
    features = spark.createDataFrame(data, "player string, session_type string, month string, performance_drop int, " + ", ".join(f"{f} double" for f in inputs))
    assert [r["player"] for r in fatigue.trainable_players(features, "match").collect()] == ["A"]


def test_dates_in_three_formats(spark, tmp_path):
    head = "Player Name,Date,Tags,Player Load,Distance Per Min (m/min)\n"
    for name, text, how in (("a", "45292.75", "excel_serial"), ("b", "2024-01-01 18:00:00", "iso"), ("c", "01/01/2024 18:00", "dd/MM/yyyy HH:mm")):
        (tmp_path / f"{name}.csv").write_text(head + f"A,{text},gym,1,1\n")
        row = ingest.read_sessions(spark, str(tmp_path / f"{name}.csv"), date_format=how).first()
        assert str(row["session_ts"]) == "2024-01-01 18:00:00"


def test_scores_in_one_slice(spark):
    rows = [("g", i % 2, 0.5 + i / 1e9) for i in range(1000)]
    found = metrics.roc_auc(spark.createDataFrame(rows, "g string, label int, score double"), ["g"]).first()
    wins = sum(1.0 for _, y, s in rows if y for _, z, t in rows if not z and s > t)
    assert found["auc"] == pytest.approx(wins / 250_000)
    assert build_features is not None
