import pytest
from helpers import make_sessions
from pyspark.sql import functions as F

from taperline import LoadAnalytics, queries
from taperline.operators import metrics, taper, zones
from taperline.operators.fatigue import ModelSizes, large_candidates, month_group_folds, select_best_model
from taperline.plans import dashboard, insights
from taperline.plans.analytics import train_and_report
from taperline.schema import require_columns
from taperline.sources import bindings, ingest

SF = "/root/testdata/sf0.001"
SMALL = ModelSizes(trees=3, boosting_rounds=2, network_iterations=3)


def season(spark):
    """Five matches, two of them strong on load days before; training the day before each."""
    rows = []
    for i in range(6):
        rows.append({"date": f"2024-0{i + 1}-10", "tags": "gym", "player_load": 10.0 + i, "duration": 30.0 + i})
        rows.append({"date": f"2024-0{i + 1}-11", "tags": "match", "distance_per_min": 100.0, "power_score": float(i)})
    return make_sessions(spark, rows)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="tags"):
        require_columns(make_sessions(spark, [{"date": "2024-01-01"}]).drop("tags"))


def test_csv_export_in_any_column_order(spark, tmp_path):
    lines = ["Player Load,Tags,Date,Player Name,Distance Per Min (m/min),Extra", "7.5,Game,45292.75,Ann,NaN,x", "bad,,45293,Bob,3,y"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    rows = {r.player: r for r in ingest.read_sessions(spark, str(tmp_path)).collect()}
    assert str(rows["Ann"].session_ts) == "2024-01-01 18:00:00"
    assert rows["Ann"].distance_per_min is None and rows["Bob"].player_load is None
    assert rows["Bob"].position == "Unknown" and rows["Ann"].k1 != rows["Bob"].k1


def test_registered_classifiers_are_whole(spark):
    """The reference's trees, rounds, iterations and tolerance, and no smaller sizes for the registered queries."""
    assert queries.QUERY_SIZES == ModelSizes() == ModelSizes(100, 100, 3, 0.1, (50, 20), 1000, 1e-4)
    network = large_candidates(3, queries.QUERY_SIZES)["NeuralNetwork"]
    assert (network.getMaxIter(), network.getTol()) == (1000, 1e-4)


def test_split_does_not_depend_on_partitions(spark):
    table = bindings.sessions(spark, SF)
    a = ingest.train_test_split(table)[1].select("k1", "k2", "k3")
    b = ingest.train_test_split(table.repartition(13))[1].select("k1", "k2", "k3")
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_zones_follow_the_last_metric(spark):
    rows = zones.zone_ranges(zones.zone_features(season(spark)))
    by_metric = zones.training_zones_by_metric(rows).collect()
    assert {(r.metric, r.n) for r in by_metric} == {("distance_per_min", 6), ("sprints_per_min", 6)}
    (one,) = zones.training_zones(rows).collect()
    assert (one.md_key, one.metric, one.daily_load_lo, one.daily_load_hi) == ("MD-1", "sprints_per_min", 11.25, 13.75)
    assert {r.metric for r in zones.match_zones(rows).collect()} == {"distance_per_min", "sprints_per_min"}


def test_session_before_two_strong_matches_counts_twice(spark):
    rows = [{"date": f"2024-0{i}-20", "tags": "match"} for i in range(1, 5)]
    rows += [{"date": "2024-05-10", "duration": 30.0}, {"date": "2024-05-12", "tags": "match"}, {"date": "2024-05-14", "tags": "match"}]
    table = make_sessions(spark, rows)
    pre = zones.pre_match_sessions(zones.zone_features(table).union()).filter("metric = 'distance_per_min'").collect()
    assert [(str(r.session_date), r.copies) for r in pre] == [("2024-05-10", 2)]


def test_taper_needs_fifteen_sessions_and_two_samples(spark):
    assert taper.taper_plan(taper.taper_features(season(spark))).count() == 0
    more = [{"date": f"2023-01-{i:02d}", "tags": "gym", "player_load": 12.5} for i in range(1, 11)]
    (day,) = taper.taper_plan(taper.taper_features(season(spark).unionByName(make_sessions(spark, more)))).collect()
    assert (day.md, day.sample_count, day.load_percentage, day.recommended_duration) == (1, 6, pytest.approx(100), 32.5)


def test_load_status_with_as_of_and_without(spark):
    table = season(spark)
    analytics = LoadAnalytics(with_fatigue=False).fit(table)
    assert analytics.predict(table).first().load_status is None
    row = analytics.predict(table, as_of=F.lit("2024-06-10").cast("date")).first()
    assert (row.load_status, row.days_until_next_match) == ("OVERLOADED", 1)
    assert row.load_adjustment == "Consider decreasing load by 8.3%"
    every = analytics.predict(table, all_sessions=True).cache()
    assert {r.load_status for r in every.collect()} == {None, "UNDERLOADED", "OPTIMAL", "OVERLOADED"}
    boards = analytics.dashboard(every)
    assert boards["match_preparation"].count() == 6
    shares = {r.status: r.share for r in dashboard.readiness_summary(every).collect()}
    assert sum(shares.values()) == pytest.approx(100)


def test_unknown_players_get_an_error(spark):
    table = season(spark)
    asked = spark.createDataFrame([("A",), ("Z",)], "player string")
    rows = LoadAnalytics(with_fatigue=False).fit(table).predict(table, players=asked).collect()
    assert {r.player: r.error for r in rows} == {"A": None, "Z": "no sessions of player Z"}


def test_train_and_report_uses_the_held_out_part(spark):
    table = bindings.sessions(spark, SF)
    analytics, rows = train_and_report(table, LoadAnalytics(with_fatigue=False))
    assert analytics.is_trained and "target" in rows.columns
    held_out = ingest.train_test_split(table)[1].select("k1", "k2", "k3")
    assert rows.select("k1", "k2", "k3").join(held_out, ["k1", "k2", "k3"], "left_anti").isEmpty()


def test_untrained_and_missing_artefacts(spark, tmp_path):
    with pytest.raises(ValueError, match="fit"):
        LoadAnalytics().predict(season(spark))
    with pytest.raises(ValueError, match="fit"):
        LoadAnalytics().save(str(tmp_path / "x"))
    with pytest.raises(FileNotFoundError):
        LoadAnalytics.load(spark, str(tmp_path / "nothing"))


def test_auc_by_pairs_and_reversed(spark):
    rows = [(g, (i * 7 + g) % 2, ((i * 13 + g) % 10) / 10.0) for g in (1, 2) for i in range(40)] + [(3, 1, 0.5)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    got = {r.g: r.auc for r in metrics.roc_auc(df, ["g"]).collect()}
    back = {r.g: r.auc for r in metrics.roc_auc(df.withColumn("score", 1 - F.col("score")), ["g"]).collect()}
    for g in (1, 2):
        pos = [s for k, y, s in rows if k == g and y == 1]
        neg = [s for k, y, s in rows if k == g and y == 0]
        expected = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
        assert got[g] == pytest.approx(expected) and back[g] == pytest.approx(1 - expected)
    assert got[3] is None


def test_best_model_prefers_the_first_of_equals(spark):
    rows = [("a", "NeuralNetwork", 0.8), ("a", "RandomForest", 0.8), ("b", "RandomForest", 0.65)]
    df = spark.createDataFrame(rows, "player string, model_type string, auc double").withColumn("session_type", F.lit("match"))
    assert [(r.player, r.model_type) for r in select_best_model(df).collect()] == [("a", "RandomForest")]


def test_folds_keep_months_whole(spark):
    rows = [(m,) for m, n in (("01", 5), ("02", 4), ("03", 3), ("04", 3)) for _ in range(n)]
    assert month_group_folds(spark.createDataFrame(rows, "month string")) == {"01": 0, "02": 1, "03": 2, "04": 2}
    assert month_group_folds(spark.createDataFrame(rows[:9], "month string")) == {}


def test_key_factors(spark):
    row = spark.range(1).select(
        F.create_map(F.lit("acwr"), F.lit(0.5), F.lit("load_monotony"), F.lit(0.3), F.lit("high_impact_count"), F.lit(0.1),
                     F.lit("days_since_match"), F.lit(0.1)).alias("importances"),
        *[F.lit(2.0).alias(f) for f in insights.TRAINING_FEATURES],
    )
    got = [(f.feature, f.status) for f in row.select(insights.key_factors(F.col("importances"))).first()[0]]
    assert got == [("acwr", "HIGH"), ("load_monotony", "OPTIMAL"), ("high_impact_count", "NOTEWORTHY")]


def test_save_load_predict(spark, tmp_path):
    table = bindings.sessions(spark, SF)
    analytics = LoadAnalytics(SMALL).fit(table)
    first = analytics.fatigue.registry
    assert set(first.columns) >= {"session_type", "player", "model_type", "auc", "tn", "importances"}
    path = str(tmp_path / "saved")
    analytics.save(path)
    again = LoadAnalytics.load(spark, path)
    when = F.lit("1998-07-01").cast("date")
    a, b = (
        sorted(x.predict(table, as_of=when).select("player", "load_status", "load_target", "risk_score").collect())
        for x in (analytics, again)
    )
    assert a == b and len(a) == 10
    assert all(0 <= r.risk_score <= 100 for r in a if r.risk_score is not None)
    assert analytics.profile().count() >= 2
