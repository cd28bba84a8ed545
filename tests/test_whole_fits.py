"""Fits that do the same whatever the number of rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_classifiers import SMALL, sample

from taperline.operators import fatigue, learners
from taperline.operators.fatigue import ModelSizes
from taperline.operators.hotspots import Split, stored
from taperline.schema import TRAINING_FEATURES


def player_table(spark, n):
    """One player's training sessions over six months."""
    number = F.col("id")
    noise = [(F.abs(F.xxhash64(number, F.lit(i))) % 1000 / 1000.0).alias(f) for i, f in enumerate(TRAINING_FEATURES)]
    rows = spark.range(n).select(
        F.lit("A").alias("player"), F.date_add(F.lit("2024-01-01").cast("date"), (number % 180).cast("int")).alias("session_date"),
        number.alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("k3"), F.lit("training").alias("session_type"), *noise,
    )
    drop = (F.col(TRAINING_FEATURES[0]) + F.col(TRAINING_FEATURES[1]) > 1).cast("int")
    return rows.withColumns({"month": F.date_format("session_date", "yyyy-MM"), "performance_drop": drop})


def test_a_player_of_any_size_is_fitted_by_the_same_learners(spark):
    sizes = ModelSizes(trees=2, boosting_rounds=2, network_iterations=2)
    n = 20_100
    found = fatigue.train_fatigue(Split(stored(player_table(spark, n))), sizes)
    assert not found.large
    seen = found.held_out.orderBy("session_date", "k1").toPandas()
    assert len(seen) == 3 * n
    # Against the learners themselves.
    rows, _ = fatigue._training_table(Split(player_table(spark, n)), "training")
    rows = rows.orderBy("session_date", "k1").toPandas()
    x, y = np.array(rows["features"].tolist()), rows["performance_drop"].to_numpy()
    for kind, learner in learners.LEARNERS.items():
        own = seen[seen["model_type"] == kind]
        fold = own["fold"].to_numpy()
        parts = np.stack([*[fold != f for f in range(3)], fold >= 0])
        scores = learner(x, y, parts, sizes, fatigue.SEED)[0][fold, np.arange(n)]
        # Scalers add up in any order, so a value on a cut may fall to either side.
        assert (np.abs(own["score"].to_numpy() - scores) < 1e-4).mean() > 0.999


def test_trees_searched_in_blocks_and_sessions_scored_in_pieces_are_the_same(monkeypatch):
    x, y, parts, _ = sample(n=200, features=10)
    whole = {kind: learner(x, y, parts, SMALL, 42) for kind, learner in learners.LEARNERS.items()}
    monkeypatch.setattr(learners, "BLOCK", 1)
    monkeypatch.setattr(learners, "SCORED", 30)
    for kind, learner in learners.LEARNERS.items():
        scores, model, shares = learner(x, y, parts, SMALL, 42)
        assert scores == pytest.approx(whole[kind][0], abs=1e-9)
        assert shares is None or shares == pytest.approx(whole[kind][2])
        packed = learners.packed(model)
        assert learners.probabilities(kind, packed, x) == pytest.approx(scores[-1], abs=1e-9)


def test_only_chosen_kinds_learn_from_all_months_and_say_the_same(spark, monkeypatch):
    features = Split(stored(player_table(spark, 400)))
    sizes = ModelSizes(trees=10, boosting_rounds=10, network_iterations=20)
    found = {every: fatigue.train_fatigue(features, sizes, refit_all=every) for every in (False, True)}
    held = [found[every].held_out.orderBy("model_type", "session_date", "k1") for every in (False, True)]
    columns = ["model_type", "session_date", "k1", "fold", "performance_drop", "score", "said"]
    assert held[0].select(*columns).collect() == held[1].select(*columns).collect()
    assert held[1].filter("refit_said is null").count() == 0
    chosen, other = (found[every].registry.collect() for every in (False, True))
    assert len(chosen) == 1
    for name in ("model_type", "tn", "fp", "fn", "tp", "held_out_tp"):
        assert chosen[0][name] == other[0][name]
    assert (chosen[0]["importances"] or {}) == pytest.approx(other[0]["importances"] or {})
    scores = [{r["k1"]: r["risk"] for r in fatigue.score_sessions(features, found[every]).collect()} for every in (False, True)]
    assert scores[0] == pytest.approx(scores[1]) and len(scores[0]) == 400
    # Of three kinds with three folds each, one is fitted once more.
    fits = []
    real = fatigue.learners.random_forest
    monkeypatch.setitem(learners.LEARNERS, "RandomForest", lambda x, y, parts, *rest: fits.append(len(parts)) or real(x, y, parts, *rest))
    rows, _ = fatigue._training_table(features, "training")
    group = rows.withColumn("model_type", F.lit("RandomForest")).toArrow()
    for which in (fatigue.HELD_OUT, fatigue.WHOLE, fatigue.BOTH):
        fatigue.fit_group(sizes, which)(group)
    assert fits == [3, 1, 4]
