"""Fits per player against brute force, separate fits, and the plans for oversized players."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from taperline import LoadAnalytics
from taperline.operators import fatigue, learners
from taperline.operators.fatigue import ModelSizes
from taperline.operators.hotspots import MAX_GROUP_ROWS, stored
from taperline.sources import bindings

SF = "/root/testdata/sf0.001"
SMALL = ModelSizes(trees=5, boosting_rounds=4, network_iterations=5)


def sample(n=90, features=4, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 1)  # with ties
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n)) > 0).astype(int)
    fold = rng.integers(0, 3, n)
    return x, y, np.stack([*[fold != f for f in range(3)], fold >= 0]), fold


def brute_tree(x, y, w, depth):
    """Nested (feature, threshold, below, above) or the leaf's mean; all cuts of all features are tried."""
    mean = (w * y).sum() / w.sum()
    spread = (w * (y - mean) ** 2).sum()
    best = None
    if spread > 1e-9 and depth != 0:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:]):
                left = x[:, f] <= low
                rest = sum((w[s] * (y[s] - (w[s] * y[s]).sum() / w[s].sum()) ** 2).sum() for s in (left, ~left))
                if best is None or rest < best[0] - 1e-9:
                    best = (rest, f, (low + high) / 2, left)
    if best is None:
        return mean
    _, f, at, left = best
    return (f, at, *(brute_tree(x[s], y[s], w[s], None if depth is None else depth - 1) for s in (left, ~left)))


def nested(trees, node):
    if trees.feature[node] < 0:
        return trees.value[node]
    left = trees.left[node]
    return (int(trees.feature[node]), trees.threshold[node], nested(trees, left), nested(trees, left + 1))


def flat(tree):
    return [v for part in tree for v in flat(part)] if isinstance(tree, tuple) else [tree]


@pytest.mark.parametrize("depth", [None, 3])
def test_trees_equal_brute_force(depth):
    x, y, _, _ = sample()
    rng = np.random.default_rng(2)
    weight = rng.integers(0, 3, (6, len(y)))
    target = np.stack([y.astype(float), rng.normal(size=len(y)), *[y.astype(float)] * 4])
    trees = learners.grow(x, target, weight, depth, x.shape[1])
    for t in range(6):
        used = weight[t] > 0
        want = brute_tree(x[used], target[t][used], weight[t][used].astype(float), depth)
        assert flat(nested(trees, t)) == pytest.approx(flat(want))


def test_boosting_follows_its_trees_one_part_at_a_time():
    x, y, parts, _ = sample()
    sizes = ModelSizes(boosting_rounds=7)
    together, _, _ = learners.gradient_boosting(x, y, parts, sizes, 42)
    for p, part in enumerate(parts):
        share = y[part].mean()
        raw = np.full(len(y), np.log(share / (1 - share)))
        for _ in range(sizes.boosting_rounds):
            chance = 1 / (1 + np.exp(-raw))
            tree = brute_tree(x[part], (y - chance)[part], np.ones(part.sum()), 3)

            def leaf(row, node=tree, path=()):
                return path if not isinstance(node, tuple) else leaf(row, node[2 if row[node[0]] <= node[1] else 3], (*path, row[node[0]] <= node[1]))

            at = [leaf(row) for row in x]
            for name in set(at):
                inside = np.array([a == name for a in at])
                own = inside & part
                raw[inside] += 0.1 * (y - chance)[own].sum() / (chance * (1 - chance))[own].sum()
        assert together[p] == pytest.approx(1 / (1 + np.exp(-raw)))


@pytest.mark.parametrize("features", [4, 12])
def test_a_level_of_trees_is_sorted_once_for_all_features(features, monkeypatch):
    x, y, parts, _ = sample(features=features)
    calls, real = [], np.argsort

    def counted(*args, **named):
        calls.append(args)
        return real(*args, **named)

    monkeypatch.setattr(np, "argsort", counted)
    learners.gradient_boosting(x, y, parts, ModelSizes(boosting_rounds=7), 42)
    assert 7 <= len(calls) <= 7 * 3


@pytest.mark.parametrize(("nodes", "ranks"), [(20, 100), (3_000, 1_000), (70_000, 50), (3, 70_000)])
def test_entries_are_sorted_by_node_and_rank(nodes, ranks):
    rng = np.random.default_rng(5)
    node, rank = rng.integers(0, nodes, 2_000), rng.integers(0, ranks, (3, 2_000))
    node[0], rank[0, 0] = nodes - 1, ranks - 1
    found = learners.sorted_entries(node, rank)
    assert (found == np.stack([np.lexsort((r, node)) for r in rank])).all()


def test_features_looked_at_in_turn_give_the_same_trees(monkeypatch):
    x, y, parts, _ = sample(n=200, features=10)
    for kind in ("RandomForest", "GradientBoosting"):
        monkeypatch.setattr(learners, "CELLS", 500_000)
        together, _, shares = learners.LEARNERS[kind](x, y, parts, SMALL, 42)
        monkeypatch.setattr(learners, "CELLS", 1)
        in_turn, _, again = learners.LEARNERS[kind](x, y, parts, SMALL, 42)
        assert (together == in_turn).all() and (shares == again).all()


def test_network_equals_plain_steps():
    """Parts of unlike sizes, some with a batch more than others, against one part at a time in plain steps."""
    x, y, _, _ = sample(n=450)
    parts = np.stack([np.arange(450) < 390, np.arange(450) >= 250, np.arange(450) >= 0])
    sizes = ModelSizes(hidden=(6, 3), network_iterations=4)
    scores, _, _ = learners.neural_network(x, y, parts, sizes, 42)
    widths = [x.shape[1], 6, 3, 1]
    for p, part in enumerate(parts):
        rng, own, w = np.random.default_rng([42, p]), np.flatnonzero(part), []
        for a, b in zip(widths, widths[1:]):
            bound = np.sqrt((2.0 if b == 1 else 6.0) / (a + b))
            drawn = rng.uniform(-bound, bound, a * b + b)
            w += [drawn[: a * b].reshape(a, b), drawn[a * b :]]
        first, second, t = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
        for _ in range(sizes.network_iterations):
            order = rng.permutation(own)
            for at in (order[i : i + 200] for i in range(0, len(order), 200)):
                h1 = np.maximum(x[at] @ w[0] + w[1], 0)
                h2 = np.maximum(h1 @ w[2] + w[3], 0)
                d3 = 1 / (1 + np.exp(-(h2 @ w[4] + w[5]))) - y[at][:, None]
                d2 = d3 @ w[4].T * (h2 > 0)
                d1 = d2 @ w[2].T * (h1 > 0)
                slopes = [x[at].T @ d1, d1.sum(axis=0), h1.T @ d2, d2.sum(axis=0), h2.T @ d3, d3.sum(axis=0)]
                t += 1
                for i, g in enumerate(slopes):
                    g = (g + (1e-4 * w[i] if i % 2 == 0 else 0)) / len(at)
                    first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
                    w[i] = w[i] - 1e-3 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * first[i] / (np.sqrt(second[i]) + 1e-8)
        plain = np.maximum(np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3], 0) @ w[4] + w[5]
        assert scores[p] == pytest.approx(1 / (1 + np.exp(-plain[:, 0])), abs=1e-4)


@pytest.mark.parametrize("kind", learners.LEARNERS)
def test_joint_fits_equal_separate_ones(kind):
    x, y, parts, fold = sample(n=450)
    sizes = ModelSizes(trees=10, boosting_rounds=10, network_iterations=30)
    scores, model, importances = learners.LEARNERS[kind](x, y, parts, sizes, 42)
    assert learners.probabilities(kind, learners.packed(model), x) == pytest.approx(scores[-1])
    assert importances is None or importances.sum() == pytest.approx(1)
    for f in range(3):
        # The same part alone, in its place so that it draws the same numbers.
        alone = np.stack([parts[f]] * (f + 1))
        again = learners.LEARNERS[kind](x, y, alone, sizes, 42)[0][f]
        assert auc(again[fold == f], y[fold == f]) == pytest.approx(auc(scores[f][fold == f], y[fold == f]), abs=1e-6)


def auc(score, y):
    pairs = score[y == 1][:, None] - score[y == 0][None, :]
    return ((pairs > 0) + (pairs == 0) / 2).mean()


def test_learners_find_a_signal():
    x, y, parts, fold = sample(n=600, seed=4)
    for kind, learner in learners.LEARNERS.items():
        scores = learner(x, y, parts, ModelSizes(), 42)[0]
        held = [auc(scores[f][fold == f], y[fold == f]) for f in range(3)]
        assert min(held) > 0.7, (kind, held)


@pytest.fixture
def settings(spark):
    def use(**values):
        for name, value in values.items():
            spark.conf.set(name, value)

    yield lambda values: use(**values)
    for name in (MAX_GROUP_ROWS, fatigue.MAX_FIT_ROWS):
        spark.conf.unset(name)


def trained(spark, gate, monkeypatch):
    monkeypatch.setattr(fatigue, "MIN_AUC", gate)
    features = fatigue.fatigue_features(bindings.sessions(spark, SF)).each(stored)
    return features, fatigue.train_fatigue(features, SMALL)


def risks(scored):
    return {(r["session_type"], r["player"], r["session_date"], r["k1"], r["k2"], r["k3"]): r["risk"] for r in scored.collect()}


def test_every_player_has_its_own_models(spark, monkeypatch, settings):
    features, found = trained(spark, 0.0, monkeypatch)
    importances = [tuple(sorted(r["importances"].items())) for r in found.registry.filter("importances is not null").collect()]
    assert len(importances) > 3 and len(set(importances)) == len(importances)
    held = found.held_out.groupBy("session_type", "model_type").agg(F.count_distinct("player").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    assert len(held) == 6 and len({(r["session_type"], r["n"]) for r in held}) == 2
    months = found.held_out.groupBy("player", "session_type", F.date_format("session_date", "yyyy-MM").alias("m")).agg(F.count_distinct("fold").alias("n"))
    assert months.filter("n <> 1").count() == 0
    plain = risks(fatigue.score_sessions(features, found))
    assert plain
    # Sessions of oversized players are scored in several tasks.
    settings({MAX_GROUP_ROWS: "300"})
    heavy = fatigue.fatigue_features(bindings.sessions(spark, SF)).each(stored)
    assert heavy.heavy is not None
    assert risks(fatigue.score_sessions(heavy, found)) == pytest.approx(plain)


def test_oversized_fits_use_spark_and_survive_a_save(spark, monkeypatch, settings, tmp_path):
    rows = fatigue.fatigue_features(bindings.sessions(spark, SF)).union()
    sizes = sorted(r["n_clean"] for r in fatigue.trainable_players(rows, "training").collect())
    settings({fatigue.MAX_FIT_ROWS: str(sizes[-2] - 1)})
    features, found = trained(spark, 0.0, monkeypatch)
    players = {key[:2] for key in found.large}
    assert 0 < len(players) < 10 and len(found.large) == 3 * len(players)
    n = found.held_out.count()
    assert found.held_out.select("session_type", "player", "session_date", "k1", "k2", "k3", "model_type").distinct().count() == n
    scored = fatigue.score_sessions(features, found)
    assert scored.filter("risk is null or risk < 0 or risk > 1").count() == 0
    chosen = found.registry.select("session_type", "player", "model_type")
    assert scored.select(*chosen.columns).distinct().count() == chosen.count()
    analytics = LoadAnalytics(with_fatigue=False).fit(bindings.sessions(spark, SF))
    analytics.fatigue = found
    analytics.save(str(tmp_path / "saved"))
    again = LoadAnalytics.load(spark, str(tmp_path / "saved")).fatigue
    assert risks(scored) == pytest.approx(risks(fatigue.score_sessions(features, again)))


def test_nothing_to_learn_from(spark):
    features = fatigue.fatigue_features(bindings.sessions(spark, SF).limit(0))
    found = fatigue.train_fatigue(features, SMALL)
    assert found.registry is None and found.models is None
