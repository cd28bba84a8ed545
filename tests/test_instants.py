"""Players with many instants in a few days."""

import numpy as np
import pytest
from helpers import make_sessions
from pyspark.sql import functions as F
from test_heavy import dense, same

from taperline.operators import features
from taperline.operators.features import build_features, split_features

GROUPS = ["training_load", "match_days", "speed"]


def test_frames_of_days_over_instants_are_not_read_again_for_each_row(spark, monkeypatch):
    table = dense(spark, 700, ("A",)).unionByName(dense(spark, 40, ("B",)))
    plain = build_features(table, GROUPS, grain="timestamp").drop("t")
    assert split_features(table, GROUPS, grain="timestamp").heavy is None
    monkeypatch.setattr(features, "INSTANT_ROWS", 600)
    rows = split_features(table, GROUPS, grain="timestamp")
    assert [r["player"] for r in rows.players.collect()] == ["A"]
    same(plain, build_features(table, GROUPS, grain="timestamp").drop("t"))


def test_a_player_with_rows_without_a_time_keeps_them(spark, monkeypatch):
    table = dense(spark, 300, ("A",))
    table = table.withColumn("session_ts", F.when(F.col("k1") % 50 > 0, F.col("session_ts")))
    plain = build_features(table, GROUPS, grain="timestamp").drop("t", "session_ts")
    monkeypatch.setattr(features, "INSTANT_ROWS", 100)
    found = build_features(table, GROUPS, grain="timestamp").drop("t", "session_ts")
    assert found.count() == 300
    same(plain, found)


def test_one_dense_player_against_brute_force(spark):
    """More instants than the limit: loads of 7 and 28 days, counted row by row here."""
    rng = np.random.default_rng(3)
    n = features.INSTANT_ROWS + 500
    minutes, loads = rng.integers(0, 29 * 1440, n), rng.integers(0, 9, n)
    minutes.sort()
    stamp = lambda m: f"2024-03-{1 + m // 1440:02d} {m % 1440 // 60:02d}:{m % 60:02d}"
    rows = [{"date": stamp(int(m)), "k1": i, "player_load": float(v)} for i, (m, v) in enumerate(zip(minutes, loads))]
    split = split_features(make_sessions(spark, rows), ["training_load"], grain="timestamp")
    assert split.heavy is not None
    found = split.union().orderBy("k1").toPandas()
    upto = np.cumsum(loads)
    for name, days in (("acute", 7), ("chronic", 28)):
        first = np.searchsorted(minutes, minutes - days * 1440, side="right")
        want = upto - np.where(first > 0, upto[first - 1], 0)
        assert found[f"training_{name}_load"].to_numpy() == pytest.approx(want)
