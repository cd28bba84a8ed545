"""Exact split, quarantine, pairs, merged scalers and ranks against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from helpers import make_sessions
from pyspark.sql import functions as F

from taperline.operators import fatigue, metrics
from taperline.operators.hotspots import MAX_GROUP_ROWS
from taperline.operators.pairs import session_match_pairs
from taperline.operators.running import PIECE, in_pieces
from taperline.plans import dashboard
from taperline.sources import bindings, ingest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def limit(spark):
    yield lambda rows: spark.conf.set(MAX_GROUP_ROWS, str(rows))
    spark.conf.unset(MAX_GROUP_ROWS)


@pytest.mark.parametrize("percent", [0, 1, 20, 33, 100])
def test_split_has_the_exact_size_under_any_layout(spark, percent):
    table = bindings.sessions(spark, SF).limit(1237).repartition(5).select("player", "session_date", "k1", "k2", "k3").cache()
    sides = []
    for layout in (table, table.repartition(13)):
        train, test = ingest.train_test_split(layout, percent)
        assert test.count() == math.ceil(1237 * percent / 100) and train.count() + test.count() == 1237
        sides.append(sorted(map(tuple, test.collect())))
    assert sides[0] == sides[1]


def test_split_of_equal_rows_and_of_none(spark):
    row = ("A", dt.date(2024, 1, 1), 1, 0, 0)
    kinds = "player string, session_date date, k1 long, k2 long, k3 long"
    same = spark.createDataFrame([row] * 11 + [("B", dt.date(2024, 1, 2), i, 0, 0) for i in range(4)], kinds)
    train, test = ingest.train_test_split(same, 40)
    assert (train.count(), test.count()) == (9, 6)
    train, test = ingest.train_test_split(same.limit(0))
    assert (train.count(), test.count()) == (0, 0)


def test_the_kth_smallest_is_found_in_narrow_cells(spark):
    rng = random.Random(1)
    values = [rng.randrange(1 << 60) for _ in range(500)] + [5] * 30 + [6, 7]
    keys = spark.createDataFrame([((v, i),) for i, v in enumerate(values)], "key struct<at: long, id: int>")
    ordered = sorted((v, i) for i, v in enumerate(values))
    for k in (1, 20, 31, 33, 300, len(values)):
        assert tuple(ingest.kth_smallest(keys, k, in_one_task=7)) == ordered[k - 1]
    assert ingest.kth_smallest(keys, len(values) + 1) is None


def test_rows_that_cannot_be_sessions_go_to_quarantine(spark, tmp_path):
    head = "Player Name,Date,Tags,Player Load,Distance Per Min (m/min)\n"
    (tmp_path / "a.csv").write_text(head + "Ann,45292,gym,1,2\nAnn,soon,gym,1,2\n,45292,gym,1,2\nBob,45293,match,bad,3\nBob,45293,match,1,2,3\nBob,45294\n")
    (tmp_path / "b.csv").write_text("Date,Player Name,Player Load,Tags,Distance Per Min (m/min),Extra\nnever,Cy,1,gym,2,x\n45295,Cy,1,gym,2,x\n")
    good, bad = ingest.read_with_quarantine(spark, str(tmp_path))
    assert sorted((r.player, str(r.session_date), r.player_load) for r in good.collect()) == [("Ann", "2024-01-01", 1.0), ("Bob", "2024-01-02", None), ("Cy", "2024-01-04", 1.0)]
    found = sorted((r.file.rsplit("/", 1)[1], r.reason) for r in bad.collect())
    assert found == [("a.csv", "no player"), ("a.csv", "no readable date"), ("a.csv", "wrong number of cells"), ("a.csv", "wrong number of cells"), ("b.csv", "no readable date")]
    assert {r.row for r in bad.filter("reason = 'wrong number of cells'").collect()} == {"Bob,45293,match,1,2,3", "Bob,45294"}
    with pytest.raises(ValueError, match="tags"):
        (tmp_path / "c.csv").write_text("Player Name,Date,Player Load,Distance Per Min (m/min)\nA,45292,1,1\n")
        ingest.read_with_quarantine(spark, str(tmp_path / "c.csv"))


@pytest.mark.parametrize("rows", [5, 10**9])
def test_pairs_equal_brute_force(spark, limit, rows):
    limit(rows)
    rng = random.Random(2)
    data = [{"player": rng.choice("AAAB"), "date": str(dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(40))), "tags": rng.choice(["gym", "match"]), "k1": i} for i in range(160)]
    table = make_sessions(spark, data).select("player", "session_date", "k1", "k2", "k3", "tags")
    training, matches = table.filter("tags = 'gym'").drop("tags"), table.filter("tags = 'match'").drop("tags")
    found = sorted((r.player, r.k1, r.match_k1, r.days_before) for r in session_match_pairs(training, matches).collect())
    want = []
    for s in data:
        for m in data:
            days = (dt.date.fromisoformat(m["date"]) - dt.date.fromisoformat(s["date"])).days
            if s["tags"] == "gym" and m["tags"] == "match" and s["player"] == m["player"] and 1 <= days <= 7:
                want.append((s["player"], s["k1"], m["k1"], days))
    assert want and found == sorted(want)


def test_merged_scalers_equal_those_of_all_sessions(spark):
    rng = np.random.default_rng(3)
    rows = [(p, "match", int(i), float(1e8 + rng.normal()), 2.0, None) for p in "AB" for i in rng.integers(0, 4, 50)] + [("C", "match", 3, 1.0, 2.0, None)]
    table = spark.createDataFrame(rows, "player string, session_type string, part int, x double, y double, z double")
    keyed = lambda df: fatigue.player_scalers(df, ("x", "y", "z")).withColumn("session_type", F.lit("match"))
    whole = {r.player: r for r in keyed(table).collect()}
    merged = fatigue.merged_scalers(*[keyed(table.filter(F.col("part") == p)) for p in range(4)])
    for r in merged.collect():
        for c in merged.columns:
            assert r[c] == (pytest.approx(whole[r.player][c], rel=1e-7) if isinstance(r[c], float) else whole[r.player][c])
    assert merged.count() == 3


def test_ranks_and_auc_of_scores_in_a_narrow_range(spark, limit):
    limit(100)
    scores = [50 + (i * 7919 % 1000) * 1e-9 for i in range(1000)] + [50.0] * 20
    risks = spark.createDataFrame([(f"P{i}", s) for i, s in enumerate(scores)], "player string, risk_score double")
    for r in dashboard.rank_by_risk(risks).collect():
        assert r.risk_rank == 1 + sum(s > r.risk_score for s in scores)
    sizes = [r["count"] for r in in_pieces(risks, ["risk_score"], 100).groupBy(PIECE).count().collect()]
    assert len(sizes) > 5 and max(sizes) <= 300
    table = spark.createDataFrame([(None, i % 3 == 0, s) for i, s in enumerate(scores)], "g string, label boolean, score double")
    found = metrics.roc_auc(table.withColumn("label", F.col("label").cast("int")), ["g"]).first()
    pos, neg = [s for i, s in enumerate(scores) if i % 3 == 0], [s for i, s in enumerate(scores) if i % 3]
    assert found["auc"] == pytest.approx(sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg))
