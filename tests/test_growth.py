"""Plans whose tasks, broadcasts and rounds do not grow with the table or with a low limit."""

import re

import numpy as np
import pytest
from helpers import make_sessions
from pyspark.sql import functions as F

from taperline import queries
from taperline.operators import hotspots, quantiles
from taperline.operators.features import split_features
from taperline.operators.hotspots import MAX_GROUP_ROWS, salted_join, split_players, stored
from taperline.operators.running import PIECES, in_pieces


@pytest.fixture
def limit(spark):
    def use(rows: int):
        spark.conf.set(MAX_GROUP_ROWS, str(rows))

    yield use
    spark.conf.unset(MAX_GROUP_ROWS)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_a_low_limit_does_not_make_thousands_of_pieces(spark):
    assert in_pieces(spark.range(100_000), ["id"], 20).agg(F.max("_piece")).first()[0] < PIECES


def test_a_rollup_is_joined_without_broadcast_and_copied_only_where_crowded(spark, limit):
    limit(5)
    table = spark.range(60).select(
        F.lit("A").alias("player"), F.when(F.col("id") < 20, 0).otherwise(F.col("id")).alias("t"),
        F.col("id").alias("k1"), F.lit(0).alias("k2"), F.lit(0).alias("k3"),
    )
    for rows in (table, table.filter("t > 0")):
        rollup = stored(rows.groupBy("player", "t").agg(F.count(F.lit(1)).alias("_rows"), F.sum("k1").alias("s")))
        found = salted_join(rows, rollup, ["player", "t"])
        assert "SortMergeJoin" in plan(found)
        assert {(r.k1, r.s) for r in found.collect()} == {(i, 190 if i < 20 else i) for i in range(60) if i >= 20 or rows is table}
    assert "BroadcastHashJoin" not in plan(found) and "Generate" not in plan(found)


def test_groups_of_few_values_are_not_cut(spark, limit, monkeypatch):
    rounds = []
    cut = quantiles._cells_of_ranks
    monkeypatch.setattr(quantiles, "_cells_of_ranks", lambda *a: rounds.append(a) or cut(*a))
    limit(10)
    for n, least in ((500, 0), (2 * quantiles.CELLS, 1)):
        values = np.random.default_rng(n).normal(size=n)
        df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
        found = quantiles.select_by_rank(df, ["g"], {"q": ("v", 0.67)}, F.lit(1)).first()
        assert found.q == pytest.approx(np.quantile(values, 0.67), rel=1e-12)
        assert len(rounds) >= least and (least or not rounds)


def sessions(spark, n=40):
    return make_sessions(spark, [{"player": f"P{i % 8}", "date": f"2024-01-{1 + i // 8:02d}"} for i in range(n)])


def test_tasks_of_regular_players_are_as_many_as_the_rows_ask_for(spark, monkeypatch):
    monkeypatch.setattr(hotspots, "TASK_ROWS", 1)
    rows = split_players(sessions(spark).withColumn("t", F.lit(1)))
    assert re.search(r"RepartitionByExpression \[player#\d+\], 40", plan(rows.regular))


def test_windows_on_dates_share_the_exchange_by_player(spark):
    """The first window of these groups is by player and date."""
    text = split_features(sessions(spark), ["training_load", "good_matches"]).regular._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((\w+)#\d+, (?:\w+#\d+, )?\d+\)", text) == ["player"]


def test_heavy_players_without_features_by_date_skip_the_rollup(spark, limit):
    limit(2)
    heavy = split_features(sessions(spark).withColumn("session_date", F.when(F.col("k1") > 0, F.col("session_date"))), []).heavy
    assert "Generate" not in plan(heavy) and heavy.count() == 39


def test_folds_read_stored_features(spark):
    assert "Window" not in plan(queries.month_group_folds(spark, "/root/testdata/sf0.001"))
