"""The plan for oversized players gives the same rows as the ordinary one."""

import re

import numpy as np
import pytest
from helpers import make_sessions
from pyspark.sql import functions as F

from taperline.operators import fatigue, taper, zones
from taperline.operators.features import GROUPS, build_features, split_features
from taperline.operators.hotspots import MAX_GROUP_ROWS, Split
from taperline.operators.quantiles import grouped_quantiles
from taperline.operators.running import PIECE, in_pieces, over_range, running
from taperline.sources import bindings

SF = "/root/testdata/sf0.001"


@pytest.fixture
def limit(spark):
    def use(rows: int):
        spark.conf.set(MAX_GROUP_ROWS, str(rows))

    yield use
    spark.conf.unset(MAX_GROUP_ROWS)


def same(a, b):
    a, b = (df.toPandas() for df in (a, b))
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    keys = [c for c in ("player", "session_date", "k1", "k2", "k3", "md", "metric", "session_type") if c in columns]
    a, b = (p[columns].sort_values(keys).reset_index(drop=True) for p in (a, b))
    assert len(a) == len(b) > 0
    for c in columns:
        if a[c].dtype.kind == "f" or b[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), atol=1e-9, err_msg=c)
        else:
            assert a[c].astype(str).tolist() == b[c].astype(str).tolist(), c


def test_features(spark, limit):
    table = bindings.sessions(spark, SF)
    everything = [*GROUPS, "good_matches", "taper_matches", "target"]
    limit(10**9)
    plain = build_features(table, everything)
    limit(600)
    assert split_features(table, []).heavy is not None
    same(plain, build_features(table, everything))


def test_features_of_one_crowded_date_with_gaps(spark, limit):
    """Half of a player's rows on one date, missing loads, and matches among them."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        day = 15 if i % 2 else int(rng.integers(1, 29))
        load = None if rng.random() < 0.2 else float(rng.integers(1, 9))
        tags = "match" if rng.random() < 0.3 else "gym"
        rows.append({"date": f"2024-0{rng.integers(1, 3)}-{day:02d}", "player_load": load, "tags": tags, "k1": int(i * 7919 % 1009)})
    table = make_sessions(spark, rows)
    everything = [*GROUPS, "target"]
    limit(10**9)
    plain = build_features(table, everything)
    limit(40)
    same(plain, build_features(table, everything))


def test_zones_and_tapers(spark, limit):
    table = bindings.sessions(spark, SF)

    def made():
        rows, plan = zones.zone_ranges(zones.zone_features(table)), taper.taper_features(table)
        return [zones.training_zones(rows), zones.match_zones(rows), taper.taper_plan(plan)]

    limit(10**9)
    plain = made()
    limit(600)
    for a, b in zip(plain, made()):
        same(a, b)


def test_quantiles_of_uneven_values(spark):
    """Far-off values, repeats and weights, against numpy."""
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=500), rng.integers(0, 5, 300), [1e12, -1e15, 3e300]])
    copies = rng.integers(0, 4, len(values))
    df = spark.createDataFrame(
        [("g", float(v), int(w)) for v, w in zip(values, copies)] + [("g", None, 2)], "g string, v double, w int"
    )
    wanted = {f"q{int(p * 100)}": ("v", p) for p in (0.0, 0.25, 0.5, 0.67, 0.75, 1.0)}
    empty = df.filter("false")
    heavy = grouped_quantiles(Split(empty, df), ["g"], wanted, weight="w", extra={"n": F.sum("w")}).first()
    plain = grouped_quantiles(Split(df), ["g"], wanted, weight="w", extra={"n": F.sum("w")}).first()
    expected = np.repeat(values, copies)
    for name, (_, p) in wanted.items():
        assert heavy[name] == pytest.approx(np.quantile(expected, p), rel=1e-12)
        assert heavy[name] == pytest.approx(plain[name], rel=1e-12)
    assert heavy.n == plain.n


def test_standardized_features(spark, limit):
    table = bindings.sessions(spark, SF)
    inputs = fatigue.FATIGUE_FEATURES["match"]

    def made():
        clean = fatigue.fatigue_features(table).each(lambda df: fatigue.drop_null_features(df, "match"))
        return fatigue.standardize(clean, fatigue.player_scalers(clean.union(), inputs), inputs).union()

    limit(10**9)
    plain = made()
    limit(600)
    same(plain, made())


def dense(spark, n=900, players=("A", "B")):
    """Two players with many sessions a day, at uneven instants, some of them shared."""
    rng = np.random.default_rng(11)
    rows = []
    for player in players:
        for i in range(n):
            day, second = int(rng.integers(1, 12)), int(rng.integers(0, 30)) ** 2
            stamp = f"2024-03-{day:02d} {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"
            rows.append({
                "player": player, "date": stamp, "tags": "match" if rng.random() < 0.1 else "gym", "k1": i,
                "player_load": None if rng.random() < 0.2 else float(rng.integers(1, 9)), "top_speed": float(rng.integers(20, 60)) / 4,
                "distance_per_min": float(rng.integers(50, 90)), "power_score": float(rng.integers(0, 9)),
            })
    return make_sessions(spark, rows)


def test_instants_of_a_dense_player(spark, limit):
    table = dense(spark)
    everything = [*GROUPS, "good_matches", "taper_matches", "target"]
    limit(10**9)
    plain = build_features(table, everything, grain="timestamp").drop("t")
    limit(50)
    assert split_features(table, [], grain="timestamp").heavy is not None
    same(plain, build_features(table, everything, grain="timestamp").drop("t"))


def test_running_aggregates_and_frames_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    times = {g: np.unique(rng.integers(-300, 300, 150)) for g in "ab"}
    rows = [(g, int(t), None if rng.random() < 0.3 else float(rng.integers(0, 50))) for g in "ab" for t in times[g]]
    df = spark.createDataFrame(rows, "g string, t long, v double")
    kinds = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "n": ("min", F.col("v")), "l": ("last", F.col("v"))}
    pieces = in_pieces(df, ["g", "t"], 20)
    sizes = [r["count"] for r in pieces.groupBy(PIECE).count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 60

    def told(values, last):
        values = [v for v in values if v is not None]
        return (sum(values), max(values), min(values), values[last]) if values else (None,) * 4

    for backwards in (False, True):
        for own in (False, True):
            found = {(r.g, r.t): (r.s, r.m, r.n, r.l) for r in running(pieces, ["g"], ["t"], kinds, backwards, own).collect()}
            for g, t, _ in rows:
                sign = -1 if backwards else 1
                near = [v for h, u, v in rows if h == g and (sign * u < sign * t or own and u == t)]
                assert found[g, t] == told(near, 0 if backwards else -1), (g, t, backwards, own)
    extremes = {k: v for k, v in kinds.items() if k != "l"}
    for low, high in ((-40, 0), (-7, -1), (1, 30), (5, 5), (-500, 500)):
        found = {(r.g, r.t): (r.s, r.m, r.n) for r in over_range(df, "g", "t", low, high, extremes, 20).collect()}
        for g, t, _ in rows:
            assert found[g, t] == told([v for h, u, v in rows if h == g and t + low <= u <= t + high], 0)[:3], (g, t, low, high)


def test_no_window_holds_an_oversized_player_of_instants(spark, limit):
    """What is left after the stored totals of pieces runs inside of pieces."""
    limit(50)
    heavy = split_features(dense(spark), ["training_load", "match_days", "speed"], grain="timestamp").heavy
    windows = re.findall(r"windowspecdefinition\(([^)]*?) (?:ASC|DESC)", heavy._jdf.queryExecution().optimizedPlan().toString())
    assert windows and all("_piece" in w for w in windows), windows
