import numpy as np
import pandas as pd
import pytest
from helpers import column, make_sessions
from pyspark.sql import functions as F

from taperline.functions import expressions as E
from taperline.operators.features import GROUPS, build_features, by_session_type, latest_features, latest_session, performance_target
from taperline.sources import bindings

SF = "/root/testdata/sf0.001"
# What both the view and hand-made sessions have.
SESSION_COLUMNS = ["player", "session_date", "k1", "k2", "k3", "tags", "position", "player_load", "distance_per_min", "duration", "top_speed", "dist_speed_z4", "dist_speed_z5", "accel_3_4", "accel_gt4", "decel_3_4", "decel_gt4", "impact_10_15", "impact_15_20", "impact_gt20", *[f"dist_power_{z}" for z in ("25_30", "30_35", "35_40", "40_45", "45_50", "gt50")]]


def test_rolling_load_stops_at_the_row_on_shared_dates(spark):
    dates = ["2024-01-01", "2024-01-03", "2024-01-03", "2024-01-08", "2024-01-10"]
    rows = make_sessions(spark, [{"date": d, "player_load": float(10**i)} for i, d in enumerate(dates)])
    assert column(build_features(rows, ["training_load"]), "training_acute_load") == [1, 11, 111, 1110, 11000]


def test_missing_loads_count_only_once_one_is_present(spark):
    rows = [{"date": "2024-01-01", "player_load": None}, {"date": "2024-01-02", "player_load": 3.0}]
    got = build_features(make_sessions(spark, rows), ["training_load", "row_load"], min_sessions=0)
    assert column(got, "training_acute_load") == [None, 3]
    assert column(got, "acute_load") == [None, 3]


def test_ratios_and_spread_without_a_basis(spark):
    got = build_features(
        make_sessions(spark, [{"date": f"2024-01-0{i}", "player_load": 0.0} for i in (1, 2)]), ["row_load"], min_sessions=0
    )
    assert column(got, "acwr") == [1, 1]
    assert column(got, "load_monotony") == [0, 0]


def test_training_ratio_before_and_without_training(spark):
    match = {"tags": "Game"}
    rows = [
        {"player": "A", "date": "2024-01-01"} | match,
        {"player": "A", "date": "2024-01-02"},
        {"player": "B", "date": "2024-01-01"} | match,
    ]
    got = build_features(make_sessions(spark, rows), ["training_load"], min_sessions=0)
    assert column(got, "training_acwr") == [1, 1, None]


def test_match_loads_carry_the_last_training(spark):
    rows = [
        {"date": "2024-01-01", "player_load": 5.0},
        {"date": "2024-01-02", "player_load": 9.0, "tags": "cup match"},
        {"date": "2024-02-20", "player_load": 9.0, "tags": "cup match"},
    ]
    got = build_features(make_sessions(spark, rows), ["training_load"], min_sessions=0)
    assert column(got, "training_acute_load") == [5, 5, 5]


def test_session_types(spark):
    tags = ["Rematch", "GAME day", None, "gym", "Fixture", "competition x"]
    df = spark.createDataFrame([(t,) for t in tags], "tags string")
    got = [r[0] for r in df.select(E.session_type(F.col("tags"))).collect()]
    assert got == ["match", "match", "training", "training", "match", "match"]


def test_excel_serials(spark):
    df = spark.createDataFrame([(45292.0,), (45292.75,)], "v double").select(
        E.excel_serial_to_ts(F.col("v")).cast("string").alias("ts")
    )
    assert [r.ts for r in df.collect()] == ["2024-01-01 00:00:00", "2024-01-01 18:00:00"]


def test_power_bands_skip_missing_but_the_top_band_does_not(spark):
    rows = make_sessions(
        spark, [{"date": "2024-01-01", "dist_power_25_30": None}, {"date": "2024-01-02", "dist_power_gt50": None}]
    )
    assert column(E.high_intensity(rows), "high_power_distance") == [5, None]


def test_last_session_and_missing_decline_are_labelled_zero(spark):
    speeds = [10.0, 9.0, 10.0]
    rows = [{"date": f"2024-01-0{i + 1}", "top_speed": v} for i, v in enumerate(speeds)]
    got = build_features(make_sessions(spark, rows), ["label"], min_sessions=0)
    assert column(got, "speed_decline") == [None, pytest.approx(-0.1), 0]
    assert column(got, "performance_drop") == [1, 0, 0]


def test_no_speed_at_all_is_no_decline(spark):
    rows = [{"date": f"2024-01-0{i}", "top_speed": None} for i in (1, 2)]
    got = build_features(make_sessions(spark, rows), ["speed"], min_sessions=0)
    assert column(got, "speed_decline") == [None, 0]
    wide = by_session_type(got, ["speed_decline"])
    assert column(wide, "match_speed_decline") == [None, None]


def test_short_histories_are_dropped(spark):
    rows = [{"player": "A", "date": f"2024-01-0{i}"} for i in range(1, 5)]
    rows += [{"player": "B", "date": f"2024-01-0{i}"} for i in range(1, 6)] + [{"player": None, "date": "2024-01-01"}] * 6
    schema_rows = make_sessions(spark, [r for r in rows if r["player"]])
    assert {r.player for r in build_features(schema_rows, []).collect()} == {"B"}


def test_target_uses_the_players_own_mean(spark):
    rows = [{"player": "A", "date": f"2024-01-0{i}", "distance_per_min": float(v)} for i, v in ((1, 1), (2, 2), (3, 3))]
    rows += [{"player": "B", "date": "2024-01-01", "distance_per_min": 10.0}]
    rows += [{"player": "B", "date": "2024-01-02", "distance_per_min": 20.0}]
    table = make_sessions(spark, rows)
    assert column(build_features(table, ["target"], min_sessions=0), "rolling_avg") == [1, 1.5, 2, 10, 15]
    assert column(performance_target(table), "target") == [0, 0, 0, 0, 0]


def test_days_are_floored_with_a_time_of_day(spark):
    rows = [
        {"date": "2024-01-01 12:00:00"},
        {"date": "2024-01-02 06:00:00", "tags": "match"},
        {"date": "2024-01-03 07:00:00"},
    ]
    got = build_features(make_sessions(spark, rows), ["match_days"], grain="timestamp", min_sessions=0)
    assert column(got, "days_until_match") == [0, None, None]
    assert column(got, "days_since_match") == [None, None, 1]


def test_latest_session_never_sees_a_later_match(spark):
    last = latest_session(build_features(bindings.sessions(spark, SF), ["match_days"]))
    assert last.filter("days_until_match is not null").count() == 0


def test_loads_agree_with_pandas(spark):
    got = build_features(bindings.sessions(spark, SF), ["training_load", "row_load"]).toPandas()
    got = got.sort_values(["player", "session_date", "k1", "k2", "k3"])
    for _, one in got.groupby("player"):
        load = one.player_load
        np.testing.assert_allclose(one.acute_load, load.rolling(7, min_periods=1).sum())
        np.testing.assert_allclose(one.chronic_load, load.rolling(28, min_periods=1).sum())
        spread = load.rolling(7, min_periods=1).std() / load.rolling(7, min_periods=1).mean()
        np.testing.assert_allclose(one.load_monotony, spread.fillna(0), atol=1e-12)
        own = one[one.session_type == "training"]
        by_date = pd.Series(own.player_load.values, index=pd.to_datetime(own.session_date))
        np.testing.assert_allclose(own.training_acute_load, by_date.rolling("7D", min_periods=1).sum())
        np.testing.assert_allclose(own.training_chronic_load, by_date.rolling("28D", min_periods=1).sum())
        assert ((one.acwr > 0) & (one.acwr <= 1)).all()


def test_regular_features_need_one_exchange_by_player(spark):
    everything = [*GROUPS, "good_matches", "taper_matches"]
    plan = build_features(bindings.sessions(spark, SF), everything)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(player" in line]
    assert len(exchanges) == 1, exchanges


@pytest.mark.parametrize("rows", [10**9, 30])
@pytest.mark.parametrize("as_of", [None, "1995-06-01", "1998-07-01", "1990-01-01"])
def test_the_end_of_a_history_gives_the_last_session(spark, as_of, rows):
    """With matches only, training only, crowded days and players that begin after the date."""
    table = bindings.sessions(spark, "/root/testdata/sf0.001").select(*SESSION_COLUMNS)
    crowd = make_sessions(spark, [
        {"player": p, "date": f"1995-0{1 + i % 7}-{1 + i % 3:02d}", "tags": tag if i % 5 else "gym" if p != "M" else tag, "player_load": None if i % 4 == 0 else float(i), "k1": i}
        for p, tag in (("M", "match"), ("T", "gym"), ("B", "match")) for i in range(60)
    ]).select(*SESSION_COLUMNS)
    table = table.unionByName(crowd)
    when = None if as_of is None else F.lit(as_of).cast("date")
    groups = ["training_load", "row_load", "match_days", "means"]
    want = latest_session(build_features(table, groups), when)
    spark.conf.set("spark.taperline.maxGroupRows", str(rows))
    try:
        found = latest_features(table, when).select(*want.columns)
        a, b = (df.toPandas().sort_values("player").reset_index(drop=True) for df in (want, found))
    finally:
        spark.conf.unset("spark.taperline.maxGroupRows")
    assert len(a) == len(b) and (len(a) > 5 or as_of == "1990-01-01")
    for c in want.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=1e-9, err_msg=c)
        else:
            assert a[c].astype(str).tolist() == b[c].astype(str).tolist(), c
