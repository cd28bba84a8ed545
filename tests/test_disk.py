"""What the plan for oversized players leaves on disk and carries along."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_heavy import SF, dense, limit, same  # noqa: F401

from taperline.operators import hotspots
from taperline.operators.features import GROUPS, build_features, split_features
from taperline.operators.hotspots import CLEAN_SHUFFLES, shared_folder, stored, stored_alone
from taperline.operators.zones import KEY, ZONE_INPUTS, zone_features
from taperline.sources import bindings


def tables(spark) -> set[Path]:
    return set(Path(shared_folder(spark).removeprefix("file:")).glob("table-*"))


def shuffles(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().endswith(".data") for i in range(files.size()))


def test_shuffles_of_a_stored_table_go_at_once(spark):
    before, setting = shuffles(spark), spark.conf.get(CLEAN_SHUFFLES, None)
    assert stored(spark.range(1000).repartition(3).groupBy("id").count()).count() == 1000
    assert shuffles(spark) <= before + 1  # that of the count here
    assert spark.conf.get(CLEAN_SHUFFLES, None) == setting


def test_tables_on_the_way_go(spark):
    before = tables(spark)
    found = stored_alone(lambda: stored_alone(lambda: stored(spark.range(5)).union(stored(spark.range(4)))).union(stored(spark.range(3))))
    assert found.count() == 12 and len(tables(spark) - before) == 1


def test_an_oversized_table_is_stored_once_with_what_is_read(spark, limit):  # noqa: F811
    limit(100)
    before = tables(spark)
    heavy = zone_features(bindings.sessions(spark, SF), only=ZONE_INPUTS).heavy
    assert not {"tags", "position", "accel_3_4", "dist_power_25_30", "session_ts"} & set(heavy.columns)
    held = [spark.read.parquet(str(p)) for p in tables(spark) - before]
    whole = [t for t in held if "player_load" in t.columns and "k1" in t.columns]
    assert len(whole) == 1 and len(held) <= 6, [t.columns for t in held]


@pytest.mark.parametrize("group", [*GROUPS, "good_matches", "taper_matches", "target"])
def test_columns_that_are_not_read_do_not_change_features(spark, limit, group):  # noqa: F811
    table = bindings.sessions(spark, SF)
    whole = build_features(table, [group])
    limit(100)
    split = split_features(table, [group], only=KEY)
    assert split.heavy is not None
    found = split.union()
    assert set(KEY) < set(found.columns) <= set(whole.columns)
    same(whole.select(*found.columns), found)


def test_what_is_known_of_many_players_is_joined_once(spark, limit, monkeypatch):  # noqa: F811
    """The same rows where players are too many to be broadcast, some of them without matches."""
    table = bindings.sessions(spark, SF)
    table = table.withColumn("tags", F.when(F.substring("player", 2, 9).cast("int") % 3 > 0, F.col("tags")))
    groups = ["training_load", "good_matches", "taper_matches"]
    plain = build_features(table, groups)
    limit(100)
    monkeypatch.setattr(hotspots, "BROADCAST_ROWS", 0)
    before = tables(spark)
    split = split_features(table, groups)
    held = [spark.read.parquet(str(p)) for p in tables(spark) - before]
    assert len([t for t in held if "player_load" in t.columns and "k1" in t.columns]) == 1
    same(plain, split.union())
