"""Session views over the supplied tables (a supplier, customer or user plays the athlete)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SESSIONS_SQL = """
SELECT concat('P', CAST(l_suppkey AS STRING)) AS player,
       CAST(l_shipdate AS DATE) AS session_date,
       l_orderkey AS k1, CAST(l_linenumber AS BIGINT) AS k2, l_partkey AS k3,
       CASE l_returnflag WHEN 'R' THEN 'Cup MATCH' WHEN 'A' THEN 'Gym' ELSE NULL END AS tags,
       CASE CAST(s_nationkey AS INT) % 4
            WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' WHEN 2 THEN 'MF' ELSE 'FW' END AS position,
       l_quantity AS player_load,
       CAST(floor(l_extendedprice / 100) AS DOUBLE) AS distance_per_min,
       CAST(CAST(round(l_discount * 100) AS INT) AS DOUBLE) AS sprints_per_min,
       CAST(CAST(round(l_tax * 100) AS INT) AS DOUBLE) AS power_score,
       CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS top_speed,
       CAST(l_linenumber * 2 AS BIGINT) AS sprints,
       CAST(30 + l_orderkey % 90 AS DOUBLE) AS duration,
       CAST(l_partkey % 400 AS DOUBLE) AS dist_speed_z4,
       CAST(l_partkey % 150 AS DOUBLE) AS dist_speed_z5,
       CAST(l_linenumber AS BIGINT) AS accel_3_4,
       CAST(l_quantity AS BIGINT) % 5 AS accel_gt4,
       l_orderkey % 9 AS decel_3_4, l_orderkey % 4 AS decel_gt4,
       l_orderkey % 30 AS impact_10_15, l_orderkey % 11 AS impact_15_20, l_partkey % 3 AS impact_gt20,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_partkey % 50 AS DOUBLE) END AS dist_power_25_30,
       CAST(l_partkey % 40 AS DOUBLE) AS dist_power_30_35,
       CAST(l_partkey % 30 AS DOUBLE) AS dist_power_35_40,
       CAST(l_partkey % 20 AS DOUBLE) AS dist_power_40_45,
       CAST(l_partkey % 10 AS DOUBLE) AS dist_power_45_50,
       CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_partkey % 5 AS DOUBLE) END AS dist_power_gt50
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
"""

SPARSE_SQL = """
SELECT concat('C', CAST(o_custkey AS STRING)) AS player,
       CAST(o_orderdate AS DATE) AS session_date,
       o_orderkey AS k1, CAST(0 AS BIGINT) AS k2, CAST(0 AS BIGINT) AS k3,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'league game' ELSE 'gym' END AS tags,
       CAST(floor(o_totalprice / 1000) AS DOUBLE) AS player_load
FROM {orders}
"""

EVENTS_SQL = """
SELECT {player} AS player,
       ts AS session_ts, CAST(ts AS DATE) AS session_date,
       event_id AS k1, CAST(0 AS BIGINT) AS k2, CAST(0 AS BIGINT) AS k3,
       CASE WHEN event_type = 'purchase' THEN 'fixture' ELSE event_type END AS tags,
       value AS player_load,
       {speed} AS top_speed
FROM {events}
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        SESSIONS_SQL, lineitem=_table(spark, sf_dir, "lineitem"), supplier=_table(spark, sf_dir, "supplier")
    )


def sparse_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SPARSE_SQL, orders=_table(spark, sf_dir, "orders"))


EVENT_PLAYER = "concat('U', CAST(user_id AS STRING))"
# A third of all users are one player.
DENSE_PLAYER = f"CASE WHEN user_id % 3 = 0 THEN 'dense' ELSE {EVENT_PLAYER} END"


def event_sessions(spark: SparkSession, sf_dir: str, player: str = EVENT_PLAYER) -> DataFrame:
    speed = "CAST(CAST(get_json_object(props, '$.k') AS INT) AS DOUBLE)"
    text = EVENTS_SQL.replace("{speed}", speed).replace("{player}", player)
    return spark.sql(text, events=_table(spark, sf_dir, "events"))
