"""The queries again as plain SQL, for checking results on another engine.

Written apart from the plans: pairs of sessions and matches are joined here, ranks and
sums are taken directly, and quantiles come from ``quantile_cont``.
"""

from __future__ import annotations

from taperline.queries import HEAVY
from taperline.sources.bindings import DENSE_PLAYER, EVENT_PLAYER, EVENTS_SQL, SESSIONS_SQL, SPARSE_SQL

# Fixed values, written out again so that a wrong one on either side shows.
TRAINING_TARGETS = {
    "daily_load": "player_load",
    "acwr": "training_acwr",
    "high_speed_dist": "high_speed_distance",
    "high_intensity_actions": "high_accel_count",
}
MATCH_TARGETS = {
    "distance_per_min": "distance_per_min",
    "sprint_count": "sprints",
    "high_intensity_distance": "high_speed_distance",
}
PERFORMANCE_METRICS = ("distance_per_min", "sprints_per_min", "power_score")
MATCH_INPUTS = (
    "acwr",
    "load_monotony",
    "load_strain",
    "high_speed_distance",
    "high_accel_count",
    "high_decel_count",
    "high_impact_count",
    "days_since_match",
)
TRAINING_FEATURES = (*MATCH_INPUTS, "training_acwr", "days_until_match")
FEATURES = {"match": MATCH_INPUTS, "training": TRAINING_FEATURES}

KEY = "player, session_date, k1, k2, k3"
RAW = SESSIONS_SQL.format(lineitem="lineitem", supplier="supplier")
SPARSE = SPARSE_SQL.format(orders="orders")
SPEED = "CAST(CAST(json_extract(props, '$.k') AS INT) AS DOUBLE)"
EVENTS = EVENTS_SQL.format(events="events", speed=SPEED, player=EVENT_PLAYER)
DENSE_EVENTS = EVENTS_SQL.format(events="events", speed=SPEED, player=DENSE_PLAYER)
TYPE = """CASE WHEN lower(tags) LIKE '%match%' OR lower(tags) LIKE '%game%' OR lower(tags) LIKE '%fixture%'
          OR lower(tags) LIKE '%competition%' THEN 'match' ELSE 'training' END"""
AS_OF = "DATE '1998-07-01'"

ORD = "session_date, k1, k2, k3"
P = "PARTITION BY player"
K = "PARTITION BY player, session_type"


def days(n: int) -> str:
    return f"INTERVAL {n} DAY"


VIEWS = {
    "s": f"""SELECT *, {TYPE} AS session_type, dist_speed_z4 + dist_speed_z5 AS high_speed_distance,
        accel_3_4 + accel_gt4 AS high_accel_count, decel_3_4 + decel_gt4 AS high_decel_count,
        impact_10_15 + impact_15_20 + impact_gt20 AS high_impact_count
        FROM ({RAW}) QUALIFY count(*) OVER ({P}) >= 5""",
    "loads": f"""SELECT *,
        CASE WHEN session_type = 'training' THEN
          coalesce(sum(CASE WHEN session_type = 'training' THEN player_load END) OVER ({P} ORDER BY session_date
            RANGE BETWEEN {days(6)} PRECEDING AND {days(1)} PRECEDING), 0)
          + sum(CASE WHEN session_type = 'training' THEN player_load END) OVER (PARTITION BY player, session_date
            ORDER BY k1, k2, k3 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS own_acute,
        CASE WHEN session_type = 'training' THEN
          coalesce(sum(CASE WHEN session_type = 'training' THEN player_load END) OVER ({P} ORDER BY session_date
            RANGE BETWEEN {days(27)} PRECEDING AND {days(1)} PRECEDING), 0)
          + sum(CASE WHEN session_type = 'training' THEN player_load END) OVER (PARTITION BY player, session_date
            ORDER BY k1, k2, k3 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS own_chronic,
        sum(player_load) OVER ({P} ORDER BY {ORD} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS acute_load,
        sum(player_load) OVER ({P} ORDER BY {ORD} ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS chronic_load,
        coalesce(stddev_samp(player_load) OVER ({P} ORDER BY {ORD} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
          / nullif(avg(player_load) OVER ({P} ORDER BY {ORD} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 0), 0)
          AS load_monotony,
        max(CASE WHEN session_type = 'match' THEN session_date END) OVER ({P} ORDER BY session_date
          RANGE BETWEEN UNBOUNDED PRECEDING AND {days(1)} PRECEDING) AS prev_match,
        min(CASE WHEN session_type = 'match' THEN session_date END) OVER ({P} ORDER BY session_date
          RANGE BETWEEN {days(1)} FOLLOWING AND UNBOUNDED FOLLOWING) AS next_match,
        max(top_speed) OVER ({K} ORDER BY session_date RANGE BETWEEN {days(7)} PRECEDING AND CURRENT ROW) AS fastest,
        count(*) OVER ({K} ORDER BY session_date RANGE BETWEEN {days(7)} PRECEDING AND CURRENT ROW) AS peers
        FROM s""",
    "filled": f"""SELECT *,
        last_value(own_acute IGNORE NULLS) OVER ({P} ORDER BY {ORD}
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS training_acute_load,
        last_value(own_chronic IGNORE NULLS) OVER ({P} ORDER BY {ORD}
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS training_chronic_load,
        coalesce(acute_load / nullif(chronic_load, 0), 1) AS acwr,
        player_load * load_monotony AS load_strain,
        CAST(date_diff('day', prev_match, session_date) AS INTEGER) AS days_since_match,
        CAST(date_diff('day', session_date, next_match) AS INTEGER) AS days_until_match,
        CASE WHEN peers > 1 THEN CASE WHEN fastest > 0 THEN (top_speed - fastest) / fastest ELSE 0 END END AS speed_decline
        FROM loads""",
    "f": f"""SELECT *, coalesce(training_acute_load / nullif(training_chronic_load, 0), 1) AS training_acwr,
        lead(speed_decline) OVER ({K} ORDER BY {ORD}) AS next_speed_decline,
        CASE WHEN lead(speed_decline) OVER ({K} ORDER BY {ORD}) < -0.05 THEN 1 ELSE 0 END AS performance_drop
        FROM filled""",
    "bars": "SELECT player, count(*) AS n_matches, "
    + ", ".join(f"quantile_cont({m}, 0.75) AS q75_{m}, quantile_cont({m}, 0.67) AS q67_{m}" for m in PERFORMANCE_METRICS)
    + " FROM s WHERE session_type = 'match' GROUP BY player",
    "good": " UNION ALL ".join(
        f"""(SELECT {KEY}, '{m}' AS metric, {i} AS metric_rank, {m} AS value, distance_per_min, sprints,
        high_speed_distance FROM s JOIN bars USING (player)
        WHERE session_type = 'match' AND n_matches >= 5 AND {m} >= q75_{m}
        QUALIFY count(*) OVER (PARTITION BY player) >= 3)"""
        for i, m in enumerate(PERFORMANCE_METRICS)
    ),
    "pre": """SELECT f.*, good.metric, good.metric_rank FROM f JOIN good ON f.player = good.player
        AND f.session_date >= good.session_date - 7 AND f.session_date < good.session_date
        WHERE f.session_type = 'training'""",
    "zones_all": "SELECT player, days_until_match AS md, metric, metric_rank, count(*) AS n, "
    + ", ".join(
        f"quantile_cont({c}, 0.25) AS {t}_lo, quantile_cont({c}, 0.75) AS {t}_hi" for t, c in TRAINING_TARGETS.items()
    )
    + " FROM pre WHERE days_until_match BETWEEN 1 AND 7 GROUP BY ALL HAVING count(*) >= 3",
    "zones": """SELECT *, 'MD-' || md AS md_key FROM zones_all z WHERE metric_rank =
        (SELECT max(metric_rank) FROM zones_all o WHERE o.player = z.player AND o.md = z.md)""",
    "mzones": "SELECT player, metric, count(*) AS n, "
    + ", ".join(
        f"quantile_cont({c}, 0.25) AS {t}_lo, quantile_cont({c}, 0.75) AS {t}_hi" for t, c in MATCH_TARGETS.items()
    )
    + """ FROM good WHERE EXISTS (SELECT 1 FROM pre WHERE pre.player = good.player AND pre.metric = good.metric)
        GROUP BY player, metric""",
    "strong": f"""SELECT {KEY}, distance_per_min, sprints_per_min FROM s JOIN bars USING (player)
        WHERE session_type = 'match' AND n_matches >= 5 AND distance_per_min >= q67_distance_per_min
        AND sprints_per_min >= q67_sprints_per_min
        AND player IN (SELECT player FROM s GROUP BY player HAVING count(*) >= 15)
        QUALIFY count(*) OVER (PARTITION BY player) >= 3""",
    "lead_in": """SELECT s.*, CAST(date_diff('day', s.session_date, m.session_date) AS INTEGER) AS days_before
        FROM s JOIN strong m ON s.player = m.player AND s.session_date >= m.session_date - 7
        AND s.session_date < m.session_date WHERE s.session_type = 'training'""",
    "means": """SELECT player, avg(player_load) AS mean_load, avg(high_speed_distance) AS mean_hsd
        FROM s WHERE session_type = 'training' GROUP BY player""",
    "taper": """SELECT player, days_before AS md, 'MD-' || days_before AS md_key,
        CASE WHEN any_value(mean_load) > 0 THEN avg(player_load) / any_value(mean_load) * 100 ELSE 0 END AS load_percentage,
        CASE WHEN any_value(mean_hsd) > 0 THEN avg(high_speed_distance) / any_value(mean_hsd) * 100 ELSE 0 END
          AS high_intensity,
        avg(high_accel_count) AS high_acceleration_count, avg(high_decel_count) AS high_deceleration_count,
        median(duration) AS recommended_duration, count(*) AS sample_count
        FROM lead_in JOIN means USING (player) GROUP BY player, days_before HAVING count(*) >= 2""",
    "scored": f"""SELECT player, CASE WHEN k1 % 3 = 0 THEN 1 ELSE 0 END AS label, (k3 % 97) / 97.0 AS score,
        CASE WHEN (k3 % 97) / 97.0 > 0.5 THEN 1 ELSE 0 END AS prediction FROM ({RAW})""",
    "risks": f"SELECT player, CAST(sum(k1) % 200 AS DOUBLE) / 2.0 AS risk_score FROM ({RAW}) GROUP BY player",
    "ranked": """SELECT *, rank() OVER (ORDER BY risk_score DESC) AS risk_rank,
        CASE WHEN risk_score > 70 THEN 'red' WHEN risk_score > 50 THEN 'orange'
          WHEN risk_score > 30 THEN 'yellow' ELSE 'green' END AS colour FROM risks""",
    "latest": f"""SELECT *, strftime(session_date, '%Y-%m-%d') AS latest_date,
        days_until_match AS days_until_next_match, CASE WHEN days_until_match <= 7 THEN days_until_match END AS md
        FROM f WHERE session_date <= {AS_OF}
        QUALIFY row_number() OVER ({P} ORDER BY session_date DESC, k1 DESC, k2 DESC, k3 DESC) = 1""",
    "every": "SELECT *, CASE WHEN days_until_match <= 7 THEN days_until_match END AS md FROM f",
    "named": " UNION ALL ".join(
        f"""SELECT player, {i} AS place, '{x}' AS feature,
        (CAST(substr(player, 2) AS BIGINT) * {i + 3} % 17) / 100.0 AS importance FROM (SELECT DISTINCT player FROM s)"""
        for i, x in enumerate(TRAINING_FEATURES)
    ),
    "top3": """SELECT player, feature, importance,
        CAST(row_number() OVER (PARTITION BY player ORDER BY importance DESC, place) - 1 AS INTEGER) AS pos FROM named
        QUALIFY row_number() OVER (PARTITION BY player ORDER BY importance DESC, place) <= 3""",
    "held": " UNION ALL ".join(
        f"SELECT player, days_until_match, '{x}' AS feature, CAST({x} AS DOUBLE) AS value FROM latest"
        for x in TRAINING_FEATURES
    ),
}
STATUS = """CASE WHEN z.player IS NULL THEN CASE WHEN r.player IN (SELECT player FROM zones UNION SELECT player FROM mzones)
        AND r.player NOT IN (SELECT player FROM zones WHERE r.session_type = 'training'
          UNION SELECT player FROM mzones WHERE r.session_type = 'match') THEN 'UNKNOWN' END
      WHEN player_load < daily_load_lo THEN 'UNDERLOADED' WHEN player_load > daily_load_hi THEN 'OVERLOADED'
      ELSE 'OPTIMAL' END"""
MESSAGE = """CASE load_status WHEN 'UNDERLOADED' THEN 'Current load below optimal zone for match preparation'
    WHEN 'OVERLOADED' THEN 'Current load above optimal zone for match preparation'
    WHEN 'OPTIMAL' THEN 'Current load within optimal zone for match preparation'
    WHEN 'UNKNOWN' THEN 'Insufficient historical data for this session type' END"""
ADVICE = """CASE load_status
    WHEN 'UNDERLOADED' THEN printf('Consider increasing load by %.1f%%', (daily_load_lo - player_load) / player_load * 100)
    WHEN 'OVERLOADED' THEN printf('Consider decreasing load by %.1f%%', (player_load - daily_load_hi) / player_load * 100)
    END"""


def _zoned(rows: str) -> str:
    inner = ", ".join(f"z.{t}_{b}" for t in TRAINING_TARGETS for b in ("lo", "hi"))
    return f"""SELECT *, {MESSAGE} AS load_message, {ADVICE} AS load_adjustment FROM (
      SELECT r.*, {inner}, {STATUS} AS load_status FROM {rows} r
      LEFT JOIN zones z ON r.player = z.player AND r.md = z.md AND r.session_type = 'training')"""


def _tapered(rows: str) -> str:
    return f"""SELECT *, actual_load_pct - load_target AS load_difference,
      abs(actual_load_pct - load_target) < 15 AS within_target FROM (
      SELECT r.*, t.load_percentage AS load_target, t.high_intensity AS high_intensity_target,
        t.recommended_duration AS duration_target, CASE WHEN t.player IS NOT NULL THEN least(100, t.sample_count * 20) END AS taper_confidence,
        CASE WHEN t.player IS NOT NULL THEN CASE WHEN mean_load > 0 THEN r.player_load / mean_load * 100 ELSE 0 END END
          AS actual_load_pct
      FROM {rows} r LEFT JOIN taper t ON r.player = t.player AND r.md = t.md LEFT JOIN means n ON r.player = n.player)"""


VIEWS |= {
    "zoned": _zoned("latest"),
    "zoned_all": _zoned("every"),
    "tapered": _tapered("latest"),
    "tapered_all": _tapered("every"),
    "whole": _tapered("zoned"),
}


def with_views(body: str) -> str:
    """Prefix the views a statement reads, directly or through others."""
    import re

    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in VIEWS.items():
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(sql)
                needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in needed)
    return f"WITH {ctes}\n{body}" if needed else body


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _auc() -> str:
    return """SELECT player, round((sum(CASE WHEN label = 1 THEN mid END) - p * (p + 1) / 2.0) / (p * n), 6) AS auc,
      p AS n_positive, n AS n_negative FROM (
      SELECT *, rank() OVER (PARTITION BY player ORDER BY score)
        + (count(*) OVER (PARTITION BY player, score) - 1) / 2.0 AS mid,
        count(*) FILTER (WHERE label = 1) OVER (PARTITION BY player) AS p,
        count(*) FILTER (WHERE label = 0) OVER (PARTITION BY player) AS n FROM scored)
      GROUP BY player, p, n"""


def _quantiles() -> str:
    probs = {"q25": 0.25, "q50": 0.5, "q67": 0.67, "q75": 0.75}
    parts = [
        f"round(quantile_cont({m}, {p}), 6) AS {m}_{q}" for m in ("distance_per_min", "top_speed") for q, p in probs.items()
    ]
    return f"SELECT player, session_type, {', '.join(parts)} FROM s GROUP BY player, session_type"


def _baselines() -> str:
    wide = [
        f"""round(CASE WHEN session_type = '{kind}' AND n >= 5 AND q_{m} > 0 THEN {m} / q_{m} END, 6)
        AS {kind}_{m}_vs_baseline"""
        for kind in ("match", "training")
        for m in PERFORMANCE_METRICS
    ]
    bars = ", ".join(f"quantile_cont({m}, 0.75) AS q_{m}" for m in PERFORMANCE_METRICS)
    return f"""SELECT {KEY}, {', '.join(wide)} FROM s JOIN (SELECT player, session_type, count(*) AS n, {bars}
      FROM s GROUP BY player, session_type) USING (player, session_type)"""


def clean(kind: str) -> str:
    present = " AND ".join(f"{x} IS NOT NULL" for x in FEATURES[kind])
    return f"(SELECT *, strftime(session_date, '%Y-%m') AS month FROM f WHERE session_type = '{kind}' AND {present})"


def _standard() -> str:
    parts = []
    for kind, inputs in FEATURES.items():
        z = ", ".join(
            f"round(coalesce(({x} - avg({x}) OVER ({P})) / nullif(stddev_pop({x}) OVER ({P}), 0), 0), 6) AS {x}"
            if x in inputs
            else f"NULL AS {x}"
            for x in FEATURES["training"]
        )
        parts.append(f"SELECT {KEY}, session_type, {z} FROM {clean(kind)}")
    return " UNION ALL ".join(parts)


def _folds() -> str:
    """Months from the largest on, each to the fold that holds the least so far."""
    parts = [
        f"""SELECT '{kind}' AS session_type, month, fold, n FROM (WITH RECURSIVE c AS (
          SELECT month, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, month) AS i FROM {clean(kind)} GROUP BY month),
        r AS (SELECT CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS x, CAST(0 AS BIGINT) AS y, CAST(0 AS BIGINT) AS z,
            CAST(NULL AS VARCHAR) AS month, CAST(NULL AS INTEGER) AS fold, CAST(0 AS BIGINT) AS n
          UNION ALL SELECT c.i, x + CASE WHEN g = 0 THEN c.n ELSE 0 END, y + CASE WHEN g = 1 THEN c.n ELSE 0 END,
            z + CASE WHEN g = 2 THEN c.n ELSE 0 END, c.month, g, c.n
          FROM (SELECT *, CASE WHEN x <= y AND x <= z THEN 0 WHEN y <= z THEN 1 ELSE 2 END AS g FROM r) q JOIN c ON c.i = q.i + 1)
        SELECT * FROM r WHERE month IS NOT NULL)"""
        for kind in FEATURES
    ]
    return " UNION ALL ".join(parts)


def _trainable() -> str:
    parts = [
        f"""SELECT player, count(*) AS n_sessions, count(*) FILTER (WHERE {ok}) AS n_clean,
          count(DISTINCT strftime(session_date, '%Y-%m')) FILTER (WHERE {ok}) AS n_months, '{kind}' AS session_type
          FROM f WHERE session_type = '{kind}' GROUP BY player HAVING count(*) >= 20 AND count(*) FILTER (WHERE {ok}) >= 15
          AND min(performance_drop) FILTER (WHERE {ok}) < max(performance_drop) FILTER (WHERE {ok})
          AND count(DISTINCT strftime(session_date, '%Y-%m')) FILTER (WHERE {ok}) >= 3"""
        for kind, ok in ((k, " AND ".join(f"{x} IS NOT NULL" for x in xs)) for k, xs in FEATURES.items())
    ]
    return " UNION ALL ".join(parts)


def _fold_auc() -> str:
    return f"""WITH v AS MATERIALIZED (SELECT player, k2 % 3 AS fold, CASE WHEN k1 % 3 = 0 THEN 1 ELSE 0 END AS label,
        (k3 % 97) / 97.0 AS score FROM ({RAW}) WHERE CAST(substr(player, 2) AS BIGINT) % 7 <> 0 OR k2 % 3 <> 1),
      m AS (SELECT *, rank() OVER (PARTITION BY player, fold ORDER BY score)
        + (count(*) OVER (PARTITION BY player, fold, score) - 1) / 2.0 AS mid,
        count(*) FILTER (WHERE label = 1) OVER (PARTITION BY player, fold) AS p,
        count(*) FILTER (WHERE label = 0) OVER (PARTITION BY player, fold) AS n FROM v),
      a AS (SELECT player, fold, CASE WHEN p > 0 AND n > 0 THEN
        (sum(CASE WHEN label = 1 THEN mid END) - p * (p + 1) / 2.0) / (p * n) END AS auc FROM m GROUP BY player, fold, p, n)
      SELECT 'match' AS session_type, player, 'Any' AS model_type,
        round(CASE WHEN count(auc) < 3 THEN 0.0 ELSE avg(auc) END, 6) AS auc FROM a GROUP BY player"""


def _record() -> str:
    parts = [
        f"SELECT player, 'training' AS session_type, md_key AS zone_key, '{t}' AS target FROM zones" for t in TRAINING_TARGETS
    ] + [f"SELECT player, 'match' AS session_type, metric AS zone_key, '{t}' AS target FROM mzones" for t in MATCH_TARGETS]
    return f"""SELECT w.player, position, days_until_next_match, z.zones,
      CASE WHEN w.md IS NOT NULL THEN t.plan END AS plan, load_status, round(load_target, 6) AS load_target, within_target
      FROM whole w LEFT JOIN (SELECT player, session_type, string_agg(zone_key || ':' || target, ',' ORDER BY zone_key, target) AS zones
        FROM ({' UNION ALL '.join(parts)}) GROUP BY player, session_type) z USING (player, session_type)
      LEFT JOIN (SELECT player, string_agg(md || ':' || sample_count, ',' ORDER BY md) AS plan FROM taper GROUP BY player) t
        ON t.player = w.player"""


def _best() -> str:
    kinds = ("RandomForest", "GradientBoosting", "NeuralNetwork")
    aucs = " UNION ALL ".join(
        f"""SELECT 'P' || s_suppkey AS player, {i} AS place, '{k}' AS model_type,
        ((s_suppkey * {37 + i} + {i * 13}) % 50 + 40) / 100.0 AS auc FROM supplier"""
        for i, k in enumerate(kinds)
    )
    return f"""SELECT 'match' AS session_type, player, model_type, round(auc, 6) AS auc FROM ({aucs}) WHERE auc > 0.65
      QUALIFY row_number() OVER (PARTITION BY player ORDER BY auc DESC, place) = 1"""


def _factors() -> str:
    status = """CASE WHEN feature IN ('acwr', 'training_acwr') THEN
        CASE WHEN value > 1.5 THEN 'HIGH' WHEN value < 0.8 THEN 'LOW' ELSE 'OPTIMAL' END
      WHEN feature = 'load_monotony' THEN CASE WHEN value > 2 THEN 'HIGH' ELSE 'OPTIMAL' END
      WHEN feature IN ('high_speed_distance', 'high_accel_count', 'high_decel_count') THEN 'PRESENT'
      WHEN feature = 'days_since_match' THEN CASE WHEN value < 3 THEN 'RECENT' ELSE 'SUFFICIENT' END
      ELSE 'NOTEWORTHY' END"""
    impact = """CASE status WHEN 'HIGH' THEN
        CASE WHEN feature = 'load_monotony' THEN 'training lacks variability' ELSE 'increasing fatigue risk' END
      WHEN 'LOW' THEN 'potentially insufficient stimulus'
      WHEN 'OPTIMAL' THEN CASE WHEN feature = 'load_monotony' THEN 'good training variation' ELSE 'well-balanced workload' END
      WHEN 'PRESENT' THEN 'contributing to fatigue accumulation' WHEN 'RECENT' THEN 'insufficient recovery time'
      WHEN 'SUFFICIENT' THEN 'adequate recovery period' ELSE 'influencing fatigue levels' END"""
    return f"""SELECT *, {impact} AS impact FROM (SELECT player, pos, feature, round(importance * 100, 6) AS importance,
      round(value, 6) AS value, {status} AS status FROM top3 JOIN held USING (player, feature)
      WHERE days_until_match IS NOT NULL)"""


def _applicable() -> str:
    parts = [
        f"SELECT player, 'training' AS session_type, md_key AS zone_key, '{t}' AS target, {t}_lo AS lo, {t}_hi AS hi FROM zones"
        for t in TRAINING_TARGETS
    ] + [
        f"SELECT player, 'match' AS session_type, metric AS zone_key, '{t}' AS target, {t}_lo AS lo, {t}_hi AS hi FROM mzones"
        for t in MATCH_TARGETS
    ]
    return f"""SELECT player, session_type, zone_key, target, round(lo, 6) AS lo, round(hi, 6) AS hi
      FROM latest JOIN ({' UNION ALL '.join(parts)}) USING (player, session_type)"""


def _subday(body: str) -> str:
    return f"""WITH e AS MATERIALIZED (SELECT *, {TYPE} AS session_type FROM ({EVENTS})
      QUALIFY count(*) OVER (PARTITION BY player) >= 5) {body}"""


def all_sql() -> dict[str, str]:
    zone_columns = [f"{t}_{b}" for t in TRAINING_TARGETS for b in ("lo", "hi")]
    match_columns = [f"{t}_{b}" for t in MATCH_TARGETS for b in ("lo", "hi")]
    taper_columns = [
        "load_percentage", "high_intensity", "high_acceleration_count", "high_deceleration_count", "recommended_duration",
    ]
    place = f"""row_number() OVER (ORDER BY CAST(('0x' || substr(md5(concat_ws('|', player,
      CAST(session_date AS VARCHAR), k1, k2, k3)), 1, 15)) AS BIGINT), {KEY})"""
    n_columns = 29
    sql = {
        "quarantine": f"""SELECT k1, k2, k3, CASE WHEN k1 % 11 = 0 THEN 'no player' ELSE 'no readable date' END AS reason
          FROM ({RAW}) WHERE k1 % 11 = 0 OR k1 % 13 = 0""",
        "zone_pairs": f"""SELECT {", ".join(f"f.{c}" for c in KEY.split(", "))}, metric, good.session_date AS match_session_date,
          good.k1 AS match_k1, good.k2 AS match_k2, good.k3 AS match_k3,
          CAST(date_diff('day', f.session_date, good.session_date) AS INTEGER) AS days_before
          FROM f JOIN good ON f.player = good.player AND f.session_date >= good.session_date - 7
          AND f.session_date < good.session_date WHERE f.session_type = 'training'""",
        "taper_pairs": f"""SELECT {", ".join(f"s.{c}" for c in KEY.split(", "))}, m.session_date AS match_session_date,
          m.k1 AS match_k1, m.k2 AS match_k2, m.k3 AS match_k3,
          CAST(date_diff('day', s.session_date, m.session_date) AS INTEGER) AS days_before
          FROM s JOIN strong m ON s.player = m.player AND s.session_date >= m.session_date - 7
          AND s.session_date < m.session_date WHERE s.session_type = 'training'""",
        "incremental_scalers": "SELECT player, count(*) AS scaler_n, "
        + ", ".join(f"round(avg({x}), 6) AS mean_{x}, round(stddev_pop({x}), 6) AS std_{x}" for x in TRAINING_FEATURES)
        + f" FROM {clean('training')} GROUP BY player",
        "read_sessions": f"""SELECT {KEY}, CAST(session_date AS TIMESTAMP) AS session_ts, tags, position, player_load,
          sprints, duration, dist_power_25_30, impact_gt20 FROM ({RAW})""",
        "default_position": f"SELECT {KEY}, 'Unknown' AS position FROM ({RAW})",
        "excel_serial_to_ts": """SELECT o_orderkey, TIMESTAMP '1899-12-30' + to_microseconds(CAST(round(
          (date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) + (o_orderkey % 96) / 96.0::DOUBLE) * 86400000000)
          AS BIGINT)) AS session_ts FROM orders""",
        "parse_date": """SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 10 = 0 THEN 'n/a'
          ELSE strftime(o_orderdate, '%d/%m/%Y') END, '%d/%m/%Y') AS session_ts FROM orders""",
        "order_sessions": f"SELECT {KEY}, player_load FROM ({RAW}) ORDER BY {KEY}",
        "dataset_profile": f"""SELECT count(*) AS n_sessions, CAST({n_columns} AS BIGINT) AS n_columns,
          count(DISTINCT player) AS n_players FROM ({RAW})""",
        "train_test_split": f"""SELECT {KEY}, CASE WHEN {place} <= ceil(0.2 * count(*) OVER ())
          THEN 'test' ELSE 'train' END AS part FROM ({RAW})""",
        "union_players": f"""SELECT {KEY}, position, player_load FROM ({RAW})
          UNION ALL SELECT {KEY}, NULL, player_load FROM ({SPARSE})""",
        "distinct_players": f"SELECT DISTINCT player FROM ({RAW})",
        "session_type": f"""SELECT {KEY}, {TYPE} AS session_type FROM (SELECT {KEY}, tags FROM ({RAW})
          UNION ALL SELECT {KEY}, tags FROM ({SPARSE}))""",
        "min_history_filter": f"""SELECT {KEY}, player_load FROM ({SPARSE})
          QUALIFY count(*) OVER (PARTITION BY player) >= 5""",
        "high_intensity_metrics": f"""SELECT {KEY}, dist_speed_z4 + dist_speed_z5 AS high_speed_distance,
          accel_3_4 + accel_gt4 AS high_accel_count, decel_3_4 + decel_gt4 AS high_decel_count,
          impact_10_15 + impact_15_20 + impact_gt20 AS high_impact_count FROM ({RAW})""",
        "high_power_distance": f"""SELECT {KEY}, coalesce(dist_power_25_30, 0) + coalesce(dist_power_30_35, 0)
          + coalesce(dist_power_35_40, 0) + coalesce(dist_power_40_45, 0) + coalesce(dist_power_45_50, 0)
          + dist_power_gt50 AS high_power_distance FROM ({RAW})""",
        "safe_ratio": f"SELECT {KEY}, round(coalesce(player_load / nullif(sprints_per_min, 0), 1), 6) AS ratio FROM ({RAW})",
        "drop_null_features": " UNION ALL ".join(
            f"SELECT {KEY}, session_type, days_since_match, days_until_match FROM {clean(kind)}" for kind in FEATURES
        ),
        "month_bucket": f"SELECT {KEY}, strftime(session_date, '%Y-%m') AS month FROM ({RAW})",
        "md_key": f"SELECT {KEY}, 'MD-' || days_until_match AS md_key FROM f WHERE days_until_match BETWEEN 1 AND 7",
        "training_acute_load": f"SELECT {KEY}, training_acute_load FROM f",
        "training_chronic_load": f"SELECT {KEY}, training_chronic_load FROM f",
        "forward_fill": f"SELECT {KEY}, training_acute_load, training_chronic_load FROM f WHERE session_type = 'match'",
        "training_acwr": f"SELECT {KEY}, {r6('training_acwr')} FROM f",
        "acute_load": f"SELECT {KEY}, acute_load FROM f",
        "chronic_load": f"SELECT {KEY}, chronic_load FROM f",
        "acwr": f"SELECT {KEY}, {r6('acwr')} FROM f",
        "load_monotony": f"SELECT {KEY}, {r6('load_monotony')} FROM f",
        "load_strain": f"SELECT {KEY}, {r6('load_strain')} FROM f",
        "speed_decline": f"""SELECT {KEY},
          round(CASE WHEN session_type = 'match' THEN speed_decline END, 6) AS match_speed_decline,
          round(CASE WHEN session_type = 'training' THEN speed_decline END, 6) AS training_speed_decline FROM f""",
        "vs_baseline": _baselines(),
        "days_since_match": f"SELECT {KEY}, days_since_match FROM f",
        "days_until_match": f"SELECT {KEY}, days_until_match FROM f",
        "rolling_avg_5": f"""SELECT {KEY}, round(avg(distance_per_min) OVER ({P} ORDER BY {ORD}
          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling_avg FROM ({RAW})""",
        "performance_target": f"""SELECT {KEY}, distance_per_min, CASE WHEN distance_per_min < 0.9 * m AND m > 0
          THEN 1 ELSE 0 END AS target FROM (SELECT *, avg(distance_per_min) OVER ({P} ORDER BY {ORD}
          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS m FROM ({RAW}))""",
        "next_speed_decline": f"SELECT {KEY}, {r6('next_speed_decline')} FROM f",
        "performance_drop_label": f"SELECT {KEY}, performance_drop FROM f",
        "latest_session": f"""SELECT {KEY}, session_type, player_load FROM s
          QUALIFY row_number() OVER ({P} ORDER BY session_date DESC, k1 DESC, k2 DESC, k3 DESC) = 1""",
        "subday_training_load": _subday(
            """, w AS (SELECT a.player, a.session_ts, a.k1, a.session_type,
            sum(b.player_load) FILTER (WHERE b.session_ts > a.session_ts - INTERVAL 7 DAY) AS ac, sum(b.player_load) AS ch
            FROM e a LEFT JOIN e b ON a.player = b.player AND a.session_type = 'training' AND b.session_type = 'training'
              AND b.session_ts > a.session_ts - INTERVAL 28 DAY AND (b.session_ts < a.session_ts
              OR (b.session_ts = a.session_ts AND b.k1 <= a.k1)) GROUP BY ALL),
            g AS (SELECT *, last_value(ac IGNORE NULLS) OVER x AS a7, last_value(ch IGNORE NULLS) OVER x AS c28
              FROM w WINDOW x AS (PARTITION BY player ORDER BY session_ts, k1
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
            SELECT player, session_ts, k1, round(a7, 6) AS training_acute_load, round(c28, 6) AS training_chronic_load,
              round(CASE WHEN count(*) FILTER (WHERE session_type = 'training') OVER (PARTITION BY player) > 0
              THEN coalesce(a7 / nullif(c28, 0), 1) END, 6) AS training_acwr FROM g"""
        ),
        "subday_match_days": _subday(
            """, m AS (SELECT a.player, a.session_ts, a.k1,
              max(b.session_ts) FILTER (WHERE b.session_ts < a.session_ts) AS pm,
              min(b.session_ts) FILTER (WHERE b.session_ts > a.session_ts) AS nm
              FROM e a LEFT JOIN e b ON a.player = b.player AND b.session_type = 'match' GROUP BY ALL),
            v AS (SELECT a.player, a.session_ts, a.k1, any_value(a.top_speed) AS v, max(b.top_speed) AS mx, count(*) AS n
              FROM e a JOIN e b ON a.player = b.player AND a.session_type = b.session_type
              AND b.session_ts BETWEEN a.session_ts - INTERVAL 7 DAY AND a.session_ts GROUP BY ALL)
            SELECT player, session_ts, k1,
              CAST(floor((epoch_us(session_ts) - epoch_us(pm)) / 86400000000.0) AS INTEGER) AS days_since_match,
              CAST(floor((epoch_us(nm) - epoch_us(session_ts)) / 86400000000.0) AS INTEGER) AS days_until_match,
              round(CASE WHEN n > 1 THEN CASE WHEN mx > 0 THEN (v - mx) / mx ELSE 0 END END, 6) AS speed_decline
            FROM m JOIN v USING (player, session_ts, k1)"""
        ),
        "good_matches_any": f"SELECT {KEY}, metric, value FROM good",
        "pre_match_sessions": f"SELECT {KEY}, metric, count(*) AS copies, days_until_match FROM pre GROUP BY ALL",
        "good_matches_all": f"SELECT {KEY}, distance_per_min, sprints_per_min FROM strong",
        "taper_sessions": f"SELECT {KEY}, days_before, count(*) AS copies FROM lead_in GROUP BY ALL",
        "zone_precedence": "SELECT player, md, metric, n FROM zones",
        "training_zones": f"SELECT player, md, md_key, {r6(*zone_columns)}, n FROM zones",
        "training_zones_by_metric": f"SELECT player, md, metric, {r6(*zone_columns)}, n FROM zones_all",
        "match_zones": f"SELECT player, metric, {r6(*match_columns)}, n FROM mzones",
        "zone_players": "SELECT player FROM zones UNION SELECT player FROM mzones",
        "training_means": f"SELECT player, {r6('mean_load', 'mean_hsd')} FROM means",
        "taper_plan": f"SELECT player, md, md_key, {r6(*taper_columns)}, sample_count FROM taper",
        "eligibility": f"""SELECT *, n_sessions >= 5 AS has_history, n_sessions >= 15 AS has_taper_history,
          n_matches >= 5 AS has_zone_matches, n_matches >= 20 AS can_train_match, n_trainings >= 20 AS can_train_training
          FROM (SELECT player, count(*) AS n_sessions, count(*) FILTER (WHERE {TYPE} = 'match') AS n_matches,
          count(*) FILTER (WHERE {TYPE} = 'training') AS n_trainings FROM ({SPARSE}) GROUP BY player)""",
        "exact_quantile": _quantiles(),
        "lookup_player_artifacts": f"""SELECT l.player, session_date, k1, k2, k3, n_zones, n_taper_days FROM
          (SELECT {KEY} FROM s QUALIFY row_number() OVER ({P} ORDER BY session_date DESC, k1 DESC, k2 DESC, k3 DESC) = 1) l
          LEFT JOIN (SELECT player, count(*) AS n_zones FROM zones GROUP BY player) USING (player)
          LEFT JOIN (SELECT player, count(*) AS n_taper_days FROM taper GROUP BY player) USING (player)""",
        "lookup_md_target": f"""SELECT {KEY}, md, {r6('daily_load_lo', 'daily_load_hi')} FROM zoned_all
          WHERE daily_load_lo IS NOT NULL""",
        "confusion_counts": """SELECT player, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
          count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0)
          AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM scored GROUP BY player""",
        "confusion_cells": """SELECT label AS true_label, prediction AS predicted_label, count(*) AS n FROM scored
          GROUP BY label, prediction""",
        "roc_auc": _auc(),
        "class_balance": """SELECT player, count(DISTINCT label) AS n_classes, count(*) FILTER (WHERE label = 1)
          AS n_positive, count(*) AS n FROM scored GROUP BY player""",
        "select_best_model": _best(),
        "rank_by_risk": "SELECT player, risk_score, risk_rank FROM ranked",
        "risk_ranking": "SELECT player, risk_score, risk_rank, colour FROM ranked",
        "risk_banding": """SELECT player, risk_score, CASE WHEN risk_score / 100 > 0.7 THEN 'HIGH RISK'
          WHEN risk_score / 100 > 0.3 THEN 'MODERATE RISK' ELSE 'LOW RISK' END AS interpretation FROM risks""",
        "top3_factors": "SELECT player, pos, feature, importance FROM top3",
        "key_factors": _factors(),
        "insight_header": "SELECT player, session_type, latest_date, position FROM latest",
        "next_match_info": "SELECT player, days_until_next_match FROM latest",
        "applicable_zones": _applicable(),
        "match_prep_targets": f"SELECT player, md, {r6(*zone_columns)} FROM zoned WHERE daily_load_lo IS NOT NULL",
        "load_status": f"""SELECT {KEY}, load_status, load_message, load_adjustment FROM zoned_all
          WHERE load_status IS NOT NULL""",
        "taper_strategy": f"""SELECT player, days_until_next_match, t.md, {r6(*taper_columns)}, sample_count
          FROM (SELECT player, days_until_next_match FROM latest WHERE md IS NOT NULL) JOIN taper t USING (player)""",
        "today_recommended": f"""SELECT player, {r6('load_target', 'high_intensity_target', 'duration_target')},
          taper_confidence FROM tapered WHERE load_target IS NOT NULL""",
        "today_comparison": f"""SELECT {KEY}, {r6('actual_load_pct', 'load_difference')}, within_target FROM tapered_all
          WHERE load_target IS NOT NULL""",
        "predict": f"""SELECT player, session_type, latest_date, position, days_until_next_match, load_status,
          load_adjustment, {r6('daily_load_lo', 'daily_load_hi', 'load_target', 'actual_load_pct', 'load_difference')},
          taper_confidence, within_target FROM whole""",
        "player_status": """SELECT player, coalesce(lower(load_status), 'unknown') AS status, session_type,
          coalesce(load_message, '') AS message FROM zoned""",
        "match_preparation": """SELECT player, days_until_next_match AS days_until_match,
          coalesce(lower(load_status), 'unknown') AS load_status FROM zoned WHERE days_until_next_match <= 7""",
        "taper_recommendations": """SELECT player, days_until_next_match AS days_before_match,
          round(load_target, 6) AS load_percentage, round(high_intensity_target, 6) AS high_intensity,
          round(duration_target, 6) AS duration, taper_confidence AS confidence, round(actual_load_pct, 6) AS actual_load,
          round(load_difference, 6) AS load_difference, within_target FROM tapered WHERE load_target IS NOT NULL""",
        "readiness_summary": """SELECT coalesce(lower(load_status), 'unknown') AS status, count(*) AS n,
          round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM zoned), 6) AS share FROM zoned GROUP BY 1""",
        "taper_series": f"""SELECT player, t.md, md_key, {r6('load_percentage', 'high_intensity')},
          coalesce(t.md = days_until_next_match, false) AS is_today FROM latest l JOIN taper t USING (player)""",
        "fatigue_features": f"""SELECT {KEY}, session_type, strftime(session_date, '%Y-%m') AS month,
          {', '.join(f'round({x}, 6) AS {x}' if x in ('acwr', 'load_monotony', 'load_strain', 'training_acwr') else x
          for x in FEATURES['training'])}, performance_drop FROM f""",
        "month_group_folds": _folds(),
        "trainable_players": _trainable(),
        "fold_auc": _fold_auc(),
        "insight_record": _record(),
        "profile": """SELECT 'zones' AS artefact, count(*) AS n FROM (SELECT player FROM zones UNION SELECT player FROM mzones)
          UNION ALL SELECT 'taper', count(DISTINCT player) FROM taper""",
        "metrics_absent": "SELECT player, md, metric, n FROM zones_all WHERE metric <> 'power_score'",
        "standardize_per_player": _standard(),
    }
    out = {name: with_views(text) for name, text in sql.items()}
    for name in ("training_load", "match_days"):
        out[f"dense_{name}"] = out[f"subday_{name}"].replace(EVENTS, DENSE_EVENTS)
    return out | {f"{name}_heavy": out[name] for name in HEAVY}
