"""Training-load features of every session.

``split_features`` is the whole table; ``groups`` limits it to what a query reads. All
windows of a regular player share one exchange by player. Heavy players take
``heavy_features``, which gives the same columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.functions.expressions import (
    MICROS_PER_DAY,
    add_present,
    high_intensity,
    safe_ratio,
    session_type,
)
from taperline.operators.heavy import heavy_features
from taperline.operators.hotspots import INSTANT_ROWS, Split, split_players, stored
from taperline.operators.rules import (
    ACUTE_DAYS,
    BASELINE_PROB,
    CHRONIC_DAYS,
    CHRONIC_ROWS,
    DROP_BELOW,
    MIN_SESSIONS,
    PRE_MATCH_DAYS,
    SPEED_DAYS,
    TAPER_PROB,
    TARGET_ROWS,
    TARGET_SHARE,
    ZONE_MIN_GOOD,
    days_before_frame,
    good_match,
    row_load,
    speed_decline,
    taper_eligible,
    vs_baseline,
    with_match_days,
)
from taperline.schema import EXPORT_COLUMNS, PERFORMANCE_METRICS, SESSION_TYPES, TAPER_METRICS, TIE_BREAK

# training_load: acute/chronic load of training   row_load: the same over all sessions, monotony
# match_days: days since/until a match            speed: decline against the last week
# baseline: metrics against own best quarter      label: decline of the next like session
# means: mean training load of the player
# good_matches, taper_matches: marks of strong matches and, on other rows, how many follow
GROUPS = ("training_load", "row_load", "match_days", "speed", "baseline", "label", "means")

# The columns of the sessions that a group reads, beside the key, the session type and the load.
INPUTS = {
    "target": ("distance_per_min",),
    "speed": ("top_speed",),
    "baseline": PERFORMANCE_METRICS,
    "good_matches": PERFORMANCE_METRICS,
    "taper_matches": (*TAPER_METRICS, "high_speed_distance"),
}

GRAINS = {"day": 1, "timestamp": MICROS_PER_DAY}


# What an export may lack: a metric that is absent is NULL throughout and sets no ranges.
OPTIONAL = ("sprints_per_min", "power_score", "top_speed", "sprints", "duration")
INTENSITY = ("high_speed_distance", "high_accel_count", "high_decel_count", "high_impact_count")


def tidy_sessions(sessions: DataFrame, grain: str = "day") -> DataFrame:
    """Session type, high-intensity sums and the time axis ``t`` (days, or microseconds)."""
    kinds = {name: dtype for name, dtype in EXPORT_COLUMNS.values()}
    sessions = sessions.withColumns({c: F.lit(None).cast(kinds[c]) for c in OPTIONAL if c not in sessions.columns})
    if grain == "day":
        t = F.unix_date("session_date").cast("bigint")
    else:
        t = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("session_ts"))
    sums = high_intensity(sessions)
    sums = sums.withColumns({c: F.lit(None).cast("double") for c in INTENSITY if c not in sums.columns})
    return (
        sums.filter("player is not null")
        .withColumns({"t": t, "session_type": session_type(F.col("tags"))})
    )


def split_features(
    sessions: DataFrame,
    groups: Iterable[str] = GROUPS,
    grain: str = "day",
    min_sessions: int = MIN_SESSIONS,
    only: Iterable[str] | None = None,
) -> Split:
    """Sessions plus the features of ``groups``; players with fewer than ``min_sessions`` go.

    Where ``only`` names the columns of the sessions that are read, no others go through the windows and
    joins, beside those that the features need.
    """
    groups = set(groups)
    if "label" in groups:
        groups.add("speed")
    if "good_matches" in groups:
        groups.add("match_days")
    unit = GRAINS[grain]
    tidy = tidy_sessions(sessions, grain)
    if only is not None:
        needed = {"player", "t", "session_type", "player_load", *TIE_BREAK, *only, *[c for g in groups for c in INPUTS.get(g, ())]}
        tidy = tidy.select(*[c for c in tidy.columns if c in needed])
    rows = split_players(tidy, INSTANT_ROWS if unit > 1 else None)
    # A match is strong if it is in each of the metrics that the export has.
    tapers = tuple(m for m in TAPER_METRICS if m in sessions.columns)
    regular = regular_features(rows.regular, groups, unit, min_sessions, tapers)
    heavy = rows.heavy if rows.heavy is None else heavy_features(rows.heavy, groups, unit, tapers)
    return Split(regular, heavy, rows.players).each(lambda df: finish_features(df, groups))


def build_features(sessions: DataFrame, groups: Iterable[str] = GROUPS, **options) -> DataFrame:
    """``split_features`` as one table."""
    return split_features(sessions, groups, **options).union()


def regular_features(
    df: DataFrame, groups: set[str], unit: int, min_sessions: int, tapers: tuple[str, ...] = TAPER_METRICS
) -> DataFrame:
    player = W.partitionBy("player")
    rows = player.orderBy("t", *TIE_BREAK)
    axis = player.orderBy("t")
    so_far = W.partitionBy("player", "t").orderBy(*TIE_BREAK).rowsBetween(W.unboundedPreceding, 0)
    backwards = player.orderBy(F.desc("t"))
    kind = W.partitionBy("player", "session_type")
    is_match = F.col("session_type") == "match"
    is_training = ~is_match
    training_load = F.when(is_training, F.col("player_load"))

    # Windows in (player, t, tie-break) order come first: they share one sort.
    if "row_load" in groups:
        df = df.withColumns(row_load(rows))
    if "target" in groups:
        df = df.withColumn("rolling_avg", F.avg("distance_per_min").over(rows.rowsBetween(1 - TARGET_ROWS, 0)))
    if "training_load" in groups:
        # The window is (t - 7d, t] but stops at the row itself, so later sessions of the
        # same date stay out: whole earlier dates plus this date up to the row.
        df = df.withColumn("_today", F.sum(training_load).over(so_far))
        df = df.withColumns(
            {
                "_acute": F.sum(training_load).over(axis.rangeBetween(1 - ACUTE_DAYS * unit, -1)),
                "_chronic": F.sum(training_load).over(axis.rangeBetween(1 - CHRONIC_DAYS * unit, -1)),
            }
        )
        carried = rows.rowsBetween(W.unboundedPreceding, 0)
        df = df.withColumns(
            {
                f"training{name}_load": F.last(
                    F.when(is_training, add_present(F.col(name), F.col("_today"))), ignorenulls=True
                ).over(carried)
                for name in ("_acute", "_chronic")
            }
        ).drop("_today", "_acute", "_chronic")
    if "match_days" in groups:
        earlier = axis.rangeBetween(W.unboundedPreceding, -1)
        df = df.withColumn("prev_match", F.max(F.when(is_match, F.col("t"))).over(earlier))

    # One window over the whole player for everything it is compared with.
    overall = {"_sessions": F.count(F.lit(1)).over(player)}
    if "training_load" in groups:
        overall["n_training"] = F.count_if(is_training).over(player)
    if groups & {"good_matches", "taper_matches"}:
        overall["_matches"] = F.count_if(is_match).over(player)
    if groups & {"means", "taper_matches"}:
        overall["mean_load"] = F.avg(training_load).over(player)
    if "taper_matches" in groups:
        overall["mean_hsd"] = F.avg(F.when(is_training, F.col("high_speed_distance"))).over(player)
        for m in tapers:
            overall[f"_q67_{m}"] = F.percentile(F.when(is_match, F.col(m)), F.lit(TAPER_PROB)).over(player)
    if "good_matches" in groups:
        for m in PERFORMANCE_METRICS:
            overall[f"_q75_{m}"] = F.percentile(F.when(is_match, F.col(m)), F.lit(BASELINE_PROB)).over(player)
    df = df.withColumns(overall).filter(F.col("_sessions") >= min_sessions)

    if "good_matches" in groups:
        good = {f"good_{m}": good_match(is_match, F.col("_matches"), F.col(m) >= F.col(f"_q75_{m}")) for m in PERFORMANCE_METRICS}
        df = df.withColumns(good).withColumns({f"_n_{g}": F.count_if(F.col(g)).over(player) for g in good})
        df = df.withColumns({g: F.col(g) & (F.col(f"_n_{g}") >= ZONE_MIN_GOOD) for g in good})
        week = axis.rangeBetween(1, PRE_MATCH_DAYS * unit)
        df = df.withColumns({f"ahead_{m}": F.count_if(F.col(f"good_{m}")).over(week) for m in PERFORMANCE_METRICS})
        df = df.withColumns(
            {
                f"prepared_{m}": F.max(is_training & (F.col(f"ahead_{m}") > 0)).over(player)
                for m in PERFORMANCE_METRICS
            }
        ).drop(*[f"_n_{g}" for g in good], *[f"_q75_{m}" for m in PERFORMANCE_METRICS])
    if "taper_matches" in groups:
        above = is_match
        for m in tapers:
            above = above & (F.col(m) >= F.col(f"_q67_{m}"))
        df = df.withColumn("taper_good", F.coalesce(above, F.lit(False)))
        df = df.withColumn("_good", F.count_if("taper_good").over(player))
        enough = taper_eligible(F.col("_sessions"), F.col("_matches"), F.col("_good"))
        df = df.withColumn("taper_good", F.col("taper_good") & enough)
        df = df.withColumns(
            {
                f"ahead_{k}": F.count_if("taper_good").over(axis.rangeBetween(*days_before_frame(k, unit)))
                for k in range(1, PRE_MATCH_DAYS + 1)
            }
        ).drop("_good", *[f"_q67_{m}" for m in tapers])
    df = df.drop("_sessions", "_matches")
    if "match_days" in groups:
        # Descending, so that the frame grows row by row instead of being re-read.
        later = backwards.rangeBetween(W.unboundedPreceding, -1)
        df = df.withColumn("next_match", F.min(F.when(is_match, F.col("t"))).over(later))
        df = with_match_days(df, unit)
    if "speed" in groups:
        week = kind.orderBy("t").rangeBetween(-SPEED_DAYS * unit, 0)
        df = df.withColumns(
            {"_fastest": F.max("top_speed").over(week), "_peers": F.count(F.lit(1)).over(week)}
        )
        df = df.withColumn("speed_decline", speed_decline()).drop("_fastest", "_peers")
    if "label" in groups:
        df = df.withColumn("next_speed_decline", F.lead("speed_decline").over(kind.orderBy("t", *TIE_BREAK)))
    if "baseline" in groups:
        df = df.withColumn("_like", F.count(F.lit(1)).over(kind))
        for m in [m for m in PERFORMANCE_METRICS if m in df.columns]:
            bar = F.percentile(m, F.lit(BASELINE_PROB)).over(kind)
            df = df.withColumn(f"{m}_vs_baseline", vs_baseline(F.col(m), bar, F.col("_like")))
        df = df.drop("_like")
    return df


def finish_features(df: DataFrame, groups: set[str]) -> DataFrame:
    """Features that follow from others of the same row."""
    if "training_load" in groups:
        ratio = safe_ratio(F.col("training_acute_load"), F.col("training_chronic_load"))
        df = df.withColumn("training_acwr", F.when(F.col("n_training") > 0, ratio)).drop("n_training")
    if "row_load" in groups:
        df = df.withColumns(
            {
                "acwr": safe_ratio(F.col("acute_load"), F.col("chronic_load")),
                "load_strain": F.col("player_load") * F.col("load_monotony"),
            }
        )
    if "target" in groups:
        low = (F.col("distance_per_min") < TARGET_SHARE * F.col("rolling_avg")) & (F.col("rolling_avg") > 0)
        df = df.withColumn("target", F.when(low, 1).otherwise(0))
    if "label" in groups:
        dropped = (F.col("next_speed_decline") < DROP_BELOW).cast("int")
        df = df.withColumn("performance_drop", F.coalesce(dropped, F.lit(0)))
    return df


def performance_target(sessions: DataFrame) -> DataFrame:
    """Sessions with ``target`` = 1 where distance per minute is below 90% of its rolling mean."""
    return build_features(sessions, ["target"], min_sessions=0).drop("rolling_avg", "t", "session_type")


def by_session_type(features: DataFrame, columns: list[str]) -> DataFrame:
    """One column per session type, filled on that type's rows (``match_speed_decline`` …)."""
    return features.withColumns(
        {f"{kind}_{c}": F.when(F.col("session_type") == kind, F.col(c)) for kind in SESSION_TYPES for c in columns}
    )


def latest_features(sessions: DataFrame, as_of: Column | None = None, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    """The last session of every player with its loads, match days and the player's mean load.

    The same rows as ``latest_session`` of the whole feature table, but only the end of a player's history
    goes through the windows: its last 28 sessions, and 28 days up to its last training. All else follows
    from one aggregation with a row per player, in which matches are a set of days.
    """
    rows = tidy_sessions(sessions)
    upto = F.lit(True) if as_of is None else F.col("session_date") <= as_of
    is_match = F.col("session_type") == "match"
    key = F.struct("t", *TIE_BREAK)
    players = rows.groupBy("player").agg(
        F.count(F.lit(1)).alias("_sessions"),
        F.avg(F.when(~is_match, F.col("player_load"))).alias("_mean_load"),
        F.count_if(~is_match).alias("_trainings"),
        F.max(F.when(upto, key)).alias("_last"),
        F.max(F.when(upto & ~is_match, F.col("t"))).alias("_last_training"),
        F.collect_set(F.when(is_match, F.col("t"))).alias("_match_days"),
    )
    players = players.filter((F.col("_sessions") >= min_sessions) & F.col("_last").isNotNull())
    # Ranking keeps 28 rows per player and task before the shuffle.
    newest = W.partitionBy("player").orderBy(F.desc("t"), *[F.desc(k) for k in TIE_BREAK])
    ranked = rows.filter(upto).select("player", "t", *TIE_BREAK).withColumn("_rank", F.row_number().over(newest))
    cuts = ranked.filter(F.col("_rank") <= CHRONIC_ROWS).groupBy("player").agg(F.min(key).alias("_from"))
    players = stored(players.join(cuts, "player"))
    ends = sessions.select("*", F.unix_date("session_date").cast("bigint").alias("t")).join(
        players.select("player", "_from", "_last", "_last_training"), "player"
    )
    near = (key >= F.col("_from")) | (F.col("t") > F.col("_last_training") - CHRONIC_DAYS)
    tail = ends.filter((key <= F.col("_last")) & near).select(*sessions.columns)
    groups = ["training_load", "row_load"]
    found = split_features(tail, groups, min_sessions=0).union().join(players.drop("_from", "_sessions"), "player")
    last_t = F.col("_last.t")
    found = found.filter(key == F.col("_last")).withColumns(
        {
            "mean_load": F.col("_mean_load"),
            "prev_match": F.array_max(F.filter("_match_days", lambda d: d < last_t)),
            "next_match": F.array_min(F.filter("_match_days", lambda d: d > last_t)),
            "training_acwr": F.when(
                F.col("_trainings") > 0, safe_ratio(F.col("training_acute_load"), F.col("training_chronic_load"))
            ),
        }
    )
    return with_match_days(found, 1).drop(*[c for c in players.columns if c != "player"])


def latest_session(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Last session per player, at or before ``as_of`` if given.

    Ranking keeps one row per player and task before the shuffle.
    """
    if as_of is not None:
        df = df.filter(F.col("session_date") <= as_of)
    last = W.partitionBy("player").orderBy(F.desc("t"), *[F.desc(k) for k in TIE_BREAK])
    return df.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")
