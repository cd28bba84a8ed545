"""Features of heavy players, computed without bringing a player together.

Windows over time read a rollup with one row per player and date, in spans of 28 days with their
neighbours. Where there is one row per instant, they go by pieces (``running``), as a day may hold any
number of instants. Windows over a number of rows first give every row its position, by pieces too, then
run on blocks of consecutive positions that also see the last few rows of the block before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.functions.expressions import add_present
from taperline.operators import hotspots
from taperline.operators.hotspots import joined, max_group_rows, salted_join, stored, stored_alone
from taperline.operators.quantiles import select_by_rank
from taperline.operators.rules import (
    ACUTE_DAYS,
    BASELINE_PROB,
    CHRONIC_DAYS,
    CHRONIC_ROWS,
    PRE_MATCH_DAYS,
    SPEED_DAYS,
    TAPER_MIN_GOOD,
    TAPER_MIN_MATCHES,
    TAPER_MIN_SESSIONS,
    TAPER_PROB,
    TARGET_ROWS,
    ZONE_MIN_GOOD,
    days_before_frame,
    good_match,
    row_load,
    speed_decline,
    vs_baseline,
    with_match_days,
)
from taperline.operators.running import PIECE, Aggregates, in_pieces, over_range, running
from taperline.schema import PERFORMANCE_METRICS, SESSION_TYPES, TAPER_METRICS, TIE_BREAK

PAST = (W.unboundedPreceding, -1)
#: The groups that read the rollup with a row per date.
BY_DATE = {"training_load", "match_days", "speed", "good_matches", "taper_matches"}


def is_match() -> Column:
    return F.col("session_type") == "match"


def is_training() -> Column:
    return F.col("session_type") != "match"


def training_load() -> Column:
    return F.when(is_training(), F.col("player_load"))


def heavy_features(df: DataFrame, groups: set[str], unit: int, tapers: tuple[str, ...] = TAPER_METRICS) -> DataFrame:
    limit = max(max_group_rows(df.sparkSession), CHRONIC_ROWS)
    keep: list[str] = []

    def laid_out() -> DataFrame:
        rows, names = _by_date(df, groups, unit, tapers)
        keep.extend(names)
        return rows

    found = _positions(laid_out, groups, limit) if groups & {"training_load", "row_load", "target", "label"} else laid_out()
    if "training_load" in groups:
        keep += ["training_acute_load", "training_chronic_load", "n_training"]
    if groups & {"row_load", "target", "label"}:
        found = _row_frames(found, groups, limit)
    if "row_load" in groups:
        keep += ["acute_load", "chronic_load", "load_monotony"]
    if "target" in groups:
        keep += ["rolling_avg"]
    if "label" in groups:
        keep += ["next_speed_decline"]
    return found.select(*keep)


def _by_date(df: DataFrame, groups: set[str], unit: int, tapers: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """Rows with what follows from their player or date, and the names of the columns asked for so far."""
    keep = df.columns
    metrics = [m for m in PERFORMANCE_METRICS if m in df.columns]
    if groups & {"good_matches", "taper_matches", "baseline"}:
        df = _with_bars(df, groups, metrics, tapers)
    if "means" in groups:
        keep += ["mean_load"]
        if "mean_load" not in df.columns:
            # One row per heavy player.
            df = joined(df, stored(df.groupBy("player").agg(F.avg(training_load()).alias("mean_load"))), ["player"])
    if "good_matches" in groups:
        keep += [f"good_{m}" for m in PERFORMANCE_METRICS]
    if "taper_matches" in groups:
        keep += ["taper_good", "mean_hsd"] if "means" in groups else ["taper_good", "mean_load", "mean_hsd"]
    if "baseline" in groups:
        keep += [f"{m}_vs_baseline" for m in metrics]
    df = df.filter("t is not null")
    if groups & BY_DATE:
        marked = df
        df = salted_join(df, stored_alone(lambda: _dates(marked, groups, unit)), ["player", "t"])
    if "good_matches" in groups:
        keep += [f"{n}_{m}" for m in PERFORMANCE_METRICS for n in ("ahead", "prepared")]
    if "taper_matches" in groups:
        keep += [f"ahead_{k}" for k in range(1, PRE_MATCH_DAYS + 1)]
    if "match_days" in groups:
        df = with_match_days(df, unit)
        keep += ["days_since_match", "days_until_match"]
    if "speed" in groups:
        df = df.withColumns(
            {
                name: F.when(is_match(), F.col(f"{name}_match")).otherwise(F.col(f"{name}_training"))
                for name in ("_fastest", "_peers")
            }
        ).withColumn("speed_decline", speed_decline())
        keep += ["speed_decline"]
    # What served only to get here does not travel on.
    spent = [f"{name}_{kind}" for name in ("_fastest", "_peers") for kind in SESSION_TYPES]
    return df.drop(*spent, "_fastest", "_peers"), keep


def _with_bars(df: DataFrame, groups: set[str], metrics: list[str], tapers: tuple[str, ...]) -> DataFrame:
    """What a session must reach to be strong, and the features that compare with it.

    The joined tables hold one row per heavy player, or one per session type of it: a
    few for each of at most rows / max_group_rows players.
    """
    keys = ["player", "session_type"]
    wanted = {f"_q75_{m}": (m, BASELINE_PROB) for m in metrics}
    if "taper_matches" in groups:
        wanted |= {f"_q67_{m}": (m, TAPER_PROB) for m in tapers}
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_like"),
        F.avg(training_load()).alias("_mean_load"),
        F.avg("high_speed_distance").alias("_mean_hsd") if "taper_matches" in groups else F.lit(None).alias("_mean_hsd"),
    )
    # Only matches can be strong; the others' bars serve the baseline alone.
    compared = df if "baseline" in groups else df.filter(is_match())
    stats = stats.join(select_by_rank(compared, keys, wanted, F.lit(1)), keys, "left")
    stats = stored(stats)
    marks = {}
    if "good_matches" in groups:
        for m in PERFORMANCE_METRICS:
            marks[f"good_{m}"] = good_match(is_match(), F.col("_like"), F.col(m) >= F.col(f"_q75_{m}"))
    if "taper_matches" in groups:
        above = is_match() & (F.col("_like") >= TAPER_MIN_MATCHES)
        for m in tapers:
            above = above & (F.col(m) >= F.col(f"_q67_{m}"))
        marks["taper_good"] = F.coalesce(above, F.lit(False))
    bars = stats.drop("_mean_load", "_mean_hsd")
    if marks:
        bars = stored(bars.join(_marked(df, bars, stats, marks, keys), "player"))
    # The only join of whole rows with what is known of their player.
    df = joined(df, bars, keys)
    if "baseline" in groups:
        df = df.withColumns(
            {f"{m}_vs_baseline": vs_baseline(F.col(m), F.col(f"_q75_{m}"), F.col("_like")) for m in metrics}
        )
    df = df.withColumns(marks).drop("_like", *wanted)
    for g in marks:
        enough = F.col(f"_n_{g}") >= (TAPER_MIN_GOOD if g == "taper_good" else ZONE_MIN_GOOD)
        if g == "taper_good":
            enough = enough & (F.col("_sessions") >= TAPER_MIN_SESSIONS)
        df = df.withColumn(g, F.col(g) & enough)
    df = df.drop("_sessions", *[f"_n_{g}" for g in marks])
    # Where the join is a shuffle, it runs once and is gone before the next one.
    return stored(df) if marks and bars.count() > hotspots.BROADCAST_ROWS else df


def _marked(df: DataFrame, bars: DataFrame, stats: DataFrame, marks: dict[str, Column], keys: list[str]) -> DataFrame:
    """Per player: marked sessions, all sessions and means of training."""
    means = stats.filter(is_training()).select(
        "player", F.col("_mean_load").alias("mean_load"), F.col("_mean_hsd").alias("mean_hsd")
    )
    totals = stats.groupBy("player").agg(F.sum("_like").alias("_sessions"))
    counted = [F.count_if(F.col(g)).alias(f"_n_{g}") for g in marks]
    found = joined(df.filter(is_match()), bars, keys).withColumns(marks).groupBy("player").agg(*counted)
    found = totals.join(found, "player", "left").join(means, "player", "left")
    return found.withColumns({f"_n_{g}": F.coalesce(f"_n_{g}", F.lit(0)) for g in marks})


def _dates(df: DataFrame, groups: set[str], unit: int) -> DataFrame:
    """Per player and date: what the windows over time need, already looked up."""
    held: dict[str, Column] = {
        "_rows": F.count(F.lit(1)),
        "_load": F.sum(training_load()),
        "_trainings": F.count_if(is_training()),
        "_matches": F.count_if(is_match()),
    }
    if "speed" in groups:
        for kind in SESSION_TYPES:
            like = F.col("session_type") == kind
            held[f"_fastest_{kind}"] = F.max(F.when(like, F.col("top_speed")))
            held[f"_peers_{kind}"] = F.count_if(like)
    if "good_matches" in groups:
        held |= {f"_good_{m}": F.count_if(F.col(f"good_{m}")) for m in PERFORMANCE_METRICS}
    if "taper_matches" in groups:
        held["_good"] = F.count_if("taper_good")
    dates = df.groupBy("player", "t").agg(*[c.alias(n) for n, c in held.items()])
    if unit > 1:
        return _instants(stored(dates), groups, unit, max_group_rows(df.sparkSession))
    # Frames reach at most CHRONIC_DAYS back or PRE_MATCH_DAYS ahead, so a date is also seen by the spans
    # beside its own, as far as frames of theirs reach.
    span = CHRONIC_DAYS * unit
    dates = stored(dates.withColumn("_span", F.floor(F.col("t") / span)))
    back = span if "training_load" in groups else SPEED_DAYS * unit if "speed" in groups else 0
    ahead = PRE_MATCH_DAYS * unit if groups & {"good_matches", "taper_matches"} else 0
    inside = F.col("t") - F.col("_span") * span
    sides = [F.when(inside < ahead, F.col("_span") - 1), F.when(inside >= span - back, F.col("_span") + 1)]
    near = dates.withColumn("_home", F.explode(F.array_compact(F.array(F.col("_span"), *sides))))
    home = W.partitionBy("player", "_home")
    axis = home.orderBy("t")
    match_t = F.when(F.col("_matches") > 0, F.col("t"))
    new: dict[str, Column] = {}
    if "training_load" in groups:
        for name, days in (("acute", ACUTE_DAYS), ("chronic", CHRONIC_DAYS)):
            new[f"_{name}"] = F.sum("_load").over(axis.rangeBetween(1 - days * unit, -1))
    if "match_days" in groups:
        new["prev_match"] = F.max(match_t).over(axis.rowsBetween(*PAST))
        new["next_match"] = F.min(match_t).over(home.orderBy(F.desc("t")).rowsBetween(*PAST))
    if "speed" in groups:
        week = axis.rangeBetween(-SPEED_DAYS * unit, 0)
        for kind in SESSION_TYPES:
            new[f"_fastest_{kind}"] = F.max(f"_fastest_{kind}").over(week)
            new[f"_peers_{kind}"] = F.sum(f"_peers_{kind}").over(week)
    if "good_matches" in groups:
        week = axis.rangeBetween(1, PRE_MATCH_DAYS * unit)
        new |= {
            f"ahead_{m}": F.coalesce(F.sum(f"_good_{m}").over(week), F.lit(0)) for m in PERFORMANCE_METRICS
        }
    if "taper_matches" in groups:
        for k in range(1, PRE_MATCH_DAYS + 1):
            there = axis.rangeBetween(*days_before_frame(k, unit))
            new[f"ahead_{k}"] = F.coalesce(F.sum("_good").over(there), F.lit(0))
    dates = near.withColumns(new).filter("_home = _span").drop("_home")
    if "training_load" in groups:
        inside = W.partitionBy("player", "_span").orderBy("t").rowsBetween(*PAST)
        for name in ("acute", "chronic"):
            own = F.when(F.col("_trainings") > 0, add_present(F.col(f"_{name}"), F.col("_load")))
            dates = dates.withColumn(f"_{name}_own", own)
            dates = dates.withColumn(f"_{name}_carried", F.last(f"_{name}_own", ignorenulls=True).over(inside))
    return _with_overall(_beyond_spans(stored(dates), groups, match_t), groups)


def _instants(dates: DataFrame, groups: set[str], unit: int, limit: int) -> DataFrame:
    """The same with one row per instant: a day may hold any number of them, so every frame goes by pieces."""
    match_t = F.when(F.col("_matches") > 0, F.col("t"))
    frames: list[tuple[tuple[int, int], Aggregates]] = []
    if "training_load" in groups:
        for name, days in (("acute", ACUTE_DAYS), ("chronic", CHRONIC_DAYS)):
            frames.append(((1 - days * unit, -1), {f"_{name}": ("sum", F.col("_load"))}))
    if "speed" in groups:
        week = {f"_fastest_{k}": ("max", F.col(f"_fastest_{k}")) for k in SESSION_TYPES}
        week |= {f"_peers_{k}": ("sum", F.col(f"_peers_{k}")) for k in SESSION_TYPES}
        frames.append(((-SPEED_DAYS * unit, 0), week))
    if "good_matches" in groups:
        ahead = {f"ahead_{m}": ("sum", F.col(f"_good_{m}")) for m in PERFORMANCE_METRICS}
        frames.append(((1, PRE_MATCH_DAYS * unit), ahead))
    if "taper_matches" in groups:
        for k in range(1, PRE_MATCH_DAYS + 1):
            frames.append((days_before_frame(k, unit), {f"ahead_{k}": ("sum", F.col("_good"))}))
    found = dates
    for (low, high), aggregates in frames:
        there = over_range(dates, "player", "t", low, high, aggregates, limit)
        found = found.drop(*aggregates).join(there.hint("merge"), ["player", "t"], "left")
    found = found.withColumns({c: F.coalesce(c, F.lit(0)) for c in found.columns if c.startswith("ahead_")})
    carried: Aggregates = {}
    if "training_load" in groups:
        for name in ("acute", "chronic"):
            own = F.when(F.col("_trainings") > 0, add_present(F.col(f"_{name}"), F.col("_load")))
            found = found.withColumn(f"_{name}_own", own)
            carried[f"_{name}_carried"] = ("last", F.col(f"_{name}_own"))
    if "match_days" in groups:
        carried["prev_match"] = ("max", match_t)
    if carried:
        found = running(in_pieces(found, ["player", "t"], limit), ["player"], ["t"], carried, own=False)
        if "match_days" in groups:
            found = running(found, ["player"], ["t"], {"next_match": ("min", match_t)}, backwards=True, own=False)
        found = found.drop(PIECE)
    return _with_overall(stored(found), groups)


def _beyond_spans(dates: DataFrame, groups: set[str], match_t: Column) -> DataFrame:
    """What reaches over the spans: the nearest match and loads carried on."""
    held: dict[str, Column] = {}
    if "match_days" in groups:
        held |= {"_last_match": F.max(match_t), "_first_match": F.min(match_t)}
    if "training_load" in groups:
        for name in ("acute", "chronic"):
            own = F.col(f"_{name}_own")
            held[f"_{name}_last"] = F.max_by(own, F.when(own.isNotNull(), F.col("t")))
    if held:
        # One row per player and span.
        before = W.partitionBy("player").orderBy("_span").rowsBetween(*PAST)
        after = W.partitionBy("player").orderBy(F.desc("_span")).rowsBetween(*PAST)
        spans = dates.groupBy("player", "_span").agg(*[c.alias(n) for n, c in held.items()])
        if "match_days" in groups:
            spans = spans.withColumns(
                {"_last_match": F.max("_last_match").over(before), "_first_match": F.min("_first_match").over(after)}
            )
        if "training_load" in groups:
            spans = spans.withColumns({f"_{n}_last": F.last(f"_{n}_last", ignorenulls=True).over(before) for n in ("acute", "chronic")})
        dates = joined(dates, stored(spans), ["player", "_span"])
        if "match_days" in groups:
            dates = dates.withColumns(
                {"prev_match": F.greatest("prev_match", "_last_match"), "next_match": F.least("next_match", "_first_match")}
            )
        if "training_load" in groups:
            dates = dates.withColumns({f"_{n}_carried": F.coalesce(f"_{n}_carried", f"_{n}_last") for n in ("acute", "chronic")})
        dates = dates.drop(*held)
    return dates


def _with_overall(dates: DataFrame, groups: set[str]) -> DataFrame:
    """Facts of the whole player; what served the windows goes."""
    overall: dict[str, Column] = {}
    if "training_load" in groups:
        overall["n_training"] = F.sum("_trainings")
    if "good_matches" in groups:
        for m in PERFORMANCE_METRICS:
            overall[f"prepared_{m}"] = F.max((F.col("_trainings") > 0) & (F.col(f"ahead_{m}") > 0))
    if overall:
        dates = joined(dates, stored(dates.groupBy("player").agg(*[c.alias(n) for n, c in overall.items()])), ["player"])
    spent = ["_span", "_load", "_trainings", "_matches", "_good", "_acute_own", "_chronic_own"]
    return dates.drop(*spent, *[f"_good_{m}" for m in PERFORMANCE_METRICS])


def _positions(rows: Callable[[], DataFrame], groups: set[str], limit: int) -> DataFrame:
    """``_at``: 0-based position in the player's history; running training load of the date."""
    order = ["t", *TIE_BREAK]
    pieces = in_pieces(rows, ["player", *order], limit)
    before = {"_at": ("sum", F.lit(1))}
    df = running(pieces, ["player"], order, before)
    df = df.withColumn("_at", F.col("_at") - 1)
    if "training_load" not in groups:
        return df.drop(PIECE)
    today = {"_today": ("sum", training_load()), "_trained": ("sum", is_training().cast("int"))}
    df = running(df, ["player", "t"], order, today).drop(PIECE).withColumn("_trained", F.col("_trained") > 0)
    return df.withColumns(
        {
            f"training_{name}_load": F.coalesce(
                F.when(F.col("_trained"), add_present(F.col(f"_{name}"), F.col("_today"))), F.col(f"_{name}_carried")
            )
            for name in ("acute", "chronic")
        }
    )


def _row_frames(df: DataFrame, groups: set[str], limit: int) -> DataFrame:
    """Frames over a number of rows, on blocks of ``limit`` consecutive positions."""
    block = F.floor(F.col("_at") / limit)
    reach = CHRONIC_ROWS - 1
    goes_on = F.col("_at") % limit >= limit - reach
    df = df.withColumn("_home", block).withColumn(
        "_block", F.explode(F.when(goes_on, F.array(block, block + 1)).otherwise(F.array(block)))
    )
    rows = W.partitionBy("player", "_block").orderBy("_at")
    if "row_load" in groups:
        df = df.withColumns(row_load(rows))
    if "target" in groups:
        df = df.withColumn("rolling_avg", F.avg("distance_per_min").over(rows.rowsBetween(1 - TARGET_ROWS, 0)))
    df = df.filter("_block = _home")
    if "label" not in groups:
        return df
    like = W.partitionBy("player", "_block", "session_type").orderBy("_at")
    first = F.min_by(F.struct("speed_decline"), F.col("_at")).alias("_first")
    firsts = df.groupBy("player", "session_type", "_block").agg(first)
    # One row per block and type.
    chain = W.partitionBy("player", "session_type").orderBy("_block")
    firsts = stored(firsts.select("player", "session_type", "_block", F.lead("_first").over(chain).alias("_following")))
    df = joined(df, firsts, ["player", "_block", "session_type"]).withColumns(
        {"_next": F.lead(F.struct("speed_decline")).over(like)}
    )
    return df.withColumn("next_speed_decline", F.coalesce("_next", "_following")["speed_decline"])
