"""Running aggregates and range frames of groups too long for one task.

Rows are cut into pieces of consecutive rows. A running aggregate is that of the piece so far, combined
with what earlier pieces of the group hold: one row per group and piece. A frame over a range of times of
fixed length L falls into at most two of the blocks [i L, (i + 1) L), so it is the end of one block and
the beginning of the next: two running aggregates. The work grows with the rows, not with the frame.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.operators.hotspots import BROADCAST_ROWS, stored, stored_alone

PIECE = "_piece"
#: Pieces hold the given number of rows at least; beyond so many pieces, at least so many rows.
PIECES, PIECE_ROWS = 64, 200_000
MERGE = {"sum": F.sum, "max": F.max, "min": F.min}
#: name -> (how, value): ``sum``, ``max``, ``min``, or ``last`` value that is not null.
Aggregates = dict[str, tuple[str, Column]]


def in_pieces(rows: DataFrame | Callable[[], DataFrame], order: list[str], limit: int) -> DataFrame:
    """Stored rows with the number of their piece: ranges of ``order`` of about ``limit`` rows, or more of many rows.

    Each piece is a task, and the driver draws a hundred rows for each to find their bounds. The rows are
    stored before, so what made them runs once and its shuffles are gone when they are dealt out. Tables that
    a function stores to make the rows go too.
    """

    def dealt() -> DataFrame:
        held = stored_alone(rows) if callable(rows) else stored(rows)
        n_rows = held.count()
        n = max(1, min(-(-n_rows // limit), max(PIECES, -(-n_rows // PIECE_ROWS))))
        return held.repartitionByRange(n, *order).withColumn(PIECE, F.spark_partition_id())

    return stored_alone(dealt)


def running(pieces: DataFrame, keys: list[str], order: list[str], aggregates: Aggregates, backwards: bool = False, own: bool = True) -> DataFrame:
    """Each row with the aggregates of its group's rows up to it; ``own`` counts it in, ``backwards`` starts at the end.

    ``pieces`` are ranges of ``keys`` and ``order`` (the order may go on beyond them), no two rows share these.
    """
    ordered = [F.desc(c) if backwards else F.asc(c) for c in order]
    inside = W.partitionBy(*keys, PIECE).orderBy(*ordered).rowsBetween(W.unboundedPreceding, 0 if own else -1)
    across = W.partitionBy(*keys).orderBy(F.desc(PIECE) if backwards else F.asc(PIECE)).rowsBetween(W.unboundedPreceding, -1)
    here, totals, carried, both = {}, {}, {}, {}
    for name, (how, value) in aggregates.items():
        if how == "last":
            newest = F.min_by if backwards else F.max_by
            place = F.when(value.isNotNull(), F.struct(*order))
            here[f"_{name}_here"] = F.last(value, ignorenulls=True).over(inside)
            totals[f"_{name}_all"] = newest(value, place)
            carried[f"_{name}_before"] = F.last(f"_{name}_all", ignorenulls=True).over(across)
            both[name] = F.coalesce(f"_{name}_here", f"_{name}_before")
            continue
        here[f"_{name}_here"] = MERGE[how](value).over(inside)
        totals[f"_{name}_all"] = MERGE[how](value)
        carried[f"_{name}_before"] = MERGE[how](f"_{name}_all").over(across)
        one, two = F.col(f"_{name}_here"), F.col(f"_{name}_before")
        if how == "sum":
            both[name] = F.when(one.isNull(), two).when(two.isNull(), one).otherwise(one + two)
        else:
            both[name] = (F.greatest if how == "max" else F.least)(one, two)
    # A piece cuts one group at most, so no more rows than pieces have something before them.
    before = pieces.groupBy(*keys, PIECE).agg(*[c.alias(n) for n, c in totals.items()]).withColumns(carried)
    before = before.filter(F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in carried], F.lit(False)))
    named = {c: f"_of_{c}" for c in [*keys, PIECE]}
    before = stored(before.select(*[F.col(c).alias(n) for c, n in named.items()], *carried))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in named.items()])
    both_sides = pieces.withColumns(here).join(before.hint("broadcast" if before.count() <= BROADCAST_ROWS else "merge"), same, "left")
    return both_sides.withColumns(both).drop(*here, *carried, *named.values())


def over_range(rows: DataFrame, key: str, at: str, low: int, high: int, aggregates: Aggregates, limit: int) -> DataFrame:
    """(key, at, aggregates over the rows of the key between ``at`` + low and ``at`` + high, both included).

    One row per key and time. Sums and extremes only.
    """
    length = high - low + 1
    values = [value.alias(name) for name, (_, value) in aggregates.items()]
    nothing = [F.lit(None).cast(rows.select(v).schema[0].dataType).alias(v_name) for v, v_name in zip(values, aggregates)]
    asked = F.col(at).alias("_for")
    data = rows.select(key, asked, F.col(at).alias("_time"), F.lit(0).alias("_end"), *values)
    first = rows.select(key, asked, (F.col(at) + low).alias("_time"), F.lit(-1).alias("_end"), *nothing)
    last = rows.select(key, asked, (F.col(at) + high).alias("_time"), F.lit(1).alias("_end"), *nothing)
    # At one time, the rows stand between the frames that begin there and those that end there.
    events = data.unionByName(first).unionByName(last).withColumn("_block", F.floor(F.col("_time") / F.lit(length)))
    keys, order = [key, "_block"], ["_time", "_end", "_for"]
    pieces = in_pieces(events, [*keys, *order], limit)
    held = {name: (how, F.col(name)) for name, (how, _) in aggregates.items()}
    tails = running(pieces, keys, order, held, backwards=True).filter("_end = -1")
    heads = running(pieces, keys, order, held).filter("_end = 1")
    # A frame that is just one block is all in its tail.
    heads = heads.filter(F.floor((F.col("_for") + low) / F.lit(length)) < F.col("_block"))
    both = tails.unionByName(heads).groupBy(key, F.col("_for").alias(at))
    return both.agg(*[MERGE[how](name).alias(name) for name, (how, _) in aggregates.items()])
