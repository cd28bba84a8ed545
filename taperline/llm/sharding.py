"""Shards of near-equal bytes by a k-d tree over the metadata of documents.

The tree starts with all documents and as many shards as the target asks for. A node of several shards
is cut along its widest dimension at the weighted median, that is where the bytes below come closest to
the lower half's share of shards; nodes of one shard are leaves. All nodes of a level are cut together:
histograms of bytes narrow each node's cut down to a cell of few rows, and only that cell is ordered.
Rows within two largest ones of the cut go to the side where they fit, large ones first, so that long
documents do not unbalance the halves. Texts are read once; the levels work on a compact table.

What special input gives: a null text has no bytes; null metadata come before all other values; rows that
agree in a dimension are ordered by a hash of text and doc_id, so ties spread evenly, and repeated rows by
their place in the input. Every row gets one shard and one slot, also without a doc_id. Fewer rows than
shards, or a document larger than the target, leave shards empty or uneven by that document. Columns of
the input other than those named are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taperline.llm.common import discard, stored

#: What each document weighs besides its text.
ROW_BYTES = 16
#: Cells of a histogram; a cut's cell of at most so many rows is ordered in one task.
BINS, SORTED_ROWS = 1024, 20_000
#: Slots of a shard are dealt by tasks of about so many rows.
SLOT_ROWS = 100_000
#: Dimensions of the tree: strings by their order, numbers by their logarithm.
DIMENSIONS = ("lang", "source", "size")
#: The order of rows along a dimension: coordinate, then hash, then place in the input.
KEY = ("at", "tie", "row")
NODE = ["first", "n_shards"]


def weighed(documents: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """One compact row per document: size, checksum, the named metadata, and a place that tells equal rows apart."""
    text = F.coalesce("text", F.lit(""))
    weight = (F.octet_length(text) + ROW_BYTES).cast("long")
    named = [F.col(f"`{d}`").alias(f"raw_{i}") if d != "size" else weight.alias(f"raw_{i}") for i, d in enumerate(dimensions)]
    rows = documents.select("doc_id", weight.alias("size"), F.crc32(text).alias("text_crc32"), *named)
    # 52 bits, so that doubles hold the hash.
    tie = F.shiftrightunsigned(F.xxhash64("text_crc32", "doc_id"), 12)
    return rows.withColumns({"tie": tie, "row": F.monotonically_increasing_id()})


def coordinate(value: Column, low: object, high: object) -> Column:
    """A number that never decreases with the value; nulls come first."""
    if isinstance(low, str):
        # The first seven bytes behind what all values begin with.
        one, two = low.encode(), high.encode()
        shared = next((i for i, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))
        part = F.substring(F.encode(value, "UTF-8"), shared + 1, 7)
        found = F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("long")
    else:
        found = (F.log2(value.cast("double") - F.lit(float(low or 0)) + 1.0) * float(1 << 40)).cast("long")
    return F.coalesce(found, F.lit(-1))


def with_coordinates(items: DataFrame, dimensions: tuple[str, ...]) -> tuple[DataFrame, list[int]]:
    """Coordinates d0, d1, ... of all rows, and the range of each over the whole table."""
    raw = [f"raw_{i}" for i in range(len(dimensions))]
    ends = items.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in raw for f in (F.min, F.max)]).first()
    found = {f"d{i}": coordinate(F.col(c), ends[f"min_{c}"], ends[f"max_{c}"]) for i, c in enumerate(raw)}
    out = items.withColumns(found).drop(*raw)
    spans = out.agg(*[(F.max(c) - F.min(c)).alias(c) for c in found]).first()
    return out, [spans[c] or 0 for c in found]


def widest(rows: DataFrame, spans: list[int]) -> DataFrame:
    """For each node that must be cut: its widest dimension, the bytes wanted below the cut, and all of it as cell."""
    names = [f"d{i}" for i in range(len(spans))]
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]
    others = [f(c).alias(f"{'low' if f is F.min else 'high'}_{c}") for c in KEY[1:] for f in (F.min, F.max)]
    nodes = rows.filter("n_shards > 1").groupBy(*NODE).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"), *ends, *others)
    shares = F.array(*[(F.col(f"max_{c}") - F.col(f"min_{c}")) / float(max(1, span)) for c, span in zip(names, spans)])
    dim = (F.array_position(shares, F.array_max(shares)) - 1).cast("int")
    pick = lambda end: F.array(*[F.col(f"{end}_{c}") for c in names])[F.col("dim")]
    return nodes.withColumn("dim", dim).select(
        *NODE,
        "dim",
        (F.col("bytes") * F.floor(F.col("n_shards") / 2) / F.col("n_shards")).alias("wanted"),
        "n_rows",
        pick("min").alias("low_at"),
        pick("max").alias("high_at"),
        *[f"{end}_{c}" for c in KEY[1:] for end in ("low", "high")],
    )


def in_cells(rows: DataFrame, cells: DataFrame, n_dims: int) -> DataFrame:
    """Rows inside their node's cell, with the coordinate ``at`` along the node's dimension."""
    at = F.array(*[F.col(f"d{i}") for i in range(n_dims)])[F.col("dim")]
    inside = [F.col(c).between(F.col(f"low_{c}"), F.col(f"high_{c}")) for c in KEY]
    return rows.join(cells, NODE).withColumn("at", at).filter(inside[0] & inside[1] & inside[2])


def narrowed(rows: DataFrame, cells: DataFrame, n_dims: int) -> DataFrame:
    """Cells cut down to the bin of the histogram in which the wanted bytes are reached."""
    where = F.lit(0.0)
    for c in reversed(KEY):
        low, high = F.col(f"low_{c}").cast("double"), F.col(f"high_{c}").cast("double")
        place = F.floor((F.col(c).cast("double") - low) / (high - low + 1.0) * BINS).cast("double")
        where = F.when(F.col(f"low_{c}") < F.col(f"high_{c}"), place).otherwise(where)
    ends = [f(c).alias(f"{'low' if f is F.min else 'high'}_{c}") for c in KEY for f in (F.min, F.max)]
    bins = (
        in_cells(rows, cells, n_dims)
        .groupBy(*NODE, "dim", "wanted", where.alias("bin"))
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"), *ends)
    )
    below = Window.partitionBy(*NODE).orderBy("bin")
    after = Window.partitionBy(*NODE).orderBy(F.desc("bin"))
    reached = bins.withColumns({"upto": F.sum("bytes").over(below), "left": F.row_number().over(after)})
    reached = reached.filter((F.col("upto") >= F.col("wanted")) | (F.col("left") == 1))
    first = reached.withColumn("turn", F.row_number().over(below)).filter("turn = 1")
    return first.withColumn("wanted", F.col("wanted") - (F.col("upto") - F.col("bytes"))).drop("bin", "bytes", "upto", "left", "turn")


def dealt_band(rows: pa.Table) -> pa.Table:
    """Split the rows around one cut: from the largest down, each goes below as long as it fits there.

    Then rows change sides, one of the other side for one or none, as long as that leaves less room or excess.
    """
    rows = rows.take(np.lexsort((rows.column("row").to_numpy(), rows.column("size").to_numpy())))
    size, room = rows.column("size").to_numpy(), float(rows.column("room")[0].as_py())
    below = np.zeros(len(size), dtype=bool)
    for at in range(len(size) - 1, -1, -1):
        if size[at] <= room:
            below[at] = True
            room -= size[at]
    while True:
        ours, theirs = np.flatnonzero(below), np.flatnonzero(~below)
        given, taken = np.r_[0, size[ours]], np.r_[0, size[theirs]]
        near = np.searchsorted(taken, given + room)
        x = np.tile(np.arange(len(given)), 2)
        y = np.clip(np.r_[near - 1, near], 0, len(taken) - 1)
        left = room - (taken[y] - given[x])
        best = np.argmin(abs(left))
        if abs(left[best]) >= abs(room):
            return rows.append_column("below", pa.array(below))
        room = left[best]
        below[ours[x[best] - 1 : x[best]]] = False
        below[theirs[y[best] - 1 : y[best]]] = True


def cell_halves(rows: DataFrame, cells: DataFrame, n_dims: int) -> DataFrame:
    """Rows of the cells, ``below`` their cut or not: whole prefixes, and by size within two largest rows of the cut."""
    node = Window.partitionBy(*NODE)
    upto = F.sum("size").over(node.orderBy(*KEY))
    near = in_cells(rows, cells, n_dims).withColumns({"upto": upto, "reach": 2 * F.max("size").over(node)})
    gap = F.col("upto") - F.col("size") / 2 - F.col("wanted")
    side = F.when(gap < -F.col("reach"), -1).when(gap > F.col("reach"), 1).otherwise(0)
    sided = near.withColumn("side", side)
    room = F.col("wanted") - F.coalesce(F.sum(F.when(F.col("side") == -1, F.col("size"))).over(node), F.lit(0))
    sided = sided.withColumn("room", room).select(*rows.columns, "side", "room")
    band = sided.filter("side = 0").drop("side")
    kinds = T.StructType([*band.schema.fields, T.StructField("below", T.BooleanType())])
    dealt = band.groupBy(*NODE).applyInArrow(dealt_band, kinds).drop("room")
    return sided.filter("side <> 0").withColumn("below", F.col("side") < 0).drop("side", "room").unionByName(dealt)


def halves(rows: DataFrame, cells: DataFrame, n_dims: int) -> DataFrame:
    """Rows moved from the nodes that are cut to their halves."""
    at = F.array(*[F.col(f"d{i}") for i in range(n_dims)])[F.col("dim")]
    key = F.struct(at.alias("at"), "tie", "row")
    low, high = (F.struct(*[F.col(f"{end}_{c}").alias(c) for c in KEY]) for end in ("low", "high"))
    side = F.when(F.col("dim").isNull(), 2).when(key < low, -1).when(key > high, 1).otherwise(0)
    sided = rows.join(cells, NODE, "left").withColumn("side", side)
    outside = sided.filter("side <> 0").withColumn("below", F.when(F.col("side") < 2, F.col("side") < 0)).select(*rows.columns, "below")
    half = F.floor(F.col("n_shards") / 2).cast("int")
    first = F.col("first") + F.when(~F.col("below"), half).otherwise(0)
    size = F.when(F.col("below").isNull(), F.col("n_shards")).when(F.col("below"), half).otherwise(F.col("n_shards") - half)
    moved = outside.unionByName(cell_halves(rows, cells, n_dims)).withColumns({"first": first, "n_shards": size})
    return moved.select(*rows.columns)


def with_slots(rows: DataFrame) -> DataFrame:
    """Gapless places in each shard: counts of parts of a shard give where a part begins."""
    totals = rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SLOT_ROWS).alias("n_parts"))
    parts = rows.join(stored(totals, "shard-parts"), "shard").withColumn("part", F.pmod(F.xxhash64("row"), F.col("n_parts")))
    counts = stored(parts.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n_part")), "part-rows")
    order = Window.partitionBy("shard").orderBy("part")
    starts = counts.select("shard", "part", (F.sum("n_part").over(order) - F.col("n_part")).alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return parts.withColumn("place", place).join(starts, ["shard", "part"]).withColumn("slot", F.col("start") + F.col("place"))


def shard_documents(
    documents: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions: tuple[str, ...] = DIMENSIONS
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): all documents in ``shards`` shards, or in as many as ``target_bytes`` needs.

    The driver sees ends of dimensions and one number per round of a level, no rows of documents.
    """
    items = stored(weighed(documents, dimensions), "weighed")
    if shards is None:
        total = items.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    n_dims = len(dimensions)
    rows, spans = with_coordinates(items, dimensions)
    rows = stored(rows.withColumns({"first": F.lit(0), "n_shards": F.lit(int(shards))}), "nodes")
    discard(items)
    left = shards
    while left > 1:
        cells = stored(widest(rows, spans), "cells")
        ready = cells.filter(F.col("n_rows") <= SORTED_ROWS)
        wide = cells.filter(F.col("n_rows") > SORTED_ROWS)
        spent = [cells]
        while not wide.isEmpty():
            cells = stored(narrowed(rows, wide, n_dims), "cells")
            spent.append(cells)
            ready = ready.unionByName(cells.filter(F.col("n_rows") <= SORTED_ROWS))
            wide = cells.filter(F.col("n_rows") > SORTED_ROWS)
        following = stored(halves(rows, ready, n_dims), "nodes")
        discard(rows, *spent)
        rows, left = following, -(-left // 2)
    return with_slots(rows.withColumnRenamed("first", "shard")).select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_digest(sharded: DataFrame) -> DataFrame:
    """The rows with the law they keep; a tree over metadata has no place to grow a shard into."""
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return sharded.select("doc_id", "size", "text_crc32", law, F.col("shard").cast("int"), F.col("slot").cast("long"), grown)
