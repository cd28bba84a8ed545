"""Hard negatives of anchors by slots between the scores of their positives.

An anchor's positives are the rows of its label that score highest against it. Each positive opens a window
of scores up to its own. Sorted from the highest down, the positives' scores split all scores into disjoint
slots, and the window of the j-th positive covers slots j, j + 1, ... So tasks keep only the best rows of
each slot, combiners merge them, and one merge from the lowest slot upwards answers every window.

Anchors are the stated query set. They meet all rows in blocks: a block of bounded size is broadcast, every
task scores its rows against it, and only the best of each anchor and slot leave the task.

What special input gives: rows with a null label, vector or component, a component that is not finite, or
no id take no part. Components missing in the shorter of two vectors count as 0. Rows that share the
anchor's id are the anchor itself, never its positives; other repeated rows count as often as they stand
there, and a repeated anchor is answered as often. Scores beyond 64 bits stop at the ends of the range.
Anchors without positives, or windows without negatives, give no rows; nor does an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import stored

#: Bytes of quantised anchors that are broadcast together.
BLOCK_BYTES = 16 << 20
#: Anchors and rows whose scores a task holds at once.
PART, ROWS = 256, 8192
#: Merging goes in two steps, so that an anchor's lists from all tasks never meet in one.
SALTS = 64
FOUND = "anchor long, slot int, salt int, best array<struct<below: long, id: long>>"


def quantised(vectors: DataFrame, id_column: str, vector: str, label: Column) -> DataFrame:
    """(id, label, q): rows that take part, components as whole numbers of 256ths."""
    components = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(components, lambda x: F.floor(x * 256.0))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), sound.alias("sound"), whole.alias("q"))
    return rows.filter("sound AND id IS NOT NULL AND label IS NOT NULL").drop("sound")


def padded(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """A list column as a matrix; short rows end with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of two sets of whole vectors, exactly: by doubles where sums stay below 2**53."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    largest = [max(-int(m.min(initial=0)), int(m.max(initial=0))) for m in (a, b)]
    bound = width * largest[0] * largest[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


class BestLists:
    """The best (score, id) of each group seen so far: higher scores first, ties by smaller id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        #: The least score with which a row can still enter a group.
        self.least = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = (np.concatenate(p) for p in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
        kept = place < self.k
        self.least[group[place == self.k - 1]] = score[place == self.k - 1]
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]


class Block:
    """Some anchors with their vectors and, in the second pass, the scores of their positives from the highest down."""

    def __init__(self, rows: list, limits: dict[int, list[int]] | None):
        width = max((len(r["q"]) for r in rows), default=0)
        self.q = np.zeros((len(rows), width), dtype=np.int64)
        for at, r in enumerate(rows):
            self.q[at, : len(r["q"])] = r["q"]
        self.key = np.array([r["anchor"] for r in rows], dtype=np.int64)
        self.id = np.array([r["id"] for r in rows], dtype=np.int64)
        self.label = np.array([r["label"] for r in rows], dtype=np.int64)
        self.limits = None
        if limits is not None:
            self.limits = np.full((len(rows), max([1, *map(len, limits.values())])), np.iinfo(np.int64).min)
            for at, key in enumerate(self.key):
                found = limits.get(int(key), [])
                self.limits[at, : len(found)] = found


def lowest_scores(limits: np.ndarray, margin: tuple[int, int]) -> np.ndarray:
    """The least score in any window of each anchor; windows below a negative score are empty."""
    most = np.iinfo(np.int64).max
    return np.array([min((-(-u * margin[0] // margin[1]) for u in row if u >= 0), default=most) for row in limits.tolist()], dtype=np.int64)


def best_of(batches: Iterable[pa.RecordBatch], block: Block, k: int, margin: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """This task's best rows of each anchor (first pass: of its label) or of each anchor and slot (second pass)."""
    limits, slots, salt = block.limits, 1, 0
    parts = [slice(start, start + PART) for start in range(0, len(block.key), PART)]
    if limits is not None:
        slots, top, low = limits.shape[1], limits[:, 0], lowest_scores(limits, margin)
    lists = [BestLists(PART * slots, k) for _ in parts]
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        q, ids, labels = padded(batch.column("q")), batch.column("id").to_numpy(), batch.column("label").to_numpy()
        salt = salt or int(ids[0]) % SALTS
        for part, best in zip(parts, lists):
            scores = products(block.q[part], q)
            same = block.label[part, None] == labels[None, :]
            if limits is None:
                # Each anchor is one group.
                a, b = np.nonzero(same & (block.id[part, None] != ids[None, :]) & (scores >= best.least[: len(scores), None]))
                best.add(a, scores[a, b], ids[b])
                continue
            a, b = np.nonzero(~same & (scores <= top[part, None]) & (scores >= low[part, None]))
            found = scores[a, b]
            # The slot of a score: how many positives score at least as much, less one.
            group = a * slots + (limits[part][a] >= found[:, None]).sum(axis=1) - 1
            enters = found >= best.least[group]
            best.add(group[enters], found[enters], ids[b][enters])
    for part, best in zip(parts, lists):
        starts = np.flatnonzero(np.diff(best.group, prepend=-1))
        group = best.group[starts]
        entries = pa.StructArray.from_arrays([pa.array(-best.score), pa.array(best.id)], ["below", "id"])
        found = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(best.group)].astype(np.int32)), entries)
        columns = [block.key[part][group // slots], (group % slots).astype(np.int32), np.full(len(group), salt, dtype=np.int32)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), found], ["anchor", "slot", "salt", "best"])


def first_of(lists: Column, k: int) -> Column:
    """The first k of a list of (score below zero, id)."""
    return F.slice(F.array_sort(lists), 1, k)


def merged(found: DataFrame, k: int) -> DataFrame:
    """(anchor, slot, best): the lists of all tasks as one."""
    for keys in (["anchor", "slot", "salt"], ["anchor", "slot"]):
        found = found.groupBy(*keys).agg(first_of(F.flatten(F.collect_list("best")), k).alias("best"))
    return found


def searched(rows: DataFrame, block: Block, k: int, margin: tuple[int, int]) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(block)
    return merged(rows.mapInArrow(lambda batches: best_of(batches, sent.value, k, margin), FOUND), k)


def windows_of(positives: DataFrame, slots: DataFrame, k: int, margin: tuple[int, int]) -> DataFrame:
    """(anchor, positive, negatives) for each positive, by one merge of an anchor's slots from the lowest up."""
    found = slots.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("slots"))
    both = positives.join(found, "anchor")
    empty = F.slice("positives", 1, 0)

    def step(state: Column, slot: Column) -> Column:
        # Slots count from 0 by positives of at least a score; equal positives share the last one's slot.
        own = F.coalesce(F.try_element_at("slots", slot), empty)
        suffix = first_of(F.concat(own, state["suffix"]), k)
        return F.struct(suffix.alias("suffix"), F.concat(state["answers"], F.array(suffix)).alias("answers"))

    start = F.struct(empty.alias("suffix"), F.slice(F.array(empty), 1, 0).alias("answers"))
    downwards = F.sequence(F.size("positives") - 1, F.lit(0), F.lit(-1))
    answers = F.reverse(F.aggregate(downwards, start, step, lambda s: s["answers"]))
    pairs = F.explode(F.arrays_zip(F.col("positives").alias("positive"), answers.alias("best")))
    each = both.select("anchor", pairs.alias("pair")).select("anchor", "pair.positive", "pair.best")
    times = lambda score, factor: score.cast("decimal(20,0)") * F.lit(factor)
    high_enough = lambda x: times(F.col("positive.below"), margin[0]) >= times(x["below"], margin[1])
    return each.select("anchor", "positive", F.filter("best", high_enough).alias("negatives"))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    margin: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    ``anchors`` says over ``id`` which rows ask. A positive's negatives are the best rows of other labels that
    score at most as much as it does, and at least margin[0] / margin[1] of that.
    """
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, id_column, vector, label), "quantised")
    asked = rows.filter(anchors).withColumn("anchor", F.monotonically_increasing_id())
    sizes = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("width")).first()
    per_block = max(1, BLOCK_BYTES // (8 * max(1, sizes["width"] or 0)))
    n_blocks = -(-sizes["n"] // per_block)
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(max(1, n_blocks)))), "anchors")
    out = None
    for number in range(n_blocks):
        here = asked.filter(F.col("block") == number).collect()  # about BLOCK_BYTES
        own = stored(searched(rows, Block(here, None), positives, margin).select("anchor", F.col("best").alias("positives")), "positives")
        limits = {r["anchor"]: [-p["below"] for p in r["positives"]] for r in own.collect()}
        best = windows_of(own, searched(rows, Block(here, limits), negatives, margin), negatives, margin)
        answered = best.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        part = answered.select("anchor_id", "positive", F.posexplode("negatives").alias("at", "negative"))
        part = part.select(
            "anchor_id",
            F.col("positive.id").alias("positive_id"),
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("negative.id").alias("negative_id"),
            (-F.col("positive.below")).alias("positive_score"),
            (-F.col("negative.below")).alias("negative_score"),
        )
        part = part if n_blocks == 1 else stored(part, "negatives")
        out = part if out is None else out.unionByName(part)
    if out is None:
        columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], columns)
    return out
