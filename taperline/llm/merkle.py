"""Merkle manifest of a dataset: every row's proof up to one root, by a butterfly exchange between partitions.

Rows are leaves, ordered by key within their group (here the language). Leaves are dealt to aligned blocks
of fanout**b consecutive ones, so each block is a whole subtree that one task hashes. Then blocks trade the
roots of their subtrees round by round: in round r the fanout aligned sets of fanout**r blocks that meet in
one ancestor swap roots, each block with one partner in every other set. All of them hash the ancestor
themselves, redundantly, and keep the partners' roots as the next siblings of their proofs. After a
logarithmic number of rounds every block holds the root and all upper siblings, and no pass goes back down.
The groups' own roots are then swapped in the same way, each block standing for its group.

What special input gives: nulls are written as ``-``; rows without a key come first in their group, rows
with one key are ordered by their leaves, so equal rows are interchangeable. The null group comes first, the
others in order of their UTF-8 bytes. A group of one row has its leaf as root, a table of one group that
group's root. An empty table gives no rows. Columns other than those named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taperline.llm.common import discard, stored

#: Leaves of a block, at least; rounded down to a power of the fanout.
BLOCK_LEAVES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = "array<struct<left: string, right: string>>"
BLOCK = ["group_at", "block"]


@dataclass
class Manifest:
    """``leaves``: one row per input row with its place; ``blocks``: for each block the upper part of its proofs."""

    leaves: DataFrame
    blocks: DataFrame
    fanout: int
    block_leaves: int


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]).cast("binary"), 256)


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def counted(batches):
    """Adds each row's place among the rows of its group in this task's sorted rows."""
    group, seen = object(), 0
    for batch in batches:
        places = []
        for value in batch.column("group").to_pylist():
            seen = seen + 1 if value == group else 0
            group = value
            places.append(seen)
        yield batch.append_column("at", pa.array(places, pa.int64()))


def ordered_leaves(rows: DataFrame, key: Column, group: Column, extra: dict[str, Column], leaf: Column) -> DataFrame:
    """Leaves with ``group_at``, ``index`` and ``n_leaves``: places by ranges of the order and counts of each range's groups."""
    # The byte order of groups, null first; the row number tells equal rows apart when ranges are cut.
    named = rows.select(F.encode(group.cast("string"), "UTF-8").alias("group"), key.alias("key"), leaf.alias("leaf"), *[c.alias(n) for n, c in extra.items()])
    order = ["group", "key", "leaf", "row"]
    ranged = named.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    schema = f"{ranged._jdf.schema().toDDL()}, at long"
    pieces = ranged.mapInArrow(counted, schema).withColumn("piece", F.spark_partition_id())
    pieces = stored(pieces, "leaves")
    counts = stored(pieces.groupBy("group", "piece").agg(F.count(F.lit(1)).alias("n")), "pieces")
    groups = counts.groupBy("group").agg(F.sum("n").alias("n_leaves"))
    # One row per group or piece of a group.
    numbered = stored(groups.withColumn("group_at", F.row_number().over(Window.orderBy("group")).cast("long") - 1), "groups")
    before = F.sum("n").over(Window.partitionBy("group").orderBy("piece")) - F.col("n")
    starts = stored(counts.withColumn("start", before).drop("n"), "starts")
    same = pieces["group"].eqNullSafe(starts["group"]) & (pieces["piece"] == starts["piece"])
    placed = pieces.join(starts, same).select(pieces["*"], "start")
    found = placed.join(numbered, placed["group"].eqNullSafe(numbered["group"])).select(
        placed["*"], "group_at", "n_leaves"
    )
    return found.withColumn("index", F.col("start") + F.col("at")).drop("group", "at", "piece", "start")


def levels_of(n: int, fanout: int) -> int:
    """Levels between a group's leaves and its root."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def block_levels(leaves: list[str], n_leaves: int, fanout: int, block_leaves: int) -> list[list[str]]:
    """The nodes of a block's subtree from the leaves up, as far as the block reaches in its group's tree."""
    out = [leaves]
    for _ in range(levels_of(min(n_leaves, block_leaves), fanout)):
        below = out[-1]
        out.append([digest(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return out


def block_root(fanout: int, block_leaves: int):
    def root(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("index")
        first = rows.slice(0, 1)
        top = block_levels(rows.column("leaf").to_pylist(), first.column("n_leaves")[0].as_py(), fanout, block_leaves)[-1][0]
        return first.select(["group_at", "block", "n_leaves"]).append_column("node", pa.array([top]))

    return root


def block_paths(fanout: int, block_leaves: int):
    """Full proofs of a block's leaves: its own siblings, then those that the exchange brought."""

    def paths(rows: pa.Table, upper: pa.Table) -> pa.Table:
        rows = rows.sort_by("index")
        levels = block_levels(rows.column("leaf").to_pylist(), rows.column("n_leaves")[0].as_py(), fanout, block_leaves)
        runs = []
        for nodes in levels[:-1]:
            sides = []
            for start in range(0, len(nodes), fanout):
                run = nodes[start : start + fanout]
                sides += [{"left": "".join(run[:i]), "right": "".join(run[i + 1 :])} for i in range(len(run))]
            runs.append(sides)
        above = upper.column("path")[0].as_py()
        found = []
        for at in range(rows.num_rows):
            path = []
            for sides in runs:
                path.append(sides[at])
                at //= fanout
            found.append(path + above)
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        n = rows.num_rows
        for name in ("subroot", "root"):
            rows = rows.append_column(name, pa.array([upper.column(name)[0].as_py()] * n, pa.string()))
        return rows.append_column("path", pa.array(found, kind))

    return paths


def exchanged(state: DataFrame, partners: DataFrame, fanout: int, at: Column, n: Column, size: int) -> DataFrame:
    """One round: every block learns the roots of the other sets of its run and hashes the run itself.

    ``partners``: (group_at, block, part, other_group, other_block), the sets of the run but the own one, with the
    block of each that answers.
    """
    answers = state.select(F.col("group_at").alias("other_group"), F.col("block").alias("other_block"), F.col("node").alias("other"))
    told = partners.join(answers, ["other_group", "other_block"])
    heard = told.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(F.struct("part", "other"))).alias("others"))
    own = (F.floor(at / size) % fanout).cast("long")
    side = lambda keep: F.concat_ws("", F.transform(F.filter("others", keep), lambda x: x["other"]))
    both = state.join(heard, BLOCK, "left").withColumns({"left": side(lambda x: x["part"] < own), "right": side(lambda x: x["part"] > own)})
    # A group whose nodes have become one takes no further part.
    active = F.ceil(n / size) > 1
    run = F.struct(F.coalesce("left", F.lit("")).alias("left"), F.coalesce("right", F.lit("")).alias("right"))
    node = F.sha2(F.concat(run["left"], F.col("node"), run["right"]).cast("binary"), 256)
    path = F.concat("path", F.array(run))
    changed = {"node": F.when(active, node).otherwise(F.col("node")), "path": F.when(active, path).otherwise(F.col("path"))}
    return both.withColumns(changed).select(*state.columns)


def other_parts(state: DataFrame, fanout: int, at: Column, n: Column, size: int) -> DataFrame:
    """(.., part, low, n_there) for each other set of the run: where it begins and how many members it has."""
    run = F.floor(at / (size * fanout)) * fanout
    parts = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(fanout - 1).cast("long")), lambda p: ((run + p) * size < n) & ((run + p) != F.floor(at / size)))
    each = state.withColumn("part", F.explode(parts))
    low = (F.floor(at / (size * fanout)) * fanout + F.col("part")) * size
    return each.withColumn("low", low).withColumn("n_there", F.least(F.lit(size), n - F.col("low")))


def upper_proofs(blocks: DataFrame, fanout: int, block_leaves: int) -> DataFrame:
    """(group_at, block, path, subroot, root) by the exchange over (group_at, block, n_leaves, node).

    Two phases with a round per level: between the blocks of each group, then between groups, in which each
    block stands for its group. The requests to a set are spread evenly over its members.
    """
    n_blocks = F.ceil(F.col("n_leaves") / block_leaves).cast("long")
    state = stored(blocks.withColumns({"n_blocks": n_blocks, "path": F.array().cast(RUN)}).drop("n_leaves"), "butterfly")
    most = state.agg(F.max("n_blocks"), F.max("group_at")).first()
    size = 1
    while size < (most[0] or 0):
        parts = other_parts(state, fanout, F.col("block"), F.col("n_blocks"), size)
        other = (F.col("low") + F.col("block") % F.col("n_there")).alias("other_block")
        partners = parts.select(*BLOCK, "part", F.col("group_at").alias("other_group"), other)
        state = swapped(state, exchanged(state, partners, fanout, F.col("block"), F.col("n_blocks"), size))
        size *= fanout
    state = swapped(state, state.withColumn("subroot", F.col("node")))
    groups = 1 + (most[1] if most[1] is not None else -1)
    sizes = stored(state.filter("block = 0").select(F.col("group_at").alias("other_group"), F.col("n_blocks").alias("n_other")), "group-blocks")
    size = 1
    while size < groups:
        parts = other_parts(state, fanout, F.col("group_at"), F.lit(groups), size)
        chosen = parts.withColumn("other_group", F.col("low") + (F.col("group_at") + F.col("block")) % F.col("n_there"))
        partners = chosen.join(sizes, "other_group").select(*BLOCK, "part", "other_group", (F.col("block") % F.col("n_other")).alias("other_block"))
        state = swapped(state, exchanged(state, partners, fanout, F.col("group_at"), F.lit(groups), size))
        size *= fanout
    return state.select(*BLOCK, "path", "subroot", F.col("node").alias("root"))


def swapped(before: DataFrame, after: DataFrame) -> DataFrame:
    out = stored(after, "butterfly")
    discard(before)
    return out


def manifest(
    rows: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: Sequence[str] = FIELDS,
    extra: dict[str, Column] | None = None,
    fanout: int = 2,
    block_leaves: int = BLOCK_LEAVES,
) -> Manifest:
    """Leaves in order with their blocks, and the upper proofs of all blocks.

    ``extra`` columns over the input, by name, travel with the leaves.
    """
    per_block = fanout
    while per_block * fanout <= block_leaves:
        per_block *= fanout
    leaf = leaf_digest([F.col(f"`{f}`") for f in fields])
    leaves = ordered_leaves(rows, F.col(f"`{key}`"), F.col(f"`{group}`"), extra or {}, leaf)
    leaves = stored(leaves.withColumn("block", F.floor(F.col("index") / per_block)), "ordered")
    kinds = "group_at long, block long, n_leaves long, node string"
    named = leaves.select("group_at", "block", "n_leaves", "index", "leaf")
    blocks = named.groupBy(*BLOCK).applyInArrow(block_root(fanout, per_block), kinds)
    return Manifest(leaves, upper_proofs(blocks, fanout, per_block), fanout, per_block)


def proofs(found: Manifest) -> DataFrame:
    """Every leaf with its whole proof: ``path`` has, per level, the hashes left and right of the own node."""
    kinds = f"{found.leaves._jdf.schema().toDDL()}, subroot string, root string, path {RUN}"
    ours, upper = found.leaves.groupBy(*BLOCK), found.blocks.groupBy(*BLOCK)
    return ours.cogroup(upper).applyInArrow(block_paths(found.fanout, found.block_leaves), kinds)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(run["left"], node, run["right"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the lowest level up, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda run: F.concat(run["left"], run["right"]))).cast("binary"), 256)


def tamper_digest(documents: DataFrame) -> DataFrame:
    """Proofs of all documents, checked against rows of which some were altered after the manifest was made.

    Where 7 divides the CRC-32 of the decimal doc_id, n_chars is one more than it was; null stays null.
    """
    altered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    claimed = [F.when(altered, F.col(f) + 1).otherwise(F.col(f)) if f == "n_chars" else F.col(f) for f in FIELDS]
    seen = {"claimed": leaf_digest(claimed), "doc_id": F.col("doc_id")}
    rows = proofs(manifest(documents, extra=seen))
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("claimed"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
