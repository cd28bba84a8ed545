"""Removal of long repeated passages with a family of suffix arrays.

A byte goes if a string of 200 bytes that covers it also starts anywhere else, in the same text or in
another one. Two places of a string have the same anchors: positions whose 48 bytes have the smallest
hash of all 48-byte strings in the window. So only the suffixes at anchors are indexed (about one
position in 77), and every pair of equal strings meets at one of them, whatever its offset.

1. Each task finds its texts' anchors. An anchor's context, the 200 bytes to either side that strings
   through it can reach, has a hash; of anchors of one text with equal contexts one stays, and all of
   them are removed as repeats.
2. Anchors whose 48 bytes occur once are dropped. Of the others, those with equal contexts elsewhere are
   repeats as a whole.
3. What is left are ends of repeated passages: equal 48 bytes in different contexts. Partitions by those
   bytes keep a logarithmic family of suffix arrays: every incoming batch becomes a sorted array of the
   200-byte prefixes of its suffixes, is merge-scanned against all levels for equal ones, and levels of
   equal size are merged. Strings of 48 bytes with very many contexts skip the family: their windows are
   spread over all tasks and grouped there.

Strings are told apart by 64-bit hashes of their parts. Matches never cross texts. Null texts are empty.
Rows that share doc_id and text repeat each other and get the same answer each; a null doc_id stays null;
long texts are whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import discard, stored, text_identity, text_slices
from taperline.llm.kernels import mix, powers, prefix_hash, stretch_hash, _BYTE_VALUES

LENGTH = 200
ANCHOR = 48
#: Anchors that a string of LENGTH bytes can have, and the bytes of context to either side.
REACH = LENGTH - ANCHOR + 1
SIDE = REACH - 1
#: Contexts of one anchor beyond which its windows are spread, and contexts in a partition of the others.
CROWDED = 20_000
PARTITION = 20_000


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of values[i : i + width] for each i, by doubling; needs width values at least."""
    pick = np.minimum if least else np.maximum
    have, out = 1, values
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, position, key, context) of the anchors in joined texts, in order of place."""
    none = np.zeros(0, dtype=np.int64)
    n = len(data)
    if n < LENGTH:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_hash(data)
    at = np.arange(n - ANCHOR + 1)
    keys = stretch_hash(sums, at, at + ANCHOR)
    rank = (keys >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    # Windows that cross texts have no minimum.
    least = sliding(rank, REACH, True)
    for end in offsets[1:-1]:
        least[max(0, end - LENGTH + 1) : end] = 0
    padded = np.zeros(len(least) + 2 * SIDE, dtype=np.uint32)
    padded[SIDE:-SIDE] = least
    place = np.flatnonzero(rank == sliding(padded, REACH, False))
    text = np.searchsorted(offsets, place, side="right") - 1
    left = np.minimum(place - offsets[text], SIDE)
    right = np.minimum(offsets[text + 1] - place - ANCHOR, SIDE)
    context = mix(stretch_hash(sums, place - left, place + ANCHOR + right) + (left * LENGTH + right).astype(np.uint64))
    return text, place - offsets[text], keys[place], context


def text_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a key are anchors, rows without one are stretches that repeat within their text."""
    for rows, data, offsets in text_slices(batches):
        text, pos, key, context = anchors(data, offsets)
        own = mix(context + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first, group, count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[group] > 1)
        start, stop = np.maximum(pos[twice] - SIDE, 0), pos[twice] + LENGTH
        fresh = np.ones(len(twice), dtype=bool)
        fresh[1:] = (text[twice][1:] != text[twice][:-1]) | (start[1:] > stop[:-1])
        heads = np.flatnonzero(fresh)
        ends = np.concatenate((heads[1:], [len(twice)])) - 1 if len(heads) else heads
        first.sort()
        owner = np.concatenate((text[first], text[twice][heads]))
        anchor = np.concatenate((np.ones(len(first), dtype=bool), np.zeros(len(heads), dtype=bool)))
        nothing = np.zeros(len(heads), dtype=np.int64)
        columns = [
            rows.column(0).take(pa.array(owner)),
            rows.column(1).take(pa.array(owner)),
            pa.array(np.concatenate((key[first].view(np.int64), nothing)), mask=~anchor),
            pa.array(np.concatenate((context[first].view(np.int64), nothing)), mask=~anchor),
            pa.array(np.concatenate((pos[first], start[heads])).astype(np.int32)),
            pa.array(np.concatenate((np.zeros(len(first), dtype=np.int64), stop[ends])).astype(np.int32), mask=anchor),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "key", "context", "pos", "stop"])


def window_hashes(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, valid) of the strings of LENGTH bytes through each anchor; column d starts d bytes before it."""

    def sums(sides: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) for s in sides])
        grid = np.frombuffer(b"".join(s.ljust(SIDE, b"\0") for s in sides), dtype=np.uint8).reshape(-1, SIDE)
        out = np.zeros((len(sides), REACH), dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[grid] * powers(SIDE), axis=1, out=out[:, 1:])
        return out, sizes

    before, n_before = sums([s[::-1] for s in left])
    after, n_after = sums(right)
    d = np.arange(REACH)
    hashes = mix(before * np.uint64(0xD6E8FEB86659FD93) + mix(after[:, ::-1] + d.astype(np.uint64)))
    return hashes, (d <= n_before[:, None]) & (SIDE - d <= n_after[:, None])


class SuffixFamily:
    """Sorted arrays of window hashes, sizes growing geometrically; remembers which windows were met twice."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # hashes in order, window numbers
        self.met: list[np.ndarray] = []
        self.size = 0

    def add(self, hashes: np.ndarray, windows: np.ndarray) -> None:
        """``windows`` number the hashes of one batch, from ``size`` on."""
        grown = int(windows[-1]) + 1 if len(windows) else self.size
        met = np.zeros(grown - self.size, dtype=bool)
        self.met.append(met)
        starts = np.cumsum([0, *map(len, self.met)])
        order = np.argsort(hashes, kind="stable")
        hashes, windows = hashes[order], windows[order]
        same = hashes[1:] == hashes[:-1]
        twin = np.zeros(len(hashes), dtype=bool)
        twin[1:] |= same
        twin[:-1] |= same
        for level, (known, owners) in enumerate(self.levels):
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
            twin |= hit
            back = np.unique(owners[at[hit]])
            for part in range(len(self.met)):  # mark the older side
                mine = back[(back >= starts[part]) & (back < starts[part + 1])]
                self.met[part][mine - starts[part]] = True
        met[windows[twin] - self.size] = True
        self.size = grown
        fresh = np.concatenate(([True], ~same)) if len(hashes) else np.zeros(0, dtype=bool)
        self.levels.append((hashes[fresh], windows[fresh]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            both, owners = np.concatenate((b, a)), np.concatenate((y, x))
            order = np.argsort(both, kind="stable")
            both, owners = both[order], owners[order]
            fresh = np.concatenate(([True], both[1:] != both[:-1]))
            self.levels.append((both[fresh], owners[fresh]))

    def repeated(self) -> np.ndarray:
        return np.concatenate(self.met) if self.met else np.zeros(0, dtype=bool)


SPANS = "doc_id {}, text_hash long, start int, stop int"


def family_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated stretches around anchors: rows (doc_id, text_hash, pos, key, single, left, right) of whole keys."""
    family, heads = SuffixFamily(), []
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            rows = batch.slice(at, 4096)
            hashes, valid = window_hashes(rows.column(5).to_pylist(), rows.column(6).to_pylist())
            keys = rows.column(3).to_numpy().view(np.uint64)
            numbers = (family.size // REACH + np.arange(len(keys)))[:, None] * REACH + np.arange(REACH)
            # Windows that do not fit into their text get hashes of their own by way of their number.
            mixed = mix(hashes ^ keys[:, None])
            family.add(np.where(valid, mixed, mix(numbers.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))).ravel(), numbers.ravel())
            heads.append(rows.select([0, 1, 2, 4]))
    if heads:
        table = pa.Table.from_batches(heads).combine_chunks()
        yield from spans_of(table, family.repeated().reshape(-1, REACH))


def spans_of(heads: pa.Table, repeated: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Stretches of neighbouring repeated windows of anchors that stand for one place."""
    repeated &= heads.column(3).to_numpy()[:, None]
    edges = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, near = np.nonzero(edges == 1)
    _, far = np.nonzero(edges == -1)
    pos = heads.column(2).to_numpy()[row]
    owner = pa.array(row)
    spans = heads.select([0, 1]).take(owner)
    spans = spans.append_column("start", pa.array((pos - far + 1).astype(np.int32)))
    yield from spans.append_column("stop", pa.array((pos - near + LENGTH).astype(np.int32))).to_batches()


def spread_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of crowded anchors."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            rows = batch.slice(at, 1024)
            hashes, valid = window_hashes(rows.column(5).to_pylist(), rows.column(6).to_pylist())
            row, d = np.nonzero(valid)
            owner = pa.array(row)
            start = (rows.column(2).to_numpy()[row] - d).astype(np.int32)
            columns = [*(rows.column(i).take(owner) for i in (0, 1, 3, 4)), pa.array(hashes[valid].view(np.int64)), pa.array(start)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "key", "single", "window", "start"])


def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around asked anchors: rows (doc_id, text_hash, text, asked)."""
    for batch in batches:
        owner, pos, key, single, left, right = [], [], [], [], [], []
        for row, (text, asked) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            data = (text.as_py() or "").encode()
            for ask in asked.as_py():
                at = ask["pos"]
                owner.append(row)
                pos.append(at)
                key.append(ask["key"])
                single.append(ask["single"])
                left.append(data[max(0, at - SIDE) : at])
                right.append(data[at + ANCHOR : at + LENGTH])
        columns = [
            *(batch.column(i).take(pa.array(owner, pa.int64())) for i in (0, 1)),
            pa.array(pos, pa.int32()),
            pa.array(key, pa.int64()),
            pa.array(single, pa.bool_()),
            pa.array(left, pa.binary()),
            pa.array(right, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "pos", "key", "single", "left", "right"])


def with_text(documents: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """Join facts per text (doc_id, text_hash, ...) to the texts."""
    texts = documents.select(*text_identity(), F.coalesce("text", F.lit("")).alias("text"))
    other = facts.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return texts.join(other, same, how).drop("_id", "_hash")


def repeated_stretches(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, stop): stretches of bytes that repeat; they may overlap and pass the text's end."""
    id_type = documents.schema["doc_id"].dataType.simpleString()
    found = stored(
        documents.select(*text_identity(), "text").mapInArrow(
            text_anchors, f"doc_id {id_type}, text_hash long, key long, context long, pos int, stop int"
        ),
        "anchors",
    )
    inner = found.filter("key is null").select("doc_id", "text_hash", F.col("pos").alias("start"), "stop")
    anchor = found.filter("key is not null").drop("stop")
    # Stored, so that the join's own shuffle can be split where one key has very many anchors.
    shared = stored(anchor.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "shared")
    inner = stored(inner, "inner")
    met = stored(anchor.join(shared, "key"), "met")
    discard(found, shared)
    classes = met.groupBy("key", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "pos")).alias("owner")
    )
    classes = stored(classes, "contexts")
    whole = met.join(classes.filter("n > 1").select("key", "context"), ["key", "context"]).select(
        "doc_id", "text_hash", (F.col("pos") - SIDE).alias("start"), (F.col("pos") + LENGTH).alias("stop")
    )
    sizes = stored(classes.groupBy("key").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"), "sizes")
    asked = classes.join(sizes.select("key"), "key").select("owner.*", "key", (F.col("n") == 1).alias("single"))
    per_text = asked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("pos", "key", "single")).alias("asked"))
    shape = f"doc_id {id_type}, text_hash long, pos int, key long, single boolean, left binary, right binary"
    # Equal rows share their identity; one of them speaks for the place.
    cut = with_text(documents, stored(per_text, "asked"), "inner").select("doc_id", "text_hash", "text", "asked").mapInArrow(cut_contexts, shape)
    crowded = sizes.filter(F.col("contexts") > CROWDED).select("key")
    cut = stored(cut, "cut")
    calm = cut.join(crowded, "key", "left_anti").select("doc_id", "text_hash", "pos", "key", "single", "left", "right")
    parts = 1 + sizes.agg(F.coalesce(F.sum("contexts"), F.lit(0))).first()[0] // PARTITION
    ends = calm.repartition(parts, "key").mapInArrow(family_spans, SPANS.format(id_type))
    spread = cut.join(crowded, "key", "left_semi").select("doc_id", "text_hash", "pos", "key", "single", "left", "right")
    windows = spread.mapInArrow(spread_windows, f"doc_id {id_type}, text_hash long, key long, single boolean, window long, start int")
    twice = windows.groupBy("key", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "window")
    crowd = windows.filter("single").join(twice, ["key", "window"]).select(
        "doc_id", "text_hash", "start", (F.col("start") + LENGTH).alias("stop")
    )
    out = stored(inner.unionByName(whole).unionByName(stored(ends, "ends")).unionByName(stored(crowd, "crowd")), "stretches")
    discard(met, cut)
    return out


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text_hash, text, spans) -> what is removed and what is left of each text."""
    for batch in batches:
        size, removed, runs, digest, kept = [], [], [], [], []
        for text, spans in zip(batch.column(2), batch.column(3), strict=True):
            data = (text.as_py() or "").encode()
            at, gone, count, parts = 0, 0, 0, []
            end = -1
            for span in sorted((s["start"], s["stop"]) for s in spans.as_py() or ()):
                start, stop = max(span[0], 0), min(span[1], len(data))
                if start > end:
                    count += 1
                    parts.append(data[at:start])
                    end = start
                if stop > end:
                    gone += stop - end
                    end = stop
                at = max(at, end)
            parts.append(data[at:])
            rest = b"".join(parts)
            size.append(len(data))
            removed.append(gone)
            runs.append(count)
            digest.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        numbers = [pa.array(x, pa.int64()) for x in (size, removed, runs)]
        columns = [batch.column(0), *numbers, pa.array(digest, pa.string()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])


def without_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes) of every text."""
    id_type = documents.schema["doc_id"].dataType.simpleString()
    spans = repeated_stretches(documents).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = with_text(documents, spans, "left").select("doc_id", "text_hash", "text", "spans")
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
    return rows.mapInArrow(remove_spans, schema)
