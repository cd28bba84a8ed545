"""Benchmark decontamination with suffix arrays of the training texts.

Documents come in shards of about a million words. A shard's texts become one row of word numbers, each
text closed by a sign that no word has, and prefix doubling orders all its suffixes by their first 16
words, more than a window of 13 has. Every window of every benchmark item is found in the suffix array
by binary search; all places in the found range are occurrences. Neighbouring occurrences join into the
longest verbatim matches, and the words of a document inside of any are hit.

The benchmark is a query set: it is read in blocks of at most ``block_words`` words, each sent to all
tasks and held against all documents, and the answers of the blocks are merged.

Null or empty texts have no words: no hits, and no windows. Items that share an item_id count once; those
without one count as one item, which is not the one with an empty id and adds nothing to the digest of ids.
Documents with a null doc_id or repeated rows are judged one by one. Texts are whole, however long; a very
long one makes a larger shard. Without documents or benchmark items the result has no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import stored, text_identity, text_slices
from taperline.llm.kernels import ALPHANUMERIC, word_hashes

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 2_000_000
#: A document goes if at least one word in so many is hit.
SHARE = 20


def in_order(ids: set[str | None]) -> list[str | None]:
    """Ids as strings, null last."""
    return sorted(ids, key=lambda i: (i is None, i or ""))


@dataclass
class Windows:
    """Different windows of some benchmark items; window i belongs to items[owner[first[i]:first[i + 1]]]."""

    words: list[np.ndarray] = field(default_factory=list)
    owners: list[list[str | None]] = field(default_factory=list)

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]]) -> Windows:
        texts = [(t or "").encode() for _, t in items]
        offsets = np.cumsum([0, *map(len, texts)])
        hashes, first = word_hashes(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, ALPHANUMERIC)
        known: dict[bytes, set[str | None]] = {}
        for (item_id, _), a, b in zip(items, first[:-1], first[1:], strict=True):
            for i in range(a, max(b - WINDOW, a) + 1) if b > a else ():
                known.setdefault(hashes[i : min(i + WINDOW, b)].tobytes(), set()).add(item_id)
        return cls([np.frombuffer(w, dtype=np.uint64) for w in known], [in_order(o) for o in known.values()])


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Positions of ``tokens`` ordered by what follows, up to 16 tokens, by prefix doubling."""
    rank, reach = tokens.astype(np.int64), 1
    while True:
        following = np.zeros_like(rank)
        following[:-reach] = rank[reach:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key)
        reach *= 2
        if reach >= 16:
            return order
        ordered = key[order]
        steps = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if steps[-1] == len(tokens) - 1:
            return order
        rank[order] = steps


def find(tokens: np.ndarray, order: np.ndarray, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of the suffix array whose suffixes begin with each query; queries are rows, padded."""
    n = len(order)
    padded = np.concatenate((tokens, np.zeros(queries.shape[1], dtype=tokens.dtype)))

    def search(beyond: bool) -> np.ndarray:
        low, high = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), n, dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            places = order[middle]
            # Compare word by word; only rows that are still equal go on.
            less = np.full(len(open_), beyond)
            left = np.arange(len(open_))
            for k in range(queries.shape[1]):
                left = left[sizes[open_[left]] > k]
                if not len(left):
                    break
                here, asked = padded[places[left] + k], queries[open_[left], k]
                less[left[here < asked]] = True
                less[left[here > asked]] = False
                left = left[here == asked]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]

    return search(False), search(True)


def occurrences(hashes: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, word position) of every place where a window stands inside one text."""
    none = np.zeros(0, dtype=np.int64)
    if not len(hashes) or not windows.words:
        return none, none
    values, numbers = np.unique(hashes, return_inverse=True)
    texts = len(first) - 1
    text_of = np.searchsorted(first, np.arange(len(hashes)), side="right") - 1
    tokens = np.zeros(len(hashes) + texts, dtype=np.int64)  # 0 closes a text
    tokens[np.arange(len(hashes)) + text_of] = numbers + 1
    sizes = np.array([len(w) for w in windows.words])
    flat = np.concatenate(windows.words)
    at = np.minimum(np.searchsorted(values, flat), len(values) - 1)
    known = values[at] == flat
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    possible = np.flatnonzero(np.logical_and.reduceat(known, starts))
    queries = np.zeros((len(possible), WINDOW), dtype=np.int64)
    for row, i in enumerate(possible):
        queries[row, : sizes[i]] = at[starts[i] : starts[i] + sizes[i]] + 1
    order = suffix_array(tokens)
    low, high = find(tokens, order, queries, sizes[possible])
    counts = high - low
    places = order[np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())]
    text = np.searchsorted(first + np.arange(texts + 1), places, side="right") - 1
    return np.repeat(possible, counts), places - text


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches where flags are true."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def shard_answers(hashes: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[list[list[dict]], list[list[str | None]]]:
    """For each text the longest hit spans in words and the items found."""
    texts = len(first) - 1
    spans: list[list[dict]] = [[] for _ in range(texts)]
    items: list[list[str | None]] = [[] for _ in range(texts)]
    window, place = occurrences(hashes, first, windows)
    if not len(window):
        return spans, items
    sizes = np.array([len(w) for w in windows.words])
    change = np.zeros(len(hashes) + texts + 1, dtype=np.int64)
    text = np.searchsorted(first, place, side="right") - 1
    shifted = place + text  # one place between texts, so that spans of two texts never touch
    np.add.at(change, shifted, 1)
    np.add.at(change, shifted + sizes[window], -1)
    for a, b in zip(*runs(np.cumsum(change) > 0), strict=True):
        t = int(np.searchsorted(first + np.arange(texts + 1), a, side="right") - 1)
        base = int(first[t]) + t
        spans[t].append({"start": int(a) - base, "stop": int(b) - base})
    found: dict[int, set[str | None]] = {}
    for t, w in np.unique(np.stack((text, window), axis=1), axis=0):
        found.setdefault(int(t), set()).update(windows.owners[w])
    for t, names in found.items():
        items[t] = in_order(names)
    return spans, items


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def scan_documents(documents: DataFrame, windows: Windows) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer() -> pa.RecordBatch:
            hashes = np.concatenate([h for _, h, _ in held])
            bases = np.concatenate(([0], np.cumsum([len(h) for _, h, _ in held])))
            first = np.concatenate([f[:-1] + b for (_, _, f), b in zip(held, bases[:-1], strict=True)] + [bases[-1:]])
            spans, items = shard_answers(hashes, first, shared.value)
            ids = pa.concat_arrays([r.column(0) for r, _, _ in held])
            marks = pa.concat_arrays([r.column(1) for r, _, _ in held])
            columns = [ids, marks, pa.array(np.diff(first), pa.int64()), pa.array(spans, pa.list_(SPAN)), pa.array(items, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "spans", "items"])

        held: list = []
        size = 0
        for rows, data, offsets in text_slices(batches):
            hashes, first = word_hashes(data, offsets, ALPHANUMERIC)
            held.append((rows, hashes, first))
            size += len(hashes)
            if size >= SHARD_WORDS:
                yield answer()
                held, size = [], 0
        if held:
            yield answer()

    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash long, n_words long, spans array<struct<start: long, stop: long>>, items array<string>"
    return documents.select(*text_identity(), "text").mapInArrow(run, schema)


def benchmark_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in bounded blocks; the driver holds one at a time."""
    block, size = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        block.append((item_id, text))
        size += 1 + len(text or "") // 4
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def covered(spans: Column) -> Column:
    """Places in the union of spans."""
    start = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("n"))
    total = F.aggregate(
        F.array_sort(spans),
        start,
        lambda s, x: F.struct(
            F.greatest(s["stop"], x["stop"]).alias("stop"),
            (s["n"] + F.greatest(x["stop"] - F.greatest(s["stop"], x["start"]), F.lit(0).cast("long"))).alias("n"),
        ),
    )
    return total["n"]


def matches(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text_hash, n_words, spans, items, n_hit, contaminated) of every document."""
    answers: list[DataFrame] = []
    for block in benchmark_blocks(benchmark, block_words):
        if answers:  # several blocks: each answer is written before the next block is sent
            answers[-1] = stored(answers[-1], "matches")
        answers.append(scan_documents(documents, Windows.of(block)))
    if not answers:
        answers.append(scan_documents(documents, Windows()))
    found = answers[0]
    if len(answers) > 1:
        for more in answers[1:]:
            found = found.unionByName(more)
        merged = found.groupBy("doc_id", "text_hash").agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.count(F.lit(1)).alias("n"),
        )
        copies = F.explode(F.sequence(F.lit(1), F.expr(f"int(n div {len(answers)})"))).alias("copy")
        found = merged.select("doc_id", "text_hash", "n_words", "spans", "items", copies).drop("copy")
    hit = found.withColumn("n_hit", covered(F.col("spans")))
    return hit.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def match_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = matches(documents, benchmark).filter("contaminated").select("doc_id", "text_hash").distinct()
    bad = stored(found, "contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash"))
    rows = documents.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), text_identity()[1].alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_bad_id")) & (F.col("_hash") == F.col("_bad_hash"))
    return rows.join(bad, same, "left_anti").select("_row.*")
