"""Near duplicates by MinHash signatures and a multi-index Hamming join.

A document is its set of five-word shingles. Documents with equal sets form a class, and only classes
are compared. A class has a signature of 48 symbols of 16 bits: for each of 48 hash functions, bits of
the smallest hash in the set. Sets with a similarity of 85 % differ in 7.2 symbols on average, and in
more than ``MAX_ERRORS`` = 21 with a probability of 4e-7.

Two signatures within 21 errors agree, by the pigeonhole principle, in at least one of 11 chunks up to
one error (11 chunks with two errors each would be 22). So every chunk is indexed once for each of
its symbols, with that symbol masked out: all allowed errors are enumerated, and all pairs within the
distance meet in a bucket. Buckets are never expanded into pairs. First each class is compared with
the smallest class of its buckets, the closest one; the confirmed links give components. Then only in
buckets that hold several components, members are compared across components: those of small buckets
as pairs, those of crowded ones inside of tasks, family by family and block by block. That leaves out
no link that could change a component. Every link is confirmed on the full sets.

Texts without words (also null texts) have empty sets, linked with nothing. A class's sets are equal,
so copies cost one row each. A null doc_id never is a component's id unless all its documents have none.
Repeated rows share their component, and all of them are kept if one is. Very long texts are whole.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import discard, sized, stored, text_identity, text_slices
from taperline.llm.components import connected_components
from taperline.llm.kernels import SPACED, mix, word_hashes

SHINGLE = 5
SYMBOLS = 48
MAX_ERRORS = 21
#: One error a chunk: 2 * CHUNKS > MAX_ERRORS.
CHUNKS = 11
SIMILARITY = 85  # per cent
#: Sets below this size cannot be similar without being equal: 5 of 6 shingles are 83 %.
LEAST_SIZE = 6
#: Members of a bucket up to which its pairs across components become rows.
CROWD = 16
#: Classes and shingles that one task compares among themselves.
BLOCK_CLASSES = 4096
BLOCK_SHINGLES = 4_000_000

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, (4, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK_OF = np.arange(SYMBOLS) * CHUNKS // SYMBOLS


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The ordered set of shingle hashes of each text; fewer words than a shingle are one whole."""
    hashes, first = word_hashes(data, offsets, SPACED)
    n = len(hashes)
    joined = np.zeros(n, dtype=np.uint64)
    for i in range(min(SHINGLE, n)):
        joined[: n - i] += hashes[i:] * _SEEDS[0, i]
    joined = mix(joined)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            sets.append(np.unique(joined[a : b - SHINGLE + 1]))
        elif b > a:
            whole = (hashes[a:b] * _SEEDS[0, : b - a]).sum(dtype=np.uint64, keepdims=True) + _SEEDS[0, 16 + b - a : 17 + b - a]
            sets.append(mix(whole))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of symbols per set; sets must not be empty."""
    if not sets:
        return np.zeros((0, SYMBOLS), dtype=np.uint16)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), SYMBOLS), dtype=np.uint16)
    for i in range(SYMBOLS):
        hashed = (flat ^ _SEEDS[1, i]) * _SEEDS[2, i]
        hashed ^= hashed >> np.uint64(29)
        hashed *= _SEEDS[3, i]
        out[:, i] = mix(np.minimum.reduceat(hashed, starts)) >> np.uint64(48)
    return out


def masked_keys(symbols: np.ndarray) -> np.ndarray:
    """For each symbol a key of its chunk without it: equal keys mean at most one error in the chunk."""
    weighed = symbols.astype(np.uint64) * _SEEDS[0, 64 : 64 + SYMBOLS]
    keys = np.empty(weighed.shape, dtype=np.uint64)
    for c in range(CHUNKS):
        at = np.flatnonzero(CHUNK_OF == c)
        keys[:, at] = weighed[:, at].sum(axis=1, dtype=np.uint64)[:, None] - weighed[:, at]
    return mix(keys + _SEEDS[0, 128 : 128 + SYMBOLS])


def document_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_slices(batches):
        sets = shingle_sets(data, offsets)
        full = [i for i, s in enumerate(sets) if len(s) >= LEAST_SIZE]
        marks: list[bytes | None] = [None] * len(sets)
        for i, symbols in zip(full, signatures([sets[i] for i in full]), strict=True):
            marks[i] = symbols.tobytes()
        classes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.binary()), pa.array(marks, pa.binary())],
            ["doc_id", "text_hash", "n_shingles", "class", "signature"],
        )


def class_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)
        keys = masked_keys(symbols).view(np.int64)
        ids = np.repeat(batch.column(0).to_numpy(), SYMBOLS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "cid"])


def signature_distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, signature_a, signature_b) within MAX_ERRORS, with their distance."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS) for i in (2, 3))
        errors = (a != b).sum(axis=1).astype(np.int32)
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(errors)], ["a", "b", "errors"])
        yield out.filter(pa.array(errors <= MAX_ERRORS))


def text_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_slices(batches):
        sets = [s.tobytes() for s in shingle_sets(data, offsets)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.binary())], ["cid", "shingles"])


def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both full sets, those with enough shingles in common."""
    for batch in batches:
        said = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            a, b = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            common = len(np.intersect1d(a, b, assume_unique=True))
            said[i] = 100 * common >= SIMILARITY * (len(a) + len(b) - common)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(said))


def near(pairs: DataFrame, classes: DataFrame, pairs_at_most: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose signatures are near, with errors."""
    facts = classes.select("cid", "n_shingles", "signature")
    a, b = (facts.select([F.col(c).alias(f"{c}_{s}") for c in facts.columns]) for s in "ab")
    fitting = (
        pairs.join(a, pairs["a"] == a["cid_a"])
        .join(b, pairs["b"] == b["cid_b"])
        .filter(100 * F.least("n_shingles_a", "n_shingles_b") >= SIMILARITY * F.greatest("n_shingles_a", "n_shingles_b"))
    )
    return sized(fitting.select("a", "b", "signature_a", "signature_b"), pairs_at_most).mapInArrow(signature_distance, "a long, b long, errors int")


def class_sets(cids: DataFrame, documents: DataFrame, classes: DataFrame, rows: int) -> DataFrame:
    """(cid, shingles) of classes, stored, from the text of one document of each; there are ``rows`` documents."""
    needed = stored(sized(cids.join(classes.select("cid", "doc"), "cid"), rows).select("cid", "doc.*"), "needed")
    texts = documents.select(*text_identity(), "text").alias("t")
    same = F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("t.text_hash") == F.col("n.text_hash"))
    # The classes asked for grow with the documents, so this is a merge join at any size.
    found = sized(texts.join(needed.hint("merge").alias("n"), same).select("cid", "text"), rows, 5_000)
    # Equal rows give their class's set more than once.
    sets = found.mapInArrow(text_sets, "cid long, shingles binary").dropDuplicates(["cid"])
    sets = stored(sized(sets, rows, 5_000), "sets")
    discard(needed)
    return sets


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The stored pairs of classes that are similar, by their full sets."""
    n = pairs.count()
    if not n:
        return sets.sparkSession.createDataFrame([], "a long, b long")
    one = sized(pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("left")), "a"), n, 2_000)
    two = one.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("right")), "b")
    return stored(sized(two.select("a", "b", "left", "right"), n, 2_000).mapInArrow(similar, "a long, b long"), "links")


def block_links(rows: pa.Table) -> pa.Table:
    """Links that join the components of one family's block, or of two blocks across."""
    cid = rows.column("cid").to_numpy()
    block = rows.column("block").to_numpy()
    label = np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
    symbols = np.frombuffer(b"".join(rows.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)
    sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in rows.column("shingles")]
    size = np.array([len(s) for s in sets])
    across = block.min() != block.max()
    # Only shingles that several sets hold can be common; as bits where that is small, else by merging sets.
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    shared = np.flatnonzero(count[number] > 1)
    width = 8 * (int(place[-1]) // 64 + 1)
    bits = None
    if width * len(sets) <= 1 << 27:
        bits = np.zeros((len(sets), width), dtype=np.uint8)
        at = place[number[shared]]
        np.bitwise_or.at(bits, (np.repeat(np.arange(len(sets)), size)[shared], at >> 3), (1 << (at & 7)).astype(np.uint8))
        bits = bits.view(np.uint64)
    a, b = [], []
    for i in range(len(cid) - 1):
        other = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        if across:
            other = other[block[other] != block[i]]
        other = other[100 * np.minimum(size[other], size[i]) >= SIMILARITY * np.maximum(size[other], size[i])]
        other = other[(symbols[other] != symbols[i]).sum(axis=1) <= MAX_ERRORS]
        if not len(other):
            continue
        if bits is not None:
            common = np.bitwise_count(bits[other] & bits[i]).sum(axis=1, dtype=np.int64)
        else:
            common = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in other])
        for j in other[100 * common >= SIMILARITY * (size[i] + size[other] - common)]:
            if label[j] != label[i]:
                a.append(max(cid[i], cid[j]))
                b.append(min(cid[i], cid[j]))
                label[label == label[j]] = label[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def crowd_links(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across components in crowded buckets: rows (key, cid, component) -> stored links (a, b).

    Classes that such buckets connect are a family. A family is compared inside of one task, without
    making rows of its pairs; one too large for that is cut into blocks, and each pair of blocks is a task.
    """
    rows = members.count()
    if not rows:
        return sets.sparkSession.createDataFrame([], "a long, b long")
    heads = members.groupBy("key").agg(F.min("cid").alias("head"))
    star = sized(members.join(heads, "key").select(F.col("cid").alias("a"), F.col("head").alias("b")).distinct(), rows)
    family = connected_components(star).select(F.col("node").alias("cid"), F.col("component").alias("family"))
    own = sized(members.select("cid", "component").distinct().join(family, "cid"), rows)
    own = stored(own.join(classes.select("cid", "n_shingles", "signature"), "cid"), "family")
    n = own.count()
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    sizes = own.groupBy("family").agg(blocks.cast("int").alias("blocks"))
    placed = sized(own.join(sizes, "family"), n).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = placed.select("*", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    whole = sized(tasks.join(sets, "cid"), n, 5_000).select(
        "family", "i", "j", "cid", "block", "component", "signature", "shingles"
    )
    links = stored(sized(whole.groupBy("family", "i", "j").applyInArrow(block_links, "a long, b long"), n, 2_000), "links")
    discard(own)
    return links


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every document."""
    texts = documents.select(*text_identity(), "text")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    known = stored(
        texts.mapInArrow(document_sets, f"doc_id {id_type}, text_hash long, n_shingles long, class binary, signature binary"), "shingles"
    )
    grouped = (
        known.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("doc"),
            F.max("n_shingles").alias("n_shingles"),
            F.max("signature").alias("signature"),
        )
    )
    classes = stored(grouped.select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")
    links = class_links(documents, classes, known.count())
    member = connected_components(links)
    of_class = (
        classes.join(member.withColumnRenamed("node", "cid"), "cid", "left")
        .select("class", "least_id", F.coalesce("component", "cid").alias("component"))
    )
    ids = of_class.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = stored(of_class.join(ids, "component").select("class", "component_id"), "components")
    # Many documents may share a class; the join's small rows are split by the adaptive planner.
    joined = known.select("doc_id", "text_hash", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def class_links(documents: DataFrame, classes: DataFrame, documents_at_most: int) -> DataFrame:
    """Similar pairs of classes that join all classes of each component."""
    signed = classes.filter(F.col("signature").isNotNull())
    keys = signed.select("cid", "signature").mapInArrow(class_keys, "key long, cid long")
    buckets = keys.groupBy("key").agg(F.min("cid").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Stored, so that the join's own shuffle can be split where one bucket is crowded.
    buckets = stored(buckets, "heads")
    met = stored(keys.join(buckets, "key").select("key", "cid", "head"), "buckets")
    discard(buckets)
    rows = met.count()
    # One pass over the texts gives the sets that all later steps confirm links on.
    sets = class_sets(met.select("cid").distinct(), documents, classes, documents_at_most)
    heads = sized(met.filter("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b")).distinct(), rows)
    stars = near(heads, classes, rows // SYMBOLS)
    closest = stars.groupBy("a").agg(F.min(F.struct("errors", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    tried = stored(sized(closest, rows // SYMBOLS), "stars")
    links = confirmed(tried, sets)
    member = connected_components(links)
    # Buckets that one component fills need nothing more.
    grown = sized(met.join(member.withColumnRenamed("node", "cid"), "cid", "left"), rows).select(
        "key", "cid", F.coalesce("component", "cid").alias("component")
    )
    several = grown.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    mixed = stored(sized(grown.join(several, "key"), rows), "mixed")
    left = mixed.count()
    per_key = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    known = stored(sized(mixed.join(per_key, "key"), left), "mixed")
    # Across components, each pair once.
    few = known.filter(F.col("n") <= CROWD)
    a = few.select("key", F.col("cid").alias("a"), F.col("component").alias("ca"))
    b = few.select("key", F.col("cid").alias("b"), F.col("component").alias("cb"))
    across = sized(a.join(b, "key").filter("ca <> cb and a > b"), left)
    pairs = sized(across.select("a", "b").distinct(), left)
    rest = stored(near(pairs, classes, left).select("a", "b").join(tried, ["a", "b"], "left_anti"), "across")
    more = confirmed(rest, sets)
    most = crowd_links(known.filter(F.col("n") > CROWD).select("key", "cid", "component"), classes, sets)
    discard(met, mixed, known, sets)
    return stored(links.unionByName(more).unionByName(most), "links")


def distinct_documents(documents: DataFrame) -> DataFrame:
    """One document of each group, with all its columns; rows that share id and text count as one."""
    found = near_duplicates(documents).filter("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_n"))
    kept = stored(found.withColumnsRenamed({"doc_id": "_k_id", "text_hash": "_k_hash"}), "kept")
    rows = documents.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), text_identity()[1].alias("_hash"))
    joined = rows.join(kept, F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("_hash") == F.col("_k_hash")))
    single = joined.filter("_n = 1").select("_row.*")
    if kept.filter("_n > 1").isEmpty():
        return single
    repeated = joined.filter("_n > 1").groupBy("_id", "_hash").agg(F.first("_row").alias("_row"))
    return single.unionByName(repeated.select("_row.*"))
