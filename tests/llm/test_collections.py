"""Sharding, hard negatives and the Merkle manifest against brute force and SQL."""

import hashlib
import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from text_fixture import DOCUMENTS, corpus, folder, frames, rows_of, sql_rows, with_odd_columns

from taperline.llm import merkle, negatives, queries, sharding, sql

# -- sharding ------------------------------------------------------------------------------


def brute_tree(rows: list[dict], spans: list[int], n: int) -> list[list[int]]:
    """Row numbers of each shard, by plain recursion."""
    if n == 1 or not rows:
        return [[r["row"] for r in rows]] + [[] for _ in range(n - 1)]
    shares = [(max(r[f"d{i}"] for r in rows) - min(r[f"d{i}"] for r in rows)) / max(1, s) for i, s in enumerate(spans)]
    dim = shares.index(max(shares))
    rows = sorted(rows, key=lambda r: (r[f"d{dim}"], r["tie"], r["row"]))
    wanted = sum(r["size"] for r in rows) * (n // 2) / n
    reach, upto, below, above, band = 2 * max(r["size"] for r in rows), 0, [], [], []
    for r in rows:
        upto += r["size"]
        gap = upto - r["size"] / 2 - wanted
        (below if gap < -reach else above if gap > reach else band).append(r)
    if band:
        room = wanted - sum(r["size"] for r in below)
        table = pa.table({"row": [r["row"] for r in band], "size": [r["size"] for r in band], "room": [room] * len(band)})
        said = {r["row"]: r["below"] for r in sharding.dealt_band(table).to_pylist()}
        below, above = below + [r for r in band if said[r["row"]]], above + [r for r in band if not said[r["row"]]]
    return brute_tree(below, spans, n // 2) + brute_tree(above, spans, n - n // 2)


def test_tree_equals_plain_recursion(spark, monkeypatch):
    documents, _ = frames(spark)
    items = sharding.stored(sharding.weighed(documents, sharding.DIMENSIONS))
    rows, spans = sharding.with_coordinates(items, sharding.DIMENSIONS)
    rows = [r.asDict() for r in rows.collect()]
    monkeypatch.setattr(sharding, "weighed", lambda *_: items)
    for limit in (20_000, 40):  # the least cell that two largest rows can fill is cut by histograms
        monkeypatch.setattr(sharding, "SORTED_ROWS", limit)
        found = {}
        for r in sharding.shard_documents(documents, shards=7).collect():
            found.setdefault(r["shard"], set()).add(r["doc_id"])
        if limit == 20_000:
            want = brute_tree(rows, spans, 7)
            ids = {r["row"]: r["doc_id"] for r in rows}
            assert [found.get(i, set()) for i in range(7)] == [{ids[r] for r in shard} for shard in want]
        assert sum(map(len, found.values())) == len(rows)


def test_histograms_find_the_cell_of_the_weighted_median(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BINS", 4)
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), "x" * int(rng.paretovariate(1.1))) for _ in range(3000)]
    documents = spark.createDataFrame([(i, t, lang, "s") for i, (lang, t) in enumerate(data)], "doc_id long, text string, lang string, source string")
    sizes = {}
    for limit in (50, 20_000):
        monkeypatch.setattr(sharding, "SORTED_ROWS", limit)
        found = sharding.shard_documents(documents, shards=5).groupBy("shard").agg(F.sum("size").alias("b"), F.count("slot").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
        assert len(found) == 5 and all(r["n"] == r["d"] == r["m"] + 1 for r in found)
        sizes[limit] = {r["shard"]: r["b"] for r in found}
        mean = sum(sizes[limit].values()) / 5
        largest = max(len(t) for _, t in data) + 16
        assert max(abs(b - mean) for b in sizes[limit].values()) <= largest


def test_a_hot_source_and_repeated_rows_are_split(spark):
    rows = [(None, "same text", "en", "hot")] * 900 + [(i, f"text {i} " * (1 + i % 9), None, f"s{i % 3}") for i in range(300)]
    documents = with_odd_columns(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    found = sharding.shard_documents(documents, shards=8).collect()
    assert len(found) == 1200
    sizes = [0] * 8
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert max(sizes) - min(sizes) <= 100
    by_target = sharding.shard_documents(documents, target_bytes=sum(sizes) // 4 + 1).agg(F.max("shard")).first()[0]
    assert by_target == 3


def test_sharding_query(spark, tmp_path):
    path = folder(tmp_path)
    found = queries.op11_sharding(spark, path).collect()
    texts = {d[0]: d[1] or "" for d in corpus()[0]}
    import zlib

    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in found} == {(i, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts.items()}
    assert {r["law"] for r in found} == {"bytes"} and {r["grown_shard"] for r in found} == {None}
    for shard in range(40):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert set(r["shard"] for r in found) <= set(range(40))


# -- hard negatives ------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_negatives(rows: list[tuple], asked, k: int = 5) -> list[tuple]:
    whole = [(i, label, [math.floor(256.0 * float(x)) for x in v]) for i, v, label in rows if sound(i, v, label)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, label, q in whole:
        if not asked(a):
            continue
        seen = [(-score(q, v), i, own == label) for i, own, v in whole]
        for s, p, _ in sorted(x for x in seen if x[2] and x[1] != a)[:k]:
            fits = sorted((m, i) for m, i, same in seen if not same and 80 * -s <= 100 * -m <= 100 * -s)[:k]
            out += [(a, p, n + 1, i, -s, -m) for n, (m, i) in enumerate(fits)]
    return sorted(out)


def sound(i, v, label) -> bool:
    return i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.Generator(np.random.PCG64(2))
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 6) + i % 3], int(rng.integers(0, 3))) for i in range(400)]
    rows += [(1000 + i, rows[5][1], i % 2) for i in range(40)]  # ties
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [float("nan")] * 6, 1), (2003, [float("inf")], 2), (2004, [1.0], None), (None, [1.0], 1), (2005, [], 1), (2010, [0.5, 9.0], 0), (2020, [-1.0] * 6, 2)]
    monkeypatch.setattr(negatives, "PART", 16)
    monkeypatch.setattr(negatives, "ROWS", 64)
    vectors = with_odd_columns(spark.createDataFrame(rows, VECTORS).repartition(3))
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    found = negatives.hard_negatives(vectors, F.col("id") % 10 == 0, F.col("label"))
    assert sorted(map(tuple, found.collect())) == want
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 8 * 6 * 7)  # blocks of seven anchors
    found = negatives.hard_negatives(vectors, F.col("id") % 10 == 0, F.col("label"))
    assert sorted(map(tuple, found.collect())) == want


def test_scores_beyond_doubles_stay_exact():
    a = np.array([[1 << 40, 3], [5, 7]])
    b = np.array([[1 << 20, 1 << 30], [1, 1]])
    assert negatives.products(a, b).tolist() == [[(1 << 60) + (3 << 30), (1 << 40) + 3], [(5 << 20) + (7 << 30), 12]]
    huge = np.array([[1 << 62, -(1 << 62)]])
    assert negatives.products(huge, np.array([[2, 0], [0, 4]])).tolist() == [[(1 << 63) - 1, -(1 << 63) + 1]]


def test_negatives_of_repeated_rows_and_empty_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, F.col("id") % 100 == 0, F.col("label")).collect() == []
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2), (2, [0.9], 2)]
    found = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("id") == 0, F.col("label")).collect()
    assert sorted(map(tuple, found)) == sorted([(0, 1, 1, 2, 65536, 65536), (0, 1, 2, 2, 65536, 58880)] * 2)


def test_negatives_match_sql(spark, tmp_path):
    rng = np.random.Generator(np.random.PCG64(4))
    rows = pd.DataFrame({"vec_id": range(500), "embedding": [rng.normal(0.1, 0.2, 8).astype(np.float32) for _ in range(500)], "label": rng.integers(0, 10, 500).astype(np.int32)})
    rows.to_parquet(f"{tmp_path}/embeddings.parquet")
    name = "op12_hard_negative_mining"
    got = rows_of(queries.all_queries()[name](spark, str(tmp_path)))
    assert got and got == sql_rows(sql.all_sql()[name], str(tmp_path), ("embeddings",))


# -- Merkle manifest -----------------------------------------------------------------------


def brute_root(nodes: list[str], fanout: int) -> str:
    while len(nodes) > 1:
        nodes = [hashlib.sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]
    return nodes[0]


def test_manifest_matches_sql(spark, tmp_path, monkeypatch):
    path = folder(tmp_path)
    name = "op13_merkle_manifest"
    want = sql_rows(sql.all_sql()[name], path, ("documents",))
    assert rows_of(queries.all_queries()[name](spark, path)) == want
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda rows, **kw: whole(rows, block_leaves=4, **kw))
    assert rows_of(queries.all_queries()[name](spark, path)) == want


def test_proofs_of_other_fanouts_lead_to_the_root(spark):
    documents, _ = frames(spark)
    for fanout, block in ((3, 3), (4, 16)):
        rows = merkle.proofs(merkle.manifest(with_odd_columns(documents), fanout=fanout, block_leaves=block)).withColumn("up", merkle.folded(F.col("leaf"), F.col("path"))).collect()
        assert len(rows) == documents.count() and all(r["up"] == r["root"] for r in rows)
        groups = {}
        for r in sorted(rows, key=lambda r: r["index"]):
            groups.setdefault(r["group_at"], []).append(r["leaf"])
        subroots = [brute_root(groups[g], fanout) for g in sorted(groups)]
        assert {r["root"] for r in rows} == {brute_root(subroots, fanout)}
        assert {r["subroot"] for r in rows} == set(subroots)


def test_manifest_of_odd_rows(spark):
    odd = [(None, None, None, None, None), (None, "a", "", "", 1), (5, "b", "", "s", 1), (5, "b", "", "s", 1), (5, "ü", "é", "s", None)]
    rows = merkle.tamper_digest(spark.createDataFrame(odd, DOCUMENTS)).collect()
    assert len(rows) == 5
    want = hashlib.sha256(b"-----").hexdigest()
    assert [r["leaf"] for r in rows if r["leaf"] == r["subroot"]].count(want) == 1
    assert len({r["root"] for r in rows}) == 1
    alone = merkle.tamper_digest(spark.createDataFrame(odd[:1], DOCUMENTS)).first()
    assert alone["leaf"] == alone["root"] and alone["verified"] and alone["proof_sha256"] == hashlib.sha256(b"").hexdigest()
