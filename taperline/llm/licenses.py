"""License notices by an exact set-similarity join of text blocks and notice templates.

A text's words are cut into blocks that overlap by half, of 64 words or twice the longest template's, so
that any notice lies in one block whole. A block holds a template if it contains at least 90 % of the template's
different words. The join finds every such pair: words are ordered by the number of blocks that have
them, rarest first; a template's prefix is as many of its rarest words as must share one with the block
(prefix filter), blocks with too few template words are left out (length filter), and of a shared word's
places in both orders follows how many more can be shared (positional filter). Pairs that remain are
verified on their sets. Only words that some template has can count, so blocks keep no others.

The fixed phrases are looked for beside that, word by word. A null text is empty. Repeated rows get the
same answer each; a null doc_id stays null; long texts are whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import stored, text_identity, text_slices
from taperline.llm.kernels import ALPHANUMERIC, word_hashes

STEP = 32  # words from one block to the next at least; a block is two steps long
CONTAINMENT = 90  # per cent

# Phrases of the base labels.
PHRASES = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}

# Words of usual notices, as (label, notice).
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: A block that holds the first is not also taken for the second.
NARROWER = [("lgpl", "gpl"), ("agpl", "gpl"), ("cc-by-sa", "cc-by"), ("cc-by-nc", "cc-by")]


def needed(size: int) -> int:
    return -(-CONTAINMENT * size // 100)


def block_step(templates: list[tuple[str, str]]) -> int:
    """Words from one block to the next, as many as the longest template has at least."""
    return max(STEP, *(len(notice.split()) for _, notice in templates))


def vocabulary(templates: list[tuple[str, str]]) -> list[str]:
    phrases = [w for p in PHRASES.values() for w in p.split()]
    return sorted({w for _, notice in templates for w in notice.split()} | set(phrases))


def scan_texts(documents: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """Per document: words, places of the fixed phrases, and its blocks' template words as numbers."""
    vocab = vocabulary(templates)
    step = block_step(templates)
    least = min(needed(len(set(notice.split()))) for _, notice in templates)
    joined = " ".join(vocab).encode()
    codes, _ = word_hashes(np.frombuffer(joined, dtype=np.uint8), np.array([0, len(joined)]), ALPHANUMERIC)
    order = np.argsort(codes)
    phrases = [[vocab.index(w) for w in p.split()] for p in PHRASES.values()]
    labels = list(PHRASES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = codes[order]
        for rows, data, offsets in text_slices(batches):
            hashes, first = word_hashes(data, offsets, ALPHANUMERIC)
            texts = len(first) - 1
            at = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
            places = np.flatnonzero(ordered[at] == hashes)
            number = np.full(len(hashes) + 8, -1, dtype=np.int64)
            number[places] = order[at[places]]
            text_of = np.searchsorted(first, np.arange(len(hashes)), side="right") - 1
            n_base = np.zeros(texts, dtype=np.int64)
            low, high = np.full(texts, np.iinfo(np.int64).max), np.full(texts, -1, dtype=np.int64)
            base: list[list[str]] = [[] for _ in range(texts)]
            for label, phrase in zip(labels, phrases, strict=True):
                hit = np.flatnonzero(number[: len(hashes)] == phrase[0])
                for k, word in enumerate(phrase):
                    hit = hit[number[hit + k] == word]
                hit = hit[hit + len(phrase) <= first[text_of[hit] + 1]] if len(hit) else hit
                owner = text_of[hit]
                np.add.at(n_base, owner, 1)
                np.minimum.at(low, owner, hit - first[owner])
                np.maximum.at(high, owner, hit - first[owner])
                for t in np.unique(owner):
                    base[t].append(label)
            # A word stands in the block that starts before it and in the one before that.
            owner = text_of[places]
            block = (places - first[owner]) // step
            wide = np.int64(len(vocab))
            stride = np.int64(block.max() + 2) if len(block) else np.int64(1)
            keys = np.concatenate([(owner * stride + b) * wide + number[places] for b in (block, block - 1)])
            keys = np.unique(keys[np.concatenate((block, block - 1)) >= 0])
            group, token = keys // wide, keys % wide
            heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, dtype=np.int64)
            sizes = np.diff(np.concatenate((heads, [len(group)])))
            blocks: list[list[list[int]]] = [[] for _ in range(texts)]
            for h, n in zip(heads[sizes >= least], sizes[sizes >= least], strict=True):
                blocks[group[h] // stride].append(token[h : h + n].astype(np.int16))
            found = n_base > 0
            columns = [
                rows.column(0),
                rows.column(1),
                pa.array(np.diff(first), pa.int64()),
                pa.array(n_base),
                pa.array(low, mask=~found),
                pa.array(high, mask=~found),
                pa.array(base, pa.list_(pa.string())),
                pa.array(blocks, pa.list_(pa.list_(pa.int16()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, text_hash long, n_words long, n_base long, first_word long, last_word long, "
        "base array<string>, blocks array<array<smallint>>"
    )
    return documents.select(*text_identity(), "text").mapInArrow(run, schema)


def similar_blocks(scanned: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, text_hash, block, label, containment) of every block that holds a template."""
    spark = scanned.sparkSession
    vocab = vocabulary(templates)
    blocks = scanned.select("doc_id", "text_hash", F.posexplode("blocks").alias("block", "tokens"))
    counted = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    often = {r["token"]: r["n"] for r in counted.collect()}  # at most as many rows as templates have words
    rank = {t: r for r, t in enumerate(sorted(range(len(vocab)), key=lambda t: (often.get(t, 0), t)))}
    prefixes, sets = [], []
    for number, (label, notice) in enumerate(templates):
        ordered = sorted(rank[vocab.index(w)] for w in set(notice.split()))
        need = needed(len(ordered))
        sets.append((number, label, ordered, need))
        prefixes += [(r, number, i, len(ordered), need) for i, r in enumerate(ordered[: len(ordered) - need + 1])]
    # Both tables are as large as the list of templates.
    prefix = F.broadcast(spark.createDataFrame(prefixes, "rank int, template int, i int, size int, need int"))
    template = F.broadcast(spark.createDataFrame(sets, "template int, label string, words array<int>, need int"))
    ranks = F.array(*[F.lit(rank[t]) for t in range(len(vocab))])
    ordered = blocks.select("doc_id", "text_hash", "block", F.array_sort(F.transform("tokens", lambda t: ranks[t.cast("int")])).alias("ranks"))
    lead = max(r for r, *_ in prefixes)
    met = (
        ordered.select("*", F.size("ranks").alias("held"), F.posexplode("ranks").alias("j", "rank"))
        .filter(F.col("rank") <= lead)
        .join(prefix, "rank")
        .filter("held >= need and 1 + least(size - i - 1, held - j - 1) >= need")
    )
    candidates = met.groupBy("doc_id", "text_hash", "block", "template").agg(F.any_value("ranks").alias("ranks"))
    shared = F.size(F.array_intersect("ranks", "words"))
    return (
        candidates.join(template, "template")
        .withColumn("shared", shared)
        .filter("shared >= need")
        .select("doc_id", "text_hash", "block", "label", (F.col("shared") / F.size("words")).alias("containment"))
    )


def license_labels(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per document the base columns, all labels and the score (1 for a phrase, else the best containment)."""
    scanned = stored(scan_texts(documents, templates), "licenses")
    blocks = similar_blocks(scanned, templates).groupBy("doc_id", "text_hash", "block").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best")
    )
    for narrow, wide in NARROWER:
        blocks = blocks.withColumn("found", F.when(F.array_contains("found", narrow), F.array_remove("found", wide)).otherwise(F.col("found")))
    per_text = blocks.groupBy("doc_id", "text_hash").agg(
        F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"), F.max("best").alias("best")
    )
    per_text = per_text.select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"), "found", "best")
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash"))
    joined = scanned.drop("blocks").join(stored(per_text, "labels"), same, "left")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
