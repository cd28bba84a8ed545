"""Empty tables, nulls, repeated rows and odd columns for every operator on documents."""

import hashlib

import pytest
from text_fixture import DOCUMENTS, frames, with_odd_columns

from taperline.llm import decontaminate, html_text, licenses, lm, merkle, near_dedup, packing, pipeline, quality, repeats, secrets, sharding, warc
from taperline.llm.queries import tokenizer_path

OPERATORS = {
    "secrets": secrets.secret_findings,
    "near_dedup": near_dedup.near_duplicates,
    "packing": lambda d: packing.pack_documents(d, tokenizer_path()),
    "quality": quality.quality_verdicts,
    "licenses": licenses.license_labels,
    "decontaminate": lambda d: decontaminate.matches(d, d.sparkSession.createDataFrame([(1, "a b c")], "item_id long, text string")),
    "lm": lambda d: lm.document_scores(d, tokenizer_path()),
    "repeats": repeats.without_repeats,
    "sharding": lambda d: sharding.shard_documents(d, shards=4),
    "merkle": merkle.tamper_digest,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_odd_tables(spark, name):
    run = OPERATORS[name]
    assert run(spark.createDataFrame([], DOCUMENTS)).collect() == []
    odd = [(None, None, None, None, None), (None, "a b c d e f g", None, None, 1), (5, "a b c d e f g", "en", "s", 1), (5, "a b c d e f g", "en", "s", 1)]
    found = run(with_odd_columns(spark.createDataFrame(odd, DOCUMENTS))).collect()
    assert len(found) == 4
    assert sorted(str(r["doc_id"]) for r in found) == ["5", "5", "None", "None"]


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(4, text, "en", "s", 1), (4, text, "en", "s", 1), (9, text + " x", "en", "s", 1), (None, text, "en", "s", 1)], DOCUMENTS)
    found = near_dedup.near_duplicates(rows).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {(4, 4, True), (9, 4, False), (None, 4, False)}
    kept = near_dedup.distinct_documents(with_odd_columns(rows))
    assert [(r["doc_id"], r["kept"]) for r in kept.collect()] == [(4, "odd")]
    removed = {(r["doc_id"], r["n_removed"] == r["n_bytes"]) for r in repeats.without_repeats(rows).collect()}
    assert removed == {(4, True), (9, False), (None, True)}


def test_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract_text(empty).collect() == []
    assert warc.revisit_digest(warc.write_archive(empty)).collect() == []
    odd = spark.createDataFrame([(None, None, None, "x"), (2, "u\r\nX: y", "", "x"), (2, "u", "<p>é", "x"), (2, "u", "<p>é", "x")], "page_id long, url string, html string, digest string")
    texts = [(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_text(odd).collect()]
    assert sorted(texts, key=repr) == sorted([(None, "", 0), (2, "", 0), (2, "é", 1), (2, "é", 1)], key=repr)
    archive = warc.write_archive(odd)
    records = warc.parse_records(warc.read_records(archive)).collect()
    assert sorted(r["url"] for r in records) == ["", "u", "u", "u%0D%0AX: y"]
    found = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.revisit_digest(archive).collect()), key=repr)
    assert found == sorted([(2, 0, "response", None), (None, 0, "revisit", 2), (2, 5, "response", None), (2, 5, "revisit", 2)], key=repr)


def test_stages_keep_columns_of_empty_and_odd_documents(spark, tmp_path):
    documents, items = frames(spark)
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, documents.limit(0), str(tmp_path)).columns == documents.columns, name
    odd = with_odd_columns(documents)
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, odd, str(tmp_path)).columns == odd.columns, name


def test_line_ends_of_other_alphabets_in_urls(spark):
    kinds = "page_id long, url string, html string"
    urls = [f"u{sign}Content-Length: 3 {sign}WARC-Refers-To: <urn:page:77>{sign}" for sign in ("\u2028", "\u2029", "\u0085", "\x0b", "\x0c", "\x1e")]
    archive = warc.write_archive(spark.createDataFrame([(i, u, "<p>é") for i, u in enumerate(urls)], kinds))
    records = {r["page_id"]: (r["url"], r["record_type"], r["refers_to"], bytes(r["block"])) for r in warc.parse_records(warc.read_records(archive)).collect()}
    last = len(urls) - 1
    assert records == {i: (u, "response", None, "<p>é".encode()) if i == last else (u, "revisit", last, b"") for i, u in enumerate(urls)}
    assert {r["payload_bytes"] for r in warc.revisit_digest(archive).collect()} == {5}


def test_page_ids_that_are_text(spark):
    ids = ["p1", "p2", "", "a%0Ab", "a\nb", "x>y", "\u2028", None]
    rows = spark.createDataFrame([(i, "u", "same") for i in ids], "page_id string, url string, html string")
    found = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.revisit_digest(warc.write_archive(rows)).collect()}
    largest = max(i for i in ids if i is not None)
    assert found == {i: ("response", None) if i == largest else ("revisit", largest) for i in ids}


def test_benchmark_items_without_an_id(spark):
    documents = spark.createDataFrame([(1, "a b c d", "en", "s", 7)], DOCUMENTS)
    items = spark.createDataFrame([(None, "a b"), ("", "c d"), (None, "b c"), ("x", "q")], "item_id string, text string")
    for block in (decontaminate.BLOCK_WORDS, 1):
        row = decontaminate.match_digest(decontaminate.matches(documents, items, block)).first()
        assert (row["n_items"], row["n_hit"], row["contaminated"]) == (2, 4, True)
        assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()
