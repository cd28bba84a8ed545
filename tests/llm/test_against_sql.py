"""Queries that SQL can express, over a small corpus with all special cases."""

import pandas as pd
import pytest
from text_fixture import folder, rows_of, sql_rows

from taperline.llm import queries, sql

NAMES = ["op2_minhash_near_dedup", "op4_quality_rules", "op6_license_scans", "op7_benchmark_decontamination", "op10_suffix_array_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_documents_match_sql(spark, tmp_path, name):
    path = folder(tmp_path)
    assert rows_of(queries.all_queries()[name](spark, path)) == sql_rows(sql.all_sql()[name], path)


def test_pages_match_sql(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", None, "", "<p>é ü</p>", "x" * 100_000, "<p>a</p>", None]
    pd.DataFrame({"page_id": range(8), "url": [f"http://h/{i}" for i in range(7)] + [None], "html": html}).to_parquet(f"{tmp_path}/pages.parquet")
    got = rows_of(queries.all_queries()["op8_warc"](spark, str(tmp_path)))
    assert got == sql_rows(sql.all_sql()["op8_warc"], str(tmp_path), ("pages",))
