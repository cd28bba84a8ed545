"""Compare queries with their SQL counterparts: ``python tests/check_oracle.py [sf_dir] [names…]``.

MAX_GROUP_ROWS=600 in the environment sends players with more sessions through the plan
for oversized ones.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

import __spark_entry__ as entry_points

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple("~" if pd.isna(v) else str(v) for v in row) for row in df.itertuples(index=False)))


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    ours = entry_points.queries()[name](spark, sf_dir).toArrow()
    theirs = con.sql(entry_points.oracle_sql()[name]).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {ours.column_names} != {theirs.column_names}"
    kinds = [(c, str(ours.schema.field(c).type), str(theirs.schema.field(c).type)) for c in ours.column_names]
    kinds = [k for k in kinds if k[1].replace("large_", "") != k[2].replace("large_", "")]
    options = {"integer_object_nulls": True, "date_as_object": True}
    a, b = normal(ours.to_pandas(**options)), normal(theirs.to_pandas(**options))
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"rows {len(a)} vs {len(b)}; first differences {diff} {kinds}"
    return f"types {kinds}" if kinds else ""


def main() -> None:
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry_points.oracle_sql())
    spark, con = make_session(), connect(sf_dir)
    if "MAX_GROUP_ROWS" in os.environ:
        spark.conf.set("spark.taperline.maxGroupRows", os.environ["MAX_GROUP_ROWS"])
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
