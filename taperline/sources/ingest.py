"""Session ingest: exports in, one canonical DataFrame out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taperline.functions.expressions import blank_nan, excel_serial_to_ts, parse_date
from taperline.operators.hotspots import stored
from taperline.schema import EXPORT_COLUMNS, TIE_BREAK, require_columns


def read_sessions(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", date_format: str = "excel_serial"
) -> DataFrame:
    """Read a wearable export.

    ``date_format`` is ``excel_serial``, ``iso`` or a Spark datetime pattern. CSV text is
    read without an inference pass: every known column is cast to its declared type and a
    cell that does not fit becomes NULL. Columns may come in any order, in each file its
    own; unknown ones are left unread, and one that some files lack is NULL in their rows.
    """
    if fmt != "csv":
        return canonical(spark.read.format(fmt).load(path), date_format)
    parts = [spark.read.option("header", True).csv(files) for files in files_by_header(spark, path)]
    return union_sessions(*(canonical(raw, date_format) for raw in parts))


BROKEN = "_broken_row"


def read_with_quarantine(
    spark: SparkSession, path: str | list[str], date_format: str = "excel_serial"
) -> tuple[DataFrame, DataFrame]:
    """CSV sessions, and the rows that cannot be one: (file, row, reason).

    A row goes to quarantine, as its text cells in JSON, if its number of cells is not that of the header or
    if it has no player or no readable date; the first reason counts. Other cells that do not fit are NULL
    in a session that stays, as in ``read_sessions``.
    """
    good, bad = [], []
    for files in files_by_header(spark, path):
        names = spark.read.option("header", True).csv(files).columns
        cells = T.StructType([T.StructField(c, T.StringType()) for c in [*names, BROKEN]])
        raw = spark.read.schema(cells).option("header", True).option("columnNameOfCorruptRecord", BROKEN).csv(files)
        known = {c for header, (c, _) in EXPORT_COLUMNS.items() if header in names or c in names} | set(names)
        require_columns(raw.limit(0).select(*[F.lit(None).alias(c) for c in known]))
        dates = [_date(F.col(f"`{c}`"), date_format, raw) for c in ("Date", "session_ts", "session_date") if c in names]
        players = [F.trim(f"`{c}`") for c in ("Player Name", "player") if c in names]
        why = (
            F.when(F.col(BROKEN).isNotNull(), "wrong number of cells")
            .when(F.coalesce(players[0], F.lit("")) == "", "no player")
            .when(dates[0].isNull(), "no readable date")
        )
        judged = raw.withColumn("reason", why)
        row = F.coalesce(BROKEN, F.to_json(F.struct(*[f"`{c}`" for c in names])))
        bad.append(judged.filter("reason is not null").select(F.col("_metadata.file_path").alias("file"), row.alias("row"), "reason"))
        good.append(canonical(judged.filter("reason is null").drop("reason", BROKEN), date_format))
    return union_sessions(*good), union_sessions(*bad)


def files_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """CSV files with the same header line together; Spark applies one file's header to all it reads.

    The driver gets one short row per file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("place")
    )
    starts = lines.filter(F.col("_metadata.file_block_start") == 0).filter("value <> ''")
    headers: dict[str, list[str]] = {}
    for row in starts.groupBy("file").agg(F.min_by("value", "place").alias("header")).orderBy("file").collect():
        headers.setdefault(row["header"], []).append(row["file"])
    if not headers:
        raise ValueError(f"No header line in {path}")
    return list(headers.values())


def canonical(raw: DataFrame, date_format: str = "excel_serial") -> DataFrame:
    """Rename export headers, cast, derive the date and a tie-break key."""
    names = {}
    for header, (name, dtype) in EXPORT_COLUMNS.items():
        source = header if header in raw.columns else name if name in raw.columns else None
        if source:
            names[name] = (F.col(f"`{source}`"), dtype)
    dated = "session_ts" in names or "session_date" in raw.columns
    columns: list[Column] = []
    for name, (col, dtype) in names.items():
        if name == "session_ts":
            col = _date(col, date_format, raw)
        elif dtype.typeName() == "long":
            col = col.try_cast("double").try_cast("bigint")
        else:
            col = col.try_cast(dtype)
        columns.append(col.alias(name))
    if "session_ts" not in names and dated:
        columns.append(F.col("session_date").cast("timestamp_ntz").alias("session_ts"))
    if set(TIE_BREAK).issubset(raw.columns):
        columns += [F.col(k).cast("bigint").alias(k) for k in TIE_BREAK]
    else:
        # Same content, same key, whatever file or partition the row came from.
        columns.append(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]).alias("k1"))
        columns += [F.lit(0).cast("bigint").alias(k) for k in TIE_BREAK[1:]]
    out = blank_nan(raw.select(*columns))
    require_columns(out)
    return default_position(out).withColumn("session_date", F.col("session_ts").cast("date"))


def _date(col: Column, date_format: str, raw: DataFrame) -> Column:
    if date_format == "excel_serial":
        return excel_serial_to_ts(col.try_cast("double"))
    if date_format == "iso":
        return col.try_cast("timestamp_ntz")
    return parse_date(col.cast("string"), date_format)


def default_position(sessions: DataFrame) -> DataFrame:
    return sessions if "position" in sessions.columns else sessions.withColumn("position", F.lit("Unknown"))


def union_sessions(*parts: DataFrame) -> DataFrame:
    """Stack exports; a column one of them lacks is NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def order_sessions(sessions: DataFrame) -> DataFrame:
    """Final output order; windows carry their own."""
    return sessions.orderBy("player", "session_date", *TIE_BREAK)


def dataset_profile(sessions: DataFrame, approximate: bool = False) -> DataFrame:
    """Row, column and player counts. ``approximate`` trades the exact distinct count for a sketch."""
    players = F.approx_count_distinct("player") if approximate else F.count_distinct("player")
    return sessions.agg(F.count(F.lit(1)).alias("n_sessions"), players.alias("n_players")).select(
        "n_sessions", F.lit(len(sessions.columns)).cast("bigint").alias("n_columns"), "n_players"
    )


def distinct_players(sessions: DataFrame) -> DataFrame:
    return sessions.select("player").distinct()


def split_key() -> Column:
    """Where a row stands in the order of the split: a hash of its own key, then the key."""
    key = F.concat_ws("|", "player", F.col("session_date").cast("string"), *TIE_BREAK)
    at = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
    return F.struct(at.alias("at"), "player", "session_date", *TIE_BREAK)


def kth_smallest(keys: DataFrame, k: int, in_one_task: int = 50_000) -> Row | None:
    """The k-th smallest ``key`` (a struct whose first field ``at`` is a whole number), counted from 1.

    Histograms narrow the range of ``at`` down to a cell of few rows, and only that cell is ordered. One
    row per round comes to the driver.
    """
    low, high, inside = 0, (1 << 60) - 1, F.col("key.at").isNotNull()
    while True:
        cell = keys.filter(inside)
        width = max(1, -(-(high - low + 1) // 1024))
        bins = cell.groupBy(F.expr(f"(key.at - {low}) div {width}").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(W.orderBy("bin"))
        found = bins.withColumn("upto", upto).filter(F.col("upto") >= k).orderBy("bin").first()
        if found is None:
            return None
        k -= found["upto"] - found["n"]
        low, high = low + found["bin"] * width, low + (found["bin"] + 1) * width - 1
        inside = F.col("key.at").between(low, high)
        if found["n"] <= in_one_task or low == high:
            # Equal hashes of different keys are a handful; equal keys are equal rows.
            return keys.filter(inside).select("key").orderBy("key").limit(k).agg(F.max("key").alias("key")).first()["key"]


def train_test_split(sessions: DataFrame, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """All but the test part, and the test part: exactly ``test_percent`` of the rows, rounded up.

    The test part is the rows that come first by ``split_key``, so a row falls on the same side under any
    layout. Of rows equal in the last key as many as needed are taken.
    """
    keyed = sessions.withColumn("key", split_key())
    wanted = -(-sessions.count() * test_percent // 100)
    last = kth_smallest(keyed.select("key"), wanted) if wanted else None
    if last is None:
        return sessions, sessions.limit(0)
    names = ["at", "player", "session_date", *TIE_BREAK]
    bound = F.struct(*[F.lit(last[c]).cast(keyed.select(f"key.{c}").schema[0].dataType).alias(c) for c in names])
    first, same = keyed.filter(F.col("key") < bound), keyed.filter(F.col("key") == bound)
    train = keyed.filter(F.col("key") > bound)
    short = wanted - first.count()
    if same.count() == short:
        test = keyed.filter(F.col("key") <= bound)
    else:
        same = stored(same.withColumn("_place", F.monotonically_increasing_id()))
        picked = same.orderBy("_place").limit(short).agg(F.max("_place")).first()[0] if short else -1
        test = first.unionByName(same.filter(F.col("_place") <= picked).drop("_place"))
        train = train.unionByName(same.filter(F.col("_place") > picked).drop("_place"))
    return train.drop("key"), test.drop("key")
