"""Players too large for one task.

Most players have a few thousand sessions and their windows belong in one task each.
A player with more than ``max_group_rows`` sessions is *heavy*: its rows take another
plan, which never brings a whole player together. Whether there is such a player is
asked once, by a count that reads only the player column; where there is none, the heavy
plan is not built at all.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taperline.schema import TIE_BREAK

MAX_GROUP_ROWS = "spark.taperline.maxGroupRows"
CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A table of more rows is never broadcast, however few bytes its files are said to hold.
BROADCAST_ROWS = 20_000
#: Regular players' windows go to a task for about so many rows.
TASK_ROWS = 100_000
#: At instant grain a frame of days may hold all of a player's rows and is re-read for each of them, so
#: players above so many rows are heavy whatever the limit (if all of them have a time).
INSTANT_ROWS = 5_000


def share_code(spark: SparkSession) -> None:
    """Python workers of a local session find the package where the driver does; clusters have it installed."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))


@dataclass(frozen=True)
class Split:
    """The same columns for regular players and, where there are any, for heavy ones."""

    regular: DataFrame
    heavy: DataFrame | None = None
    #: The heavy players, stored.
    players: DataFrame | None = None

    def union(self) -> DataFrame:
        return self.regular if self.heavy is None else self.regular.unionByName(self.heavy)

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Split:
        return Split(change(self.regular), None if self.heavy is None else change(self.heavy), self.players)


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_GROUP_ROWS, "250000"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a session whose driver is its one executor may do without the setting; its folder
    is deleted when the process ends.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"Set {CHECKPOINT_DIR} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="taperline-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as each ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)


#: Paths of tables stored inside of ``stored_alone``, one list for each that runs.
_MADE: list[list[str]] = []


def stored(df: DataFrame) -> DataFrame:
    """Write a table that several passes read to the shared folder, where it outlives executors.

    It is columnar, so each pass reads what it needs. The planner takes its size from compressed files
    and the share of columns read, far below what it holds in memory: see ``joined``. Once it is written
    nothing reads the shuffles that made it.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with shuffles_cleaned(df.sparkSession):
        df.write.parquet(path)
    if _MADE:
        _MADE[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """Store what ``make`` returns; the tables that it stored on its way, which nothing else reads, go."""
    _MADE.append([])
    try:
        df = make()
    finally:
        spent = _MADE.pop()
    out = stored(df)
    spark = df.sparkSession
    for path in spent:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return out


def joined(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a stored table, broadcast by its number of rows; otherwise by a shuffle that can be split."""
    return rows.join(table.hint("broadcast" if table.count() <= BROADCAST_ROWS else "merge"), keys, how)


def split_players(sessions: DataFrame, most: int | None = None) -> Split:
    """Regular and heavy players' rows; the latter are at most rows / max_group_rows players.

    With ``most`` players above so many rows are heavy too if each row has its time ``t``: the heavy plan
    leaves out rows without one.
    """
    big = F.col("n") > max_group_rows(sessions.sparkSession)
    held = [F.count(F.lit(1)).alias("n")]
    if most is not None:
        held.append(F.count("t").alias("timed"))
        big = big | (F.col("n") > most) & (F.col("n") == F.col("timed"))
    counts = sessions.groupBy("player").agg(*held)
    n_big, n_rows = counts.agg(F.count_if(big), F.sum(F.when(~big, F.col("n")))).first()
    if not n_big:
        return Split(by_player(sessions, n_rows or 0))
    players = stored(counts.filter(big).select("player"))
    if not n_rows:
        return Split(sessions.filter(F.lit(False)), sessions, players)
    regular = joined(sessions, players, ["player"], "left_anti")
    return Split(by_player(regular, n_rows or 0), joined(sessions, players, ["player"]), players)


def by_player(rows: DataFrame, n_rows: int) -> DataFrame:
    """The one exchange of all windows within players.

    Its tasks hold as many rows however large the table: partitions put together by their compressed size
    would hold more and more.
    """
    n = -(-n_rows // TASK_ROWS)
    return rows.repartition(n, "player") if n > rows.sparkSession.sparkContext.defaultParallelism else rows.repartition("player")


def lookup(rows: Split, table: DataFrame, keys: list[str], how: str = "left") -> Split:
    """Attach a per-player table to session rows.

    Regular rows meet the table by an ordinary equi-join. The heavy players' part of the
    table is a few entries for each of at most rows / max_group_rows players.
    """
    regular = rows.regular.join(table, keys, how)
    if rows.heavy is None:
        return Split(regular)
    few = stored(table.join(rows.players, "player", "left_semi"))
    return Split(regular, joined(rows.heavy, few, keys, how), rows.players)


def salted_join(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Join heavy rows to a stored rollup of them by ``keys``; its ``_rows`` says how many each entry stands for.

    An entry of more than ``max_group_rows`` rows is copied once per salt, so its rows spread over as many
    tasks; all others meet theirs as they are. The rollup grows with the rows, so it is never broadcast.
    """
    limit = max_group_rows(rows.sparkSession)
    crowds = stored(table.filter(F.col("_rows") > limit).select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_salts")))
    table = table.drop("_rows")
    if crowds.isEmpty():
        return rows.join(table.hint("merge"), keys)
    salt = F.coalesce(F.pmod(F.xxhash64(*TIE_BREAK), F.col("_salts")), F.lit(0)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    rows = joined(rows, crowds, keys, "left").withColumn("_salt", salt).drop("_salts")
    table = joined(table, crowds, keys, "left").withColumn("_salt", copies).drop("_salts")
    return rows.join(table.hint("merge"), [*keys, "_salt"]).drop("_salt")
