"""Pairs of sessions and the matches they come before, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taperline.operators.hotspots import joined, max_group_rows, stored
from taperline.operators.rules import PRE_MATCH_DAYS
from taperline.operators.zones import KEY


def session_match_pairs(sessions: DataFrame, matches: DataFrame, days: int = PRE_MATCH_DAYS) -> DataFrame:
    """Each session with every match of its player 1 to ``days`` days later; all other columns come along.

    An interval join over bins of ``days`` days: a session lies in one bin, its matches in that or the next,
    so a match goes to two bins and each pair meets once. A player's bin with many sessions is split by
    salts, and only there matches are copied. Key columns of the match begin with ``match_``.
    """
    limit = max_group_rows(sessions.sparkSession)
    day = lambda c: F.unix_date(c).cast("long")
    left = sessions.withColumns({"_day": day("session_date"), "_bin": F.floor(day("session_date") / days)})
    crowds = left.groupBy("player", "_bin").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("_salts"))
    crowds = stored(crowds.filter("_salts > 1"))
    salt = F.coalesce(F.pmod(F.xxhash64(*KEY), F.col("_salts")), F.lit(0)).cast("int")
    left = joined(left, crowds, ["player", "_bin"], "left").withColumn("_salt", salt).drop("_salts")
    own = F.floor(day("session_date") / days)
    right = matches.withColumns({"_match_day": day("session_date"), "_bin": F.explode(F.array(own - 1, own))})
    right = right.withColumnsRenamed({c: f"match_{c}" for c in KEY if c != "player"})
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    right = joined(right, crowds, ["player", "_bin"], "left").withColumn("_salt", copies).drop("_salts")
    apart = F.col("_match_day") - F.col("_day")
    both = left.join(right.hint("merge"), ["player", "_bin", "_salt"]).withColumn("days_before", apart.cast("int"))
    return both.filter(F.col("days_before").between(1, days)).drop("_day", "_match_day", "_bin", "_salt")
