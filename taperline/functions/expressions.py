"""Row-level expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.schema import POWER_ZONES

# A tag holding any of these words marks a match.
MATCH_WORDS = ("match", "game", "fixture", "competition")

MICROS_PER_DAY = 86_400_000_000


def session_type(tags: Column) -> Column:
    """``match`` when the free-text tag names one, else (also for NULL) ``training``."""
    return F.when(F.lower(tags).rlike("|".join(MATCH_WORDS)), "match").otherwise("training")


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; 1 where either is missing or the divisor is zero."""
    return F.coalesce(F.try_divide(part, whole), F.lit(1.0))


def add_present(a: Column, b: Column) -> Column:
    """Sum of the values that are present; NULL only when both are missing."""
    return F.coalesce(a + b, a, b)


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; 0 unless ``whole`` is positive."""
    return F.when(whole > 0, part / F.nullif(whole, F.lit(0.0)) * 100).otherwise(0.0)


def month_bucket(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def md_key(days: Column) -> Column:
    """``MD-k`` label for k days before a match; NULL outside the week before it."""
    return F.when(days.between(1, 7), F.concat(F.lit("MD-"), days.cast("int").cast("string")))


def excel_serial_to_ts(serial: Column) -> Column:
    """Spreadsheet day number (fractions are the time of day) to a zone-free timestamp."""
    micros = F.round(serial.cast("double") * float(MICROS_PER_DAY)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.expr("timestamp_ntz'1899-12-30 00:00:00'"))


def parse_date(text: Column, pattern: str | None = None) -> Column:
    """Text to a zone-free timestamp; unreadable text gives NULL."""
    parsed = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def blank_nan(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean a missing value; keep only NULL."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in sorted(floats)}) if floats else df


def high_intensity(df: DataFrame) -> DataFrame:
    """High-speed metres and hard accelerations, decelerations and impacts.

    A missing part makes the sum missing, except within the five power bands.
    """
    sums = {
        "high_speed_distance": ("dist_speed_z4", "dist_speed_z5"),
        "high_accel_count": ("accel_3_4", "accel_gt4"),
        "high_decel_count": ("decel_3_4", "decel_gt4"),
        "high_impact_count": ("impact_10_15", "impact_15_20", "impact_gt20"),
    }
    have = set(df.columns)
    new = {
        name: reduce(lambda a, b: a + b, [F.col(p) for p in parts])
        for name, parts in sums.items()
        if have.issuperset(parts)
    }
    if have.issuperset(POWER_ZONES + ("dist_power_gt50",)):
        bands = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in POWER_ZONES])
        new["high_power_distance"] = bands + F.col("dist_power_gt50")
    return df.withColumns(new) if new else df


def one_decimal(value: Column) -> Column:
    """Text with one decimal, rounded by the exact binary value; only a true tie goes to the even digit.

    Rounding functions go by the shortest decimal text instead, where 8.35 (a little less in
    binary) looks like a tie. Ten times the fraction is 8 times plus 2 times it; both are
    exact, and so is what their sum loses.
    """
    size = F.abs(value)
    whole = F.floor(size)
    eight, two = (size - whole) * 8, (size - whole) * 2
    tenths = eight + two
    lost = (eight - tenths) + two
    digit = F.floor(tenths)
    rest = tenths - digit
    up = (rest > 0.5) | ((rest == 0.5) & ((lost > 0) | ((lost == 0) & (digit % 2 == 1))))
    total = whole * 10 + digit + up.cast("int")
    sign = F.when(value < 0, "-").otherwise("")
    return F.concat(sign, F.floor(total / 10).cast("string"), F.lit("."), (total % 10).cast("string"))
