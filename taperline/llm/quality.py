"""Quality rules whose cutoffs adapt to each language and source.

Every document gets counts (words, symbols, repeated lines, repeated three-word windows) and from them
a few rates in whole thousandths. For each (language, source) the rates go into mergeable quantile
sketches: counts of log-linear buckets, which add up exactly in any order and give quantiles within one
part in 64 of the value. The fences of a rate lie beyond its quartiles by a multiple of their distance,
so that a uniform source loses nothing and only documents far outside of their own group go. A group
with few documents is measured by its language, and that by all documents. Fences are joined back to
the documents' rates and filter them.

A null text has no words. A null language or source is a group of its own. Repeated rows are judged one
by one and alike. An empty table gives an empty result. Everything runs as DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taperline.llm.common import stored

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Copies of each fence, so that the rows of one source meet it in several tasks.
SALTS = 16


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: A fence is the outer quartile plus this many times the distance between the quartiles ...
    reach: int = 3
    #: ... of which at least so much is assumed: thousandths, for word lengths hundredths of a character.
    least_spread: tuple[tuple[str, int], ...] = (("symbol_rate", 25), ("dup_line_rate", 100), ("repeat_rate", 100), ("word_length", 40))
    #: Groups with fewer documents are measured by the next larger group.
    min_documents: int = 100


#: Rates with an upper fence; the mean word length also has a lower one.
UPPER = ("symbol_rate", "dup_line_rate", "repeat_rate", "word_length")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more."""
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i"))
    )
    ordered = F.sort_array(windows)
    twins = F.zip_with(
        F.slice(ordered, F.lit(1), F.greatest(n - 3, F.lit(0))),
        F.slice(ordered, 2, F.greatest(n - 3, F.lit(0))),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.flatten(F.filter(twins, lambda t: t.isNotNull()))
    covered = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
    return F.when(n < 4, F.lit(0)).otherwise(F.size(F.array_distinct(covered))).cast("long")


def count_columns(text: Column) -> dict[str, Column]:
    """The counts of a text, apart from those that need its list of words."""
    spaced = F.regexp_replace(text, SPACES, "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit("\t\n\x0b\x0c\r ")) != "")
    return {
        "word_chars": F.length(spaced).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def with_counts(documents: DataFrame, keep: list[Column], rules: Rules) -> DataFrame:
    """The columns in ``keep`` and the counts and rates of each document's text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = documents.select(*keep, F.col("lang").alias("_lang"), F.col("source").alias("_source"), text.alias("_text"))
    kept = [c for c in base.columns if c not in ("_text",)]
    words = base.select("*", word_list(F.col("_text")).alias("_words"))
    counted = words.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        *[c.alias(n) for n, c in count_columns(F.col("_text")).items()],
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )

    def rate(part: str, whole: str, scale: int = 1000) -> Column:
        return F.when(F.col(whole) > 0, F.expr(f"{scale} * {part} div {whole}")).otherwise(0)

    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    return counted.withColumns(
        {
            "symbol_rate": rate("n_symbols", "word_chars"),
            "dup_line_rate": rate("n_dup_lines", "n_lines"),
            "repeat_rate": rate("n_repeat_words", "n_words"),
            "word_length": rate("word_chars", "n_words", 100),
            "base_failed": failed,
        }
    )


def bucket(value: Column) -> Column:
    """The lower end of a value's sketch bucket: exact below 64, then its six leading bits."""
    size = F.length(F.bin(value))
    step = F.pow(F.lit(2.0), F.greatest(size - 6, F.lit(0))).cast("long")
    return value - value % step


def fences(counts: DataFrame, rules: Rules) -> DataFrame:
    """(_lang, _source, fence columns) from quantile sketches of the documents that pass the fixed rules."""
    rates = F.explode(F.array(*[F.struct(F.lit(m).alias("rate"), bucket(F.col(m)).alias("at")) for m in UPPER])).alias("r")
    sketch = (
        counts.filter(~F.col("base_failed"))
        .select("_lang", "_source", rates)
        .groupBy("_lang", "_source", "r.rate", "r.at")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Sketches of larger groups are sums of those of smaller ones; a sketch has at most a few hundred buckets.
    merged = (
        sketch.unionByName(sketch.groupBy("_lang", "rate", "at").agg(F.sum("n").alias("n")).withColumn("_source", F.lit("")).withColumn("level", F.lit(1)), True)
        .unionByName(
            sketch.groupBy("rate", "at").agg(F.sum("n").alias("n")).withColumns({"_lang": F.lit(""), "_source": F.lit(""), "level": F.lit(2)}), True
        )
        .withColumn("level", F.coalesce("level", F.lit(0)))
    )
    buckets = F.array_sort(F.collect_list(F.struct("at", "n")))
    per_rate = merged.groupBy("level", "_lang", "_source", "rate").agg(buckets.alias("b"), F.sum("n").alias("n"))

    def quantile(percent: int) -> Column:
        # The first bucket in which the running count passes the rank.
        rank = F.expr(f"(n - 1) * {percent} div 100")
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).cast("long").alias("at"))
        found = F.aggregate(
            "b",
            start,
            lambda s, x: F.struct(
                (s["seen"] + x["n"]).alias("seen"),
                F.when((s["at"] < 0) & (s["seen"] + x["n"] > rank), x["at"]).otherwise(s["at"]).alias("at"),
            ),
        )
        return found["at"]

    floors = F.create_map(*[F.lit(x) for pair in rules.least_spread for x in pair])
    spread = F.greatest(F.col("q3") - F.col("q1"), floors[F.col("rate")]) * rules.reach
    fenced = per_rate.select("level", "_lang", "_source", "rate", "n", quantile(25).alias("q1"), quantile(75).alias("q3")).select(
        "level", "_lang", "_source", "rate", "n", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")
    )
    picks = [F.max(F.when(F.col("rate") == m, F.col("high"))).alias(f"_high_{m}") for m in UPPER]
    picks.append(F.max(F.when(F.col("rate") == "word_length", F.col("low"))).alias("_low_word_length"))
    wide = fenced.groupBy("level", "_lang", "_source").agg(F.max("n").alias("n"), *picks)
    names = [c for c in wide.columns if c.startswith(("_high", "_low"))]
    groups = counts.select("_lang", "_source").distinct()
    # Each group asks for its own sketch, its language's and that of all, and takes the first with enough documents.
    asked = groups.select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("_level")).alias("g")
    wide = wide.withColumnsRenamed({"_lang": "_of_lang", "_source": "_of_source"})
    same = (
        (F.col("_level") == F.col("level"))
        & F.when(F.col("_level") < 2, F.col("_lang")).otherwise("").eqNullSafe(F.col("_of_lang"))
        & F.when(F.col("_level") < 1, F.col("_source")).otherwise("").eqNullSafe(F.col("_of_source"))
    )
    enough = asked.join(wide, same).filter((F.col("_level") == 2) | (F.col("n") >= rules.min_documents))
    best = enough.groupBy("_lang", "_source").agg(F.min_by(F.struct(*names), "_level").alias("best"))
    return best.select("_lang", "_source", "best.*")


def judged(counts: DataFrame, rules: Rules) -> DataFrame:
    """Add ``kept`` to stored counts, by the fences of each row's group."""
    limits = stored(fences(counts, rules), "fences")
    # One source may hold a third of all rows: its fences are copied and its rows spread over the copies.
    salted = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = counts.withColumn("_salt", F.pmod(F.xxhash64(F.struct("n_words", "word_chars", "n_symbols")), F.lit(SALTS)).cast("int"))
    left, right = rows.alias("l"), salted.alias("r")
    same = (
        F.col("l._lang").eqNullSafe(F.col("r._lang"))
        & F.col("l._source").eqNullSafe(F.col("r._source"))
        & (F.col("l._salt") == F.col("r._salt"))
    )
    outside = F.lit(False)
    for m in UPPER:
        outside = outside | F.coalesce(F.col(m) > F.col(f"r._high_{m}"), F.lit(False))
    outside = outside | F.coalesce(F.col("word_length") < F.col("r._low_word_length"), F.lit(False))
    kept = ~F.col("base_failed") & ~outside
    return left.join(right, same, "left").select("l.*", kept.alias("_kept")).drop("_salt")


def quality_verdicts(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """Counts, fixed verdict and final verdict of every document."""
    counts = stored(with_counts(documents, [F.col("doc_id")], rules), "quality")
    return judged(counts, rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.col("_kept").alias("kept"),
    )


def quality_filter(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """The documents that the rules keep, with all their columns."""
    rows = with_counts(documents, [F.struct("*").alias("_row")], rules)
    counts = stored(rows, "quality")
    return judged(counts, rules).filter("_kept").select("_row.*")
