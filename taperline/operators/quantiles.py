"""Exact weighted quantiles per group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.operators.hotspots import Split, joined, max_group_rows, stored, stored_alone

CELLS = 4096


def grouped_quantiles(
    rows: Split,
    keys: list[str],
    quantiles: dict[str, tuple[str, float]],
    weight: str | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles ``{output: (column, probability)}`` per group.

    ``weight`` is a repeat count per row; ``extra`` are further aggregates of the same
    groups. Groups of regular players use the built-in ``percentile``, whose buffer is
    bounded by the size of a regular player.
    """
    freq = F.col(weight) if weight else F.lit(1)
    extras = [a.alias(n) for n, a in (extra or {}).items()]
    probs: dict[str, list[float]] = {}
    for column, p in quantiles.values():
        probs.setdefault(column, []).append(p)
    arrays = [F.percentile(c, F.array(*map(F.lit, ps)), freq).alias(f"_{c}") for c, ps in probs.items()]
    picks = [F.col(f"_{c}")[probs[c].index(p)].alias(out) for out, (c, p) in quantiles.items()]
    regular = rows.regular.groupBy(*keys).agg(*arrays, *extras).select(*keys, *picks, *(extra or {}))
    if rows.heavy is None:
        return regular
    heavy = select_by_rank(rows.heavy, keys, quantiles, freq)
    if extra:
        heavy = joined(rows.heavy.groupBy(*keys).agg(*extras), heavy, keys, "left")
    return regular.unionByName(heavy)


def select_by_rank(df: DataFrame, keys: list[str], quantiles: dict[str, tuple[str, float]], freq: Column) -> DataFrame:
    """The same quantiles without bringing a group together, equal to the last bit. Only the result stays stored.

    Equal values are first counted, which spreads a group over (group, value). Then the
    value range is cut into cells; cell counts tell which few cells hold the wanted ranks,
    and those are cut again until each is small; only what is left is ordered. Cells kept are
    at most two per group and probability.
    """
    return stored_alone(lambda: _by_rank(df, keys, quantiles, freq))


def _by_rank(df: DataFrame, keys: list[str], quantiles: dict[str, tuple[str, float]], freq: Column) -> DataFrame:
    columns = sorted({c for c, _ in quantiles.values()})
    probs = sorted({p for _, p in quantiles.values()})
    limit = max_group_rows(df.sparkSession)
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])
    counted = stored(
        df.select(*keys, freq.cast("bigint").alias("w"), F.explode(pairs).alias("pair"))
        .select(*keys, "w", "pair.name", "pair.v")
        .filter("v is not null and w > 0")
        .groupBy(*keys, "name", "v")
        .agg(F.sum("w").alias("w"))
    )
    group = keys + ["name"]
    totals = counted.groupBy(*group).agg(
        F.sum("w").alias("n"), F.count(F.lit(1)).alias("values"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    ranks = []
    for p in probs:
        at = (F.col("n") - 1) * F.lit(p)
        ranks += [F.floor(at), F.ceil(at)]
    known = ["n", "values", "low", "high", "before", "ranks"]
    cells = stored(totals.select(*group, "n", "values", "low", "high", F.lit(0).cast("bigint").alias("before"), F.array(*ranks).alias("ranks")))
    path = list(group)
    rows = counted
    crowd, before = _crowd(cells), None
    # Cutting a group of fewer values than there are cells would make a cell of each.
    while crowd > max(limit, CELLS) and crowd != before:
        level = f"cell{len(path) - len(group) + 1}"
        cell = _cell(F.col("v"), F.col("low"), F.col("high"), even=path != group)
        rows = joined(rows.drop(*known), cells, path).withColumn(level, cell)
        cells = stored(_cells_of_ranks(rows, path, level))
        path = path + [level]
        crowd, before = _crowd(cells), crowd
    rows = joined(rows.drop(*known), cells, path)
    upto = F.sum("w").over(W.partitionBy(*path).orderBy("v"))
    rows = rows.withColumn("stop", F.col("before") + upto).withColumn("start", F.col("stop") - F.col("w"))
    picks = []
    for out, (column, p) in quantiles.items():
        at = (F.col("n") - 1) * F.lit(p)
        mine = F.col("name") == column
        lower, upper = F.floor(at), F.ceil(at)
        v_lower = F.max(F.when(mine & (lower >= F.col("start")) & (lower < F.col("stop")), F.col("v")))
        v_upper = F.max(F.when(mine & (upper >= F.col("start")) & (upper < F.col("stop")), F.col("v")))
        # Where both ends are equal, interpolating would round; else in the order of the built-in.
        down, up = F.max(F.when(mine, upper - at)), F.max(F.when(mine, at - lower))
        picks.append(F.when(v_lower == v_upper, v_lower).otherwise(down * v_lower + up * v_upper).alias(out))
    return rows.groupBy(*keys).agg(*picks)


def _crowd(cells: DataFrame) -> int:
    """Different values in the fullest cell that can still be cut."""
    return cells.agg(F.max(F.when(F.col("low") < F.col("high"), F.col("values")))).first()[0] or 0


def _cell(v: Column, low: Column, high: Column, even: bool) -> Column:
    # First on a log scale: a few far-off values do not push all others into one cell.
    def scale(c: Column) -> Column:
        return c if even else F.signum(c) * F.log1p(F.abs(c))

    step = F.try_divide((scale(v) - scale(low)) * CELLS, scale(high) - scale(low))
    return F.least(F.lit(CELLS - 1), F.coalesce(F.floor(step), F.lit(0))).cast("int")


def _cells_of_ranks(rows: DataFrame, path: list[str], level: str) -> DataFrame:
    cells = rows.groupBy(*path, level).agg(
        F.sum("w").alias("held"),
        F.count(F.lit(1)).alias("values"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.max("n").alias("n"),
        F.max("before").alias("before"),
        F.max("ranks").alias("ranks"),
    )
    # At most CELLS rows per partition.
    upto = F.sum("held").over(W.partitionBy(*path).orderBy(level))
    return (
        cells.withColumn("before", F.col("before") + upto - F.col("held"))
        .filter(F.exists("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("held"))))
        .drop("held")
    )
