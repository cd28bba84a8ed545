"""Fatigue classifiers: one model per player, session type and kind, judged by held-out months.

A player's sessions of one type are a few hundred rows, and fits of different players have nothing in
common, so one exchange brings each player's rows to a task that fits all its folds (``learners``),
however many they are. Only who sets ``spark.taperline.maxFitRows`` asks for Spark's own classifiers, which
are other models (binned trees of depth 5, a network without Adam), for players with more sessions of a type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.functions.expressions import month_bucket
from taperline.operators import learners
from taperline.operators.features import split_features
from taperline.operators.hotspots import Split, joined, lookup, share_code, stored
from taperline.operators.metrics import confusion_counts, roc_auc
from taperline.operators.zones import KEY
from taperline.schema import FATIGUE_FEATURES, SESSION_TYPES, TRAINING_FEATURES

# Fixed values, in order: of two kinds with the same score the first one is kept.
CANDIDATES = ("RandomForest", "GradientBoosting", "NeuralNetwork")
SEED = 42
FOLDS = 3
MIN_TYPE_SESSIONS, MIN_CLEAN_SESSIONS = 20, 15
MIN_AUC = 0.65
#: Not set by default: what is learned does not depend on the number of rows.
MAX_FIT_ROWS = "spark.taperline.maxFitRows"
#: Tasks over which an oversized player's sessions are scored.
SCORING_SALTS = 64
GROUP = ["session_type", "player"]
#: Of a group's fits: those without one fold each, that on all months, or both.
HELD_OUT, WHOLE, BOTH = slice(0, FOLDS), slice(FOLDS, FOLDS + 1), slice(0, FOLDS + 1)
SEEN = "session_date: date, k1: long, k2: long, k3: long, fold: int, performance_drop: int, score: double, said: int, refit_score: double, refit_said: int"
FITTED = f"session_type string, player string, model_type string, model binary, importances array<double>, seen array<struct<{SEEN}>>"


@dataclass(frozen=True)
class ModelSizes:
    trees: int = 100
    boosting_rounds: int = 100
    boosting_depth: int = 3
    boosting_step: float = 0.1
    hidden: tuple[int, ...] = (50, 20)
    network_iterations: int = 1000
    #: A network stops earlier once its loss improves by less than this.
    network_tolerance: float = 1e-4


@dataclass
class FatigueModels:
    """Fitted models and the tables that go with them."""

    #: (session_type, player, model_type, model): those the registry names, packed.
    models: DataFrame | None = None
    #: Spark's models of players above ``MAX_FIT_ROWS``, by session type, player and kind; none unless that is set.
    large: dict[tuple[str, str, str], object] = field(default_factory=dict)
    registry: DataFrame | None = None
    scalers: DataFrame | None = None
    #: Every session with its fold and its held-out score, per kind; with ``refit_all`` also the score of the fit on all months.
    held_out: DataFrame | None = None
    aucs: DataFrame | None = None


FATIGUE_GROUPS = ("training_load", "row_load", "match_days", "label")


def fatigue_features(sessions: DataFrame) -> Split:
    """Sessions with the classifier inputs, the label and the month."""
    return fatigue_inputs(split_features(sessions, FATIGUE_GROUPS, only=[*KEY, *TRAINING_FEATURES]))


def fatigue_inputs(features: Split) -> Split:
    return features.each(
        lambda df: df.select(
            *KEY,
            "session_type",
            month_bucket(F.col("session_date")).alias("month"),
            *TRAINING_FEATURES,
            "performance_drop",
        )
    )


def drop_null_features(df: DataFrame, session_type: str) -> DataFrame:
    """Sessions of the type whose whole feature vector is present."""
    return df.filter(F.col("session_type") == session_type).na.drop(subset=list(FATIGUE_FEATURES[session_type]))


def player_scalers(clean: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Mean and population deviation per player, and over how many sessions."""
    stats = [a for f in features for a in (F.avg(f).alias(f"mean_{f}"), F.stddev_pop(f).alias(f"std_{f}"))]
    return clean.groupBy("player").agg(F.count(F.lit(1)).alias("scaler_n"), *stats)


def merged_scalers(*parts: DataFrame) -> DataFrame:
    """Scalers of several disjoint sets of sessions as those of all of them; the sessions are not read again.

    Parts may have further key columns beside the player, such as the session type.
    """
    columns = parts[0].columns
    features = [c.removeprefix("mean_") for c in columns if c.startswith("mean_")]
    keys = [c for c in columns if c != "scaler_n" and not c.startswith(("mean_", "std_"))]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    # One entry per part; deviations from the common mean are added where they arise, so nothing cancels out.
    held = stacked.groupBy(*keys).agg(F.collect_list(F.struct(*[c for c in columns if c not in keys])).alias("parts"))

    def total(of: Column) -> Column:
        """The sum over parts of an expression of their columns."""
        return F.aggregate(of, F.lit(0.0), lambda so_far, v: so_far + F.coalesce(v, F.lit(0.0)))

    size = F.col("parts.scaler_n")
    n = total(F.transform(size, lambda v: v.cast("double")))
    product = lambda a, b: F.zip_with(a, b, lambda x, y: x * y)
    means = {f"mean_{f}": total(product(size, F.col(f"parts.mean_{f}"))) / n for f in features}

    def deviation(f: str) -> Column:
        common = F.col(f"mean_{f}")
        inside = F.transform(F.col(f"parts.std_{f}"), lambda v: F.pow(v, 2))
        between = F.transform(F.col(f"parts.mean_{f}"), lambda v: F.pow(v - common, 2))
        return F.sqrt((total(product(size, inside)) + total(product(size, between))) / n)

    # Features that a session type does not have stay NULL.
    absent = {f: F.forall(f"parts.mean_{f}", lambda v: v.isNull()) for f in features}
    found = held.withColumns(means).withColumns({f"std_{f}": deviation(f) for f in features}).withColumn("scaler_n", n.cast("long"))
    found = found.withColumns({f"{s}_{f}": F.when(~absent[f], F.col(f"{s}_{f}")) for f in features for s in ("mean", "std")})
    return found.select(*columns)


def z_scores(features: tuple[str, ...]) -> dict[str, Column]:
    """0 where a player's feature never varies."""
    return {
        f: F.coalesce(F.try_divide(F.col(f) - F.col(f"mean_{f}"), F.col(f"std_{f}")), F.lit(0.0)) for f in features
    }


def standardize(rows: Split, scalers: DataFrame, features: tuple[str, ...]) -> Split:
    """Replace features by z-scores.

    Players without a scaler drop out: nothing was learned about them.
    """
    spent = ["scaler_n", *[f"{s}_{f}" for f in features for s in ("mean", "std")]]
    return lookup(rows, scalers, ["player"], how="inner").each(lambda df: df.withColumns(z_scores(features)).drop(*spent))


def standardize_own(rows: Split) -> Split:
    """Complete sessions of both types as z-scores within player and type, on the exchange that made the features.

    Features that matches do not have are NULL there. An oversized player's scalers are joined.
    """
    keys = ["player", "session_type"]
    own = W.partitionBy(*keys)
    stats = [(f"{s}_{f}", a(f)) for f in TRAINING_FEATURES for s, a in (("mean", F.avg), ("std", F.stddev_pop))]
    spent = [name for name, _ in stats]

    def usable(df: DataFrame) -> DataFrame:
        complete = F.lit(False)
        for kind, inputs in FATIGUE_FEATURES.items():
            present = F.col("session_type") == kind
            for f in inputs:
                present = present & F.col(f).isNotNull()
            complete = complete | present
        return df.filter(complete)

    def scaled(df: DataFrame) -> DataFrame:
        scores = z_scores(TRAINING_FEATURES)
        for f in set(TRAINING_FEATURES) - set(FATIGUE_FEATURES["match"]):
            scores[f] = F.when(F.col("session_type") != "match", scores[f])
        return df.withColumns(scores).drop(*spent)

    rows = rows.each(usable)
    heavy = rows.heavy
    if heavy is not None:
        # One row per type for each of at most rows / maxGroupRows players.
        heavy = joined(heavy, stored(heavy.groupBy(*keys).agg(*[a.alias(n) for n, a in stats])), keys)
    regular = rows.regular.withColumns({n: a.over(own) for n, a in stats})
    return Split(regular, heavy, rows.players).each(scaled)


def trainable_players(features: DataFrame, session_type: str) -> DataFrame:
    """Players with enough sessions of the type, enough of them complete, both labels, and a month for each fold."""
    inputs = FATIGUE_FEATURES[session_type]
    complete = F.lit(True)
    for f in inputs:
        complete = complete & F.col(f).isNotNull()
    label = F.when(complete, F.col("performance_drop"))
    return (
        features.filter(F.col("session_type") == session_type)
        .groupBy("player")
        .agg(
            F.count(F.lit(1)).alias("n_sessions"),
            F.count_if(complete).alias("n_clean"),
            F.min(label).alias("_least"),
            F.max(label).alias("_most"),
            F.count_distinct(F.when(complete, F.col("month"))).alias("n_months"),
        )
        .filter((F.col("n_sessions") >= MIN_TYPE_SESSIONS) & (F.col("n_clean") >= MIN_CLEAN_SESSIONS))
        .filter((F.col("_least") < F.col("_most")) & (F.col("n_months") >= FOLDS))
        .select("player", "n_sessions", "n_clean", "n_months")
    )


def placed_folds(months: list[tuple[str, int]], folds: int = FOLDS) -> dict[str, int]:
    """Fold of each month: largest month first, earlier ones before later ones, each to the lightest fold."""
    held = [0] * folds
    placed = {}
    for month, size in sorted(months, key=lambda m: (-m[1], m[0])):
        lightest = held.index(min(held))
        held[lightest] += size
        placed[month] = lightest
    return placed


def month_group_folds(clean: DataFrame, folds: int = FOLDS) -> dict[str, int]:
    """Fold of every calendar month of a table; only the month counts come to the driver."""
    months = [tuple(m) for m in clean.groupBy("month").count().collect()]
    return placed_folds(months, folds) if len(months) >= folds else {}


def fold_of(folds: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in folds.items() for x in pair])[F.col("month")]


def large_candidates(n_features: int, sizes: ModelSizes) -> dict[str, object]:
    """Spark's classifiers, for players above ``MAX_FIT_ROWS``."""
    shared = {"featuresCol": "vector", "labelCol": "performance_drop", "seed": SEED}
    return {
        "RandomForest": RandomForestClassifier(numTrees=sizes.trees, **shared),
        "GradientBoosting": GBTClassifier(
            maxIter=sizes.boosting_rounds,
            maxDepth=sizes.boosting_depth,
            stepSize=sizes.boosting_step,
            **shared,
        ),
        "NeuralNetwork": MultilayerPerceptronClassifier(
            layers=[n_features, *sizes.hidden, 2],
            maxIter=sizes.network_iterations,
            tol=sizes.network_tolerance,
            **shared,
        ),
    }


def large_scores(df: DataFrame, model: object, score: str, said: str) -> DataFrame:
    """Probability of a drop and the class, by one of Spark's models."""
    outputs = {f"{c}Col": f"_{c}" for c in ("probability", "rawPrediction", "prediction")}
    for setter, column in outputs.items():
        model._set(**{setter: column})
    vectors = df.withColumn("vector", array_to_vector("features"))
    found = {score: vector_to_array(F.col("_probability"))[1], said: F.col("_prediction").cast("int")}
    return model.transform(vectors).withColumns(found).drop("vector", *outputs.values())


def cross_validated_auc(held_out: DataFrame) -> DataFrame:
    """Mean AUC over the folds per player and kind; 0 where a fold is missing or holds only one class."""
    keys = ["session_type", "player", "model_type"]
    folds = roc_auc(held_out, [*keys, "fold"], "performance_drop", "score")
    undefined = F.count("auc") < FOLDS
    return folds.groupBy(*keys).agg(F.when(undefined, 0.0).otherwise(F.avg("auc")).alias("auc"))


def select_best_model(aucs: DataFrame) -> DataFrame:
    """The best kind per player, kept only above the quality gate."""
    order = F.create_map(*[x for i, k in enumerate(CANDIDATES) for x in (F.lit(k), F.lit(-i))])
    best = F.max(F.struct("auc", order[F.col("model_type")].alias("_order"), "model_type")).alias("best")
    return (
        aucs.groupBy("session_type", "player")
        .agg(best)
        .select("session_type", "player", "best.model_type", "best.auc")
        .filter(F.col("auc") > MIN_AUC)
    )


def _training_table(features: Split, session_type: str) -> tuple[DataFrame, DataFrame]:
    inputs = FATIGUE_FEATURES[session_type]
    players = stored(trainable_players(features.union(), session_type).select("player"))
    rows = lookup(features.each(lambda df: drop_null_features(df, session_type)), players, ["player"], how="inner")
    scalers = stored(player_scalers(rows.union(), inputs))
    scaled = standardize(rows, scalers, inputs).union()
    vector = F.array(*[F.col(f).cast("double") for f in inputs]).alias("features")
    return scaled.select(*KEY, "session_type", "month", F.col("performance_drop").cast("int"), vector), scalers


def matrix(features: pa.ChunkedArray) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    flat = pa.chunked_array([c.flatten() for c in features.chunks], pa.float64())
    return flat.to_numpy().reshape(len(features), -1)


def fit_group(sizes: ModelSizes, which: slice = BOTH) -> Callable[[pa.Table], pa.Table]:
    """The folds, the whole or both of one player, session type and kind; what the others would say is NULL."""

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in KEY[1:]])
        kind, months = rows.column("model_type")[0].as_py(), rows.column("month").to_pylist()
        counts: dict[str, int] = {}
        for month in months:
            counts[month] = counts.get(month, 0) + 1
        placed = placed_folds(list(counts.items()))
        fold = np.array([placed[m] for m in months], dtype=np.int32)
        parts = np.stack([*[fold != f for f in range(FOLDS)], fold >= 0])[which]
        x = matrix(rows.column("features"))
        y = rows.column("performance_drop").to_numpy().astype(int)
        scores, model, importances = learners.LEARNERS[kind](x, y, parts, sizes, SEED, which.start)
        seen = {c: rows.column(c).combine_chunks() for c in KEY[1:]}
        seen |= {"fold": pa.array(fold), "performance_drop": pa.array(y.astype(np.int32))}
        folds, whole = which.start == 0, which.stop > FOLDS
        said = {"score": ("said", scores[fold, np.arange(len(y))] if folds else None), "refit_score": ("refit_said", scores[-1] if whole else None)}
        for name, (verdict, found) in said.items():
            seen[name] = pa.nulls(len(y), pa.float64()) if found is None else pa.array(found)
            seen[verdict] = pa.nulls(len(y), pa.int32()) if found is None else pa.array((found > 0.5).astype(np.int32))
        listed = pa.ListArray.from_arrays(pa.array([0, len(y)], pa.int32()), pa.StructArray.from_arrays(list(seen.values()), list(seen)))
        shares = pa.array([importances.tolist() if whole and importances is not None else None], pa.list_(pa.float64()))
        first = rows.slice(0, 1).select([*GROUP, "model_type"])
        return first.append_column("model", pa.array([learners.packed(model) if whole else None], pa.binary())).append_column("importances", shares).append_column("seen", listed)

    return fit


def fit_players(asked: DataFrame, sizes: ModelSizes, n_rows: int, which: slice) -> DataFrame:
    """One row per player, session type and kind, from one exchange; a fit costs far more than moving its ``n_rows``."""
    spark = asked.sparkSession
    share_code(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism + n_rows // 20_000
    keys = [*GROUP, "model_type"]
    return stored(asked.repartition(tasks, *keys).groupBy(*keys).applyInArrow(fit_group(sizes, which), FITTED))


def fit_large(table: DataFrame, session_type: str, player: str, sizes: ModelSizes, kinds: tuple[str, ...]):
    """One oversized player's models, importances and scored sessions, by Spark's classifiers."""
    inputs = FATIGUE_FEATURES[session_type]
    own = table.filter((F.col("session_type") == session_type) & (F.col("player") == player))
    own = stored(own.withColumn("fold", fold_of(month_group_folds(own))))
    models, importances, seen = {}, [], None
    for kind in kinds:
        learner = large_candidates(len(inputs), sizes)[kind]
        fit = lambda df: learner.fit(df.withColumn("vector", array_to_vector("features")))  # noqa: B023, E731
        whole = models[session_type, player, kind] = fit(own)
        shares = [float(v) for v in whole.featureImportances.toArray()] if hasattr(whole, "featureImportances") else None
        importances.append((session_type, player, kind, None, shares))
        for fold in range(FOLDS):
            scored = large_scores(own.filter(F.col("fold") == fold), fit(own.filter(F.col("fold") != fold)), "score", "said")
            scored = large_scores(scored, whole, "refit_score", "refit_said").withColumn("model_type", F.lit(kind))
            seen = scored if seen is None else seen.unionByName(scored)
    return models, importances, stored(seen)


def train_fatigue(
    features: Split, sizes: ModelSizes = ModelSizes(), kinds: tuple[str, ...] = CANDIDATES, refit_all: bool = False
) -> FatigueModels:
    """Fit the given kinds for every player and session type that has enough to learn from.

    The folds judge every kind; then the best one of each player, if it is good enough, learns from all
    months. ``refit_all`` lets all kinds of all players do so. ``features`` is read several times: pass it stored.
    """
    parts = {t: _training_table(features, t) for t in SESSION_TYPES}
    # Read by every fit, so written once to storage that outlives executors.
    table = stored(parts["match"][0].unionByName(parts["training"][0]))
    spark = table.sparkSession
    n_rows = table.count()
    if not n_rows:
        return FatigueModels()
    limit, large, regular = spark.conf.get(MAX_FIT_ROWS, None), [], table
    if limit is not None:
        oversized = table.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > int(limit)).select(*GROUP)
        large = [tuple(r) for r in oversized.collect()]
        regular = table.join(oversized, GROUP, "left_anti") if large else table
    keys = [*GROUP, "model_type"]
    asked = regular.withColumn("model_type", F.explode(F.array(*map(F.lit, kinds))))
    fits = fit_players(asked, sizes, n_rows * len(kinds), BOTH if refit_all else HELD_OUT)
    seen = fits.select(*keys, F.inline("seen"))
    fitted = fits.select(*keys, "model", "importances")
    out = FatigueModels()
    from_spark = None
    for session_type, player in large:
        models, importances, scored = fit_large(table, session_type, player, sizes, kinds)
        out.large |= models
        shares = spark.createDataFrame(importances, fitted.schema)
        from_spark = shares if from_spark is None else from_spark.unionByName(shares)
        seen = seen.unionByName(scored.select(*seen.columns))
    out.held_out = refit = stored(seen)
    out.aucs = stored(cross_validated_auc(out.held_out))
    best = stored(select_best_model(out.aucs))
    if not refit_all:
        again = regular.join(best.select(*keys), GROUP)
        refits = fit_players(again, sizes, again.count(), WHOLE)
        fitted = refits.select(*keys, "model", "importances")
        refit = refit.filter("refit_said is not null").unionByName(refits.select(*keys, F.inline("seen")))
    if from_spark is not None:
        fitted = fitted.unionByName(from_spark)
    counts = confusion_counts(refit, keys, "performance_drop", "refit_said")
    unseen = confusion_counts(out.held_out, keys, "performance_drop", "said")
    unseen = unseen.select(*keys, *[F.col(c).alias(f"held_out_{c}") for c in ("tn", "fp", "fn", "tp")])
    named = F.lit(None).cast("array<string>")
    for session_type in SESSION_TYPES:
        own = F.array(*map(F.lit, FATIGUE_FEATURES[session_type]))
        named = F.when(F.col("session_type") == session_type, own).otherwise(named)
    chosen = stored(best.join(fitted, keys).withColumn("features", named))
    registry = chosen.drop("model").withColumn("importances", F.when(F.col("importances").isNotNull(), F.map_from_arrays("features", "importances")))
    out.registry = stored(registry.join(counts, keys).join(unseen, keys))
    out.models = chosen.filter(F.col("model").isNotNull()).select(*keys, "model")
    scalers = [parts[t][1].withColumn("session_type", F.lit(t)) for t in SESSION_TYPES]
    out.scalers = scalers[0].unionByName(scalers[1], allowMissingColumns=True)
    return out


def score_group(rows: pa.Table, models: pa.Table) -> pa.Table:
    """One player's sessions by the packed model chosen for it."""
    x = matrix(rows.column("features"))
    kind, model = models.column("model_type")[0].as_py(), models.column("model")[0].as_py()
    risk = learners.probabilities(kind, model, x)
    return rows.drop_columns(["features", "salt"]).append_column("risk", pa.array(risk, pa.float64()))


def score_sessions(rows: Split, fatigue: FatigueModels) -> DataFrame:
    """Risk of a drop after each session that has a model and a complete feature vector.

    A session is standardised like the data its model learned from. An oversized player's sessions meet
    copies of its model in several tasks.
    """
    ready = None
    keys = [*KEY, "session_type"]
    for session_type, inputs in FATIGUE_FEATURES.items():
        part = rows.each(lambda df: drop_null_features(df, session_type).select(*keys, *inputs))
        chosen = fatigue.registry.filter(F.col("session_type") == session_type).select("player", "model_type")
        scalers = fatigue.scalers.filter(F.col("session_type") == session_type)
        scalers = scalers.select("player", *[f"{s}_{f}" for f in inputs for s in ("mean", "std")])
        scaled = standardize(lookup(part, chosen, ["player"], how="inner"), scalers, inputs)
        vector = F.array(*[F.col(f).cast("double") for f in inputs]).alias("features")
        salt = F.pmod(F.xxhash64(*KEY), F.lit(SCORING_SALTS))
        own = scaled.regular.withColumn("salt", F.lit(0).cast("long"))
        if scaled.heavy is not None:
            own = own.unionByName(scaled.heavy.withColumn("salt", salt.cast("long")))
        own = own.select(*keys, "model_type", vector, "salt")
        ready = own if ready is None else ready.unionByName(own)
    share_code(ready.sparkSession)
    copies = fatigue.models.select(*GROUP, "model_type", "model", F.lit(0).cast("long").alias("salt"))
    if rows.heavy is not None:
        salts = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(SCORING_SALTS - 1).cast("long")))
        more = fatigue.models.join(rows.players, "player", "left_semi").withColumn("salt", salts)
        copies = copies.unionByName(more.select(*copies.columns))
    by = [*GROUP, "salt"]
    kinds = f"{', '.join(f'{c} {ready.schema[c].dataType.simpleString()}' for c in [*keys, 'model_type'])}, risk double"
    small = ready
    for session_type, player, _ in fatigue.large:
        small = small.filter((F.col("session_type") != session_type) | (F.col("player") != player))
    out = small.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(_scored_or_empty(), kinds)
    for (session_type, player, kind), model in fatigue.large.items():
        picked = (F.col("session_type") == session_type) & (F.col("player") == player) & (F.col("model_type") == kind)
        out = out.unionByName(large_scores(ready.filter(picked), model, "risk", "said").select(*out.columns))
    about = fatigue.registry.select(*GROUP, (F.col("auc") * 100).alias("confidence"), F.struct("tn", "fp", "fn", "tp").alias("confusion"), "importances")
    scored = out.join(about, GROUP)
    return scored.select(*keys, "model_type", "risk", (F.col("risk") * 100).alias("risk_score"), "confidence", "confusion", "importances")


def _scored_or_empty() -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``score_group`` for a player with sessions and a model; models without sessions give no rows."""

    def score(rows: pa.Table, models: pa.Table) -> pa.Table:
        if rows.num_rows and models.num_rows:
            return score_group(rows, models)
        empty = rows.slice(0, 0)
        return empty.drop_columns(["features", "salt"]).append_column("risk", pa.array([], pa.float64()))

    return score
