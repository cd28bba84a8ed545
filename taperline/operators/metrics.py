"""Classifier metrics per group, from counts; no group is ordered as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taperline.operators.hotspots import max_group_rows
from taperline.operators.running import in_pieces, running


def confusion_counts(df: DataFrame, keys: list[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    def cell(truth: int, said: int):
        return F.count_if((F.col(label) == truth) & (F.col(prediction) == said))

    return df.groupBy(*keys).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_cells(df: DataFrame, keys: list[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(*keys, F.col(label).alias("true_label"), F.col(prediction).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_balance(df: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_distinct(label).alias("n_classes"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.count(F.lit(1)).alias("n"),
    )


def roc_auc(df: DataFrame, keys: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL for a group of one class.

    Scores are counted per distinct value and ranked by pieces of consecutive ones, so neither a large
    group nor a narrow range of scores meets in one task.
    """
    counted = df.groupBy(*keys, F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    pieces = in_pieces(counted, [*keys, "_score"], max_group_rows(df.sparkSession))
    ranked = running(pieces, keys, ["_score"], {"_neg_below": ("sum", F.col("_neg"))}, own=False)
    won = F.sum(F.col("_pos") * (F.coalesce("_neg_below", F.lit(0)) + F.col("_neg") / 2))
    return ranked.groupBy(*keys).agg(
        F.try_divide(won.cast("double"), F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"),
        F.sum("_pos").alias("n_positive"),
        F.sum("_neg").alias("n_negative"),
    )
