"""Scores of predictions, computed on Spark without collecting labels or predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.operators.positions import running_totals
from backglance.operators.profile import value_shares
from backglance.operators.quality import require_columns


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, accuracy of always predicting 0, and the positive rate."""
    require_columns(df, [label, prediction])
    share = lambda condition: F.avg(condition.cast("double"))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        share(F.col(label) == F.col(prediction)).alias("accuracy"),
        share(F.col(label) == 0).alias("majority_accuracy"),
        share(F.col(label) == 1).alias("positive_rate"),
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows and share of all rows per (label, prediction)."""
    return value_shares(df, [label, prediction])


def _thresholds(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Per distinct score, high to low: positives and rows at it and above it."""
    require_columns(df, [score, label, *by])
    scores = df.groupBy(*by, score).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col(label) == 1).cast("bigint")).alias("hits")
    )
    return running_totals(scores, [score], ["n", "hits"], by, descending=True)


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall at every distinct score."""
    points = _thresholds(df, score, label, ())
    points = points.withColumn("positives", points.agg(F.sum("hits")).scalar())
    reached, seen = F.col("hits_before") + F.col("hits"), F.col("n_before") + F.col("n")
    return points.withColumns(
        {"precision": reached / seen, "recall": F.try_divide(reached, F.col("positives"))}
    )


def area_under_pr(df: DataFrame, score: str, label: str) -> DataFrame:
    """Trapezoid area under the precision-recall curve, which starts at recall 0 with the first precision."""
    points = pr_curve(df, score, label)
    before = F.coalesce(F.try_divide(F.col("hits_before"), F.col("n_before")), F.col("precision"))
    step = F.try_divide(F.col("hits"), F.col("positives"))
    return points.agg(F.sum(step * (F.col("precision") + before) / 2).alias("area_under_pr"))


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Mean precision at the positives of each group, ranked by score; equal scores count together."""
    points = _thresholds(df, score, label, by)
    precision = (F.col("hits_before") + F.col("hits")) / (F.col("n_before") + F.col("n"))
    return points.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("hits").alias("positives"),
        F.coalesce(F.try_divide(F.sum(F.col("hits") * precision), F.sum("hits")), F.lit(0.0)).alias("average_precision"),
    )


def mean_average_precision(groups: DataFrame) -> DataFrame:
    return groups.agg(F.avg("average_precision").alias("mean_average_precision"))
