"""Value shares, distributions and correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.operators.impute import apply_values, fit_medians
from backglance.operators.quality import require_columns, unpivot_row


def value_shares(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and share of all rows per distinct value."""
    require_columns(df, by)
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return groups.withColumn("share", F.col("n") / groups.agg(F.sum("n")).scalar())


def distribution(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean, spread, extremes, skewness and kurtosis (population moments) of numeric columns, in one pass."""
    require_columns(df, names)
    statistics = {
        "n": F.count,
        "mean": F.avg,
        "sd": F.stddev_samp,
        "smallest": F.min,
        "largest": F.max,
        "skewness": F.skewness,
        "kurtosis": F.kurtosis,
    }
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{s}_{c}") for c in names for s, f in statistics.items()])
    return unpivot_row(row, {s: f"{s}_" for s in statistics})


def correlations(df: DataFrame, names: Sequence[str], impute: bool = True, exact: bool = False) -> DataFrame:
    """Pearson correlation of every pair of columns as (a, b, r).

    Nulls are filled with the median first (``exact`` or from a sketch).  Only the columns ×
    columns matrix is collected; its cells are taken apart by Spark, a line per column.
    """
    names = list(names)
    require_columns(df, names)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    if impute:
        numbers = apply_values(numbers, fit_medians(numbers, names, exact))
    vectors = VectorAssembler(inputCols=names, outputCol="v", handleInvalid="skip").transform(numbers).select("v")
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    lines = df.sparkSession.createDataFrame([(a, matrix[i].tolist()) for i, a in enumerate(names)], "a string, line array<double>")
    cells = lines.select("a", F.posexplode("line").alias("at", "r"))
    return cells.select("a", F.get(F.array(*[F.lit(n) for n in names]), F.col("at")).alias("b"), "r")


def correlated_columns(matrix: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Columns with at least one partner of |r| >= threshold, and their strongest |r|."""
    strong = matrix.where((F.col("a") != F.col("b")) & (F.abs("r") >= threshold))
    return strong.groupBy(F.col("a").alias("column_name")).agg(F.max(F.abs("r")).alias("strongest"))


def prune_correlated(matrix: DataFrame, names: Sequence[str], threshold: float = 0.75) -> list[str]:
    """Columns to drop so that no strong pair stays; the earlier column of a pair is kept."""
    strong = matrix.where((F.col("a") != F.col("b")) & (F.abs("r") >= threshold))
    pairs = {(line["a"], line["b"]) for line in strong.collect()}
    kept: list[str] = []
    for name in names:
        if not any((name, k) in pairs for k in kept):
            kept.append(name)
    return [n for n in names if n not in kept]
