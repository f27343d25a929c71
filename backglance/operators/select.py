"""Choice of features and principal components."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backglance.functions.vectors import as_array


def fit_selector(df: DataFrame, kind: str, features: str = "features", label: str = "label", threshold: float = 0.05):
    """Features that depend on a categorical label, with family-wise error control.

    ``kind`` is ``categorical`` (chi-square) or ``continuous`` (ANOVA F).
    """
    selector = UnivariateFeatureSelector(
        featuresCol=features, labelCol=label, outputCol="selected_features", selectionMode="fwe"
    )
    return selector.setFeatureType(kind).setLabelType("categorical").setSelectionThreshold(threshold).fit(df)


def select_features(train: DataFrame, test: DataFrame, kind: str = "continuous", threshold: float = 0.05):
    """Both tables with the features chosen on the training rows."""
    model = fit_selector(train, kind, threshold=threshold)
    narrow = lambda df: model.transform(df).drop("features").withColumnRenamed("selected_features", "features")
    return narrow(train), narrow(test), list(model.selectedFeatures)


def _name_of(position, names: Sequence[str]):
    return F.element_at(F.array(*[F.lit(n) for n in names]), position + 1).alias("column_name")


def anova_statistics(df: DataFrame, features: str, label: str, names: Sequence[str]) -> DataFrame:
    """F statistic per feature against a categorical label.

    One pass gives count, mean and variance of every feature per class; the rest works on
    that classes × features table.
    """
    metrics = Summarizer.metrics("count", "mean", "variance").summary(F.col(features)).alias("s")
    classes = df.groupBy(label).agg(metrics)
    moments = F.arrays_zip(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("variance")
    )
    cells = classes.select(F.col("s.count").alias("n"), F.posexplode(moments).alias("i", "m"))
    cells = cells.select("i", "n", "m.mean", "m.variance")
    centre = F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    overall = cells.groupBy("i").agg(
        centre.alias("centre"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")
    )
    spread = F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)
    sums = (
        cells.join(overall, "i")
        .groupBy("i", "rows", "classes")
        .agg(F.sum(spread).alias("between"), F.sum((F.col("n") - 1) * F.col("variance")).alias("within"))
    )
    statistic = F.try_divide(
        F.col("between") / (F.col("classes") - 1), F.col("within") / (F.col("rows") - F.col("classes"))
    )
    return sums.select(_name_of(F.col("i"), names), statistic.alias("statistic"), (F.col("rows") - 1).alias("degrees"))


def chi_square_tail(statistic: float, degrees: int) -> float:
    """Probability of a chi-square value above ``statistic``: 1 minus the regularised incomplete gamma function."""
    a, x = degrees / 2, statistic / 2
    if degrees <= 0 or x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        # The lower tail as a power series.
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * scale)
    # The upper tail as a continued fraction.
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    value = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, scale * value)


def chi_square_statistics(df: DataFrame, categorical: Sequence[str], label: str) -> DataFrame:
    """Chi-square statistic, degrees and p-value per text column against a label; nulls are a value.

    Works on the counts of (column, value, label), whatever the number of values; the label
    itself is never a feature.  One line per column comes to the driver for its p-value.
    """
    names = [c for c in categorical if c != label]
    text = lambda c: F.col(f"`{c}`").cast("string")
    known = lambda c: F.coalesce(F.concat(F.lit("v"), text(c)), F.lit("null"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), known(c).alias("value")) for c in names])
    lines = df.select(F.explode(pairs).alias("pair"), known(label).alias("label")).select("pair.*", "label")
    cells = lines.groupBy("column_name", "value", "label").agg(F.count(F.lit(1)).alias("n"))
    values = cells.groupBy("column_name", "value").agg(F.sum("n").alias("of_value"))
    labels = cells.groupBy("column_name", "label").agg(F.sum("n").alias("of_label"))
    share = F.col("n") * F.col("n") / (F.col("of_value").cast("double") * F.col("of_label"))
    joined = cells.join(values, ["column_name", "value"]).join(labels, ["column_name", "label"])
    sums = joined.groupBy("column_name").agg(F.sum(share).alias("share"), F.sum("n").alias("rows"))
    shape = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_values")).join(
        labels.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_labels")), "column_name"
    )
    tested = sums.join(shape, "column_name").select(
        "column_name",
        F.greatest(F.col("rows") * (F.col("share") - 1), F.lit(0.0)).alias("statistic"),
        ((F.col("n_values") - 1) * (F.col("n_labels") - 1)).alias("degrees"),
    )
    found = [(r["column_name"], r["statistic"], r["degrees"], chi_square_tail(r["statistic"], r["degrees"])) for r in tested.collect()]
    return df.sparkSession.createDataFrame(found, "column_name string, statistic double, degrees bigint, p_value double")


def dependent_columns(df: DataFrame, categorical: Sequence[str], label: str, threshold: float = 0.05) -> list[str]:
    """Text columns that depend on the label with family-wise error ``threshold``, in the given order."""
    tests = chi_square_statistics(df, categorical, label).collect()
    names = [c for c in categorical if c != label]
    kept = {t["column_name"] for t in tests if t["p_value"] < threshold / len(names)}
    return [c for c in names if c in kept]


@dataclass
class Components:
    """Principal components: the mean of the columns, one direction per row, and the share of the variance each explains."""

    mean: np.ndarray
    directions: np.ndarray
    explained: np.ndarray

    def transform(self, df: DataFrame, features: str = "features", out: str = "pca_features") -> DataFrame:
        """The rows with ``out``, the array of their places along the directions, from the mean."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def project(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=object)
            model = shared.value
            return pd.Series(list((np.stack(values.to_numpy()) - model.mean) @ model.directions.T))

        return df.withColumn(out, project(_doubles(df, features)))


def _doubles(df: DataFrame, features: str) -> Column:
    return as_array(df, features).cast("array<double>")


# Directions that are followed beside twice the wanted ones; the more, the fewer steps.
_MORE_DIRECTIONS = 32


def principal_components(
    train: DataFrame, k: int, features: str = "features", steps: int = 200, tolerance: float = 1e-9, seed: int = 48
) -> tuple[Components, DataFrame]:
    """Fitted components and the explained variance per component, by block power iteration.

    A step multiplies the covariance with a block of ``k`` and some more directions in one pass over the rows:
    each task adds up its part and Spark adds the parts by column, so there is no matrix of
    columns by columns anywhere; the driver holds the block.  It stops once no entry of a wanted direction
    changes by more than ``tolerance``, or no share changes at all (equal shares leave their directions
    free).  Rows without features are left out; with fewer than two
    rows, or none that differ, there are no components.  The largest entry of a direction is positive.
    """
    spark = train.sparkSession
    schema = "component bigint, explained double"
    rows = train.select(_doubles(train, features).alias("values")).where("values is not null")
    metrics = Summarizer.metrics("count", "mean", "variance").summary(array_to_vector("values")).alias("s")
    if rows.isEmpty():
        return Components(np.zeros(0), np.zeros((0, 0)), np.zeros(0)), spark.createDataFrame([], schema)
    line = rows.agg(metrics).select("s.*").first()
    n, mean = line["count"], np.array(line["mean"].toArray(), float)
    variance = float(line["variance"].toArray().sum()) if n > 1 else 0.0
    if not variance:
        return Components(mean, np.zeros((0, len(mean))), np.zeros(0)), spark.createDataFrame([], schema)
    many = min(len(mean), 2 * k + _MORE_DIRECTIONS)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(mean), many)))[0]
    shares, found = np.zeros(0), np.zeros((0, 0))
    for _ in range(steps):
        product = _covariance_times(rows, mean, block) / (n - 1)
        # The block's own directions of most variance: eigenvectors of block' covariance block.
        values, turn = np.linalg.eigh(block.T @ product)
        now = values[::-1][:k] / variance
        before, found = found, _signed((block @ turn)[:, ::-1][:, :k].T)
        settled = before.shape == found.shape and (np.abs(found - before).max() <= tolerance or np.all(np.abs(now - shares) <= 1e-15 * now))
        shares = now
        if settled or many == len(mean):
            break
        block = np.linalg.qr(product)[0]
    model = Components(mean, found, np.maximum(shares, 0.0))
    return model, spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.explained)], schema)


def _signed(directions: np.ndarray) -> np.ndarray:
    return directions * np.sign(directions[np.arange(len(directions)), np.abs(directions).argmax(1)])[:, None]


def _covariance_times(rows: DataFrame, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Sum over the rows x of (x - mean) (x - mean)' block."""
    shared = rows.sparkSession.sparkContext.broadcast((mean, block))

    def run(frames):
        centre, directions = shared.value
        total = np.zeros_like(directions)
        for frame in frames:
            if len(frame):
                x = np.stack(frame["values"].to_numpy()) - centre
                total += x.T @ (x @ directions)
        yield pd.DataFrame({"i": np.arange(len(total)), "parts": list(total)})

    parts = rows.mapInPandas(run, "i int, parts array<double>")
    sums = F.array(*[F.sum(F.get("parts", F.lit(j))) for j in range(block.shape[1])])
    found = {r["i"]: r["total"] for r in parts.groupBy("i").agg(sums.alias("total")).collect()}  # the size of the block
    return np.array([found[i] for i in range(len(mean))])
