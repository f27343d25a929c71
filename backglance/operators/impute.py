"""Fill nulls with values learnt from the training rows only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.operators.positions import quantile_rows
from backglance.operators.quality import require_columns


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for the non-null values of text columns, in one aggregation."""
    require_columns(df, names)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names]
    )
    lines = df.select(F.explode(pairs).alias("pair")).select("pair.*").where(F.col("value").isNotNull())
    return lines.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def mode_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Most frequent value per column; the smallest value wins a tie."""
    best = F.min(F.struct((-F.col("n")).alias("minus"), "value")).alias("best")
    chosen = value_counts(df, names).groupBy("column_name").agg(best)
    return chosen.select("column_name", F.col("best.value").alias("value"), (-F.col("best.minus")).alias("n"))


def fit_modes(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    return {line["column_name"]: line["value"] for line in mode_rows(df, names).collect()}


def fit_medians(df: DataFrame, names: Sequence[str], exact: bool = False) -> dict[str, float]:
    """Median per numeric column: one sketch pass, or exact."""
    names = list(names)
    require_columns(df, names)
    if exact:
        found = {line["column_name"]: line["value"] for line in quantile_rows(df, names).collect()}
    else:
        found = df.agg(*[F.percentile_approx(F.col(c), 0.5, 1000).alias(c) for c in names]).first().asDict()
    return {c: float(v) for c, v in found.items() if v is not None}


def apply_values(df: DataFrame, values: Mapping[str, str | float]) -> DataFrame:
    """Nulls replaced by the fitted value, in the type the column has."""
    require_columns(df, values)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()}
    )
