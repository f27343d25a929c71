"""Per-group features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backglance.functions.hashing import unit_hash
from backglance.operators.joins import join_groups
from backglance.operators.quality import require_columns


def group_total(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Total of the group on every row.

    Partial sums and a join back instead of a window, so that a hot group stays spread.
    """
    require_columns(df, [*by, value])
    return join_groups(df, df.groupBy(*by).agg(F.sum(value).alias(out)), by)


def group_extreme(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Smallest value of the group on every row."""
    require_columns(df, [*by, value])
    return join_groups(df, df.groupBy(*by).agg(F.min(value).alias(out)), by)


def prior_day_total(
    df: DataFrame, day: str, value: str, out: str, by: Sequence[str] = (), calendar: bool = True
) -> DataFrame:
    """Total of the day before on every row; never the total of the same day.

    ``calendar`` takes the day before by date and gives null when it has no rows;
    otherwise the latest earlier day that has rows.
    """
    require_columns(df, [day, value, *by])
    totals = df.groupBy(*by, day).agg(F.sum(value).alias(out))
    if calendar:
        totals = totals.withColumn(day, F.date_add(day, 1))
    else:
        # One line per day and group: the window sees days, not rows.
        keys = list(by) or [F.lit(0)]
        totals = totals.withColumn(out, F.lag(out).over(Window.partitionBy(*keys).orderBy(day)))
    return join_groups(df, totals, [*by, day])


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, out: str = "place"
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark cuts each map task to ``k`` rows per group before the shuffle, so a hot
    group sends little.  The order must be total for a repeatable result.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in a total order, instead of an arbitrary survivor."""
    return top_k_per_group(df, by, order, 1, "_place").drop("_place")


def pick_per_group(df: DataFrame, by: Sequence[str], key: str, seed: int) -> DataFrame:
    """One row per group, chosen by a seeded hash of its key; the same on every run."""
    return first_per_group(df, by, [unit_hash(key, seed=seed), F.col(key)])
