"""Joins shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null, as in GROUP BY."""
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns already there: {', '.join(sorted(clash))}")
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def lookup(df: DataFrame, dimension: DataFrame, on: dict[str, str], columns: Iterable[str]) -> DataFrame:
    """Columns of a dimension; rows without a match keep nulls, and no row is multiplied.

    Where a key occurs more than once in the dimension, its smallest row counts.

    No broadcast hint: Spark broadcasts the dimension when its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle beyond it.
    """
    keys = [f"_k_{ours}" for ours in on]
    side = dimension.select(
        *[F.col(theirs).alias(key) for key, theirs in zip(keys, on.values())], F.struct(*list(columns)).alias("_values")
    )
    side = side.groupBy(*keys).agg(F.min("_values").alias("_values")).select(*keys, "_values.*")
    condition = reduce(lambda a, b: a & b, [F.col(ours) == F.col(f"_k_{ours}") for ours in on])
    return df.join(side, condition, "left").drop(*[f"_k_{ours}" for ours in on])


def unmatched(left: DataFrame, right: DataFrame, on: Iterable[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    The right keys are made distinct before the shuffle, so a hot key there is one row.
    """
    on = list(on)
    return left.join(right.select(*on).distinct(), on, "left_anti")


def key_difference(left: DataFrame, right: DataFrame, on: Iterable[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    on = list(on)
    return unmatched(left.select(*on).distinct(), right, on)
