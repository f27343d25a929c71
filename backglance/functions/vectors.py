"""Vector arithmetic on arrays of doubles."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_array(df: DataFrame, name: str) -> Column:
    """Array of doubles from a vector column or from an array column."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return vector_to_array(F.col(name))
    return F.col(name).cast("array<double>")


def as_vector(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, VectorUDT):
        return F.col(name)
    return array_to_vector(as_array(df, name))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scale(a: Column, factor: Column) -> Column:
    return F.transform(a, lambda x: x * factor)


def between_points(a: Column, b: Column, share: Column) -> Column:
    """The point ``share`` of the way from ``a`` to ``b``."""
    return F.zip_with(a, b, lambda x, y: x + (y - x) * share)
