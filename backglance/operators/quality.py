"""Null shares, sparse columns, column choice by type."""

from __future__ import annotations

from collections.abc import Iterable

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop named columns; a name the table does not have is an error, not a no-op."""
    names = list(names)
    require_columns(df, names)
    return df.drop(*names)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``text``, ``numeric`` or ``time`` columns."""
    types = {
        "text": (T.StringType,),
        "numeric": (T.NumericType,),
        "time": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null; other types stay as they are."""
    text = set(columns_of_type(df, "text"))
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in df.columns])


def null_out(df: DataFrame, names: Iterable[str], when=None) -> DataFrame:
    """Typed nulls in the named columns, for the rows where ``when`` holds (all rows by default)."""
    names = list(names)
    require_columns(df, names)
    empty = {n: F.lit(None).cast(df.schema[n].dataType) for n in names}
    if when is None:
        return df.withColumns(empty)
    return df.withColumns({n: F.when(when, empty[n]).otherwise(F.col(n)) for n in names})


def unpivot_row(row: DataFrame, values: dict[str, str], key: str = "column_name") -> DataFrame:
    """One wide row of statistics to one line per column.

    ``values`` maps an output name to the prefix its statistics carry in ``row``:
    ``{"n": "n_"}`` reads ``n_a``, ``n_b`` ...
    """
    first = next(iter(values.values()))
    names = [c[len(first):] for c in row.columns if c.startswith(first)]
    lines = F.array(
        *[
            F.struct(F.lit(n).alias(key), *[F.col(f"`{prefix}{n}`").alias(out) for out, prefix in values.items()])
            for n in names
        ]
    )
    return row.select(F.explode(lines).alias("line")).select("line.*")


def null_fractions(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Share of nulls of every column, in one pass."""
    names = list(names or df.columns)
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(f"nf_{c}") for c in names])
    return unpivot_row(row, {"null_fraction": "nf_"})


def sparse_columns(df: DataFrame, threshold: float = 0.95) -> list[str]:
    """Columns with a null share of ``threshold`` or more; one line per column is collected."""
    lines = null_fractions(df).where(F.col("null_fraction") >= threshold).collect()
    found = {line["column_name"] for line in lines}
    return [c for c in df.columns if c in found]


def drop_sparse(df: DataFrame, threshold: float = 0.95, keep: Iterable[str] = ()) -> DataFrame:
    """Without the sparse columns; those in ``keep`` (a label, a join key) stay however sparse."""
    keep = set(keep)
    return df.drop(*[c for c in sparse_columns(df, threshold) if c not in keep])


def distinct_counts(df: DataFrame, names: Iterable[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values of every column, nulls apart.

    Each column is counted by itself, in its own type: its values are thinned out in the map tasks and
    only distinct ones are shuffled.  A Parquet scan reads each column once; a table that is
    dear to work out should be staged before.  Sketches need one row per task only.
    """
    names = list(names or df.columns)
    if approximate:
        row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"dc_{c}") for c in names])
        return unpivot_row(row, {"n_distinct": "dc_"})
    one = lambda c: (
        df.select(F.col(f"`{c}`").alias("value")).distinct().agg(F.lit(c).alias("column_name"), F.count("value").alias("n_distinct"))
    )
    return reduce(DataFrame.unionAll, [one(c) for c in names]).select("column_name", "n_distinct")
