"""Packed text fields: one string that holds several separated parts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.functions.text import last_characters
from backglance.operators.quality import require_columns


def split_packed(df: DataFrame, parts: Mapping[str, int], separator: str = ",", keep: bool = False) -> DataFrame:
    """``name`` with ``n`` parts becomes ``name1`` .. ``nameN``; parts that are not there are null.

    One projection for all fields, so that column pruning removes the parts nobody reads.
    """
    require_columns(df, parts)
    kept = [F.col(c) for c in df.columns if keep or c not in parts]
    pieces = [
        F.get(F.split(F.col(name), f"\\Q{separator}\\E"), F.lit(i)).alias(f"{name}{i + 1}")
        for name, count in parts.items()
        for i in range(count)
    ]
    return df.select(*kept, *pieces)


def apply_sentinels(df: DataFrame, codes: Mapping[str, str], mode: str = "null") -> DataFrame:
    """Missing-value codes.

    ``null`` (the default) turns a part equal to its code into null, with or without a
    sign, so that a code never counts as a measurement.  ``fill`` does the inverse and
    writes the code into null parts.
    """
    require_columns(df, codes)
    if mode == "fill":
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(code)) for c, code in codes.items()})
    if mode != "null":
        raise ValueError(f"mode is 'null' or 'fill', not {mode!r}")
    return df.withColumns(
        {c: F.when(~F.col(c).isin(code, f"+{code}", f"-{code}"), F.col(c)) for c, code in codes.items()}
    )


def type_parts(df: DataFrame, doubles: Iterable[str] = (), integers: Iterable[str] = ()) -> DataFrame:
    """Numeric parts; text that is no number gives null."""
    types = {**{c: "double" for c in doubles}, **{c: "int" for c in integers}}
    require_columns(df, types)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def suffix_bucket(df: DataFrame, name: str, n: int = 2) -> DataFrame:
    """Fewer distinct values: keep the last ``n`` characters of an identifier."""
    require_columns(df, [name])
    return df.withColumn(name, last_characters(name, n))
