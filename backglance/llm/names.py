"""Names for helper columns that no column of a table has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
