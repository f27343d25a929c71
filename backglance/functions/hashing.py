"""Repeatable random numbers: a hash of the row key, so that a re-run task draws the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits, the exact range of a double


def unit_hash(*parts: str | Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of the parts and the seed."""
    columns = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    digest = F.md5(F.concat_ws("|", *columns, F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double") / float(16**_HEX_DIGITS)


def pick_index(size: Column, *parts: str | Column, seed: int) -> Column:
    """An index in 0..size-1."""
    return F.floor(unit_hash(*parts, seed=seed) * size).cast("int")
