"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_characters(name: str, n: int = 2) -> Column:
    return F.right(F.col(name), F.lit(n))


def country_code(name: str) -> Column:
    """Last two characters of a station name without blanks, in upper case."""
    return F.upper(F.right(F.replace(F.col(name), F.lit(" "), F.lit("")), F.lit(2)))


def after_last(name: str, separator: str = "/") -> Column:
    return F.substring_index(F.col(name), separator, -1)
