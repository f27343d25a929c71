"""Labels and the shares of their causes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backglance.operators.profile import value_shares
from backglance.operators.quality import require_columns


def derive_label(df: DataFrame, label: str, cancelled: str, out: str = "label") -> DataFrame:
    """Cancelled rows are positive; a label still missing is 0."""
    require_columns(df, [label, cancelled])
    return df.withColumn(out, F.coalesce(F.when(F.col(cancelled) == 1, F.lit(1)), F.col(label), F.lit(0)))


def cause_shares(df: DataFrame, causes: Mapping[str, Column], none: str = "none", out: str = "cause") -> DataFrame:
    """Share of rows per cause; the first cause that holds counts, and ``none`` is the rest."""
    chosen = F.lit(none)
    for name, holds in reversed(list(causes.items())):
        chosen = F.when(holds, F.lit(name)).otherwise(chosen)
    return value_shares(df.select(chosen.alias(out)), [out])
