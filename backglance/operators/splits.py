"""Splits in time order and repeatable samples."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from backglance.functions.hashing import unit_hash
from backglance.operators.positions import after, keys_at, up_to
from backglance.operators.quality import require_columns


def time_split(
    df: DataFrame, order: Sequence[str], fraction: float = 0.8, levels: Sequence[Column] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows with ``percent_rank <= fraction`` and the rest; equal times stay together.

    Only the order key of the last training row comes to the driver.  Both sides are then
    plain comparisons, which reach the Parquet scan.
    """
    require_columns(df, order)
    n_rows = df.count()
    if n_rows < 2 or not 0 <= fraction < 1:
        everything = n_rows == 0 or fraction >= 0
        return df.where(F.lit(everything)), df.where(F.lit(not everything))
    last = int(fraction * (n_rows - 1))
    # Compare as percent_rank does, whatever the product above was rounded to.
    while (last + 1) / (n_rows - 1) <= fraction:
        last += 1
    while last / (n_rows - 1) > fraction:
        last -= 1
    cut = keys_at(df, order, [last], levels)[last]
    return df.where(up_to(order, cut)), df.where(after(order, cut))


def fold_bounds(n_rows: int, folds: int, train_fraction: float, gap: int) -> list[tuple[int, int, int]]:
    """(first row, first row of the gap, first row of the test part) of each block, and the end."""
    starts = [-(-f * n_rows // folds) for f in range(folds + 1)]
    cuts = [a + math.floor((b - a) * train_fraction) for a, b in zip(starts, starts[1:])]
    return [(a, max(a, cut - gap), cut) for a, cut in zip(starts, cuts)]


def blocked_folds(
    df: DataFrame,
    order: Sequence[str],
    folds: int = 3,
    train_fraction: float = 0.8,
    gap: int = 0,
    levels: Sequence[Column] = (),
) -> DataFrame:
    """Consecutive blocks in time, each cut into an early ``train`` and a late ``test`` part.

    Adds ``fold`` and ``part``.  ``order`` must be unique.  The last ``gap`` training rows of
    each block are marked ``gap`` and belong to neither.  Rows are told apart by comparison
    with the few keys at the bounds; none is sorted or moved.
    """
    n_rows = df.count()
    bounds = fold_bounds(n_rows, folds, train_fraction, gap)
    places = {place for block in bounds for place in block if 0 < place < n_rows}
    keys = keys_at(df, order, places, levels)

    def from_place(place: int) -> Column:
        if place not in keys:
            return F.lit(place <= 0)
        return F.coalesce(~up_to(order, keys[place]) | _equal(order, keys[place]), F.lit(False))

    fold = sum((from_place(first).cast("int") for first, _, _ in bounds[1:]), F.lit(0))
    part = F.lit("train")
    for number, (_, gap_start, cut) in enumerate(bounds):
        late = F.when(from_place(cut), "test").when(from_place(gap_start), "gap").otherwise("train")
        part = F.when(F.col("fold") == number, late).otherwise(part)
    return df.withColumn("fold", fold).withColumn("part", part)


def _equal(order: Sequence[str], key: Sequence[Column | None]) -> Column:
    equal = [F.col(n).isNull() if v is None else F.col(n).eqNullSafe(v) for n, v in zip(order, key)]
    return reduce(lambda a, b: a & b, equal)


def repeatable_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample by a hash of the key: the same rows on every run and in every engine."""
    require_columns(df, [key])
    return df.where(unit_hash(key, seed=seed) < fraction)
