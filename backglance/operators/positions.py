"""Ranks, running totals and row numbers over a whole table without one big task.

All exact:

* ``running_totals`` collapses rows to groups, so that equal rows, however many, cost
  nothing, range-sorts the groups, and adds to each range the total of the ranges before.
* ``dense_index`` range-sorts rows by a unique order, so that even one hot time is spread
  over tasks, and adds the sizes of the ranges before.
* ``keys_at`` finds the keys at a few places by counting ever finer groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backglance.operators.joins import join_groups
from backglance.operators.quality import require_columns
from backglance.sources.tables import pin

# Groups that one task may sort and add up by itself.
_FEW_GROUPS = 1_000_000


def _totals_before(
    groups: DataFrame, order: Sequence[str], measures: Sequence[str], by: Sequence[str], descending: bool = False
) -> DataFrame:
    """Add ``<measure>_before`` by one window per ``by``; for few groups only."""
    keys = [F.desc(c) if descending else F.asc(c) for c in order]
    partition = list(by) or [F.lit(0)]
    earlier = Window.partitionBy(*partition).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumns({f"{m}_before": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in measures})


def running_totals(
    groups: DataFrame, order: Sequence[str], measures: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``<measure>_before``: the total of all groups of the same ``by`` that sort earlier.

    ``groups`` holds one row per (by, order).  The range-sorted groups are written once, so
    that totals and rows come from the same ranges.  A large ``by`` spans many ranges, each
    added up by itself.
    """
    by, order = list(by), list(order)
    before = [f"{m}_before" for m in measures]
    keys = [F.desc(c) if descending else F.asc(c) for c in order]
    ranges = pin(groups.orderBy(*by, *keys).withColumn("_range", F.spark_partition_id()))
    local = _totals_before(ranges, order, measures, ["_range", *by], descending)
    sizes = ranges.groupBy("_range", *by).agg(*[F.sum(m).alias(m) for m in measures])
    # One line per range and group: a window here sees the ranges of one group.
    starts = _totals_before(sizes, ["_range"], measures, by)
    starts = starts.select("_range", *by, *[F.col(b).alias(f"_s_{b}") for b in before])
    if by:
        result = join_groups(local, starts, ["_range", *by])
    else:
        result = local.join(F.broadcast(starts), "_range")  # one line per range: no more than shuffle partitions
    result = result.withColumns({b: F.col(b) + F.col(f"_s_{b}") for b in before})
    return result.drop("_range", *[f"_s_{b}" for b in before])


def _tie_groups(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct order key, with the rows before it."""
    return running_totals(df.groupBy(*by, *order).agg(F.count(F.lit(1)).alias("_n")), order, ["_n"], by)


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "rank") -> DataFrame:
    """``rank()`` inside each ``by`` group: ties share a rank and gaps follow."""
    require_columns(df, [*by, *order])
    ranks = _tie_groups(df, order, by).select(*by, *order, (F.col("_n_before") + 1).alias(out))
    return join_groups(df, ranks, [*by, *order])


def global_percent_rank(df: DataFrame, order: Sequence[str], out: str = "percent_rank") -> DataFrame:
    """``percent_rank()`` over the whole table."""
    require_columns(df, order)
    groups = _tie_groups(df, order)
    last = groups.agg((F.sum("_n") - 1).alias("_last")).scalar()
    share = F.coalesce(F.try_divide(F.col("_n_before"), last), F.lit(0.0))
    return join_groups(df, groups.select(*order, share.alias(out)), order)


def dense_index(df: DataFrame, order: Sequence[str], out: str = "index") -> DataFrame:
    """0, 1, 2 ... in the given order, which must be unique.

    One range shuffle by the whole order key.  The sorted ranges are written once, so that
    sizes and rows come from the same ranges; counting them reads one narrow column.
    """
    require_columns(df, order)
    low = (1 << 33) - 1  # monotonically_increasing_id keeps the place in its range in 33 bits
    place = F.col("_place")
    ranges = pin(
        df.orderBy(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumns({"_range": F.shiftright(place, 33).cast("int"), "_place": place.bitwiseAND(low)})
    )
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = _totals_before(sizes, ["_range"], ["_n"], []).select("_range", F.col("_n_before").alias("_start"))
    # One line per sorted range: bounded by the number of shuffle partitions.
    return (
        ranges.join(F.broadcast(starts), "_range")
        .withColumn(out, F.col("_start") + F.col("_place"))
        .drop("_range", "_place", "_start")
    )


def keys_at(
    df: DataFrame, order: Sequence[str], wanted: Iterable[int], levels: Sequence[Column] = ()
) -> dict[int, list[Column | None]]:
    """The order keys at some places (0-based) of the sorted table, as literals; null is None.

    Counts the coarsest level, opens only the groups that hold a wanted place, counts the
    next level in them, and so on; only counts are shuffled, and one line per wanted place
    comes to the driver.  ``levels`` are coarse forms of the first order column, such as
    ``time_levels``, with few distinct values.  Reads the order columns once per level.
    """
    require_columns(df, order)
    names = [f"_level{i}" for i in range(len(levels))] + list(order)
    slim = df.select(*[c.alias(n) for n, c in zip(names, levels)], *order)
    types = [f.dataType for f in slim.schema.fields]
    paths: dict[int, list] = {place: [] for place in wanted}
    if not paths:
        return {}
    # Rows in the largest open group; before the first level that may be the whole table.
    largest = _FEW_GROUPS + 1
    rest = {place: place for place in paths}
    for depth, name in enumerate(names):
        on_path = {p: _all_equal(names[:depth], path) for p, path in paths.items()}
        opened = slim.where(_any_of(on_path.values())) if depth else slim
        groups = opened.groupBy(*names[: depth + 1]).agg(F.count(F.lit(1)).alias("_n"))
        totals = (_totals_before if largest <= _FEW_GROUPS else running_totals)(groups, [name], ["_n"], names[:depth])
        holds = {
            p: on_path[p] & (F.col("_n_before") <= rest[p]) & (F.col("_n_before") + F.col("_n") > rest[p]) for p in paths
        }
        value = F.unix_micros(name) if isinstance(types[depth], T.TimestampType) else F.col(name)
        lines = totals.select(
            F.explode(F.array(*[F.when(h, F.lit(p).cast("bigint")) for p, h in holds.items()])).alias("_place"),
            value.alias("_value"),
            "_n",
            "_n_before",
        )
        largest = 0
        for line in lines.where(F.col("_place").isNotNull()).collect():
            place = line["_place"]
            paths[place].append(_literal(line["_value"], types[depth]))
            rest[place] -= line["_n_before"]
            largest = max(largest, line["_n"])
        paths = {p: path for p, path in paths.items() if len(path) > depth}
    return {p: path[len(levels):] for p, path in paths.items()}


def _literal(value, data_type: T.DataType) -> Column | None:
    if value is None:
        return None
    # Times as microseconds or as text: no detour through the time zone of the driver.
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)


def _all_equal(names: Sequence[str], values: Sequence[Column | None]) -> Column:
    equal = [F.col(n).isNull() if v is None else F.col(n) == v for n, v in zip(names, values)]
    return reduce(lambda a, b: a & b, equal, F.lit(True))


def _any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def up_to(order: Sequence[str], key: Sequence[Column | None]) -> Column:
    """Rows that sort at or before the key, nulls first, in comparisons a scan can use."""
    column, value, rest = F.col(order[0]), key[0], len(order) > 1
    if value is None:
        return column.isNull() & up_to(order[1:], key[1:]) if rest else column.isNull()
    if not rest:
        return column.isNull() | (column <= value)
    return column.isNull() | (column < value) | ((column == value) & up_to(order[1:], key[1:]))


def after(order: Sequence[str], key: Sequence[Column | None]) -> Column:
    """Rows that sort after the key."""
    column, value, rest = F.col(order[0]), key[0], len(order) > 1
    later = column.isNotNull() if value is None else column > value
    if not rest:
        return later
    equal = column.isNull() if value is None else column == value
    return later | (equal & after(order[1:], key[1:]))


def quantile_rows(df: DataFrame, names: Sequence[str], share: float = 0.5) -> DataFrame:
    """Exact discrete quantile of each numeric column: the smallest value with at least ``share`` at or below it.

    A sketch first gives a narrow bracket per column; only values inside are counted
    one by one.  The rows below the bracket are counted exactly, so the result is exact.
    """
    accuracy = 10_000
    edges = [max(0.0, share - 2.0 / accuracy), min(1.0, share + 2.0 / accuracy)]
    sketch = df.agg(*[F.percentile_approx(F.col(c), edges, accuracy).alias(c) for c in names]).first()
    known = [c for c in names if sketch[c] is not None]
    empty = [c for c in names if sketch[c] is None]
    spark = df.sparkSession
    if not known:
        return _no_quantiles(spark, empty)
    below = df.agg(
        *[F.count_if(F.col(c) < sketch[c][0]).alias(f"lt_{c}") for c in known],
        *[F.count_if(F.col(c).between(*sketch[c])).alias(f"in_{c}") for c in known],
        *[F.count(F.col(c)).alias(f"n_{c}") for c in known],
    ).first()
    lines = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.when(F.col(c).between(*sketch[c]), F.col(c).cast("double")).alias("value"),
                )
                for c in known
            ]
        )
    )
    counts = (
        df.select(lines.alias("line"))
        .select("line.*")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def per_column(prefix: str) -> Column:
        expr = F.lit(None).cast("bigint")
        for c in known:
            expr = F.when(F.col("column_name") == c, F.lit(below[f"{prefix}_{c}"])).otherwise(expr)
        return expr

    few = max(below[f"in_{c}"] for c in known) <= _FEW_GROUPS
    placed = (_totals_before if few else running_totals)(counts, ["value"], ["n"], ["column_name"])
    target, skipped = F.greatest(F.ceil(per_column("n") * share), F.lit(1)), per_column("lt")
    found = placed.where((skipped + F.col("n_before") < target) & (skipped + F.col("n_before") + F.col("n") >= target))
    found = found.select("column_name", "value")
    return found.unionByName(_no_quantiles(spark, empty)) if empty else found


def _no_quantiles(spark, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n, None) for n in names], "column_name string, value double")
