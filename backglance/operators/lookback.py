"""Nearest earlier observation inside a bounded look-back.

For each event: among the observations of the same key between ``min_hours`` and
``max_hours`` earlier (both ends in), the one with the smallest gap; events without one
stay, with nulls.

How it is spread.  Times are moved by the smallest gap, so that the wanted observation is
the last one at or before the event.  The distinct (key, time) pairs of both sides are range-sorted,
so that even one key with very many times is cut into ranges of measured, equal size.  In each range a
window carries the last observation forward, and the last observation of a key is handed on to
the ranges behind that begin with the same key: at most one line per range.  No pairs are made,
copies of a time do not count, and rows are thin: wide columns join at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from backglance.functions.timeops import MICROS_PER_HOUR, epoch_micros
from backglance.operators.joins import join_groups
from backglance.operators.quality import require_columns
from backglance.operators.windows import first_per_group
from backglance.sources.tables import pin


def lookback_join(
    events: DataFrame,
    observations: DataFrame,
    on: Sequence[str],
    event_time: str,
    observation_time: str,
    observation_key: str,
    columns: Sequence[str] = (),
    min_hours: float = 2.0,
    max_hours: float = 4.0,
    same_day: bool = False,
    slot_hours: float | None = None,
    unique_key: bool = False,
    gap: str = "gap_hours",
) -> DataFrame:
    """Events with ``observation_time``, ``observation_key``, ``columns`` and the gap in hours.

    ``on`` names columns both sides have.  ``observation_key`` tells observations of one
    time apart; the smallest wins, and copies with equal key and time count once.  Say
    ``unique_key`` when there are no copies: that spares a pass over the wide columns.
    ``same_day`` also asks for equal calendar days.  ``slot_hours`` is still accepted and changes
    nothing: ranges are cut by the number of times in them.
    """
    on = list(on)
    carried = [observation_time, observation_key, *columns]
    require_columns(events, [*on, event_time])
    require_columns(observations, [*on, *carried])
    taken = set(carried) & set(events.columns)
    if taken:
        raise ValueError(f"both sides have {', '.join(sorted(taken))}; rename one of them")

    to_micros = lambda hours: round(hours * MICROS_PER_HOUR)
    least, most = to_micros(min_hours), to_micros(max_hours)
    span = most - least

    keys = on + (["_day"] if same_day else [])
    left = events.withColumn("_at", epoch_micros(events, event_time))
    right = observations.select(*on, *carried).dropna(subset=[*on, observation_time, observation_key])
    right = right.withColumn("_at", epoch_micros(observations, observation_time) + least)
    if same_day:
        left = left.withColumn("_day", F.to_date(event_time))
        right = right.withColumn("_day", F.to_date(observation_time))

    asked = left.dropna(subset=[*on, event_time]).select(*keys, "_at").distinct()
    seen = right.groupBy(*keys, "_at").agg(F.min(observation_key).alias("_key"))
    answers = _last_before(seen, asked, keys).where(F.col("_at") - F.col("_found.at") <= span)
    answers = answers.select(*keys, "_at", F.col("_found.at").alias("_seen_at"), F.col("_found.key").alias("_key"))

    values = [c for c in carried if c != observation_key]
    at_key = [
        *[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_at").alias("_w_at"), F.col(observation_key).alias("_w_key")
    ]
    if unique_key:
        wide = right.select(*at_key, F.struct(*values).alias("_values"))
    else:
        # Copies are told apart only among the observations that some event has chosen.
        wide = right.select(*at_key, F.struct(*values).alias("_values"))
        chosen = answers.select(
            *[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_seen_at").alias("_w_at"), F.col("_key").alias("_w_key")
        ).distinct()
        wide = wide.join(chosen, chosen.columns, "left_semi")
        wide = first_per_group(wide, chosen.columns, [F.col("_values")])
    same = [F.col(k) == F.col(f"_w_{k}") for k in keys]
    matched = answers.join(wide, [*same, F.col("_seen_at") == F.col("_w_at"), F.col("_key") == F.col("_w_key")])
    matched = matched.select(
        *keys, "_at", "_seen_at", *[F.col(f"_values.{c}").alias(c) for c in values], F.col("_key").alias(observation_key)
    )
    hours = (F.col("_at") - F.col("_seen_at") + least) / F.lit(float(MICROS_PER_HOUR))
    matched = matched.withColumn(gap, hours).drop("_seen_at")
    joined = join_groups(left, matched, [*keys, "_at"])
    return joined.drop("_at", "_day")


def _last_before(seen: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Each (keys, _at) of ``asked`` with ``_found``, the (at, key) of the last row of ``seen`` at or before it.

    The sorted ranges are written once, so that their ends and their rows come from the same ranges.
    """
    line = seen.withColumn("_asked", F.lit(1))
    line = line.unionByName(asked.withColumns({"_key": F.lit(None).cast(seen.schema["_key"].dataType), "_asked": F.lit(2)}))
    ranges = pin(line.orderBy(*keys, "_at", "_asked").withColumn("_range", F.spark_partition_id()))
    one = F.when(F.col("_asked") == 1, F.struct(F.col("_at").alias("at"), F.col("_key").alias("key")))
    so_far = (
        Window.partitionBy("_range", *keys).orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = ranges.withColumn("_inside", F.last(one, True).over(so_far)).where("_asked = 2")
    # One line per range and key; a key has more than one line only where it goes on from range to range.
    ends = ranges.groupBy("_range", *keys).agg(F.max(one).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("_range", *keys, F.last("_end", True).over(earlier).alias("_handed")).where("_handed is not null")
    # Only the first key of a range can have begun before it: one line per range at most.
    found = inside.join(F.broadcast(handed), ["_range", *keys], "left").withColumn("_found", F.coalesce("_inside", "_handed"))
    return found.where("_found is not null").select(*keys, "_at", "_found")


def with_match_flag(joined: DataFrame, observation_key: str, out: str = "matched") -> DataFrame:
    """1 where the look-back found an observation, else 0."""
    return joined.withColumn(out, F.col(observation_key).isNotNull().cast("int"))
