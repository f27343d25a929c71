"""Nearest place for each site by great-circle distance, without comparing all pairs.

Places are points on the unit sphere, sorted into cubes inside cubes.  A site walks down
from the eight top cubes: at each level it keeps only cubes that can still hold its
nearest place, judged by the box around the places of the cube, and in the end compares
the few places of the cubes that are left.  The smallest cubes are made so small that the
fullest holds few places, so a dense cluster adds levels and not comparisons.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backglance.functions.geo import haversine_km, unit_sphere
from backglance.operators.joins import join_groups
from backglance.operators.quality import require_columns

_AXES = ("x", "y", "z")
_SPLIT = 4  # a cube has edge 1/4 of its parent's
_MAX_DEPTH = 12  # edges down to about a metre
_FEW_PLACES = 64
# Squared chord that stands for about a micrometre of a kilometre: keeps ties that rounding makes.
_SLACK = 1e-9


def _cube(depth: int, axes: tuple[Column, Column, Column]) -> Column:
    edge = 2.0 / _SPLIT**depth
    return F.struct(*[F.floor(v / edge).alias(n) for n, v in zip(_AXES, axes)])


def _axes() -> tuple[Column, Column, Column]:
    return tuple(F.col(a) for a in _AXES)


def _depth(places: DataFrame) -> int:
    """The first depth at which every cube holds few places; one line comes to the driver."""
    cubes = F.array(*[F.struct(F.lit(d).alias("depth"), _cube(d, _axes()).alias("cube")) for d in range(_MAX_DEPTH + 1)])
    held = places.select(F.explode(cubes).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    fullest = held.groupBy(F.col("c.depth").alias("depth")).agg(F.max("n").alias("n"))
    first = fullest.where(F.col("n") <= _FEW_PLACES).agg(F.min("depth")).first()[0]
    return _MAX_DEPTH if first is None else first


def _boxes(places: DataFrame, depth: int) -> DataFrame:
    """The box around the places of each cube."""
    sides = [f(a).alias(f"{s}_{a}") for a in _AXES for s, f in (("low", F.min), ("high", F.max))]
    named = places.withColumns({"cube": _cube(depth, _axes()), "parent": _cube(max(depth - 1, 0), _axes())})
    return named.groupBy("cube", "parent").agg(*sides)


def _add(terms: list[Column]) -> Column:
    return terms[0] + terms[1] + terms[2]


def _prune(looking: DataFrame) -> DataFrame:
    """Drop cubes whose nearest corner is farther than the farthest corner of another."""
    low = lambda a: F.col(f"low_{a}") - F.col(f"s{a}")
    high = lambda a: F.col(f"s{a}") - F.col(f"high_{a}")
    nearest = _add([F.pow(F.greatest(F.lit(0.0), low(a), high(a)), 2) for a in _AXES])
    farthest = _add([F.pow(F.greatest(F.abs(low(a)), F.abs(high(a))), 2) for a in _AXES])
    site = Window.partitionBy("lat", "lon")
    kept = looking.withColumn("reach", F.min(farthest).over(site)).where(nearest <= F.col("reach") + _SLACK)
    return kept.select("lat", "lon", *[f"s{a}" for a in _AXES], "cube")


def nearest_site(
    df: DataFrame,
    places: DataFrame,
    lat: str,
    lon: str,
    place_key: str,
    place_lat: str,
    place_lon: str,
    out: str = "nearest",
    distance: str = "distance_km",
) -> DataFrame:
    """Add the key of the nearest place and its distance in km.

    Distances are compared to the millimetre; the smallest key wins a tie.  Null
    coordinates give null.  Work is per distinct site, not per row.
    """
    require_columns(df, [lat, lon])
    require_columns(places, [place_key, place_lat, place_lon])

    points = dict(zip(_AXES, unit_sphere(F.col("place_lat"), F.col("place_lon"))))
    # Places at one coordinate are copies for this purpose; the smallest key stands for them.
    distinct_places = (
        places.select(F.col(place_lat).alias("place_lat"), F.col(place_lon).alias("place_lon"), F.col(place_key).alias("key"))
        .dropna()
        .groupBy("place_lat", "place_lon")
        .agg(F.min("key").alias("key"))
        .withColumns(points)
    )
    depth = _depth(distinct_places)

    sites = df.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).dropna().distinct()
    sphere = dict(zip([f"s{a}" for a in _AXES], unit_sphere(F.col("lat"), F.col("lon"))))
    # The sphere lies in eight top cubes, numbered -1 and 0 on each axis.
    top = F.array(
        *[
            F.struct(*[F.lit(v).cast("bigint").alias(n) for n, v in zip(_AXES, corner)])
            for corner in itertools.product((-1, 0), repeat=3)
        ]
    )
    looking = sites.withColumns(sphere).withColumn("cube", F.explode(top))
    for level in range(depth + 1):
        boxes = _boxes(distinct_places, level)
        step = F.col("cube") if level == 0 else F.col("parent")
        boxes = boxes.withColumn("inside", step).withColumnRenamed("cube", "child").drop("parent")
        opened = looking.join(boxes, F.col("cube") == F.col("inside")).drop("cube", "inside")
        looking = _prune(opened.withColumnRenamed("child", "cube"))

    held = distinct_places.withColumn("held_in", _cube(depth, _axes())).drop(*_AXES)
    compared = looking.join(held, F.col("cube") == F.col("held_in"))
    km = F.round(haversine_km(F.col("lat"), F.col("lon"), F.col("place_lat"), F.col("place_lon")), 6)
    answers = compared.groupBy("lat", "lon").agg(F.min(F.struct(km.alias("km"), "key")).alias("best"))
    answers = answers.select(
        F.col("lat").alias(lat), F.col("lon").alias(lon), F.col("best.key").alias(out), F.col("best.km").alias(distance)
    )
    return join_groups(df, answers, [lat, lon])
