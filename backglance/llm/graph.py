"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.sources.tables import pin


def _least_neighbours(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("_a", "_m").alias("_least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.join(_least_neighbours(both), F.col("a") == F.col("_a"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least_neighbours(down)
    joined = down.join(least, F.col("a") == F.col("_a")).where(F.col("b") != F.col("_least"))
    return joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).union(least.select("_a", "_least")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the least node of its component.

    Each round hangs every node's neighbours on the least of them, first those above it, then
    those below; the table then holds one star per component after some logarithm of its
    size in rounds.  No neighbourhood is gathered: a step is an aggregate and a join.  Each
    round is written to the shared checkpoint folder, which cuts the lineage.  Edges that join
    a node to itself and rows with a null end are no edges.
    """
    edges = pin(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct())
    edges = pin(_small_star(edges))
    state = None
    while True:
        edges = pin(_small_star(_large_star(edges)))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        state = now
