"""Exact nearest neighbours among many vectors, compared in bounded groups.

Projections on the principal directions of a bounded sample put each vector on a space-filling
order (the bits of its rank along the directions, interleaved).  The order is cut into leaves of
one number of vectors, so a dense region means more leaves and never a larger one, and
copies of a vector are compared once.  A vector is sent to one group for each pair of its leaf, so
there are few leaves: they grow with the table as far as the memory of a task allows.

1. Each leaf is compared with itself.  The distance of a vector's k-th neighbour so far bounds how
   far its true neighbours can lie.
2. Leaves have boxes, their ranges along the directions, and so have groups of consecutive leaves, up to
   one box for all.  The directions are orthonormal, so the gap between two boxes is at most the
   distance of any two vectors in them.  Pairs of boxes are opened from the top: a pair whose gap
   exceeds the bound of the first is dropped with all that lies below.
3. The pairs of leaves that are left are compared, each in a group of its own, after single
   vectors that lie too far from the other box are left out.  Inside a group, leaves are halved along
   the directions into chunks, and pairs of chunks are dropped by the same rule.

No true neighbour is dropped at any size; the spread of the data decides how many pairs are
left.  Vectors in clusters, or near a few directions, meet few of them, and vectors spread
evenly in many directions meet most.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from backglance.functions.vectors import as_array
from backglance.operators.positions import dense_index
from backglance.operators.quality import require_columns
from backglance.operators.windows import top_k_per_group
from backglance.sources.tables import pin

_BITS = 4  # 16 ranks along each direction
# Vectors that the directions are found from, at most.
SAMPLE = 4_000
# Boxes under a box.
_FANOUT = 16
# Leaves of a table whose leaves fit the memory of a task, and numbers in a leaf at most.
_LEAVES, _LEAF_NUMBERS = 12, 1 << 22
# Vectors of a chunk at most; rows and columns of the squares that are looked at together.
_CHUNK, _ROWS, _COLUMNS = 256, 64, 4096
# Room for rounding in the bounds: a pair is dropped only if it is farther by more than this share.
_ROOM = 1e-9


def vector_copies(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, representative): the smallest key among rows with the same vector."""
    values = F.transform(as_array(df, vector), lambda x: x + 0.0)  # -0.0 and 0.0 are one value
    print_of = F.struct(*[F.xxhash64(F.lit(i), values).alias(f"h{i}") for i in (1, 2)])  # 128 bits
    prints = df.select(F.col(key).alias("key"), print_of.alias("print")).select("key", "print.*")
    firsts = prints.groupBy("h1", "h2").agg(F.min("key").alias("representative"))
    return prints.join(firsts, ["h1", "h2"]).select("key", "representative")


def _principal_directions(points: DataFrame, most: int, seed: int) -> np.ndarray:
    """Orthonormal principal directions (columns) of at most SAMPLE vectors, drawn by a hash of the key."""
    drawn = points.orderBy(F.xxhash64("key", F.lit(seed)), "key").limit(SAMPLE)
    sample = np.array([r["values"] for r in drawn.select("values").collect()], float)
    centred = sample - sample.mean(0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1][:, :most]


def _in_leaves(points: DataFrame, leaf: int, directions: int, seed: int) -> DataFrame:
    """(leaf, key, values, along): vectors with their place along the directions, in leaves of the space-filling order."""
    matrix = _principal_directions(points, directions, seed)
    many = matrix.shape[1]

    def project(frames):
        for frame in frames:
            if len(frame):
                yield frame.assign(along=list(_matrix(frame["values"]) @ matrix))

    schema = f"key {_sql_type(points)}, values {_sql_type(points, 'values')}, along array<double>"
    placed = points.mapInPandas(project, schema)
    along, ranks = [f"p{i}" for i in range(many)], [f"r{i}" for i in range(many)]
    placed = placed.withColumns({c: F.get("along", F.lit(i)) for i, c in enumerate(along)})
    # Only the cut points, ranks × directions numbers, come to the driver.
    ranking = QuantileDiscretizer(inputCols=along, outputCols=ranks, numBuckets=2**_BITS, relativeError=0.001)
    ranked = ranking.fit(placed).transform(placed)

    def spread(direction: int) -> list[int]:
        """Each rank with its bits moved apart, to make room for the other directions."""
        place = lambda bit: bit * many + many - 1 - direction
        return [sum(((rank >> bit) & 1) << place(bit) for bit in range(_BITS)) for rank in range(2**_BITS)]

    code = F.lit(0).cast("bigint")
    for i, rank in enumerate(ranks):
        code = code + F.get(F.lit(spread(i)).cast("array<bigint>"), F.col(rank).cast("int"))
    ordered = dense_index(ranked.select("key", "values", "along", code.alias("code")), ["code", "key"], "at")
    # The rest that fills no leaf joins the last one, so every leaf but a lone one holds at least ``leaf`` vectors.
    last = F.lit(max(0, points.count() // leaf - 1))
    return ordered.select(F.least(F.floor(F.col("at") / leaf), last).alias("leaf"), "key", "values", "along")


def _nearest(
    a: np.ndarray, b: np.ndarray, k: int, bounds: np.ndarray, rank: np.ndarray, own: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of a, row of b and distance of the ``k`` nearest in b of each row in a, at most at its bound.

    Of equal distances the first in ``rank``; ``own`` are the rows of b that the rows of a are themselves.
    """
    rows, columns, distances = [], [], []
    take = k + (own is not None)
    of_a, of_b = (a * a).sum(1), (b * b).sum(1)
    # Some more than k where rounding may hide the order; exact distances decide.
    room = 1e-9 * (of_a + of_b[np.isfinite(of_b)].max(initial=0.0))
    limits = bounds**2 + room - of_a
    for start in range(0, len(a), _ROWS):  # bounds memory where very many distances are equal
        part, some, limit = -2 * a[start : start + _ROWS], room[start : start + _ROWS], limits[start : start + _ROWS].copy()
        for first in range(0, len(b), _COLUMNS):
            squares = part @ b[first : first + _COLUMNS].T
            squares += of_b[first : first + _COLUMNS]
            near = squares <= limit[:, None]
            # Of many, the nearest here tell how far the nearest of all can lie.
            many = np.flatnonzero(np.count_nonzero(near, axis=1) > 4 * take + 32)
            if len(many):
                limit[many] = np.minimum(limit[many], np.partition(squares[many], take - 1, axis=1)[:, take - 1] + some[many])
                near[many] = squares[many] <= limit[many, None]
            i, j = np.divmod(np.flatnonzero(near), near.shape[1])
            i, j = i + start, j + first
            if own is not None:
                other = own[i] != j
                i, j = i[other], j[other]
            gaps = a[i] - b[j]
            rows.append(i), columns.append(j), distances.append(np.sqrt((gaps * gaps).sum(1)))
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    i, j, distance = map(np.concatenate, (rows, columns, distances))
    order = np.lexsort((rank[j], distance, i))
    i, j, distance = i[order], j[order], distance[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    kept = (place < k) & (distance <= bounds[i] * (1 + _ROOM))
    return i[kept], j[kept], distance[kept]


def _bounds(i: np.ndarray, distance: np.ndarray, many: int, k: int) -> np.ndarray:
    """Distance of the k-th neighbour of each row, infinite where there are fewer."""
    counts = np.bincount(i, minlength=many)
    full = counts == k
    bounds = np.full(many, np.inf)
    bounds[full] = distance[np.cumsum(counts)[full] - 1]
    return bounds


def _chunks(along: np.ndarray) -> list[np.ndarray]:
    """Rows in chunks of near ones, halved along the direction of widest range."""
    open_, chunks = [np.arange(len(along))], []
    while open_:
        rows = open_.pop()
        if len(rows) <= _CHUNK:
            chunks.append(rows)
            continue
        values = along[rows]
        order = np.argpartition(values[:, np.argmax(np.ptp(values, axis=0))], len(rows) // 2)
        open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return chunks


def _nearest_in_chunks(a, a_along, b, b_along, k: int, bounds: np.ndarray, rank: np.ndarray, same: bool):
    """As ``_nearest``, over the chunks of b that are near enough to a chunk of a."""
    of_b = _chunks(b_along)
    low, high = (np.array([side(b_along[rows], axis=0) for rows in of_b]) for side in (np.min, np.max))
    parts = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
    for rows in of_b if same else _chunks(a_along):
        values, most = a[rows], bounds[rows]
        if same and len(of_b) > 1:
            # Its own chunk first: the neighbours there bound how far the true ones can lie.
            i, _, distance = _nearest(values, values, k, most, np.arange(len(rows)), np.arange(len(rows)))
            most = _bounds(i, distance, len(rows), k)
        mine = a_along[rows]
        gaps = np.maximum(0.0, np.maximum(mine.min(0) - high, low - mine.max(0)))
        near = ~(np.sqrt((gaps * gaps).sum(1)) > most.max() * (1 + _ROOM))
        if near.all():
            i, j, distance = _nearest(values, b, k, most, rank, rows if same else None)
        else:
            chosen = np.sort(np.concatenate([np.zeros(0, int), *[c for c, n in zip(of_b, near) if n]]))
            i, j, distance = _nearest(values, b[chosen], k, most, rank[chosen], np.searchsorted(chosen, rows) if same else None)
            j = chosen[j]
        parts.append((rows[i], j, distance))
    i, j, distance = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(i, kind="stable")
    return i[order], j[order], distance[order]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _within(k: int):
    def run(leaf: pd.DataFrame) -> pd.DataFrame:
        leaf = leaf.sort_values("key", ignore_index=True)
        values, along, keys = _matrix(leaf["values"]), _matrix(leaf["along"]), leaf["key"].to_numpy()
        everything = np.full(len(leaf), np.inf)
        i, j, distance = _nearest_in_chunks(values, along, values, along, k, everything, np.arange(len(leaf)), True)
        cuts = np.cumsum(np.bincount(i, minlength=len(leaf)))[:-1]
        return leaf.assign(bound=_bounds(i, distance, len(leaf), k), neighbours=np.split(keys[j], cuts), distances=np.split(distance, cuts))

    return run


def _between(k: int):
    def matrix(table: pa.Table, name: str) -> np.ndarray:
        column = table[name].combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        i, j, distance = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if len(left) and len(right):
            right = right.sort_by("other")
            i, j, distance = _nearest_in_chunks(
                matrix(left, "values"), matrix(left, "along"), matrix(right, "vector"), matrix(right, "beside"),
                k, left["bound"].to_numpy(), np.arange(len(right)), False,
            )
        return pa.table({"key": left["key"].take(pa.array(i)), "neighbour": right["other"].take(pa.array(j)), "distance": distance})

    return run


def _gap(low, high, other_low, other_high, many: int) -> Column:
    """Distance between two boxes, given by columns of arrays; a vector is a box of its own."""
    at = lambda c, i: F.get(c, F.lit(i))
    sides = [F.greatest(F.lit(0.0), at(low, i) - at(other_high, i), at(other_low, i) - at(high, i)) for i in range(many)]
    return F.sqrt(reduce(lambda a, b: a + b, [s * s for s in sides]))


def _box(many: int, low: str, high: str) -> list[Column]:
    side = lambda pick, c: F.array(*[pick(F.get(c, F.lit(i))) for i in range(many)])
    return [side(F.min, low).alias("low"), side(F.max, high).alias("high"), F.max("bound").alias("bound")]


def _pairs_of_leaves(members: DataFrame, many: int, leaves: int) -> DataFrame:
    """(a, b) with the boxes of both and the bound of a: the leaves b that may hold a neighbour of a vector in leaf a."""
    boxes = [pin(members.groupBy(F.col("leaf").alias("node")).agg(*_box(many, "along", "along")))]
    count = leaves
    while count > 1:
        above = boxes[-1].groupBy(F.floor(F.col("node") / _FANOUT).alias("node")).agg(*_box(many, "low", "high"))
        boxes.append(pin(above))
        count = -(-count // _FANOUT)
    pairs = boxes[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(boxes[:-1] or boxes):
        side = lambda s: level.select(  # noqa: E731, B023
            F.floor(F.col("node") / (_FANOUT if len(boxes) > 1 else 1)).alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("node", "low", "high", "bound")]
        )
        opened = pairs.join(side("a"), "a").join(side("b").drop("b_bound"), "b")
        near = _gap(F.col("a_low"), F.col("a_high"), F.col("b_low"), F.col("b_high"), many) <= F.col("a_bound") * (1 + _ROOM)
        pairs = opened.where(near).select(
            F.col("a_node").alias("a"), F.col("b_node").alias("b"), "a_low", "a_high", "a_bound", "b_low", "b_high"
        )
        if level is not boxes[0]:
            pairs = pairs.select("a", "b")
    return pairs.where("a <> b")


def nearest_neighbours(
    df: DataFrame, key: str, vector: str, k: int = 3, leaf: int = 512, directions: int = 8, seed: int = 48
) -> DataFrame:
    """(key, neighbour, distance, place): the ``k`` nearest vectors with distance above 0 of every row, exactly.

    Neighbours are named by the smallest key among copies of one vector; of equally near ones the
    smaller key comes first.  Rows without a vector are left out.  ``leaf`` (the least number of vectors
    in a leaf), ``directions`` and ``seed`` change how the work is cut, not the result.
    """
    require_columns(df, [key, vector])
    # Floats stay floats, half as many bytes to send, until they are compared as doubles.
    floats = df.schema[vector].dataType in (ArrayType(FloatType()), ArrayType(FloatType(), False))
    values = F.col(vector) if floats else as_array(df, vector).cast("array<double>")
    points = df.select(F.col(key).alias("key"), values.alias("values")).where("values is not null")
    copies = vector_copies(points, "key", "values")
    # Read by several jobs below: written once instead of worked out again each time.
    points = pin(points.join(copies.where("key = representative").select("key"), "key"))
    n_points = points.count()
    kind = _sql_type(points)
    schema = f"key {kind}, neighbour {kind}, distance double"
    if n_points < 2:
        best = df.sparkSession.createDataFrame([], schema + ", place int")
    else:
        dimensions = max(1, len(points.select("values").first()[0]))
        leaf = max(leaf, min(math.ceil(n_points / _LEAVES), _LEAF_NUMBERS // dimensions))
        leaves = max(1, n_points // leaf)
        cut = _in_leaves(points, leaf, directions, seed)
        inside = (
            f"leaf bigint, key {kind}, values {_sql_type(points, 'values')}, along array<double>, "
            f"bound double, neighbours array<{kind}>, distances array<double>"
        )
        members = pin(cut.repartition(leaves, "leaf").groupBy("leaf").applyInPandas(_within(k), inside))
        own = members.select("key", F.explode(F.arrays_zip("neighbours", "distances")).alias("n"))
        own = own.select("key", F.col("n.neighbours").alias("neighbour"), F.col("n.distances").alias("distance"))
        many = min(directions, dimensions)
        pairs = pin(_pairs_of_leaves(members, many, leaves))
        vector_of = lambda side, *more: members.select(F.col("leaf").alias(side), "key", "values", "along", *more)
        along = F.col("along")
        # Single vectors too far from the other leaf's box, or from the bound of this one, stay at home.
        left = pairs.join(vector_of("a", "bound"), "a").where(_gap(along, along, F.col("b_low"), F.col("b_high"), many) <= F.col("bound") * (1 + _ROOM))
        right = pairs.join(vector_of("b"), "b").where(_gap(along, along, F.col("a_low"), F.col("a_high"), many) <= F.col("a_bound") * (1 + _ROOM))
        left = left.select(F.col("a").alias("a1"), F.col("b").alias("b1"), "key", "values", "along", "bound")
        right = right.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("key").alias("other"), F.col("values").alias("vector"), along.alias("beside"))
        # As many tasks as pairs: a pair is much work on few bytes, by which Spark would put many into one task.
        tasks = max(1, min(leaves * leaves, 1000))
        left, right = left.repartition(tasks, "a1", "b1").groupBy("a1", "b1"), right.repartition(tasks, "a2", "b2").groupBy("a2", "b2")
        found = own.unionByName(left.cogroup(right).applyInArrow(_between(k), schema))
        best = top_k_per_group(found, ["key"], [F.col("distance"), F.col("neighbour")], k)
    best = best.withColumnRenamed("key", "representative")
    return copies.join(best, "representative").select(F.col("key").alias(key), "neighbour", "distance", "place")


def _sql_type(points: DataFrame, column: str = "key") -> str:
    return points.schema[column].dataType.simpleString()
