"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

Entries become whole numbers, so the scatter n * sum(x x') - S S' is an integer matrix, n squared
times the covariance, and is summed without rounding.  Its characteristic polynomial is found
modulo many primes, a task for some of them each (reduction to Hessenberg form, then the
recurrence of its leading minors), and put together by Chinese remaindering.  All roots of a
symmetric matrix are real, so the sign changes of the shifted polynomial are the number of roots
above the shift: a task per component bisects to its root, then refines it until its neighbours lie
2^64 widths away.  The vector comes from the null space of scatter minus root, by elimination and
inverse iteration in decimals of as many digits.  Trailing zero coefficients tell the rank.

The driver holds what has the size of the model: the scatter, the polynomial, the components.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How an entry becomes a whole number, and how many components there are at most.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32

# The whole number of an entry fits a long below this.
_LARGEST = float(2**63 - 2**20)
# Bits to a limb: products of limbs, summed over _ROWS rows, stay exact in a double.
_LIMB, _ROWS = 21, 512
# Bits to a part of a long sum, and widths of a root's interval that hold no other root.
_PART, _APART = 48, 64


# -- vectors as whole numbers ---------------------------------------------------------------


def _entries(vector: str) -> Column:
    return F.col(vector).cast("array<double>")


def usable_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, entries) of the rows whose vector has only finite entries that fit a long."""
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(SCALE))) <= F.lit(_LARGEST))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), _entries(vector).alias("entries"))
    return rows.where(F.col("entries").isNotNull() & F.forall("entries", fits))


def _whole(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    """floor(64 c): one row per vector.  The shift by SHIFT changes neither scatter nor deviations."""
    flat = batch["entries"].flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dimension)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as doubles of _LIMB bits each, the last one with the sign."""
    found = []
    while np.abs(x).max(initial=0) >= 1 << _LIMB:
        found.append((x & ((1 << _LIMB) - 1)).astype(float))
        x = x >> _LIMB
    return [*found, x.astype(float)]


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x as Python whole numbers, from products of limbs that doubles hold exactly."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for start in range(0, len(x), _ROWS):
        limbs = _limbs(x[start : start + _ROWS])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def _parts(value: int) -> list[tuple[int, int]]:
    """(place, part) of a whole number in parts of _PART bits, each with its sign."""
    sign, value, found, place = (-1 if value < 0 else 1), abs(value), [], 0
    while value:
        found.append((place, sign * (value & ((1 << _PART) - 1))))
        value >>= _PART
        place += 1
    return found


def scatter(rows: DataFrame, dimension: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, sums of their whole numbers, and n * sum(x x') - S S', all exact.

    Each task adds up its vectors and sends one line per entry and part; Spark adds the lines up.
    """

    def run(batches):
        total = np.zeros((dimension + 1, dimension + 1), object)
        for batch in batches:
            if batch.num_rows:
                x = _whole(batch, dimension)
                total += exact_products(np.hstack([x, np.ones((len(x), 1), np.int64)]))
        lines = [(i, j, *part) for i in range(dimension + 1) for j in range(i, dimension + 1) for part in _parts(int(total[i, j]))]
        columns = list(zip(*lines)) or [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["i", "j", "place", "part"])

    lines = rows.select("entries").mapInArrow(run, "i int, j int, place int, part long")
    sums = lines.groupBy("i", "j", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    products = [[0] * (dimension + 1) for _ in range(dimension + 1)]
    for i, j, place, part in sums.collect():  # the size of the covariance
        products[i][j] += int(part) << (_PART * place)
    n, sums_of = products[dimension][dimension], [products[i][dimension] for i in range(dimension)]
    at = lambda i, j: n * products[min(i, j)][max(i, j)] - sums_of[i] * sums_of[j]
    return n, sums_of, [[at(i, j) for j in range(dimension)] for i in range(dimension)]


# -- the characteristic polynomial -----------------------------------------------------------


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test with the bases that decide every number below 3 * 10^9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        value = pow(base, odd, n)
        if value not in (1, n - 1) and all((value := value * value % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bits: int) -> list[int]:
    """Primes below 2^31, falling, whose product has more than ``bits`` bits."""
    found, have, n = [], 0, 1 << 31
    while have <= bits:
        n -= 1
        if _is_prime(n):
            found.append(n)
            have += 30  # each is above 2^30
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime below 2^31, highest first."""
    a, d = matrix % p, len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        a[[k + 1, pivot]] = a[[pivot, k + 1]]
        a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factor % p).sum(1)) % p
    # Polynomials of the leading minors, lowest coefficient first.
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        weights, product = np.zeros(k, np.int64), 1
        weights[k - 1] = a[k - 1, k - 1]
        for i in range(k - 2, -1, -1):
            product = product * int(a[i + 1, i]) % p
            weights[i] = int(a[i, k - 1]) * product % p
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(0)) % p
    return [int(c) for c in minors[d][::-1]]


def _tasks(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(0, count, 1, count)


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), highest first, of a symmetric matrix without negative eigenvalues."""
    d = len(matrix)
    # The k-th coefficient is a symmetric function of the eigenvalues: at most binomial(d, k) * mean^k.
    mean = sum(matrix[i][i] for i in range(d)) // d + 1
    primes = primes_beyond(d * (mean + 1).bit_length() + 1)
    shared = spark.sparkContext.broadcast((matrix, primes))

    def run(batches):
        numbers, moduli = shared.value
        for batch in batches:
            for place in batch["id"].to_pylist():
                p = moduli[place]
                rest = polynomial_modulo(np.array([[v % p for v in row] for row in numbers], np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([rest], pa.list_(pa.int64()))], ["prime", "rest"])

    found = _tasks(spark, len(primes)).mapInArrow(run, "prime long, rest array<long>").collect()
    values, modulus = [0] * (d + 1), 1
    for p, rest in sorted((r["prime"], r["rest"]) for r in found):
        inverse = pow(modulus % p, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, rest)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


# -- its roots ---------------------------------------------------------------------------------


def _primitive(poly: list[int]) -> list[int]:
    """Without leading zeros and common factors."""
    first = next((i for i, c in enumerate(poly) if c), len(poly))
    common = math.gcd(*poly[first:]) if first < len(poly) else 1
    return [c // common for c in poly[first:]]


def _remainder(a: list[int], b: list[int]) -> list[int]:
    """Primitive remainder of a by b, highest coefficient first."""
    a = list(a)
    while len(a) >= len(b):
        lead = a[0]
        a = [b[0] * c for c in a]
        for i, c in enumerate(b):
            a[i] -= lead * c
        a = a[1:]
    return _primitive(a)


def _quotient(a: list[int], b: list[int]) -> list[int]:
    """a / b where b divides a, up to a factor."""
    rest, found = [Fraction(c) for c in a], []
    while len(rest) >= len(b):
        factor = rest[0] / b[0]
        found.append(factor)
        rest = [c - factor * (b[i] if i < len(b) else 0) for i, c in enumerate(rest)][1:]
    scale = math.lcm(*[f.denominator for f in found])
    return _primitive([int(f * scale) for f in found])


def _no_double_root(poly: list[int], p: int) -> bool:
    """Whether some prime shows that no root is repeated: it has no common factor with its derivative even there."""
    n = len(poly) - 1
    a, b = [c % p for c in poly], [c * (n - i) % p for i, c in enumerate(poly[:-1])]
    strip = lambda f: f[next((i for i, c in enumerate(f) if c), len(f)) :]
    a, b = strip(a), strip(b)
    if len(a) != n + 1:
        return False
    while b:
        inverse = pow(b[0], -1, p)
        while len(a) >= len(b):
            factor = a[0] * inverse % p
            a = [(c - factor * (b[i] if i < len(b) else 0)) % p for i, c in enumerate(a)][1:]
        a, b = b, strip(a)
    return len(a) == 1


def distinct_roots(poly: list[int]) -> list[int]:
    """A polynomial with the same roots, each once."""
    if _no_double_root(poly, (1 << 31) - 1):
        return poly
    n = len(poly) - 1
    a, b = _primitive(poly), _primitive([c * (n - i) for i, c in enumerate(poly[:-1])])
    while b:
        a, b = b, _remainder(a, b)
    return _quotient(poly, a)


def roots_above(poly: list[int], at: int, scale: int = 0) -> int:
    """Number of roots above at / 2^scale >= 0 of a polynomial with real roots only.

    By Descartes: the sign changes of the coefficients of poly((1 + y) * at / 2^scale).
    """
    n = len(poly) - 1
    c = [v << (scale * i) for i, v in enumerate(poly)]
    if at:
        power = 1
        for i in range(n, -1, -1):
            c[i] *= power
            power *= at
        for i in range(n):
            c[: n + 1 - i] = accumulate(c[: n + 1 - i])
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign_at(poly: list[int], at: int, scale: int) -> int:
    value = 0
    for i, c in enumerate(poly):
        value = value * at + (c << (scale * i))
    return (value > 0) - (value < 0)


def isolate(poly: list[int], place: int, top: int) -> tuple[int, int, int]:
    """(low, high, scale): the root number ``place`` from the largest (1) on lies in (low, high] / 2^scale.

    ``poly`` has positive roots only, each once, none above ``top``.  No other root lies within 2^_APART
    widths of the interval, nor does 0.
    """
    low, high, scale = 0, 1 << top.bit_length(), 0

    def middle():
        nonlocal low, high, scale
        if high - low == 1:
            low, high, scale = 2 * low, 2 * high, scale + 1
        return (low + high) // 2

    above_low, above_high = len(poly) - 1, 0
    while above_low - above_high > 1:
        at = middle()
        above = roots_above(poly, at, scale)
        if above >= place:
            low, above_low = at, above
        else:
            high, above_high = at, above
    # The polynomial has this sign between the root and the next larger one.
    sign = (1 if poly[0] > 0 else -1) * (-1) ** (place - 1)

    def refine(bits: int):
        nonlocal low, high, scale
        for _ in range(bits):
            at = middle()
            now = _sign_at(poly, at, scale)
            if now == 0:  # the root itself: narrow the interval from below at once
                low, high, scale = (at << bits) - 1, at << bits, scale + bits
                return
            if now == sign:
                high = at
            else:
                low = at

    while True:
        far = (high - low) << _APART
        if low > far and roots_above(poly, low - far, scale) - roots_above(poly, high + far, scale) == 1:
            return low, high, scale
        refine(16)


# -- its vectors -------------------------------------------------------------------------------


def null_vectors(matrix: list[list[int]], low: int, high: int, scale: int, many: int) -> np.ndarray:
    """``many`` orthonormal eigenvectors (rows) of the eigenvalue in (low, high] / 2^scale.

    Scatter minus a value just above the root is eliminated with full pivoting; its last ``many``
    pivots nearly vanish, which gives a basis of the null space, and two steps of inverse
    iteration on the same elimination polish it.  Digits cover the span from the largest
    eigenvalue down to the interval's width.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    with localcontext() as context:
        context.prec = int((trace.bit_length() + scale) * 0.30103) + 40
        context.Emax, context.Emin = 10**9, -(10**9)
        shift = Decimal(2 * high - low) / Decimal(1 << scale)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object).reshape(d, d)
        for i in range(d):
            a[i, i] -= shift
        rows, columns = np.arange(d), np.arange(d)
        least = Decimal(10) ** -context.prec
        for k in range(d):
            at = int(np.abs(a[k:, k:]).argmax())
            i, j = k + at // (d - k), k + at % (d - k)
            a[[k, i]], rows[[k, i]] = a[[i, k]], rows[[i, k]]
            a[:, [k, j]], columns[[k, j]] = a[:, [j, k]], columns[[j, k]]
            if a[k, k] == 0:
                a[k, k] = least
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - np.outer(a[k + 1 :, k], a[k, k + 1 :])

        def back(y: np.ndarray, until: int) -> np.ndarray:
            """Upper part solved for the first ``until`` unknowns, the others given in y."""
            for k in range(until - 1, -1, -1):
                y[k] = (y[k] - a[k, k + 1 :] @ y[k + 1 :]) / a[k, k] if k + 1 < d else y[k] / a[k, k]
            return y

        def solve(x: np.ndarray) -> np.ndarray:
            y = x[rows].copy()
            for k in range(d - 1):
                y[k + 1 :] = y[k + 1 :] - np.outer(a[k + 1 :, k], y[k]).reshape(y[k + 1 :].shape)
            y = back(y, d)
            found = np.empty_like(y)
            found[columns] = y
            return found

        def orthonormal(x: np.ndarray) -> np.ndarray:
            for i in range(x.shape[1]):
                for _ in range(2):
                    for j in range(i):
                        x[:, i] = x[:, i] - x[:, j] * (x[:, j] @ x[:, i])
                x[:, i] = x[:, i] / (x[:, i] @ x[:, i]).sqrt()
            return x

        start = np.full((d, many), Decimal(0), object)
        for i in range(many):
            start[d - many + i, i] = Decimal(1)
        start = back(start, d - many)
        x = np.empty_like(start)
        x[columns] = start
        x = orthonormal(x)
        for _ in range(2):
            x = orthonormal(solve(x))
        vectors = x.T.astype(float)
    # Of the two signs, the one with a positive largest entry.
    largest = np.abs(vectors).argmax(1)
    return vectors * np.sign(vectors[np.arange(many), largest])[:, None]


@dataclass
class Whitening:
    """``directions`` (one row per component) are divided by the root of the scatter's eigenvalue.

    A vector's whitened values are (n * x - S) @ directions'; ``explained`` are shares of the trace.
    """

    n: int
    sums: list[int]
    eigenvalues: list[float]
    vectors: np.ndarray
    directions: np.ndarray
    explained: list[float]


def fit_whitening(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening:
    """Components of the covariance of all ``rows``, by falling eigenvalue, at most ``components`` and only above 0."""
    spark = rows.sparkSession
    n, sums, matrix = scatter(rows, dimension)
    trace = sum(matrix[i][i] for i in range(dimension))
    empty = Whitening(n, sums, [], np.zeros((0, dimension)), np.zeros((0, dimension)), [])
    if not trace:
        return empty
    whole = characteristic_polynomial(spark, matrix)
    while whole[-1] == 0:  # a zero eigenvalue
        whole = whole[:-1]
    once = distinct_roots(whole)
    shared = spark.sparkContext.broadcast((matrix, whole, once))

    def run(batches):
        numbers, every, single = shared.value
        top = sum(numbers[i][i] for i in range(len(numbers)))
        for batch in batches:
            for place in batch["id"].to_pylist():
                low, high, scale = isolate(single, place + 1, top)
                many = len(every) - len(single) and roots_above(every, low, scale) - roots_above(every, high, scale) or 1
                vectors = null_vectors(numbers, low, high, scale, many)
                columns = [[place], [str(high)], [scale], [vectors.ravel().tolist()]]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["place", "high", "scale", "vectors"])

    roots = _tasks(spark, min(components, len(once) - 1)).mapInArrow(run, "place long, high string, scale long, vectors array<double>")
    eigenvalues, vectors, directions, explained = [], [], [], []
    for root in sorted(roots.collect(), key=lambda r: r["place"]):
        exact = Fraction(int(root["high"]), 1 << root["scale"])
        with localcontext() as context:
            context.prec = 40
            length = float((Decimal(exact.numerator) / Decimal(exact.denominator)).sqrt())
        for vector in np.array(root["vectors"]).reshape(-1, dimension):
            if len(vectors) < components:
                eigenvalues.append(float(exact / (n * n)))
                vectors.append(vector)
                directions.append(vector / length)
                explained.append(float(exact / trace))
    return Whitening(n, sums, eigenvalues, np.array(vectors), np.array(directions), explained)


# -- whitened vectors ----------------------------------------------------------------------------


def _centred(batch: pa.RecordBatch, model: Whitening) -> np.ndarray:
    """n * x - S of each vector, as longs where they fit and as Python whole numbers elsewhere."""
    x = _whole(batch, len(model.sums))
    most = model.n * int(np.abs(x.astype(float)).max(initial=0) + 1) + max(map(abs, model.sums))
    if most < 1 << 62:
        return model.n * x - np.array(model.sums, np.int64)
    return model.n * x.astype(object) - np.array(model.sums, object)


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; None where a long can't hold one."""
    if centred.dtype != object and len(centred) and int(np.abs(centred).max()) ** 2 * centred.shape[1] < 1 << 63:
        return (centred * centred).sum(1).tolist()
    sums = [sum(v * v for v in row) for row in centred.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity.

    Each task centres its vectors before it multiplies; the parts merge by their means.
    """
    many = len(model.directions)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        count, mean, products = 0, np.zeros(many), np.zeros((many, many))
        for batch in batches:
            if batch.num_rows:
                w = _centred(batch, shared.value).astype(float) @ shared.value.directions.T
                m, off = len(w), w.mean(0)
                gap = off - mean
                products += (w - off).T @ (w - off) + np.outer(gap, gap) * (count * m / (count + m))
                mean += gap * (m / (count + m))
                count += m
        i, j = np.triu_indices(many)
        columns = [i.astype(np.int32), j.astype(np.int32), products[i, j], count * mean[i] * mean[j], count * mean[i]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "inside", "between", "total"])

    lines = rows.select("entries").mapInArrow(run, "i int, j int, inside double, between double, total double")
    sums = lines.groupBy("i", "j").agg(F.sum("inside").alias("inside"), F.sum("between").alias("between"), F.sum("total").alias("total"))
    found = {(r["i"], r["j"]): r for r in sums.collect()}  # one line per pair of components
    mean = [found[i, i]["total"] / model.n for i in range(many)]
    entry = lambda i, j: (found[i, j]["inside"] + found[i, j]["between"]) / model.n - mean[i] * mean[j]
    return max(abs(entry(i, j) - (i == j)) for i, j in found)


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every usable row and component.

    Rows whose vector is null, holds a null or non-finite entry or one whose whole number fits no
    long are left out; so are, where lengths differ, rows whose vector has not the most frequent
    length (of equally frequent ones the largest).  Components with eigenvalue 0 do not exist, so equal
    vectors alone, one row, or an empty table give no rows.  A deviation that fits no long is
    null.  Equal eigenvalues share their space; any orthonormal basis of it may come out, the same for all
    rows.  Repeated rows and null ids count like others; other columns are not read.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    usable = usable_vectors(vectors, key, vector)
    lengths = usable.groupBy(F.size("entries").alias("length")).count()
    length = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    spark = vectors.sparkSession
    if length is None or not length["length"]:
        return spark.createDataFrame([], schema)
    dimension = length["length"]
    rows = usable.where(F.size("entries") == dimension)
    model = fit_whitening(rows, dimension, components)
    many = len(model.directions)
    if not many:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, model)
    shared = spark.sparkContext.broadcast(model)
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches):
        fitted = shared.value
        for batch in batches:
            centred = _centred(batch, fitted)
            whitened = centred.astype(float) @ fitted.directions.T
            n = len(centred)
            each = pa.array(np.repeat(np.arange(n), many))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(each),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * many, fitted.n, np.int64)),
                    pa.array(_deviations(centred), pa.int64()).take(each),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(np.array(fitted.explained), n)),
                    pa.array(np.full(n * many, error)),
                ],
                names,
            )

    return rows.mapInArrow(run, schema)
