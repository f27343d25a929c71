"""SimHash near-duplicates found with anchors from a covering code.

Two halves of 23 bits of a 64-bit fingerprint are each covered by the perfect binary Golay
code: every 23-bit word lies within 3 bits of exactly one code word.  The anchors of a
fingerprint are pairs of code words, and its home is the pair within the covering radius of
both halves.  If x and y differ in at most t bits, the home of x lies within 3 + t1 bits of y
in one half and 3 + t2 in the other with t1 + t2 <= t.  So y, copied to every such anchor,
meets x at the home of x, and only pairs that meet at an anchor are compared.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backglance.llm.graph import connected_components
from backglance.llm.names import free_name
from backglance.llm.words import ASCII_LOWER, slices, text_bytes
from backglance.operators.joins import join_groups
from backglance.sources.tables import pin

# Length, check bits and covering radius of the code, and its generator
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
LENGTH, CHECKS, RADIUS, GENERATOR = 23, 11, 3, 0b101011100011
_HALVES = (0, LENGTH)  # first bits of the halves


def _fingerprints(texts: pa.Array, shingle: int, seed: int) -> np.ndarray:
    data, offsets = text_bytes(texts)
    lowered = ASCII_LOWER[data].tobytes()
    found = np.zeros(len(offsets) - 1, np.uint64)
    for d, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        words = lowered[start:end].split()
        if not words:
            continue
        if len(words) <= shingle:
            hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
        else:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            firsts = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
            hashes = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(firsts, ends[shingle - 1 :].tolist())]
        found[d] = _majority(np.array(hashes, np.uint64))
    return found


def _majority(hashes: np.ndarray, part: int = 1 << 16) -> np.uint64:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), part):
        bits = np.unpackbits(hashes[i : i + part].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and the 64-bit fingerprint of each row, as a signed long ``bits``.

    A bit is set if it is set in over half of the XXH64 values of the word shingles, repeats
    included, of the text with A-Z lowered.  Fewer words than a shingle: the whole
    sequence is the one shingle.  No word or a null text: 0.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                bits = _fingerprints(part["text"], shingle, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), pa.array(bits)], ["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, bits long")


def _remainder(word: int) -> int:
    """The word modulo the generator: 0 for code words."""
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@cache
def _steps(most: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """By syndrome and bits to spare: what leads from a word to each anchor, and the bits that takes beyond the radius."""
    single = [_remainder(1 << bit) for bit in range(LENGTH)]
    found: dict[tuple[int, int], list[tuple[int, int]]] = {(s, spare): [] for s in range(1 << CHECKS) for spare in range(most + 1)}
    for weight in range(RADIUS + most + 1):
        for bits in combinations(range(LENGTH), weight):
            syndrome = pattern = 0
            for bit in bits:
                syndrome ^= single[bit]
                pattern |= 1 << bit
            cost = max(0, weight - RADIUS)
            for spare in range(cost, most + 1):
                found[syndrome, spare].append((pattern, cost))
    return found


def _code_table(spark: SparkSession, most: int) -> DataFrame:
    """Spark table of ``_steps``: 2048 x (most + 1) lines, whatever the input."""
    rows = [(s, spare, steps) for (s, spare), steps in _steps(most).items()]
    return spark.createDataFrame(rows, "syndrome int, spare int, steps array<struct<pattern: int, cost: int>>")


def _half(column: str, first: int):
    return F.shiftrightunsigned(column, first).bitwiseAND(F.lit((1 << LENGTH) - 1).cast("long")).cast("int")


def _syndrome(half):
    single = [_remainder(1 << bit) for bit in range(LENGTH)]
    total = F.lit(0)
    for check in range(CHECKS):
        mask = sum(1 << bit for bit in range(LENGTH) if single[bit] >> check & 1)
        total = total + F.shiftleft(F.bit_count(half.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1)), check)
    return total.cast("int")


def links(prints: DataFrame, bits: str, most: int = 2) -> DataFrame:
    """Pairs ``x < y`` of different fingerprints that differ in at most ``most`` bits, each once.

    ``prints`` holds each fingerprint once.  A fingerprint goes to its home and to every anchor
    that may be the home of a neighbour: on average some 60 copies for 2 bits, at 2^24
    homes.  Different fingerprints within 2 bits of each other are at most 65, so no
    fingerprint has more than 2,080 partners, however many rows share it.
    """
    table = F.broadcast(_code_table(prints.sparkSession, most))  # fixed size, see _code_table
    halves = prints.select(F.col(bits).alias("y"), _half(bits, _HALVES[0]).alias("_h0"), _half(bits, _HALVES[1]).alias("_h1"))
    halves = halves.withColumns({"_s0": _syndrome(F.col("_h0")), "_s1": _syndrome(F.col("_h1"))})
    first = table.where(F.col("spare") == most).select(F.col("syndrome").alias("_s0"), F.col("steps").alias("_t0"))
    second = table.select(F.col("syndrome").alias("_s1"), F.col("spare").alias("_left"), F.col("steps").alias("_t1"))
    one = halves.join(first, "_s0").withColumn("_e0", F.explode("_t0")).withColumn("_left", most - F.col("_e0.cost"))
    two = one.join(second, ["_s1", "_left"]).withColumn("_e1", F.explode("_t1"))

    def anchor(a, b):
        return F.shiftleft(F.col("_h0").bitwiseXOR(a).cast("long"), LENGTH).bitwiseOR(F.col("_h1").bitwiseXOR(b).cast("long"))

    near = two.select(anchor(F.col("_e0.pattern"), F.col("_e1.pattern")).alias("anchor"), "y")
    homes = table.where(F.col("spare") == 0)
    h0 = homes.select(F.col("syndrome").alias("_s0"), F.col("steps")[0]["pattern"].alias("_p0"))
    h1 = homes.select(F.col("syndrome").alias("_s1"), F.col("steps")[0]["pattern"].alias("_p1"))
    home = halves.join(h0, "_s0").join(h1, "_s1").select(anchor(F.col("_p0"), F.col("_p1")).alias("anchor"), F.col("y").alias("x"))
    met = home.hint("merge").join(near, "anchor").where("x < y")
    return met.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= most).select("x", "y")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 2, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links).

    One line per row of ``docs``.  Equal fingerprints are linked, so they are one node before
    anchors are drawn: a group of equal texts costs one line per task.  Repeated rows stay
    repeated; a null doc_id is no candidate for the smallest, and a component of null ids
    alone has a null component_id.  An empty table gives no rows.  Only doc_id and text of
    ``docs`` are read.
    """
    prints = pin(fingerprints(docs, shingle, seed))
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("_least"))
    component = connected_components(links(nodes, "bits", most), "x", "y")
    linked = component.join(nodes, F.col("node") == F.col("bits"))
    smallest = linked.groupBy("root").agg(F.min("_least").alias("_smallest"))
    of_node = component.join(smallest, "root").select(F.col("node").alias("bits"), "_smallest")
    every = join_groups(nodes, of_node, ["bits"]).select("bits", F.coalesce("_smallest", "_least").alias("component_id"))
    every = pin(every)  # both sides of the last join then come straight from a shuffle, which lets it split a hot fingerprint
    hexadecimal = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return join_groups(prints, every, ["bits"]).select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component; the other columns stay as they are.

    Of several rows with that id (repeated rows, or null ids alone) one stays: a row has a
    running number for this, so the joined rows are told apart whatever they hold.
    """
    columns, row = docs.columns, free_name(docs, "_row")
    marked = pin(docs.withColumn(row, F.monotonically_increasing_id()))
    found = near_duplicates(marked.select(F.col(row).alias("doc_id"), "text"), shingle, most, seed)
    ids = marked.select(F.col(row).alias("_r"), F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("_r")).alias("_rank"))
    rows = found.join(ids, F.col("doc_id") == F.col("_r")).groupBy("component_id").agg(F.min("_rank").alias("_rank"))
    return marked.join(rows.select(F.col("_rank._r").alias(row)), row, "left_semi").select(*columns)
