"""A sparse document-term matrix of a whole table, and the audit of five filters that read it.

Each slice of texts becomes a shard: one row per document, one entry per word of it with its
count, words numbered inside the shard.  Words are dealt over targets by their hash: a shard
sends each target its distinct words there, joined, in one line.  A target sorts and numbers the
distinct words it receives, and the numbers return to the shards, so a token is never shuffled and a
word found in every document costs one entry per shard.  Shards in compressed sparse rows
(CSR) then hold, per document, the global numbers of its words in rising order and their counts.

The audit reads two things off the matrix: the sum of a row is the document's words, the number
of its entries the distinct ones.  The other flags travel with the rows of the shard.  Documents
with equal flags are counted before anything is laid out by order and step.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.words import slices, words_of
from backglance.sources.tables import pin

FILTERS = "ABCDE"
# What fails a document.
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SYMBOLS = b"#$%&*|"

# Bytes of text to a target, which holds the distinct words of every shard that fall to it.
TARGET_BYTES = 8 << 20

_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_BITS = {name: 1 << i for i, name in enumerate(FILTERS)}

# Of each document, beside its row of the matrix; the hash has 128 bits.
_CARRIED = {
    "doc_id": pa.int64(), "part": pa.string(), "capitals": pa.int64(), "code_points": pa.int64(), "has_symbol": pa.bool_(),
    "hash_high": pa.int64(), "hash_low": pa.int64(),
}
_DOCUMENTS = (
    "doc_id array<bigint>, part array<string>, capitals array<bigint>, code_points array<bigint>, has_symbol array<boolean>, "
    "hash_high array<bigint>, hash_low array<bigint>"
)
_LOCAL = f"shard bigint, {_DOCUMENTS}, first array<int>, codes array<int>, counts array<int>, words array<struct<target: int, joined: binary>>"
_CSR = f"shard bigint, {_DOCUMENTS}, first array<int>, terms array<bigint>, counts array<int>"


def _one_list(values, kind: pa.DataType) -> pa.Array:
    flat = values.cast(kind) if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flagged bytes of each text; quick where few are flagged."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def _local_shard(shard: int, part: pa.RecordBatch, targets: int) -> pa.RecordBatch:
    """The matrix of a slice, its words numbered inside it by target, and what is carried of each document."""
    words = words_of(part["text"])
    data, offsets = words.data, words.offsets
    known = words.vocabulary.to_pylist()
    target = (np.array([xxhash.xxh3_64_intdigest(w) for w in known], np.uint64) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    width = max(1, len(known))
    cells, counts = np.unique(words.documents * width + number[words.codes], return_counts=True)
    rows, codes = np.divmod(cells, width)
    raw = data.tobytes()
    hashes = b"".join([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
    pairs = np.frombuffer(hashes, "<i8").reshape(-1, 2)
    carried = [
        part["doc_id"], part["part"], _by_text((data >= 65) & (data <= 90), offsets), np.diff(offsets) - _by_text((data & 0xC0) == 0x80, offsets),
        _by_text(_SYMBOL[data], offsets) > 0, pairs[:, 0], pairs[:, 1],
    ]
    lists = [_one_list(v, kind) for v, kind in zip(carried, _CARRIED.values())]
    first = np.searchsorted(rows, np.arange(part.num_rows + 1))
    lists += [_one_list(v, pa.int32()) for v in (first, codes, counts)]
    found, begins = np.unique(target[order], return_index=True)
    ends = np.append(begins[1:], len(order))
    # A word holds no line break, so that joins them.
    dealt = [known[i] for i in order.tolist()]
    joined = [b"\n".join(dealt[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
    sent = pa.StructArray.from_arrays([pa.array(found, pa.int32()), pa.array(joined, pa.binary())], ["target", "joined"])
    lists.append(pa.ListArray.from_arrays(pa.array([0, len(sent)], pa.int32()), sent))
    names = ["shard", *_CARRIED, "first", "codes", "counts", "words"]
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *lists], names)


def targets_for(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))).first()[0] or 0
    return max(1, math.ceil(size / TARGET_BYTES))


def local_shards(docs: DataFrame, targets: int) -> DataFrame:
    """One row per slice of texts: its matrix with words numbered inside the slice, and its words by target.

    A shard is named by its task and its place in the task's output, so the result has to be
    written (``pin``) before it is read more than once.
    """

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch):
                yield _local_shard(number, part, targets)
                number += 1

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    return rows.mapInArrow(run, _LOCAL)


def _words_by_target(shards: DataFrame) -> DataFrame:
    return shards.select(F.col("shard").alias("of"), F.explode("words").alias("w")).select("of", "w.*").groupBy("target")


def _numbered(table: pa.Table, targets: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of a target in the order of their bytes, the global number of every word sent, and where each line ends.

    Target t numbers its words t, t + targets, t + 2 * targets and so on.
    """
    lines = table["joined"].to_pylist()
    ends = np.cumsum([line.count(b"\n") + 1 for line in lines])
    coded = pa.array(b"\n".join(lines).split(b"\n"), pa.large_binary()).dictionary_encode()
    known = coded.dictionary.to_pylist()
    order = sorted(range(len(known)), key=known.__getitem__)
    number = np.empty(len(known), np.int64)
    number[order] = np.arange(len(known)) * targets + table["target"][0].as_py()
    return [known[i] for i in order], number[coded.indices.to_numpy()], ends


def dictionary(shards: DataFrame, targets: int) -> DataFrame:
    """(word, term): every distinct word of all shards with its global number."""

    def run(table: pa.Table) -> pa.Table:
        words, _, _ = _numbered(table, targets)
        terms = np.arange(len(words)) * targets + table["target"][0].as_py()
        return pa.table({"word": pa.array(words, pa.binary()).cast(pa.string()), "term": terms})

    return _words_by_target(shards).applyInArrow(run, "word string, term bigint")


def _numbers(shards: DataFrame, targets: int) -> DataFrame:
    """(of, target, terms): the global numbers of the words that a shard sent to a target, in the order it sent them."""

    def run(table: pa.Table) -> pa.Table:
        _, numbers, ends = _numbered(table, targets)
        terms = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(numbers))
        return pa.table({"of": table["of"], "target": table["target"], "terms": terms})

    return _words_by_target(shards).applyInArrow(run, "of bigint, target int, terms array<bigint>")


def _to_csr(local: pa.Table, numbers: pa.Table) -> pa.Table:
    """A shard with global numbers in place of its own, each row in rising order."""
    flat = lambda column: column.combine_chunks().flatten().to_numpy()
    terms = flat(numbers.sort_by("target")["terms"])
    first, counts = flat(local["first"]), flat(local["counts"])
    entry = terms[flat(local["codes"])]
    order = np.lexsort((entry, np.repeat(np.arange(len(first) - 1), np.diff(first))))
    lists = [_one_list(entry[order], pa.int64()), _one_list(counts[order], pa.int32())]
    columns = ["shard", *_CARRIED, "first"]
    return pa.table([*[local[c] for c in columns], *lists], [*columns, "terms", "counts"])


def csr_shards(docs: DataFrame) -> DataFrame:
    """The document-term matrix in compressed sparse rows, one line per shard.

    Row i of a shard belongs to ``doc_id[i]`` and has the entries from ``first[i]`` to ``first[i + 1]`` of
    ``terms`` (numbers of the global dictionary) and ``counts``.  Words are ``[^\\x20\\x09-\\x0D]+``, in
    their case; null counts as an empty text.  ``part`` is the language.
    """
    targets = targets_for(docs)
    # A reader holds the lists of a whole row group, so each shard is one of its own.
    shards = pin(local_shards(docs, targets), group_rows=1)
    return shards.drop("words").groupBy("shard").cogroup(_numbers(shards, targets).groupBy("of")).applyInArrow(_to_csr, _CSR)


_ROWS = ", ".join(
    ["doc_id bigint, part string, capitals bigint, code_points bigint, has_symbol boolean, hash_high bigint, hash_low bigint"]
    + ["n_words bigint, n_distinct bigint"]
)


def document_rows(shards: DataFrame) -> DataFrame:
    """One line per document: its row's sum (words) and number of entries (distinct words), and what was carried."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                first = one["first"].flatten().to_numpy()
                counts = one["counts"].flatten().to_numpy()
                total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                sums = [total[first[1:]] - total[first[:-1]], np.diff(first).astype(np.int64)]
                columns = [*[one[c].flatten() for c in _CARRIED], *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, [*_CARRIED, "n_words", "n_distinct"])

    return shards.select(*_CARRIED, "first", "counts").mapInArrow(run, _ROWS)


def failed_filters(docs: DataFrame) -> DataFrame:
    """doc_id, part and ``failed`` of every row: the sum of 1, 2, 4, 8 and 16 for the filters A to E that it fails."""
    rows = pin(document_rows(csr_shards(docs)))  # narrow; read for the earliest of equal texts and for the flags
    text = ["hash_high", "hash_low"]
    earliest = rows.groupBy(*text).agg(F.min("doc_id").alias("_earliest"), F.max("doc_id").alias("_latest"))
    # Written, so that both sides of the join come straight from a shuffle, which lets it split a hot text.
    earliest = pin(earliest.where("_earliest < _latest").drop("_latest"))
    joined = rows.join(earliest, text, "left")
    fails = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n_words"),
        "C": 100 * F.col("capitals") > MOST_CAPITALS_PERCENT * F.col("code_points"),
        "D": F.col("has_symbol"),
        "E": F.coalesce(F.col("_earliest") < F.col("doc_id"), F.lit(False)),
    }
    failed = sum((F.when(condition, _BITS[name]).otherwise(0) for name, condition in fails.items()), F.lit(0))
    return joined.select("doc_id", "part", failed.alias("failed"))


def _steps():
    """All orders of the filters, step by step: the filter's bit and the bits of those before it; one constant."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            found.append({"filter_order": "".join(order), "step": step, "bit": _BITS[name], "before": before})
            before |= _BITS[name]
    return F.from_json(F.lit(json.dumps(found)), "array<struct<filter_order: string, step: int, bit: int, before: int>>")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per language, order of the five filters and step, with what the step does to its documents.

    A document counts in ``kept`` if it passes this step's filter and all before it, in ``removed`` if
    this filter is the first of the order that it fails, in ``redundant`` if it fails this one and one
    before, in ``unique_fails`` if it fails this one alone; ``good_lost`` and ``toxic_lost`` are the removed ones
    with label 1; ``shapley`` sums the filter's removals over all 120 orders: 120 / k for a document
    that fails k filters, whichever they are.

    Null texts count as empty; a null language is the empty string.  Repeated rows count as often as
    they occur; rows of one id are no copies of each other, and a row without an id is neither a copy nor
    an original.  Of several labels for an id any 1 counts.  An empty table gives no rows; only
    doc_id, lang and text are read.  A text of any length is one row of its shard.
    """
    marked = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    marked = pin(marked.agg(one("quality"), one("toxic")))  # written for the same reason as the earliest texts
    rows = failed_filters(docs).join(marked, "doc_id", "left")
    alike = rows.groupBy("part", "failed", "quality", "toxic").agg(F.count(F.lit(1)).alias("n"))
    laid = alike.withColumn("s", F.explode(_steps())).select("part", "failed", "quality", "toxic", "n", "s.*")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("failed").bitwiseAND(F.col("before")) != 0
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")
    orders = F.expr("n * (120 div bit_count(failed))")
    return laid.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier & F.col("quality")).alias("good_lost"),
        total(fails & ~earlier & F.col("toxic")).alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, orders)), F.lit(0)).cast("long").alias("shapley"),
    )
