"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

A sketch of a measure is a table of buckets with counts: whole numbers up to 127 have a bucket
each, larger ones share a bucket when their seven leading bits agree, so a quantile is off by
at most 1 part in 64.  Sketches merge by adding counts, are partly summed in the map tasks,
and hold a few hundred buckets whatever the input, so a hot source costs no more than another.
They also merge upward, from sources to languages to all documents: a group's quantiles are
weighted with those of the wider group, by their documents, so a group of few documents is not
judged by its own few values.

A cutoff lies above the upper quantile of the group by a multiple of its distance from the lower
one: what many documents of a source do is usual there.  Symbols are usual if a quarter of the
documents have them; repeated lines and words, which good texts have now and then, if one in a
hundred has as many.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backglance.llm.words import slices, words_of
from backglance.operators.joins import join_groups
from backglance.sources.tables import pin

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5

# Sketched measures: whole numbers, as shares in thousandths.
MEASURES = {
    "symbol_share": "1000 * n_symbols DIV greatest(word_chars, 1)",
    "line_share": "1000 * n_dup_lines DIV greatest(n_lines, 1)",
    "repeat_share": "1000 * n_repeat_words DIV greatest(n_words, 1)",
    "word_length": "100 * word_chars DIV greatest(n_words, 1)",
}
# Levels of the lower and upper quantile, in thousandths.
LEVELS = {"symbol_share": (500, 750), "line_share": (500, 990), "repeat_share": (500, 990), "word_length": (250, 750)}
# A document fails if a measure lies above its group's upper quantile by more than so many times
# the distance of the quantiles, and by more than the least distance a cutoff has.
REACH = {"symbol_share": 3, "line_share": 3, "repeat_share": 3, "word_length": 5}
LEAST_REACH = {"symbol_share": 10, "line_share": 100, "repeat_share": 50, "word_length": 50}
# The quantiles of the wider group count like those of so many documents of the group itself.
PARENT_DOCUMENTS = 100
# Leading bits that values of a bucket share.
BITS = 7
# A word length that far below the lower quantile fails too.
BOTH_SIDES = {"word_length"}


def _repeated(words, window: int) -> np.ndarray:
    """For each word whether a window over it stands twice or more in its text."""
    n = len(words.codes)
    covered = np.zeros(n + 1, np.int64)
    each = np.maximum(np.diff(words.first) - window + 1, 0)
    if not each.sum():
        return np.zeros(n, bool)
    text = np.repeat(np.arange(len(each)), each)
    start = np.repeat(words.first[:-1], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    # Rank ever longer windows by the ranks of their two parts: equal ranks mean equal words.
    rank, size = words.codes, 1
    ranks = {1: rank}
    while size * 2 <= window:
        pair = rank[: n - 2 * size + 1] * (int(rank.max()) + 1) + rank[size : n - size + 1]
        rank = np.unique(pair, return_inverse=True)[1]
        size *= 2
        ranks[size] = rank
    key, at = None, 0
    for size in sorted(ranks, reverse=True):
        if window & size:
            part = ranks[size][start + at]
            key = part if key is None else np.unique(key * (int(part.max()) + 1) + part, return_inverse=True)[1]
            at += size
    key = key * len(each) + text
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = start[order[twice]]
    np.add.at(covered, found, 1)
    np.add.at(covered, found + window, -1)
    return np.cumsum(covered)[:-1] > 0


def _sum_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _measures(texts: pa.Array) -> list[np.ndarray]:
    words = words_of(texts)
    data, offsets = words.data, words.offsets
    inside = np.zeros(len(data) + 1, np.int64)
    inside[words.starts] += 1
    np.subtract.at(inside, words.ends, 1)
    in_word = np.cumsum(inside)[:-1] > 0
    code_points = _sum_by(offsets, in_word & ((data & 0xC0) != 0x80))
    symbols = _sum_by(offsets, np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))
    # Lines with a word, told apart by all their bytes.
    cut = np.concatenate([data == 0x0A, [True]])
    cut[offsets] = True
    breaks = np.flatnonzero(cut)
    first_byte = breaks[:-1] + ((data[breaks[:-1]] == 0x0A) if len(data) else 0)
    # A text that starts with a line break has its first line before that break; it is empty.
    raw = data.tobytes()
    duplicates = np.zeros(len(offsets) - 1, np.int64)
    lines = np.zeros(len(offsets) - 1, np.int64)
    has_word = np.searchsorted(words.starts, breaks[1:]) > np.searchsorted(words.starts, first_byte)
    owner = np.searchsorted(offsets, breaks[:-1], "right") - 1
    seen: set[bytes] = set()
    current = -1
    for line, end, text in zip(first_byte[has_word].tolist(), breaks[1:][has_word].tolist(), owner[has_word].tolist()):
        if text != current:
            seen, current = set(), text
        content = raw[line:end]
        lines[text] += 1
        if content in seen:
            duplicates[text] += 1
        else:
            seen.add(content)
    repeats = _sum_by(words.first, _repeated(words, REPEAT_WINDOW))
    return [np.diff(words.first), code_points, symbols, duplicates, repeats, lines]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row: words, code points in words, symbols, lines
    with a word that equal an earlier line, words in repeated windows, and lines with a word."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                counts = [pa.array(c, pa.int64()) for c in _measures(part["text"])]
                keys = [part["doc_id"].cast(pa.int64()), part["lang"].cast(pa.string()), part["source"].cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*keys, *counts], ["doc_id", "lang", "source", *COUNTS])

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "lang", "source", "text").mapInArrow(run, schema)


def bucket_of(value: Column) -> Column:
    """The sketch bucket of a whole number from 0 on, named by its least value."""
    drop = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    power = F.expr("1L").cast("long") * F.pow(F.lit(2), drop).cast("long")
    return (F.floor(value / power) * power).cast("long")


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by``, measure, bucket, n: one line per bucket that occurs."""
    pairs = [F.struct(F.lit(name).alias("measure"), bucket_of(F.expr(f)).alias("bucket")) for name, f in MEASURES.items()]
    lines = rows.select(*by, F.explode(F.array(*pairs)).alias("_m")).select(*by, "_m.measure", "_m.bucket")
    return lines.groupBy(*by, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _of_measure(values: dict[str, object]) -> Column:
    return F.coalesce(*[F.when(F.col("measure") == m, F.lit(v)) for m, v in values.items()])


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``by``, measure, low, high and docs (their number) from sketches; a window here sees the few hundred buckets of one sketch."""
    whole = Window.partitionBy(*by, "measure")
    total, until = F.sum("n").over(whole), F.sum("n").over(whole.orderBy("bucket"))
    placed = sketch.withColumns({"_all": total, "_until": until})
    level = lambda i: _of_measure({m: levels[i] for m, levels in LEVELS.items()})
    at = lambda i: F.min(F.when(1000 * F.col("_until") >= level(i) * F.col("_all"), F.col("bucket")))
    return placed.groupBy(*by, "measure").agg(at(0).alias("low"), at(1).alias("high"), F.max("_all").alias("docs"))


def weighted_quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``by``, measure, low, high: those of each group weighted with those of the group by one column less.

    A group of n documents weighs n to PARENT_DOCUMENTS, at every size; the wider group's
    quantiles are themselves weighted so, up to all documents, which have no wider group.
    """
    found = None
    for depth in range(len(by) + 1):
        keys = by[:depth]
        own = quantiles(sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n")), keys)
        if found is not None:
            wider = found.withColumnsRenamed({"low": "_low", "high": "_high"})
            own = join_groups(own, wider, [*by[: depth - 1], "measure"])
            both = lambda q: (F.col("docs") * F.col(q) + PARENT_DOCUMENTS * F.col(f"_{q}")) / (F.col("docs") + PARENT_DOCUMENTS)
            own = own.withColumns({q: both(q) for q in ("low", "high")})
        found = own.select(*keys, "measure", "low", "high")
    return found


def thresholds(rows: DataFrame, by: list[str]) -> DataFrame:
    """One line per group with ``<measure>_most`` and, where it counts, ``<measure>_least``."""
    found = weighted_quantiles(pin(sketches(rows, by)), by)
    reach = F.greatest(_of_measure(REACH) * (F.col("high") - F.col("low")), _of_measure(LEAST_REACH))
    bounds = found.select(*by, "measure", (F.col("high") + reach).alias("most"), (F.col("low") - reach).alias("least"))
    one = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}")
    return bounds.groupBy(*by).agg(*[one(m, "most") for m in MEASURES], *[one(m, "least") for m in sorted(BOTH_SIDES)])


def judge_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated windows.  Thresholds
    come from the documents that pass the base, per language and source (null is a value of
    its own), and join back to them; quantiles of a group are weighted with those of its
    language and of all documents.  Null and empty texts have no words and fail the base; repeated rows
    count as often as they occur; a text of any length counts whole; a value equal to a cutoff passes;
    an empty table gives no rows; other columns are not read.
    """
    by = ["lang", "source"]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = pin(measure(docs).withColumn("base_failed", failed))  # narrow; read for the sketches and the verdict
    bounds = thresholds(rows.where(~F.col("base_failed")), by)
    values = {m: F.expr(f) for m, f in MEASURES.items()}
    passes = F.lit(True)
    for m, value in values.items():
        passes = passes & (value <= F.col(f"{m}_most"))
        if m in BOTH_SIDES:
            passes = passes & (value >= F.col(f"{m}_least"))
    joined = join_groups(rows, bounds, by)
    kept = ~F.col("base_failed") & F.coalesce(passes, F.lit(True))
    return joined.select("doc_id", *COUNTS[:5], "base_failed", kept.alias("kept"))
