"""A quality classifier by similarity-weighted votes of labelled neighbours in a latent space.

A document's terms are the shapes of its words, pairs of letters, words that repeat the word
one or two before, and its length in powers of two, hashed to a fixed number of columns.
Logarithmic counts of a bounded labelled sample give the latent directions (the leading
singular vectors).  The sample's latent vectors are broadcast; every document's cosine to all
of them is computed block by block, and its nearest ones vote with their similarity.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.words import slices, words_of

SHAPES, PAIRS = 512, 512
_PREVIOUS, _SECOND, _LENGTH = SHAPES + PAIRS, SHAPES + PAIRS + 1, SHAPES + PAIRS + 2
COLUMNS = _LENGTH + 64

# Labelled documents that a model is fitted on; more are left out by the hash of their id.
MAX_LABELLED = 4000
DIRECTIONS = 48
NEIGHBOURS = 25
# Cosines this close are equal: single precision rounds by less.
TIE = 1e-6
THRESHOLD = 0.3

_RUNS = [(regex.compile(rb"[a-z\x80-\xff]+"), b"a"), (regex.compile(rb"[A-Z]+"), b"A"), (regex.compile(rb"[0-9]+"), b"0")]


def _shape(word: bytes) -> int:
    for pattern, letter in _RUNS:
        word = pattern.sub(letter, word)
    return zlib.crc32(word) % SHAPES


def term_counts(texts: pa.Array) -> np.ndarray:
    """Logarithmic term counts, scaled to length 1: one line per text, COLUMNS wide."""
    words = words_of(texts)
    n = len(words.first) - 1
    counts = np.zeros((n, COLUMNS), np.float32)
    lengths = np.diff(words.first)
    counts[np.arange(n), _LENGTH + np.ceil(np.log2(lengths + 1)).astype(int)] = 1
    if len(words.codes):
        owner = words.documents
        shapes = np.fromiter(map(_shape, words.vocabulary.to_pylist()), np.int64, len(words.vocabulary))
        counts[:, :SHAPES] = np.bincount(owner * SHAPES + shapes[words.codes], minlength=n * SHAPES).reshape(n, SHAPES)
        for back, column in ((1, _PREVIOUS), (2, _SECOND)):
            same = (words.codes[back:] == words.codes[:-back]) & (owner[back:] == owner[:-back])
            counts[:, column] = np.bincount(owner[back:][same], minlength=n)
        data = words.data
        pair = (data[:-1].astype(np.int64) * 256 + data[1:]) * 0x9E3779B1 >> 15 & (PAIRS - 1)
        owner = np.repeat(np.arange(n), np.diff(words.offsets))
        inside = owner[1:] == owner[:-1]  # the last byte of a text and the first of the next are no pair
        counts[:, SHAPES : SHAPES + PAIRS] = np.bincount(owner[:-1][inside] * PAIRS + pair[inside], minlength=n * PAIRS).reshape(n, PAIRS)
    counts = np.log1p(counts)
    return counts / np.linalg.norm(counts, axis=1, keepdims=True)  # never 0: the length has a term


@dataclass
class Neighbours:
    """Mean and latent directions of the sample, its latent vectors scaled to length 1, and their labels."""

    mean: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        found = (counts - self.mean) @ self.directions
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray, nearest: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, each weighted by its cosine; all that tie with the last one vote."""
        found = np.full(len(counts), float(self.labels.mean()) if len(self.labels) else 0.5)
        nearest = min(nearest, len(self.labels))
        if not nearest:
            return found
        latent = self.latent(counts)
        for i in range(0, len(latent), 512):
            cosines = latent[i : i + 512] @ self.vectors.T
            last = np.partition(cosines, -nearest, axis=1)[:, -nearest, None]
            row, best = np.nonzero(cosines >= last - TIE)
            weights = np.maximum(cosines[row, best].astype(float), 1e-6) ** 2
            size = len(cosines)
            found[i : i + 512] = np.bincount(row, weights * self.labels[best], size) / np.bincount(row, weights, size)
        return np.clip(found, 0, 1)


def fit_neighbours(counts: np.ndarray, labels: np.ndarray, directions: int = DIRECTIONS) -> Neighbours:
    mean = counts.mean(0) if len(counts) else np.zeros(COLUMNS, np.float32)
    centred = (counts - mean).astype(np.float32)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    model = Neighbours(mean, vectors[:, ::-1][:, :directions].astype(np.float32), np.zeros((0, directions), np.float32), labels.astype(float))
    model.vectors = model.latent(counts).astype(np.float32)
    return model


def held_out(key: str = "doc_id"):
    """Whether crc32 of the id as text leaves 0 by 5; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text and label of at most ``most`` labelled documents that are not held out.

    Ids are drawn by hash before their texts are read, so the join sees a bounded side.  Of
    several labels for an id the smallest counts, of several texts the one with the smallest
    hash, so an id on very many rows is one line; null ids and labels are left out.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    one = usable.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(label).alias("_label"))
    drawn = one.orderBy(F.xxhash64("_id", F.lit(17)), "_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    found = texts.join(F.broadcast(drawn), "_id")
    # Partly aggregated in the map tasks: a repeated id sends one text from each of them.
    one_text = found.groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("text").alias("_hash"), "text")).alias("_least"))
    return one_text.select(F.col("_id").alias("doc_id"), F.col("_least.text").alias("text"), F.col("_label").alias("label"))


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_LABELLED) -> Neighbours:
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                counts = term_counts(part["text"]).ravel()
                lists = pa.FixedSizeListArray.from_arrays(pa.array(counts, pa.float32()), COLUMNS).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["label"].cast(pa.int32()), lists], ["doc_id", "label", "counts"])

    rows = labelled_sample(docs, labels, label, most).mapInArrow(run, "doc_id long, label int, counts array<float>")
    table = rows.toArrow().sort_by("doc_id")  # at most ``most`` lines of COLUMNS numbers each: one for each drawn id
    counts = table["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, COLUMNS)
    return fit_neighbours(counts, table["label"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on) of every row.

    Labels, languages, sources and ids never enter a score.  Null and empty texts have the term
    of length 0 alone and are scored like others; repeated rows get equal scores; without any
    label the score is 0.5; labelled vectors as near as the last neighbour all vote; a text of any
    length counts whole; an empty table gives no rows; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_quality(docs, labels, most=most))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                scores = model.value.scores(term_counts(part["text"]))
                columns = [part["doc_id"], part["held_out"], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
