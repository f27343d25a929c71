"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after another.  The classifier of a category is a logistic
regression with an L1 penalty on which words and word beginnings a text has, and, without
penalty, on the probabilities of the categories before it.  For training those
probabilities are out-of-fold: each row gets them from a classifier that has not seen it,
as it will be with new documents.

The labels know only ``toxic``, the last link.  The links before it, kinds of abuse, are
learned from toxic rows of the sample that hold a seed word of the kind; they guide the last
link and are reported, and a document is judged by the last link alone.

The labelled sample is bounded, so it is fitted on the driver; scoring is one pass over the
documents with the few weights that the penalty leaves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.decontam import plain
from backglance.llm.knn import held_out, labelled_sample
from backglance.llm.words import slices, words_of

# Seed words of the kinds of abuse that come before the label.
INSULT = ("clown", "idiot", "loser", "moron", "scum", "trash")
CONTEMPT = ("disgusting", "pathetic", "stupid", "worthless")
SEEDS = {"insult": INSULT, "contempt": CONTEMPT}
LABEL = "toxic"

# Labelled documents that the chain is fitted on; more are left out by the hash of their id.
MAX_LABELLED = 8_000
WIDTH = 1 << 20
FOLDS = 3
PENALTY = 0.0002
ITERATIONS = 150
THRESHOLD = 0.2
# Letters of a word beginning.
BEGINNING = 4
# A term is fitted if it is in so many rows and its share of the category is so many
# standard deviations from the overall share.
LEAST_ROWS, LEAST_DEVIATION = 5, 4.0


def _hashed(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode(), 7) % WIDTH


def term_ids(word: bytes) -> tuple[int, int]:
    """Columns of a word and of its beginning."""
    text = plain(word).decode("utf-8", "replace").lower()
    return _hashed(text), _hashed("^" + text[:BEGINNING])


def present_terms(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of all terms that texts have, each once; only ``wanted`` columns (a mask) if given."""
    words = words_of(texts)
    pairs = np.array([term_ids(w) for w in words.vocabulary.to_pylist()], np.int64).reshape(-1, 2)
    owner, found = words.documents, []
    for side in (0, 1):
        ids = pairs[words.codes, side]
        keep = slice(None) if wanted is None else wanted[ids]
        found.append(np.unique(owner[keep] * WIDTH + ids[keep]))
    cells = np.unique(np.concatenate(found))
    return cells // WIDTH, cells % WIDTH


@dataclass
class Rows:
    """A 0/1 table: the columns of row i are ``ids[first[i]:first[i + 1]]``."""

    first: np.ndarray
    ids: np.ndarray

    def take(self, mask: np.ndarray) -> Rows:
        lengths = np.diff(self.first)
        return Rows(np.concatenate([[0], np.cumsum(lengths[mask])]), self.ids[np.repeat(mask, lengths)])

    def times(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.ids])])
        return total[self.first[1:]] - total[self.first[:-1]]


@dataclass
class Link:
    """Weights by column, of the probabilities before, and the intercept."""

    category: str
    weights: dict[int, float]
    before: np.ndarray
    intercept: float

    def probability(self, sums: np.ndarray, before: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums + before @ self.before + self.intercept, -30, 30)))


def _fit(rows: Rows, label: np.ndarray, before: np.ndarray, category: str) -> Link:
    """L1 logistic regression by accelerated proximal gradient steps; one class alone gives its share."""
    n = len(label)
    share = float(label.mean()) if n else 0.0
    if not 0 < share < 1:
        return Link(category, {}, np.zeros(before.shape[1]), 30.0 if share else -30.0)
    lengths = np.diff(rows.first)
    counts = np.bincount(rows.ids, minlength=WIDTH)
    ones = np.bincount(rows.ids, np.repeat(label, lengths), minlength=WIDTH)
    deviation = np.abs(ones - share * counts) / np.sqrt(np.maximum(counts, 1) * share * (1 - share))
    chosen = np.flatnonzero((counts >= LEAST_ROWS) & (deviation >= LEAST_DEVIATION))
    place = np.full(WIDTH, -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[rows.ids] >= 0
    owner = np.repeat(np.arange(n), lengths)[keep]
    small = Rows(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]), place[rows.ids[keep]])
    dense = np.hstack([before, np.ones((n, 1))])
    width = len(chosen)
    # The largest curvature, by power steps, sets the step length.
    v = np.ones(width + dense.shape[1])
    curvature = 1.0
    for _ in range(12):
        z = small.times(v[:width]) + dense @ v[width:]
        v = np.concatenate([np.bincount(small.ids, z[owner], minlength=width), dense.T @ z])
        curvature = np.linalg.norm(v)
        v /= curvature
    step = 4 * n / (1.1 * curvature)
    w = np.zeros(width + dense.shape[1])
    w[-1] = np.log(share / (1 - share))
    ahead, momentum = w.copy(), 1.0
    for _ in range(ITERATIONS):
        z = small.times(ahead[:width]) + dense @ ahead[width:]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / n
        moved = ahead - step * np.concatenate([np.bincount(small.ids, error[owner], minlength=width), dense.T @ error])
        moved[:width] = np.sign(moved[:width]) * np.maximum(np.abs(moved[:width]) - step * PENALTY, 0)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / after * (moved - w)
        w, momentum = moved, after
    left = np.flatnonzero(w[:width])
    return Link(category, dict(zip(chosen[left].tolist(), w[left].tolist())), w[width:-1], float(w[-1]))


def _sums(link: Link, rows: Rows) -> np.ndarray:
    weights = np.zeros(WIDTH)
    weights[list(link.weights)] = list(link.weights.values())
    return rows.times(weights)


@dataclass
class Chain:
    links: list[Link]

    def predict(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of the categories: one line per text, one column per link."""
        used = sorted({column for link in self.links for column in link.weights})
        wanted = np.zeros(WIDTH, bool)
        wanted[used] = True
        row, column = present_terms(texts, wanted)
        place = np.searchsorted(used, column)
        found = np.zeros((len(texts), 0))
        for link in self.links:
            weights = np.array([link.weights.get(c, 0.0) for c in used])
            sums = np.bincount(row, weights[place], minlength=len(texts)) if used else np.zeros(len(texts))
            found = np.hstack([found, link.probability(sums, found)[:, None]])
        return found


def fit_chain(rows: Rows, labels: Mapping[str, np.ndarray], folds: np.ndarray) -> Chain:
    """Fit the categories in the order of ``labels`` (0.0 or 1.0 by row); ``folds`` numbers the fold of each row."""
    links: list[Link] = []
    before = np.zeros((len(rows.first) - 1, 0))
    for category, label in labels.items():
        links.append(_fit(rows, label, before, category))
        if len(links) == len(labels):
            break
        unseen = np.zeros(len(label))
        for fold in np.unique(folds):
            out = folds == fold
            apart = _fit(rows.take(~out), label[~out], before[~out], category)
            unseen[out] = apart.probability(_sums(apart, rows.take(out)), before[out])
        before = np.hstack([before, unseen[:, None]])
    return Chain(links)


def train_toxicity(docs: DataFrame, labels: DataFrame, seeds: Mapping[str, Sequence[str]] = SEEDS, most: int = MAX_LABELLED) -> Chain:
    """The chain from a bounded sample of labelled documents; ids with crc32 0 by 5 are held out."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                row, column = present_terms(part["text"])
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(column, pa.int32()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["label"].cast(pa.int32()), lists], ["doc_id", "label", "ids"])

    sample = labelled_sample(docs, labels, LABEL, most).mapInArrow(run, "doc_id long, label int, ids array<int>")
    table = sample.toArrow().sort_by("doc_id")  # at most ``most`` lines: one for each drawn id
    lists = table["ids"].combine_chunks()
    lengths = np.array([len(x) for x in lists], np.int64)
    rows = Rows(np.concatenate([[0], np.cumsum(lengths)]), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    toxic = (table["label"].to_numpy() > 0).astype(float)
    targets = {}
    for name, words in seeds.items():
        seeded = np.zeros(WIDTH)
        seeded[[term_ids(word.encode())[0] for word in words]] = 1
        targets[name] = toxic * (rows.times(seeded) > 0)
    targets[LABEL] = toxic
    folds = np.array([xxhash.xxh64_intdigest(str(k), 5) % FOLDS for k in table["doc_id"].to_pylist()], np.int64)
    return fit_chain(rows, targets, folds)


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, p_<kind> of each kind, score (of the label) and predicted (1: toxic) of every row.

    The whole text counts; labels, languages, sources and ids never enter a score.  Null and
    empty texts have no term and get the score of the intercept; repeated rows get equal
    scores; without labels the score is near 0; a text longer than a slice is a slice of its own;
    an empty table gives no rows; other columns are not read.
    """
    chain = docs.sparkSession.sparkContext.broadcast(train_toxicity(docs, labels, most=most))
    names = [f"p_{name}" for name in SEEDS] + ["score"]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = chain.value.predict(part["text"])
                columns = [pa.array(found[:, k]) for k in range(len(names))]
                predicted = pa.array((found[:, -1] >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], *columns, predicted], ["doc_id", "held_out", *names, "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, " + ", ".join(f"{n} double" for n in names) + ", predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score lies under the threshold, unchanged; see ``score_toxicity``."""
    chain = docs.sparkSession.sparkContext.broadcast(train_toxicity(docs, labels, most=most))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(chain.value.predict(part["text"])[:, -1] < threshold))

    return docs.mapInArrow(run, docs.schema)
