"""Benchmark passages in training texts, found with a BM25 index of the test items.

Items are indexed in segments; every passage of every text is a query.  A posting's impact
is its BM25 weight as a share of what its segment scores against itself, so a passage that
holds all words of a segment scores 1 and one threshold suits all.  Retrieval is block-max
WAND: segments stand in blocks, each list keeps its largest impact in every block, and a
block whose bounds sum to less than the threshold is skipped.  For all passages of a batch at
once this is done with the bounds of the rarer words, plus, for the most common words, the
largest sum of impacts they have in any segment of the block.  Passages with a block left are
searched one by one with a pivot over postings in segment order.  A retrieved segment is verified
by the words of its question and of its answer that stand in order in the text around the passage,
so an excerpt of a long item is judged by what it holds of the item.

Document frequencies and lengths are counted once over all segments of the benchmark, in Spark, and
are the same for every index, however many the items make.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.words import Words, slices, words_of
from backglance.sources.tables import pin

K1, B = 1.2, 0.75
# Words of a passage, and from one passage to the next.
PASSAGE, STEP = 64, 32
# Words of an indexed segment: five sixths of one, wherever it lies, are in some passage.
SEGMENT = 48
# Share of a segment's own score that retrieves it, and of question and answer that confirm it.
SCORE, OVERLAP = 0.5, 0.7
# Segments to a block.
BLOCK = 4
# Windows times blocks whose bounds are summed at a time.
_CELLS = 4_000_000
# Items and bytes of items that one broadcast index holds; more items make more indexes.
MAX_ITEMS, MAX_BYTES = 20_000, 16 << 20

_MARKS = bytes(b for b in range(128) if not chr(b).isalnum())
_SENTENCE_END = (b".", b"!", b"?")


def plain(word: bytes) -> bytes:
    """The word with A-Z lowered and without ASCII punctuation at its ends, unless that is all of it."""
    lowered = word.lower()
    return lowered.strip(_MARKS) or lowered


def split_item(words: list[bytes]) -> int:
    """Where the answer starts: at the last sentence, or the last quarter of an item of one sentence."""
    for i in range(len(words) - 1, 0, -1):
        if words[i - 1].endswith(_SENTENCE_END):
            return i
    return len(words) - max(1, len(words) // 4)


class Wanted:
    """Words of a question or answer, to be found in order."""

    def __init__(self, words: list[bytes]):
        self.length = len(words)
        self.places: dict[bytes, int] = {}
        for i, word in enumerate(words):
            self.places[word] = self.places.get(word, 0) | 1 << i

    def in_order(self, there: list[bytes]) -> int:
        """How many stand in ``there`` in their order: the longest common subsequence, a bit for each word."""
        everything = rest = (1 << self.length) - 1
        for word in there:
            places = self.places.get(word)
            if places:
                met = rest & places
                rest = (rest + met | rest - met) & everything
        return self.length - rest.bit_count()

    def enough(self, found: int, overlap: float) -> bool:
        """The share ``overlap``; of two or three words one may lack, a single word may not."""
        least = math.ceil(overlap * self.length - 1e-9)
        return found >= (min(least, self.length - 1) if self.length > 1 else least)


@dataclass
class Index:
    keys: list[int] = field(default_factory=list)  # of items
    item_of: list[int] = field(default_factory=list)  # item of each segment
    wanted: list[tuple[Wanted, Wanted]] = field(default_factory=list)  # question and answer of each segment
    terms: dict[bytes, int] = field(default_factory=dict)
    postings: list[list[int]] = field(default_factory=list)  # segments by term, ascending
    impacts: list[list[float]] = field(default_factory=list)
    block_bounds: list[dict[int, float]] = field(default_factory=list)  # by term, its blocks
    bounds: list[float] = field(default_factory=list)  # by term
    # The same for the rarer words as arrays: blocks of term t at first[t] to first[t + 1].
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    blocks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    block_most: np.ndarray = field(default_factory=lambda: np.zeros(0))
    common: np.ndarray = field(default_factory=lambda: np.zeros(0))  # by block, what common words add at most


def build_index(rows: list[tuple[int, str]], frequency: dict[bytes, int], segments: int, mean_length: float, least: float = SCORE) -> Index:
    """Index of ``rows`` (key, text) under the statistics of all segments of the benchmark."""
    index = Index()
    lists: dict[int, list[tuple[int, float]]] = {}
    for key, text in rows:
        raw = text.encode().split()
        if not raw:
            continue
        words = [plain(w) for w in raw]
        at = split_item(raw)
        index.keys.append(key)
        for start in segment_starts(len(words)):
            part = words[start : start + SEGMENT]
            number = len(index.item_of)
            index.item_of.append(len(index.keys) - 1)
            middle = max(0, at - start)
            index.wanted.append((Wanted(part[:middle]), Wanted(part[middle:])))
            weights: dict[bytes, float] = {}
            for word, times in Counter(part).items():
                seen = frequency[word]
                idf = math.log(1 + (segments - seen + 0.5) / (seen + 0.5))
                weights[word] = idf * times * (K1 + 1) / (times + K1 * (1 - B + B * len(part) / mean_length))
            own = math.fsum(weights.values())
            for word, weight in weights.items():
                lists.setdefault(index.terms.setdefault(word, len(index.terms)), []).append((number, weight / own))
    for term in range(len(index.terms)):
        index.postings.append([s for s, _ in lists[term]])
        index.impacts.append([w for _, w in lists[term]])
        bounds: dict[int, float] = {}
        for number, weight in lists[term]:
            bounds[number // BLOCK] = max(bounds.get(number // BLOCK, 0.0), weight)
        index.block_bounds.append(bounds)
        index.bounds.append(max(bounds.values()))
    _split_common(index, least)
    return index


def _split_common(index: Index, least: float) -> None:
    """Set aside the commonest words, as long as they give no segment over half the threshold."""
    given = np.zeros(len(index.item_of))
    common = set()
    for term in sorted(range(len(index.postings)), key=lambda t: -len(index.postings[t])):
        sums = given[index.postings[term]] + index.impacts[term]
        if sums.max() <= least / 2:
            given[index.postings[term]] = sums
            common.add(term)
        elif len(index.postings[term]) <= BLOCK:
            break
    rest = [{} if t in common else bounds for t, bounds in enumerate(index.block_bounds)]
    index.first = np.concatenate([[0], np.cumsum([len(b) for b in rest], dtype=np.int64), [0]])
    index.first[-1] = index.first[-2]  # a last term for other words, without blocks
    index.blocks = np.array([block for bounds in rest for block in bounds], np.int64)
    index.block_most = np.array([most for bounds in rest for most in bounds.values()])
    blocks = -(-len(given) // BLOCK)
    index.common = np.pad(given, (0, blocks * BLOCK - len(given))).reshape(blocks, BLOCK).max(1) if blocks else given


def segment_starts(length: int) -> list[int]:
    """Starts of segments that cover all words; the last one ends with the item."""
    if length <= SEGMENT:
        return [0]
    return [*range(0, length - SEGMENT, SEGMENT), length - SEGMENT]


def search(index: Index, terms: list[int], least: float) -> list[tuple[int, float]]:
    """All segments that score ``least`` or more for the distinct terms, by block-max WAND."""
    slack = least - 1e-9  # sums of bounds may round below the score they bound
    found = []
    cursors = [[index.postings[t][0], 0, t] for t in terms]  # segment, place in the list, term
    while cursors:
        cursors.sort()
        total, pivot = 0.0, None
        for n, (_, _, term) in enumerate(cursors):
            total += index.bounds[term]
            if total >= slack:
                pivot = n
                break
        if pivot is None:
            return found
        segment = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
            pivot += 1
        # Bounds of the pivot's block, and the first segment beyond it.
        block = segment // BLOCK
        bound = sum(index.block_bounds[term].get(block, 0.0) for _, _, term in cursors[: pivot + 1])
        beyond = (block + 1) * BLOCK
        if pivot + 1 < len(cursors):
            beyond = min(beyond, cursors[pivot + 1][0])
        if bound >= slack:
            if cursors[0][0] == segment:
                # Exact to rounding in any order of the terms.
                score = math.fsum(index.impacts[term][place] for at, place, term in cursors if at == segment)
                if score >= slack:
                    found.append((segment, score))
                goal = segment + 1
            else:
                goal = segment
        else:
            goal = beyond if beyond > segment else segment + 1
        rest = []
        for at, place, term in cursors:
            if at < goal and at <= segment:
                postings = index.postings[term]
                while place < len(postings) and postings[place] < goal:
                    place += 1
                if place == len(postings):
                    continue
                at = postings[place]
            rest.append([at, place, term])
        cursors = rest
    return found


def _with_block(index: Index, terms: np.ndarray, words: Words, base: np.ndarray, each: np.ndarray, least: float) -> np.ndarray:
    """Passages that have a block whose bounds reach the threshold.

    A word that a passage repeats adds to the sum each time, so sums are bounds all the more.
    """
    blocks = len(index.common)
    at = np.flatnonzero(index.first[terms + 1] > index.first[terms])
    owner = words.documents[at]
    place = (at - words.first[owner]) // STEP
    inside = [np.minimum(place - back, each[owner] - 1) for back in range(-(-PASSAGE // STEP))]
    passages = np.concatenate([base[owner] + p for p in inside])
    valid = np.concatenate([(p >= 0) & ((p == place - back) | (back == 0)) for back, p in enumerate(inside)])
    passages, hits = passages[valid], np.tile(terms[at], len(inside))[valid]
    order = np.argsort(passages, kind="stable")
    passages, hits = passages[order], hits[order]
    found = []
    step = max(1, _CELLS // max(1, blocks))
    for low in range(0, int(each.sum()), step):
        a, b = np.searchsorted(passages, [low, low + step])
        count = index.first[hits[a:b] + 1] - index.first[hits[a:b]]
        cell = np.repeat(index.first[hits[a:b]] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        key = np.repeat(passages[a:b] - low, count) * blocks + index.blocks[cell]
        size = min(step, int(each.sum()) - low)
        sums = np.bincount(key, index.block_most[cell], size * blocks).reshape(size, blocks)
        found.append(low + np.flatnonzero((sums + index.common >= least - 1e-6).any(1)))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _leaks(index: Index, texts: pa.Array, least: float, overlap: float) -> list[tuple[int, int, float, float, float, int]]:
    """(row, item, score, question, answer, first word) of the best passage of every verified pair."""
    words = words_of(texts)
    n = len(words.codes)
    if not n:
        return []
    vocabulary = [plain(w) for w in words.vocabulary.to_pylist()]
    other = len(index.terms)
    term_of = np.fromiter((index.terms.get(w, other) for w in vocabulary), np.int64, len(vocabulary))
    terms = term_of[words.codes]
    lengths = np.diff(words.first)
    each = np.where(lengths > 0, np.maximum(1, -(-(lengths - PASSAGE + STEP) // STEP)), 0)
    base = np.cumsum(each) - each
    rows = np.repeat(np.arange(len(each)), each)
    starts = words.first[rows] + STEP * (np.arange(len(rows)) - base[rows])
    ends = np.minimum(starts + PASSAGE, words.first[rows + 1])
    may = _with_block(index, terms, words, base, each, least)
    best: dict[tuple[int, int], tuple] = {}
    for i in may.tolist():
        start, end, row = int(starts[i]), int(ends[i]), int(rows[i])
        query = np.unique(terms[start:end])
        for segment, score in search(index, query[query < other].tolist(), least):
            number = index.item_of[segment]
            low, high = max(int(words.first[row]), start - SEGMENT), min(int(words.first[row + 1]), end + SEGMENT)
            near = [vocabulary[c] for c in words.codes[low:high].tolist()]
            parts = index.wanted[segment]
            counts = [part.in_order(near) for part in parts]
            if all(part.enough(count, overlap) for part, count in zip(parts, counts)):
                question, answer = (count / part.length if part.length else 1.0 for part, count in zip(parts, counts))
                line = (score, question, answer, -(start - int(words.first[row])))
                best[row, number] = max(best.get((row, number), line), line)
    return [(row, index.keys[k], s, q, a, -p) for (row, k), (s, q, a, p) in sorted(best.items())]


def segment_counts(texts: list[str]) -> tuple[Counter, int, int]:
    """Segments that hold each word, segments, and words of all segments."""
    frequency: Counter = Counter()
    segments = total = 0
    for text in texts:
        words = [plain(w) for w in text.encode().split()]
        for start in segment_starts(len(words)) if words else []:
            part = words[start : start + SEGMENT]
            frequency.update(set(part))
            segments += 1
            total += len(part)
    return frequency, segments, total


def _statistics(items: DataFrame) -> DataFrame:
    """part, word, seen: in how many segments of all parts each word of a part stands.

    The empty word stands for all: its ``seen`` are the segments, its ``size`` the words of all.
    """

    def run(batches):
        for batch in batches:
            table = pa.table({"part": batch["part"], "text": batch["text"]})
            for part in table["part"].unique().to_pylist():
                texts = table.filter(pc.equal(table["part"], part))["text"].to_pylist()
                frequency, segments, total = segment_counts(texts)
                words, seen = [b"", *frequency], [segments, *frequency.values()]
                columns = [pa.array([part] * len(words), pa.int64()), pa.array(words, pa.binary()), pa.array(seen, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([total] + [0] * len(frequency), pa.int64())], ["part", "word", "seen", "size"])

    counted = items.mapInArrow(run, "part long, word binary, seen long, size long").groupBy("part", "word")
    counted = counted.agg(F.sum("seen").alias("seen"), F.sum("size").alias("size"))
    overall = counted.groupBy("word").agg(F.sum("seen").alias("seen"), F.sum("size").alias("size"))
    return counted.select("part", "word").join(overall, "word")


def _indexes(items: DataFrame, least: float) -> list:
    """Broadcast indexes of all items, each of at most about MAX_ITEMS items and MAX_BYTES bytes."""
    usable = items.select(F.col("item_id").cast("long"), "text").where("text is not null")
    count, size = usable.agg(F.count(F.lit(1)), F.sum(F.octet_length("text").cast("long"))).first()
    parts = max(1, math.ceil(count / MAX_ITEMS), math.ceil((size or 0) / MAX_BYTES))
    usable = usable.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("long"))
    statistics = pin(_statistics(usable))
    found = []
    for number in range(parts):
        rows = [(r.item_id, r.text) for r in usable.where(F.col("part") == number).collect()]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        frequency = {bytes(r.word): (r.seen, r["size"]) for r in statistics.where(F.col("part") == number).collect()}
        segments, total = frequency.pop(b"", (0, 0))
        index = build_index(rows, {w: n for w, (n, _) in frequency.items()}, segments, total / segments if segments else 1.0, least)
        found.append(items.sparkSession.sparkContext.broadcast(index))
    return found


def find_leaks(docs: DataFrame, key: str, items: DataFrame, least: float = SCORE, overlap: float = OVERLAP) -> DataFrame:
    """``key``, item_id, score, question_overlap, answer_overlap and first_word of every verified pair.

    One line per row of ``docs`` and item, for its best passage, the first of equals.  All words
    of all texts are in passages; items of any length are indexed whole.  ``question_overlap``
    and ``answer_overlap`` are shares of the words of the best segment's question and answer, 1
    where the segment has none of them.  Null texts and items hold nothing; null ids stay null;
    repeated rows and repeated items are judged each by itself.  Items beyond MAX_ITEMS or
    MAX_BYTES make further indexes of that size under the same statistics, and a pass over the
    texts each.  Empty tables give no rows.
    """
    names = ["key", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
    schema = "key long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"
    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    def finder(index):
        def run(batches):
            for batch in batches:
                for piece in slices(batch):
                    leaks = _leaks(index.value, piece["text"], least, overlap)
                    keys = piece["key"].take(pa.array([line[0] for line in leaks], pa.int64()))
                    columns = list(zip(*leaks))[1:] if leaks else [[] for _ in kinds]
                    yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

        return run

    texts = docs.select(F.col(key).cast("long").alias("key"), "text")
    return reduce(DataFrame.union, [texts.mapInArrow(finder(index), schema) for index in _indexes(items, least)]).withColumnRenamed("key", key)


def drop_leaks(docs: DataFrame, items: DataFrame, least: float = SCORE, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` in which no test item is verified, unchanged; see ``find_leaks``."""

    def keeper(index):
        def run(batches):
            for batch in batches:
                for piece in slices(batch):
                    stay = np.ones(piece.num_rows, bool)
                    stay[[line[0] for line in _leaks(index.value, piece["text"], least, overlap)]] = False
                    yield piece.filter(pa.array(stay))

        return run

    return reduce(lambda rows, index: rows.mapInArrow(keeper(index), docs.schema), _indexes(items, least), docs)
