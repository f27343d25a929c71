"""Secrets in texts: fixed patterns, and a character convolutional network over all other candidates.

A candidate is a maximal run of 12 or more characters of secrets (letters, digits, ``+/_=-``).  The
network reads all of it with the characters before and behind: embedded characters, one
convolution, the largest and the mean response of each filter, one linear layer.  It is trained
on labelled findings: all different candidates under a span of the fixed patterns against all others,
dealt over shards by a hash.  In each round every shard goes on from the same network for one
pass over its candidates, in numpy inside a task, and the networks are averaged by their
candidates.  Findings are also shown with the surroundings of another
candidate and with letters redrawn from other alphabets, so that the network learns the
token rather than the word before it.  Held-out candidates calibrate its scores and set the
threshold: it keeps the wanted recall for every kind of finding, lets in as few others as that
allows, and lies midway between the two.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.words import ASCII_LOWER, slices, text_bytes
from backglance.sources.tables import pin

# The kinds of findings in the order of the result, and what they look like.
KINDS = ("assign", "access", "hex", "net")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# Texts in lower case; a match that fails still uses up its characters.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")

_BYTE = np.arange(256)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_IS_HEX = _DIGIT | ((_BYTE >= 97) & (_BYTE <= 102))
_IS_SECRET = _DIGIT | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | np.isin(_BYTE, np.frombuffer(b"+/_=-", np.uint8))

LEAST_CANDIDATE = 12
BEFORE, BEHIND = 24, 12
# Candidates of a shard, about; rounds over all shards, and passes where there is but one list.
SHARD_CANDIDATES = 8_192
ROUNDS, EPOCHS, SEED = 6, 12, 12
# Characters of a candidate that may be drawn for training; scoring reads candidates of any length.
MAX_TRAINED = 200
RECALL = 0.99

# Characters: nothing, control, printable ASCII, all other bytes; each before, inside or behind the candidate.
_SYMBOLS = 98
_SYMBOL = np.where(_BYTE < 32, 1, np.where(_BYTE < 127, _BYTE - 30, np.where(_BYTE == 127, 1, 97))).astype(np.int32)
_WIDTH, _EMBEDDED, _FILTERS = 5, 8, 24
# Characters that are convolved at a time: bounds memory, drops nothing.
_BLOCK = 1 << 16
# Alphabets that letters of findings are redrawn from.
_ALPHABETS = (
    "0123456789ABCDEF", "0123456789abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
)


# -- spans ------------------------------------------------------------------------------------


def _runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of at least ``least`` bytes that do not cross a text."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    begins, ends = np.zeros(len(inside) + 1, bool), np.zeros(len(inside) + 1, bool)
    begins[:-1] = inside
    begins[1:-1] &= ~inside[:-1] | edge[1:-1]
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    long = stops - starts >= least
    return starts[long], stops[long]


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends, in bytes, of the spans of each fixed pattern, all texts end to end in ``data``."""
    # A zero byte after each text: it is part of no pattern, so no match crosses a text.
    apart = np.zeros(len(data) + len(offsets) - 1, np.uint8)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    apart[np.arange(len(data)) + text] = data
    back = np.append(offsets[1:], offsets[-1:]) + np.arange(len(offsets))  # where the zero byte of each text stands

    def spans(pattern, raw: bytes, least: int, group: int) -> tuple[np.ndarray, np.ndarray]:
        found = [m.span() for m in pattern.finditer(raw) if m.end(group) - m.start(group) >= least]
        both = np.array(found, np.int64).reshape(-1, 2)
        both -= np.searchsorted(back, both[:, :1], "left")
        return both[:, 0], both[:, 1]

    return [
        spans(_ASSIGN, ASCII_LOWER[apart].tobytes(), LEAST_ASSIGNED, 1),
        spans(_ACCESS, apart.tobytes(), LEAST_ACCESS, 0),
        _runs(_IS_HEX[data], offsets, LEAST_HEX),
    ]


def _under(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each candidate the first kind of span that it shares a byte with, or -1."""
    kind = np.full(len(starts), -1)
    for number in reversed(range(len(spans))):
        low, high = spans[number]
        if len(low):  # spans of one kind do not overlap
            at = np.searchsorted(high, starts, "right")
            meets = (at < len(low)) & (low[np.minimum(at, len(low) - 1)] < ends)
            kind[meets] = number
    return kind


# -- the network --------------------------------------------------------------------------------


@dataclass
class Windows:
    """Characters of candidates with their surroundings, end to end, each followed by nothing for a filter's width."""

    codes: np.ndarray
    at: np.ndarray  # places of true characters in ``codes``
    first: np.ndarray  # where each candidate starts in ``at``


def windows_of(data: np.ndarray, left: np.ndarray, starts: np.ndarray, ends: np.ndarray, right: np.ndarray) -> Windows:
    """Candidates from ``starts`` to ``ends`` with what stands from ``left`` on and up to ``right``."""
    lengths = right - left
    first = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(first[-1]) - np.repeat(first[:-1], lengths)
    source = np.repeat(left, lengths) + place
    role = 1 + (source >= np.repeat(ends, lengths)).astype(np.int32) - (source < np.repeat(starts, lengths))
    at = np.arange(first[-1]) + np.repeat(np.arange(len(lengths)) * (_WIDTH - 1), lengths)
    codes = np.zeros(first[-1] + len(lengths) * (_WIDTH - 1), np.int32)
    codes[at] = _SYMBOL[data[source]] + _SYMBOLS * role
    return Windows(codes, at, first)


def _windows_of_texts(parts: list[tuple[bytes, bytes, bytes]]) -> Windows:
    """Windows of (before, candidate, behind)."""
    lengths = np.array([[len(a), len(b), len(c)] for a, b, c in parts], np.int64).reshape(-1, 3)
    ends = np.cumsum(lengths.sum(1))
    left = ends - lengths.sum(1)
    data = np.frombuffer(b"".join([b"".join(p) for p in parts]), np.uint8)
    return windows_of(data, left, left + lengths[:, 0], left + lengths[:, :2].sum(1), ends)


@dataclass
class Net:
    embedding: np.ndarray
    filters: np.ndarray
    offset: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.offset, self.weights, self.bias]

    def pooled(self, w: Windows) -> np.ndarray:
        """Largest and mean response of each filter over a candidate and its surroundings."""
        many = len(w.first) - 1
        largest, total = np.zeros((many, _FILTERS), np.float32), np.zeros((many, _FILTERS), np.float32)
        taps = [self.embedding @ self.filters[k * _EMBEDDED : (k + 1) * _EMBEDDED] for k in range(_WIDTH)]
        for begin in range(0, len(w.at), _BLOCK):
            at = w.at[begin : begin + _BLOCK]
            response = taps[0][w.codes[at]] + self.offset
            for k in range(1, _WIDTH):
                response += taps[k][w.codes[at + k]]
            np.maximum(response, 0, out=response)
            one = np.searchsorted(w.first, begin, "right") - 1
            last = np.searchsorted(w.first, begin + len(at), "left")
            cuts = np.maximum(w.first[one:last] - begin, 0)
            largest[one:last] = np.maximum(largest[one:last], np.maximum.reduceat(response, cuts))
            total[one:last] += np.add.reduceat(response, cuts)
        return np.hstack([largest, total / np.diff(w.first)[:, None]])

    def probabilities(self, w: Windows) -> np.ndarray:
        if len(w.first) < 2:
            return np.zeros(0)
        margin = (self.pooled(w) @ self.weights + self.bias[0]).astype(float)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def _gradients(net: Net, w: Windows, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean logistic loss, by the parameters; equal largest responses share their gradient."""
    taps = w.codes[w.at[:, None] + np.arange(_WIDTH)]
    seen = net.embedding[taps].reshape(len(w.at), -1)
    response = np.maximum(seen @ net.filters + net.offset, 0)
    lengths, cuts = np.diff(w.first), w.first[:-1]
    largest = np.maximum.reduceat(response, cuts)
    pooled = np.hstack([largest, np.add.reduceat(response, cuts) / lengths[:, None]]).astype(np.float32)
    margin = pooled @ net.weights + net.bias[0]
    error = ((1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels) / len(labels)).astype(np.float32)
    each = np.repeat(np.arange(len(labels)), lengths)
    is_largest = (response == largest[each]) & (response > 0)
    ties = np.maximum(np.add.reduceat(is_largest.astype(np.float32), cuts), 1)
    to_largest = error[:, None] * net.weights[:_FILTERS] / ties
    to_mean = error[:, None] * net.weights[_FILTERS:] / lengths[:, None].astype(np.float32)
    back = (to_largest[each] * is_largest + to_mean[each]) * (response > 0)
    to_seen = (back @ net.filters.T).reshape(-1, _EMBEDDED)
    flat = taps.ravel()
    embedding = np.stack([np.bincount(flat, to_seen[:, i], len(net.embedding)) for i in range(_EMBEDDED)], 1)
    return [embedding.astype(np.float32), seen.T @ back, back.sum(0), pooled.T @ error, np.array([error.sum()])]


def _redrawn(draw: np.random.Generator, token: bytes) -> bytes:
    """A token of the same length with letters and digits from another alphabet."""
    alphabet = _ALPHABETS[draw.integers(len(_ALPHABETS))].encode()
    letters = draw.integers(0, len(alphabet), len(token))
    return bytes(c if c in b"+/_=-" else alphabet[k] for c, k in zip(token, letters.tolist()))


def _held(parts: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
    """The candidates, three of ten by their hash, that calibrate the network."""
    return np.array([hashlib.md5(token).digest()[0] % 10 < 3 for _, token, _ in parts], bool)


def _shown(draw: np.random.Generator, train: list) -> list:
    """Candidates and labels, findings also with other surroundings and redrawn."""
    shown = list(train)
    for (before, token, behind), found in train:
        if found:
            other = train[draw.integers(len(train))][0]
            shown += [((other[0], token, other[2]), True), ((other[0], _redrawn(draw, token), other[2]), True)]
    return shown


def _new_net(draw: np.random.Generator) -> tuple[Net, list]:
    """A network before training, with the moments of its gradients."""
    scale = lambda *shape: draw.normal(size=shape).astype(np.float32)
    wide = _WIDTH * _EMBEDDED
    net = Net(scale(3 * _SYMBOLS, _EMBEDDED) * 0.3, scale(wide, _FILTERS) / wide**0.5, np.zeros(_FILTERS, np.float32), scale(2 * _FILTERS) * 0.1, np.zeros(1))
    return net, [[np.zeros_like(p), np.zeros_like(p)] for p in net.parameters()]


def _one_pass(net: Net, moments: list, step: int, shown: list, draw: np.random.Generator) -> int:
    """Trains the network in place on all that is shown, in a drawn order; the number of steps so far."""
    order = draw.permutation(len(shown))
    for start in range(0, len(order), 128):
        some = [shown[i] for i in order[start : start + 128]]
        step += 1
        found = _gradients(net, _windows_of_texts([s for s, _ in some]), np.array([y for _, y in some], np.float32))
        for parameter, gradient, (one, two) in zip(net.parameters(), found, moments):
            one += 0.1 * (gradient - one)
            two += 0.01 * (gradient * gradient - two)
            parameter -= 0.01 * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
    return step


def fit_net(parts: list[tuple[bytes, bytes, bytes]], kinds: np.ndarray, recall: float = RECALL, epochs: int = EPOCHS, seed: int = SEED) -> Net | None:
    """A network for (before, candidate, behind) with a kind of finding from 0 on, or -1 for none.

    Three of ten candidates, by a hash of the candidate, calibrate it and set the threshold; where they hold no
    finding or nothing else there is no network.
    """
    held = _held(parts)
    label = kinds >= 0
    if any(not (label & side).any() or not (~label & side).any() for side in (held, ~held)):
        return None
    draw = np.random.default_rng(seed)
    shown = _shown(draw, [(parts[i], bool(label[i])) for i in np.flatnonzero(~held)])
    net, moments = _new_net(draw)
    step = 0
    for _ in range(epochs):
        step = _one_pass(net, moments, step, shown, draw)
    _calibrate(net, _windows_of_texts([parts[i] for i in np.flatnonzero(held)]), kinds[held], recall)
    return net


def _calibrate(net: Net, w: Windows, kinds: np.ndarray, recall: float) -> None:
    """Logistic calibration on held-out candidates, then the threshold.

    Of every kind at least the share ``recall`` lies above it; of the thresholds that let in equally
    few others, it is the one midway in log odds.
    """
    margin = (net.pooled(w) @ net.weights + net.bias[0]).astype(float)
    label = kinds >= 0
    # Targets a little inside 0 and 1, after Platt, so that separable candidates have a finite slope.
    target = np.where(label, (label.sum() + 1) / (label.sum() + 2), 1 / ((~label).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -60, 60)))
        weight = np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(weight * margin * margin).sum() + 1e-6, (weight * margin).sum()], [(weight * margin).sum(), weight.sum() + 1e-6]])
        move = np.linalg.solve(hessian, [((target - p) * margin).sum(), (target - p).sum()])
        move *= min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        slope, shift = slope + move[0], shift + move[1]
        if np.abs(move).max() < 1e-9:
            break
    net.slope, net.shift = float(slope), float(shift)
    scores = net.probabilities(w)
    lowest = []
    for kind in np.unique(kinds[label]):
        ordered = np.sort(scores[kinds == kind])
        lowest.append(ordered[int(len(ordered) * (1 - recall))])
    most = min(lowest)
    least = scores[~label & (scores < most)].max(initial=0.0)
    odds = lambda p: np.log(max(p, 1e-12) / max(1 - p, 1e-12))
    net.threshold = float(1 / (1 + np.exp(-(odds(most) + odds(least)) / 2)))


def labelled_candidates(docs: DataFrame, rows: int | None = None, findings: int | None = None, others: int | None = None) -> DataFrame:
    """(before, token, behind, kind): all different candidates under a fixed pattern (kind 0 to 2) and all others (-1).

    On request at most so many of either, drawn by a hash, from about ``rows`` rows, drawn by a hash of id and text.
    """
    total = docs.agg(F.count(F.lit(1))).first()[0] if rows is not None else 0
    sampled = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(total, 1))) < rows) if rows is not None and total > rows else docs

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part["text"])
                starts, ends = _runs(_IS_SECRET[data], offsets, LEAST_CANDIDATE)
                short = ends - starts <= MAX_TRAINED
                starts, ends = starts[short], ends[short]
                kind = _under(starts, ends, base_spans(data, offsets))
                left, right = _surroundings(starts, ends, offsets)
                raw = data.tobytes()
                cut = lambda a, b: pa.array([raw[i:j] for i, j in zip(a.tolist(), b.tolist())], pa.binary())
                columns = [cut(left, starts), cut(starts, ends), cut(ends, right), pa.array(kind.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["before", "token", "behind", "kind"])

    found = sampled.select("text").mapInArrow(run, "before binary, token binary, behind binary, kind int")
    found = found.distinct().withColumn("_draw", F.xxhash64("token", "before", "behind"))

    def some(which: str, most: int | None) -> DataFrame:
        chosen = found.where(which)
        return chosen if most is None else chosen.orderBy("_draw", "token", "before", "behind").limit(most)

    if findings is None and others is None:
        return found.drop("_draw")
    return some("kind >= 0", findings).unionByName(some("kind < 0", others)).drop("_draw")


def _of_shard(row: dict) -> tuple[list[tuple[bytes, bytes, bytes]], np.ndarray]:
    parts = [(c["before"], c["token"], c["behind"]) for c in row["candidates"]]
    return parts, np.array([c["kind"] for c in row["candidates"]], np.int64)


def train_net(docs: DataFrame, epochs: int = ROUNDS, seed: int = SEED, shard: int = SHARD_CANDIDATES) -> Net | None:
    """The network trained on all ``labelled_candidates``, in shards of about ``shard``.

    The driver receives one network a shard and round, and sums over the held-out candidates.  Shards are dealt by
    a hash and sorted, so neither partitions nor the order of rows change the network.
    """
    spark = docs.sparkSession
    candidates = pin(labelled_candidates(docs))
    many = max(1, math.ceil(candidates.count() / shard))
    at = F.pmod(F.xxhash64("token", "before", "behind"), F.lit(many)).alias("shard")
    listed = F.sort_array(F.collect_list(F.struct("token", "before", "behind", "kind"))).alias("candidates")
    shards = pin(candidates.repartition(many, at).groupBy(at).agg(listed))

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                parts, kinds = _of_shard(row)
                held, label = _held(parts), kinds >= 0
                yield pa.RecordBatch.from_pylist([{f"n{i}": int((a & b).sum()) for i, (a, b) in enumerate([(x, y) for x in (held, ~held) for y in (label, ~label)])}])

    sides = shards.mapInArrow(count, "n0 long, n1 long, n2 long, n3 long").agg(*[F.sum(f"n{i}") for i in range(4)]).first()
    if any(not n for n in sides):
        return None
    net, moments = _new_net(np.random.default_rng(seed))
    step = 0
    for epoch in range(epochs):
        state = spark.sparkContext.broadcast((net, moments, step))

        def run(batches, state=state, epoch=epoch):
            for batch in batches:
                for row in batch.to_pylist():
                    parts, kinds = _of_shard(row)
                    train = [(parts[i], bool(kinds[i] >= 0)) for i in np.flatnonzero(~_held(parts))]
                    if train:
                        own, its, steps = pickle.loads(pickle.dumps(state.value))  # the broadcast value stays as it is
                        shown = _shown(np.random.default_rng([seed, row["shard"]]), train)
                        steps = _one_pass(own, its, steps, shown, np.random.default_rng([seed, row["shard"], epoch]))
                        yield pa.RecordBatch.from_pylist([{"shard": row["shard"], "n": len(shown), "state": pickle.dumps((own.parameters(), its, steps))}])

        found = sorted(shards.mapInArrow(run, "shard long, n long, state binary").collect(), key=lambda r: r["shard"])
        total = sum(r["n"] for r in found)
        means = None
        for r in found:
            parameters, its, steps = pickle.loads(r["state"])
            flat = [*parameters, *[m for pair in its for m in pair], np.array([steps], float)]
            part = [np.asarray(x, float) * (r["n"] / total) for x in flat]
            means = part if means is None else [a + b for a, b in zip(means, part)]
        state.unpersist()
        places = [p.dtype for p in net.parameters()]
        values = [m.astype(t) for m, t in zip(means, places)]
        net = Net(*values)
        moments = [[means[len(places) + 2 * i].astype(t), means[len(places) + 2 * i + 1].astype(t)] for i, t in enumerate(places)]
        step = max(1, round(float(means[-1][0])))
    _calibrate_on_all(net, shards)
    return net


def _calibrate_on_all(net: Net, shards: DataFrame, recall: float = RECALL) -> None:
    """As ``_calibrate``, by sums over all held-out candidates."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                parts, kinds = _of_shard(row)
                held = np.flatnonzero(_held(parts))
                if len(held):
                    margin = (net.pooled(_windows_of_texts([parts[i] for i in held])) @ net.weights + net.bias[0]).astype(float)
                    yield pa.RecordBatch.from_arrays([pa.array(margin), pa.array(kinds[held])], ["margin", "kind"])

    margins = pin(shards.mapInArrow(run, "margin double, kind long"))
    m, label = F.col("margin"), F.col("kind") >= 0
    counts = {r["kind"]: r["n"] for r in margins.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = sum(n for kind, n in counts.items() if kind >= 0)
    target = F.when(label, (found + 1) / (found + 2)).otherwise(1 / (counts[-1] + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        odds = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.lit(slope) * m + F.lit(shift)))
        p = 1 / (1 + F.exp(-odds))
        weight = F.greatest(p * (1 - p), F.lit(1e-9))
        sums = margins.agg(*[F.sum(x) for x in (weight * m * m, weight * m, weight, (target - p) * m, target - p)]).first()
        move = np.linalg.solve([[sums[0] + 1e-6, sums[1]], [sums[1], sums[2] + 1e-6]], [sums[3], sums[4]])
        move *= min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        slope, shift = slope + float(move[0]), shift + float(move[1])
        if np.abs(move).max() < 1e-7:
            break
    net.slope, net.shift = slope, shift
    score = lambda margin: float(1 / (1 + np.exp(-np.clip(slope * margin + shift, -60, 60))))
    # Of every kind only the share below the threshold is sorted; scores rise or fall with the margin.
    order = m.asc() if slope >= 0 else m.desc()
    last = F.max if slope >= 0 else F.min
    lowest = [
        margins.where(F.col("kind") == kind).orderBy(order).limit(int(n * (1 - recall)) + 1).agg(last("margin")).first()[0]
        for kind, n in counts.items() if kind >= 0
    ]
    most = min(lowest, key=score)
    below = m < most if slope >= 0 else m > most
    least = margins.where(~label & below).agg(last("margin")).first()[0]
    odds = lambda p: np.log(max(p, 1e-12) / max(1 - p, 1e-12))
    net.threshold = float(1 / (1 + np.exp(-(odds(score(most)) + odds(0.0 if least is None else score(least))) / 2)))


# -- texts --------------------------------------------------------------------------------------


def _surroundings(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text = np.searchsorted(offsets, starts, "right") - 1
    return np.maximum(starts - BEFORE, offsets[text]), np.minimum(ends + BEHIND, offsets[text + 1])


def scan(texts: pa.Array, net: Net | None) -> list[pa.Array]:
    """Per text the number of spans of each kind, of candidates, the hash of the base spans, and all spans as text."""
    data, offsets = text_bytes(texts)
    spans = base_spans(data, offsets)
    starts, ends = _runs(_IS_SECRET[data], offsets, LEAST_CANDIDATE)
    chosen = np.zeros(len(starts), bool)
    if net is not None and len(starts):
        left, right = _surroundings(starts, ends, offsets)
        chosen = (net.probabilities(windows_of(data, left, starts, ends, right)) >= net.threshold) & (_under(starts, ends, spans) < 0)
    spans = [*spans, (starts[chosen], ends[chosen])]
    of_text = lambda places: np.searchsorted(offsets, places, "right") - 1
    many = len(offsets) - 1
    counts = [np.bincount(of_text(s), minlength=many) for s, _ in spans]
    begin = np.concatenate([s for s, _ in spans])
    until = np.concatenate([e for _, e in spans])
    kind = np.repeat(np.arange(len(spans)), [len(s) for s, _ in spans])
    order = np.lexsort((kind, begin))
    begin, until, kind = begin[order], until[order], kind[order]
    # Bytes to code points: places of first bytes, counted from the start of the text.
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text = of_text(begin)
    low, high = points[begin] - points[offsets[text]], points[until] - points[offsets[text]]
    lines, base = [[] for _ in range(many)], [[] for _ in range(many)]
    for t, k, a, b in zip(text.tolist(), kind.tolist(), low.tolist(), high.tolist()):
        line = f"{KINDS[k]}:{a}:{b}"
        lines[t].append(line)
        if KINDS[k] != "net":
            base[t].append(line)
    nothing = hashlib.sha256(b"").hexdigest()
    digests = [hashlib.sha256(",".join(b).encode()).hexdigest() if b else nothing for b in base]
    counts += [np.bincount(of_text(starts), minlength=many)]
    return [*[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array([",".join(x) for x in lines], pa.string())]


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row, then n_net and n_candidates.

    A span is kind:start:end in code points, end exclusive; spans stand by start, then kind.
    ``assign``, ``access`` and ``hex`` are the fixed patterns, leftmost and non-overlapping per kind; ``net`` spans are
    candidates that share no character with those and whose calibrated score reaches the threshold.
    Null texts count as empty; repeated rows give repeated lines; an empty table gives none, and
    without findings to train on there are no ``net`` spans.  A text of any length is scanned whole.
    Only doc_id and text are read.
    """
    net = docs.sparkSession.sparkContext.broadcast(train_net(docs))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_net", "n_candidates"]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                *counts, digests, spans = scan(part["text"], net.value)
                yield pa.RecordBatch.from_arrays([part["doc_id"], *counts[:3], digests, spans, *counts[3:]], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_net long, n_candidates long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
