"""Byte-level BPE, encoded and decoded with contiguous rank arrays.

A pre-token is held as the array of its parts and, beside it, the rank of each pair of
neighbouring parts.  A step scans the ranks for the least (the first of equals), deletes
the boundary inside that pair and refreshes the two ranks beside it.  The distinct pre-tokens of
a slice of texts take their steps together, one row of numpy arrays each, so no memory of earlier
texts is needed and none is kept.  The scan is linear, which is the fastest way for pre-tokens of some
tens of bytes; longer ones take their next pair from a heap over the same boundaries, with
the same result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backglance.llm.words import slices, text_bytes

# Bytes of a pre-token up to which the linear scan is used; either way gives the same ids.
_SHORT = 128
# Pre-tokens that take their steps together, and from how many on it is worth it; same ids.
_TOGETHER, _FEW = 8192, 48
_NONE = 1 << 60
_NO_RANK = np.int32(2**31 - 1)

_BYTE = np.arange(256)
_LETTER, _NUMBER, _OTHER, _BREAK, _SPACE, _UNCLEAR = 1, 2, 3, 4, 5, 6
# Classes of bytes that tell where a pre-token ends; unclear ones are left to the pattern.
_CLASS = np.full(256, _UNCLEAR, np.uint8)
_CLASS[0x21:0x7F] = _OTHER
_CLASS[ord("'")] = _UNCLEAR
_CLASS[0x30:0x3A] = _NUMBER
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x0A], _CLASS[0x20] = _BREAK, _SPACE


def binary_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a large_binary array end to end, and where each starts."""
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _chosen(flat: np.ndarray, first: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``take`` of the lists that start in ``flat`` at ``first``."""
    lengths = np.diff(first)[take]
    ends = _ends(lengths)
    return flat[np.arange(ends[-1]) + np.repeat(first[:-1][take] - ends[:-1], lengths)], ends


@dataclass
class Pieces:
    """Texts cut before every space: ``codes[i]`` is the place of piece i in ``distinct``; text d has those from ``first[d]`` to ``first[d + 1]``.

    Texts marked ``whole`` have places where that cut may go through a pre-token.
    """

    data: np.ndarray
    offsets: np.ndarray
    cuts: np.ndarray
    codes: np.ndarray
    distinct: pa.Array
    first: np.ndarray
    whole: np.ndarray


def _alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """Vocabulary, ranks and added tokens of a byte-level BPE file, with its encoder and decoder."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _alphabet()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.ids = {raw(token): number for token, number in model["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        # A pair's rank is its line in the file.  Parts are told apart by their bytes, so ranks are
        # kept by the joined bytes, with the length of the left part that the line asks for.
        self.ranks: dict[bytes, int] = {}
        self.lefts: list[int] = []
        for rank, (a, b) in enumerate(merges):
            if self.ranks.setdefault(raw(a) + raw(b), rank) != rank:
                raise ValueError(f"two merges make the same token: {a} {b}")
            self.lefts.append(len(raw(a)))
        self.bytes_of = {number: token for token, number in self.ids.items()}
        self.added = {token["content"]: token["id"] for token in model["added_tokens"]}
        self.bytes_of |= {number: content.encode() for content, number in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.pattern = regex.compile(pattern)
        self._make_tables(merges, raw)

    def _make_tables(self, merges, raw) -> None:
        """Ranks by pair of part ids in open addressing, for many look-ups at once; ids as text and bytes."""
        pairs = np.array([(self.ids[raw(a)], self.ids[raw(b)], self.ids[raw(a) + raw(b)]) for a, b in merges], np.int64).reshape(-1, 3)
        self._byte_id = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        self._merged = pairs[:, 2].astype(np.int32)
        bits = max(10, (8 * len(pairs)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NO_RANK, np.int32)
        for rank, key in enumerate((pairs[:, 0] << 32 | pairs[:, 1]).tolist()):
            slot = int(self._slots(np.array([key]))[0])
            while self._keys[slot] != -1:
                slot = (slot + 1) & self._mask
            self._keys[slot], self._values[slot] = key, rank
        top = max(self.bytes_of) + 1
        self._id_text = pa.array([str(i) for i in range(top)], pa.large_string())
        self._id_bytes = pa.array([self.bytes_of.get(i, b"") for i in range(top)], pa.large_binary())

    # -- many pre-tokens ------------------------------------------------------------------

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of part ids; -1 stands for no part and has no rank."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots(keys)
        held = self._keys[slots]
        ranks = np.where(held == keys, self._values[slots], _NO_RANK)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        flat, ranks_flat, slots_flat = keys.ravel(), ranks.reshape(-1), slots.ravel()
        while len(open_):
            slots_flat[open_] = (slots_flat[open_] + 1) & self._mask
            held = self._keys[slots_flat[open_]]
            hit = held == flat[open_]
            ranks_flat[open_[hit]] = self._values[slots_flat[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return ranks

    def _join_rows(self, part: np.ndarray):
        """(rows, parts) once no pair of neighbours can be joined; each row of ``part`` is a pre-token, filled up with -1."""
        rows = np.arange(len(part))
        ranks = self._rank(part[:, :-1], part[:, 1:])
        while part.shape[1] > 1:
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            joins = least != _NO_RANK
            if not joins.all():
                yield rows[~joins], part[~joins]
                rows, part, ranks, at, least = rows[joins], part[joins], ranks[joins], at[joins], least[joins]
                if not len(rows):
                    return
            each = np.arange(len(rows))
            part[each, at] = self._merged[least]
            keep = np.ones(part.shape, bool)
            keep[each, at + 1] = False
            part = part[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[each, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            # The new part has new ranks with both its neighbours.
            some = np.flatnonzero(at < ranks.shape[1])
            ranks[some, at[some]] = self._rank(part[some, at[some]], part[some, at[some] + 1])
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self._rank(part[some, at[some] - 1], part[some, at[some]])
        yield rows, part

    def pretokens(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens (large_binary) end to end, and where those of each start."""
        data, offsets = binary_parts(tokens)
        lengths = np.diff(offsets)
        counts = np.zeros(len(lengths), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        short = order[lengths[order] <= _SHORT]
        for start in range(0, len(short), _TOGETHER):
            some = short[start : start + _TOGETHER]
            place = np.arange(lengths[some[-1]])
            inside = place < lengths[some][:, None]
            part = np.full(inside.shape, -1, np.int32)
            part[inside] = self._byte_id[data[(offsets[some][:, None] + place)[inside]]]
            for rows, parts in self._join_rows(part):
                counts[some[rows]] = (parts >= 0).sum(1)
                found.append((some[rows], parts))
        for i in order[len(short) :].tolist():
            word = data[offsets[i] : offsets[i + 1]].tobytes()
            bounds = self._long(word)
            found.append((np.array([i]), np.array([[self.ids[word[a:b]] for a, b in zip(bounds, bounds[1:])]], np.int32)))
            counts[i] = len(bounds) - 1
        first = _ends(counts)
        flat = np.zeros(first[-1], np.int32)
        for rows, parts in found:
            inside = parts >= 0
            flat[(first[rows][:, None] + np.arange(parts.shape[1]))[inside]] = parts[inside]
        return flat, first

    def _plain_tokens(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the bytes of a piece alone tell its pre-tokens; then where they start, and their number, for those pieces end to end."""
        data, offsets = binary_parts(pieces)
        kind = _CLASS[data]
        # The letters of Latin-1 in two bytes, but for the signs of multiplication and division.
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[lead] = kind[lead + 1] = _LETTER
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        unclear = kind == _UNCLEAR
        unclear[1:] |= (kind[1:] == _BREAK) & (kind[:-1] == _BREAK)
        unclear |= (kind == _BREAK) & (begins[:-1] | begins[1:])  # a break at either end may join what is beyond
        unclear |= (kind == _SPACE) & ~begins[:-1]
        clear = np.diff(_ends(unclear)[offsets]) == 0
        head = begins[:-1].copy()
        head[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
        return clear, head, np.diff(_ends(head)[offsets])

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (large_binary) end to end, and where those of each start."""
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        clear, head, per_piece = self._plain_tokens(pieces)
        data, offsets = binary_parts(pieces)
        inside = np.repeat(clear, np.diff(offsets))
        starts = np.flatnonzero(head[inside])
        tokens = [_binary(np.append(starts, inside.sum()), data[inside])]
        others = [[t.encode() for t in self._tokens(p.decode("utf-8"))] for p in pieces.filter(pa.array(~clear)).to_pylist()]
        per_piece[~clear] = [len(o) for o in others]
        tokens.append(pa.array([t for o in others for t in o], pa.large_binary()))
        coded = pa.concat_arrays(tokens).dictionary_encode()
        flat, first = self.pretokens(coded.dictionary)
        flat, first = _chosen(flat, first, coded.indices.to_numpy())
        # Clear pieces stand first: back to the order given.
        order = np.concatenate([np.flatnonzero(clear), np.flatnonzero(~clear)])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _chosen(flat, first[_ends(per_piece[order])], back)

    # -- one pre-token ------------------------------------------------------------------

    def _short(self, word: bytes) -> list[int]:
        """Part boundaries once no pair of neighbours can be joined."""
        rank_of, lefts = self.ranks.get, self.lefts
        bounds = list(range(len(word) + 1))
        ranks = [rank_of(word[i : i + 2], _NONE) for i in bounds[:-2]]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            # Parts i and i + 1 are now one: its pairs with both neighbours have new ranks.
            if i < len(ranks):
                start, middle = bounds[i], bounds[i + 1]
                rank = rank_of(word[start : bounds[i + 2]], _NONE)
                ranks[i] = rank if rank == _NONE or lefts[rank] == middle - start else _NONE
            if i:
                start, middle = bounds[i - 1], bounds[i]
                rank = rank_of(word[start : bounds[i + 1]], _NONE)
                ranks[i - 1] = rank if rank == _NONE or lefts[rank] == middle - start else _NONE
        return bounds

    def _long(self, word: bytes) -> list[int]:
        """The same boundaries by a heap of ranks over linked parts."""
        n = len(word)
        following, previous = list(range(1, n + 2)), list(range(-1, n))

        def rank(start: int) -> int:
            middle = following[start]
            if middle >= n:
                return _NONE
            found = self.ranks.get(word[start : following[middle]], _NONE)
            return found if found == _NONE or self.lefts[found] == middle - start else _NONE

        now = [rank(i) for i in range(n)]
        heap = [(r, i) for i, r in enumerate(now) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            least, i = heapq.heappop(heap)
            if now[i] != least:
                continue
            middle = following[i]
            following[i] = following[middle]
            if following[i] <= n - 1:
                previous[following[i]] = i
            now[middle] = _NONE
            for start in (i, previous[i]):
                if start >= 0:
                    now[start] = rank(start)
                    if now[start] != _NONE:
                        heapq.heappush(heap, (now[start], start))
        bounds, at = [0], 0
        while at < n:
            at = following[at]
            bounds.append(at)
        return bounds

    # -- texts --------------------------------------------------------------------------

    def _tokens(self, text: str) -> list[str]:
        if text.isascii() and (text[1:] if text[:1] == " " else text).isalpha():
            return [text]
        return self.pattern.findall(text)

    def _plain(self, text: str) -> list[int]:
        tokens = [t.encode("utf-8") for t in self._tokens(text)]
        if len(tokens) >= _FEW:
            coded = pa.array(tokens, pa.large_binary()).dictionary_encode()
            return _chosen(*self.pretokens(coded.dictionary), coded.indices.to_numpy())[0].tolist()
        found = []
        for word in tokens:
            bounds = self._short(word) if len(word) <= _SHORT else self._long(word)
            found += [self.ids[word[a:b]] for a, b in zip(bounds, bounds[1:])]
        return found

    def _spans(self, text: str) -> list:
        """Texts between added tokens, and the ids of added tokens as lists."""
        if self.added_pattern is None or not any(content in text for content in self.added):
            return [text]
        return [[self.added[s]] if s in self.added else s for s in self.added_pattern.split(text) if s]

    def encode(self, text: str) -> list[int]:
        return [number for span in self._spans(text) for number in (span if isinstance(span, list) else self._plain(span))]

    def decode(self, ids) -> str:
        """The text of the ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join([self.bytes_of[number] for number in ids]).decode("utf-8", "replace")

    def cut(self, texts: pa.Array) -> Pieces:
        """Texts as pieces; null counts as empty."""
        data, offsets = text_bytes(texts)
        cut = np.concatenate([data == 0x20, [True]])
        whole = self._not_to_cut(data, offsets, np.flatnonzero(cut[:-1]))
        cut[offsets] = True
        cuts = np.flatnonzero(cut)
        coded = _binary(cuts, data).dictionary_encode()
        return Pieces(data, offsets, cuts, coded.indices.to_numpy(), coded.dictionary, np.searchsorted(cuts, offsets), whole)

    def digests(self, texts: pa.Array) -> tuple[list[int], list[str], list[str]]:
        """For each text the number of ids, the SHA-256 of the ids and of the decoded text; null counts as empty."""
        cut = self.cut(texts)
        flat, first = self.pieces(cut.distinct)
        counts, lists = _ends(np.diff(first)[cut.codes])[cut.first], pa.array(cut.first, pa.int64())
        numbers = pa.array(flat, pa.int64())
        # Ids joined within pieces, then pieces within texts.
        ids = _joined(_joined(self._id_text.take(numbers), pa.array(first), ",").take(pa.array(cut.codes)), lists, ",")
        back = _joined(_joined(self._id_bytes.take(numbers), pa.array(first), b"").take(pa.array(cut.codes)), lists, b"")
        n, ids_sha, back_sha = np.diff(counts).tolist(), [], []
        for d, (joined, decoded) in enumerate(zip(ids, back)):
            if cut.whole[d]:
                found = self.encode(cut.data[cut.offsets[d] : cut.offsets[d + 1]].tobytes().decode("utf-8"))
                n[d], joined, decoded = len(found), ",".join(map(str, found)).encode(), self.decode(found).encode()
            else:
                joined, decoded = joined.as_buffer(), decoded.as_py().decode("utf-8", "replace").encode()
            ids_sha.append(hashlib.sha256(joined).hexdigest())
            back_sha.append(hashlib.sha256(decoded).hexdigest())
        return n, ids_sha, back_sha

    def _not_to_cut(self, data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray) -> np.ndarray:
        """Texts that are encoded whole: those with an added token, or a space after (perhaps) white space.

        Elsewhere no pre-token crosses the place before a space.  White space beyond ASCII ends in
        UTF-8 on C2 85, C2 A0, or a character whose last byte but one is 80, 81 or 9A.
        """
        padded = np.concatenate([np.zeros(2, np.uint8), data])
        one, two = padded[spaces + 1], padded[spaces]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        wide = (one >= 0x80) & ((two == 0x80) | (two == 0x81) | (two == 0x9A))
        odd = ((one <= 0x20) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | wide) & ~begins[spaces]
        whole = np.zeros(len(offsets) - 1, bool)
        whole[np.searchsorted(offsets, spaces[odd], "right") - 1] = True
        raw = data.tobytes()
        for content in self.added:
            at = raw.find(content.encode())
            while at >= 0:
                whole[np.searchsorted(offsets, at, "right") - 1] = True
                at = raw.find(content.encode(), at + 1)
        return whole

    def counts(self, pieces: list[str]) -> list[int]:
        """Number of ids of each piece of a text."""
        if len(pieces) < _FEW:
            return [len(self.encode(p)) for p in pieces]
        coded = pa.array([p.encode("utf-8") for p in pieces], pa.large_binary()).dictionary_encode()
        return np.diff(self.pieces(coded.dictionary)[1])[coded.indices.to_numpy()].tolist()


def _joined(values: pa.Array, first: pa.Array, between) -> pa.Array:
    """For each list the values from its start on, joined."""
    return pc.binary_join(pa.LargeListArray.from_arrays(first, values), pa.scalar(between, values.type))


@lru_cache(maxsize=2)
def load_bpe(path: str, pattern: str) -> Bpe:
    """One encoder per worker and file."""
    return Bpe(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, column: str = "text", out: str = "ids") -> DataFrame:
    """The rows of ``docs`` with ``out``, the array of token ids of the text; null counts as empty.

    A column called ``out`` is replaced.  Repeated rows are encoded each; an empty table gives no rows.
    """
    schema = docs.drop(out).schema.add(out, T.ArrayType(T.IntegerType()))

    def run(batches):
        bpe = load_bpe(path, pattern)
        for batch in batches:
            for part in slices(batch, column):
                ids = [bpe.encode(t or "") for t in part[column].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, out])

    return docs.drop(out).mapInArrow(run, schema)


def decode_documents(rows: DataFrame, path: str, pattern: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with ``out``, the text of the array of ids; null counts as no id.

    A column called ``out`` is replaced.  Repeated rows are decoded each; an empty table gives no rows.
    """
    schema = rows.drop(out).schema.add(out, T.StringType())

    def run(batches):
        bpe = load_bpe(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [bpe.decode(ids or ()) for ids in part[column].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return rows.drop(out).mapInArrow(run, schema)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids are encoded and decoded in one pass.

    A null text counts as empty.  Repeated rows give repeated lines, an empty table none, and
    further columns of ``docs`` are not read.  A text of any length is one row of its slice;
    nothing of it is remembered.
    """

    def run(batches):
        bpe = load_bpe(path, pattern)
        for batch in batches:
            for part in slices(batch):
                counts, ids, back = bpe.digests(part["text"])
                columns = [part["doc_id"].cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
