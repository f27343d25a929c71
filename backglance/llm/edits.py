"""Token counts that follow edits without encoding a document again.

A document's leaves are its pieces between places that no pre-token can cross: before a space
that follows no white space.  A segment tree over the leaves holds their token counts and
the sums of its subtrees; its root is the document's count.  An edit re-encodes the leaves it
touches with one character of context on either side (only that far can it move a place
between leaves), and renews the sums above them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.bpe import Bpe, load_bpe
from backglance.llm.words import slices

_PLACE = regex.compile(r"(?<=[^\s\x1c-\x1f]) ")
# What the redaction replaces, and by what.
REDACTIONS = ((r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "<email>"), (r"\d{5,}", "<number>"))

Edit = tuple[int, int, str]


def leaves(text: str, bpe: Bpe) -> tuple[list[int], list[int]]:
    """Where the leaves of a text start, and their token counts."""
    if not text:
        return [], []
    starts = [0, *(m.start() for m in _PLACE.finditer(text))]
    return starts, bpe.counts([text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])])


def trees(texts: pa.Array, bpe: Bpe) -> Iterator[TokenTree]:
    """The tree of every text; the distinct leaves of all of them are encoded together, null counts as empty."""
    cut = bpe.cut(texts)
    counts = np.diff(bpe.pieces(cut.distinct)[1])[cut.codes]
    # Places in characters: first bytes of characters, counted from the start of the text.
    points = np.concatenate([[0], np.cumsum((cut.data & 0xC0) != 0x80)])
    for d, text in enumerate(texts.to_pylist()):
        if cut.whole[d] or not text:
            yield TokenTree.build(text or "", bpe)
        else:
            own = slice(cut.first[d], cut.first[d + 1])
            starts = points[cut.cuts[own]] - points[cut.offsets[d]]
            yield TokenTree.of(text, starts.tolist(), counts[own])


class TokenTree:
    """``sums[1]`` is the root, ``sums[size + i]`` leaf i; ``starts`` are the places of the leaves in ``text``."""

    def __init__(self, text: str, starts: list[int], sums: np.ndarray):
        self.text, self.starts, self.sums = text, starts, sums

    @classmethod
    def build(cls, text: str, bpe: Bpe) -> TokenTree:
        return cls.of(text, *leaves(text, bpe))

    @classmethod
    def of(cls, text: str, starts: list[int], counts) -> TokenTree:
        size = 1 << max(0, len(starts) - 1).bit_length()
        sums = np.zeros(2 * size, np.int64)
        sums[size : size + len(starts)] = counts
        width = size
        while width > 1:
            width //= 2
            sums[width : 2 * width] = sums[2 * width : 4 * width : 2] + sums[2 * width + 1 : 4 * width : 2]
        return cls(text, starts, sums)

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def _set(self, leaf: int, count: int) -> None:
        at = len(self.sums) // 2 + leaf
        change = count - self.sums[at]
        while at and change:
            self.sums[at] += change
            at //= 2

    def apply(self, edits: list[Edit], bpe: Bpe) -> int:
        """Apply edits (start, end, new text) in places of ``text``; the number of leaves encoded again.

        Edits stand in any order and must not overlap; two at the same place apply in the given
        order.  The tree then counts the edited text; its leaves keep their old places, so all
        edits of a version are given at once.
        """
        edits = sorted(edits, key=lambda e: (e[0], e[1]))
        for (_, end, _), (start, _, _) in zip(edits, edits[1:]):
            if start < end:
                raise ValueError("edits overlap")
        if edits and not (0 <= edits[0][0] and all(s <= e <= len(self.text) for s, e, _ in edits)):
            raise ValueError("an edit lies outside the text")
        if not self.starts:  # an empty text has no leaf; its root is leaf 0
            new = "".join(e[2] for e in edits)
            pieces = TokenTree.build(new, bpe)
            self._set(0, pieces.total)
            return len(pieces.starts)
        regions: list[tuple[int, int, list[Edit]]] = []
        for edit in edits:
            first = bisect_right(self.starts, max(edit[0] - 1, 0)) - 1
            last = bisect_right(self.starts, min(edit[1], len(self.text) - 1)) - 1
            if regions and first <= regions[-1][1]:
                low, high, held = regions.pop()
                regions.append((low, max(high, last), [*held, edit]))
            else:
                regions.append((first, last, [edit]))
        encoded = 0
        for first, last, held in regions:
            at, until = self.starts[first], self.starts[last + 1] if last + 1 < len(self.starts) else len(self.text)
            parts = []
            for start, end, new in held:
                parts += [self.text[at:start], new]
                at = end
            region = "".join([*parts, self.text[at:until]])
            _, counts = leaves(region, bpe)
            encoded += len(counts)
            self._set(first, sum(counts))
            for leaf in range(first + 1, last + 1):
                self._set(leaf, 0)
        return encoded


def apply_to_text(text: str, edits: list[Edit]) -> str:
    parts, at = [], 0
    for start, end, new in sorted(edits, key=lambda e: (e[0], e[1])):
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


_PATTERNS = [(regex.compile(p), new) for p, new in REDACTIONS]


def redactions(text: str) -> list[Edit]:
    """Edits that redact e-mail addresses and long numbers; of overlapping ones the earlier, then the longer, stays."""
    found = [(m.start(), m.end(), new) for pattern, new in _PATTERNS for m in pattern.finditer(text)]
    kept: list[Edit] = []
    for edit in sorted(found, key=lambda e: (e[0], -e[1])):
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


EDITS = "array<struct<start: int, end: int, text: string>>"


def with_redactions(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``edits`` of every row; null texts have none."""

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            for part in slices(batch):
                lists = [[{"start": s, "end": e, "text": t} for s, e, t in redactions(x or "")] for x in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, kind)], ["doc_id", "text", "edits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, text string, edits {EDITS}")


_NAMES = ["doc_id", "n_tokens", "n_edits", "n_leaves", "n_encoded_again", "n_tokens_edited"]


def _lines(keys: list, part: pa.RecordBatch, edits_of, bpe: Bpe) -> pa.RecordBatch:
    lines = []
    for i, (key, tree) in enumerate(zip(keys, trees(part["text"], bpe))):
        before, changes = tree.total, edits_of(i, tree.text)
        again = tree.apply(changes, bpe) if changes else 0
        lines.append((key, before, len(changes), len(tree.starts), again, tree.total))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*lines)], _NAMES)


def count_edited(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_leaves, n_encoded_again and n_tokens_edited of every row.

    ``docs`` has doc_id, text and ``edits``, which are in characters of the text.  Null texts count
    as empty, null edits as none; edits that overlap or leave the text are an error.  Repeated
    rows are counted each; an empty table gives no rows; other columns are not read.  A tree
    has two numbers per leaf and lives as long as its row is worked on.
    """

    def run(batches):
        bpe = load_bpe(path, pattern)
        for batch in batches:
            for part in slices(batch):
                edits = part["edits"].to_pylist()
                given = lambda i, text: [(e["start"], e["end"], e["text"] or "") for e in edits[i] or ()]  # noqa: B023, E731
                yield _lines(part["doc_id"].to_pylist(), part, given, bpe)

    rows = docs.select(F.col("doc_id").cast("long"), "text", "edits")
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in _NAMES))


def count_redacted(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``count_edited`` of ``with_redactions``, found and applied in one pass over the texts; the same rules hold."""

    def run(batches):
        bpe = load_bpe(path, pattern)
        for batch in batches:
            for part in slices(batch):
                yield _lines(part["doc_id"].to_pylist(), part, lambda _, text: redactions(text), bpe)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{n} long" for n in _NAMES))
