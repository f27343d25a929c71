"""Licence texts in documents by patience alignment with templates.

Anchors are words that stand once in a stretch of text and once in the template.  The longest
increasing subsequence of their places is kept, the stretches between them are aligned the same
way, and words that are equal at the ends of a stretch are matched first.  Coverage is
the share of a template's words that are matched in order.

A stretch of one and a half template lengths is aligned where it holds enough words of the
template to reach the wanted coverage.  Notices with longer foreign passages inside come from
runs: all places where four words in a row stand in the template are anchors, the longest increasing
subsequence of their places in the whole text is kept, whatever lies between them, and the gaps are
aligned in the same way.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backglance.llm.decontam import plain
from backglance.llm.license_texts import TEMPLATES
from backglance.llm.words import Words, slices, words_of

COVERAGE = 0.8
# Words in a row that are anchors wherever they stand.
RUN = 4
# Different words of all templates stay below this, so that a run of four fits a number.
_MANY = 1 << 15


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs in order of their first number, the most whose second numbers increase: patience piles."""
    tops: list[int] = []
    heads: list[int] = []
    before: list[int] = []
    for i, (_, second) in enumerate(pairs):
        pile = bisect_left(tops, second)
        before.append(heads[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(second)
            heads.append(i)
        else:
            tops[pile], heads[pile] = second, i
    chain, at = [], heads[-1] if heads else -1
    while at >= 0:
        chain.append(pairs[at])
        at = before[at]
    return chain[::-1]


def align(text: Sequence, template: Sequence) -> list[tuple[int, int]]:
    """Matched places (in the text, in the template), both increasing."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            matched.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matched.append((b, d))
        if a == b or c == d:
            continue
        once: dict = {}
        for i in range(a, b):
            once[text[i]] = -1 if text[i] in once else i
        seen: dict = {}
        for j in range(c, d):
            seen[template[j]] = -1 if template[j] in seen else j
        pairs = sorted((i, seen[w]) for w, i in once.items() if i >= 0 and seen.get(w, -1) >= 0)
        at, ct = a, c
        chain = _longest_increasing(pairs)
        for i, j in chain:
            matched.append((i, j))
            todo.append((at, i, ct, j))
            at, ct = i + 1, j + 1
        if chain:
            todo.append((at, b, ct, d))
    return sorted(matched)


def _stretches(hits: np.ndarray, first: np.ndarray, length: int, need: int) -> list[tuple[int, int, int]]:
    """(document, start, end) of stretches of 1.5 template lengths with enough words of the template."""
    width, step = length + math.ceil(length / 2), max(1, length // 4)
    if not len(hits):
        return []
    # Only starts a quarter before a hit matter; step over the words in quarters of the template.
    owner = np.searchsorted(first, hits, "right") - 1
    block = (hits - first[owner]) // step
    starts = np.unique(np.concatenate([first[owner] + np.maximum(block - k, 0) * step for k in range(-(-width // step))]))
    owner = np.searchsorted(first, starts, "right") - 1
    ends = np.minimum(starts + width, first[owner + 1])
    enough = np.searchsorted(hits, ends) - np.searchsorted(hits, starts) >= need
    return list(zip(owner[enough].tolist(), starts[enough].tolist(), ends[enough].tolist()))


def _runs(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where ``RUN`` known words follow each other in a document, and a number for those words."""
    held = np.flatnonzero(codes >= 0)
    if len(held) < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.searchsorted(first, held, "right") - 1
    back = RUN - 1
    starts = held[:-back][(held[back:] - held[:-back] == back) & (owner[back:] == owner[:-back])]
    keys = np.zeros(len(starts), np.int64)
    for k in range(RUN):
        keys = keys * _MANY + codes[starts + k]
    return starts, keys


def chain(text: Sequence, places: Sequence[int], runs: Sequence[Sequence[int]], template: Sequence) -> list[tuple[int, int]]:
    """Matched places of a whole text: ``runs[n]`` says where in the template the run at ``places[n]`` stands.

    A gap is aligned whole up to four times its words in the template, and else at
    its ends of twice that, so that single words far from any run don't count.
    """
    pairs = {(i + k, j + k) for i, js in zip(places, runs) for j in js for k in range(RUN)}
    # Of pairs with the same place in the text only one can be kept: later places in the template first.
    kept = _longest_increasing(sorted(pairs, key=lambda pair: (pair[0], -pair[1])))
    matched, at, ct = list(kept), 0, 0
    for i, j in [*kept, (len(text), len(template))]:
        reach = 2 * (j - ct)
        if i > at and reach:
            near = range(at, i) if i - at <= 2 * reach else [*range(at, at + reach), *range(i - reach, i)]
            matched += [(near[a], ct + c) for a, c in align([text[n] for n in near], template[ct:j])]
        at, ct = i + 1, j + 1
    return sorted(matched)


def scan(words: Words, templates: Mapping[str, Sequence[bytes]], coverage: float = COVERAGE) -> list[tuple[int, str, float, int, int, int]]:
    """(document, template, coverage, first word, last word, matched words) of the best place of each pair found."""
    vocabulary = [plain(w) for w in words.vocabulary.to_pylist()]
    known: dict[bytes, int] = {}
    for template in templates.values():
        for word in template:
            known.setdefault(word, len(known))
    if len(known) >= _MANY:
        raise ValueError(f"templates of {_MANY} or more different words")
    place = np.fromiter((known.get(w, -1) for w in vocabulary), np.int64, len(vocabulary))
    codes = place[words.codes]  # equal words have equal codes; words of no template are -1
    held = np.flatnonzero(codes >= 0)
    run_starts, run_keys = _runs(codes, words.first)
    found = []
    for name, template in templates.items():
        own = np.array([known[w] for w in template])
        member = np.zeros(len(known), bool)
        member[own] = True
        need = math.ceil(coverage * len(template))
        best: dict[int, tuple] = {}

        def take(document: int, matched: list[tuple[int, int]]) -> None:
            if len(matched) >= need:
                low = int(words.first[document])
                line = (len(matched), low - matched[0][0], low - matched[-1][0])
                best[document] = max(best.get(document, line), line)

        mine = held[member[codes[held]]]
        for document, start, end in _stretches(mine, words.first, len(template), need):
            text = [c if c >= 0 else None for c in codes[start:end].tolist()]
            take(document, [(start + i, j) for i, j in align(text, own.tolist())])
        of_run: dict[int, list[int]] = {}
        for j, key in enumerate(_runs(own, np.array([0, len(own)]))[1].tolist()):
            of_run.setdefault(key, []).append(j)
        hits = np.flatnonzero(np.isin(run_keys, np.array(list(of_run), np.int64)))
        owner = np.searchsorted(words.first, run_starts[hits], "right") - 1
        for document in np.unique(owner).tolist():
            low, high = int(words.first[document]), int(words.first[document + 1])
            inside = hits[np.searchsorted(owner, document) : np.searchsorted(owner, document, "right")]
            # One run in a text gives no more than its stretch, and a text cannot match words that it lacks.
            if len(inside) < 2 or np.searchsorted(mine, high) - np.searchsorted(mine, low) < need or best.get(document, (0,))[0] == len(own):
                continue
            text = [c if c >= 0 else None for c in codes[low:high].tolist()]
            runs = [of_run[key] for key in run_keys[inside].tolist()]
            matched = chain(text, (run_starts[inside] - low).tolist(), runs, own.tolist())
            take(document, [(low + i, j) for i, j in matched])
        found += [(d, name, n / len(template), -a, -b, n) for d, (n, a, b) in best.items()]
    return sorted(found)


def template_words(templates: Mapping[str, str] = TEMPLATES) -> dict[str, list[bytes]]:
    return {name: [plain(w) for w in text.encode().split()] for name, text in templates.items()}


def find_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, coverage, first_word, last_word and n_matched of every template found in a row's whole text.

    Of several places the one with most matched words counts, the first of equals; runs of four
    words count together over the whole text, also those of several incomplete copies.  Texts of
    any length are scanned whole.  Null and empty texts have no licence; null ids stay null; repeated rows are scanned each; an empty
    table gives no rows; other columns are not read.  Templates without a word are left out.
    """
    wanted = {name: words for name, words in template_words(templates).items() if words}
    names = ["doc_id", "license", "coverage", "first_word", "last_word", "n_matched"]
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = scan(words_of(part["text"]), wanted, coverage)
                columns = list(zip(*found)) if found else [[] for _ in range(6)]
                keys = part["doc_id"].take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, k) for c, k in zip(columns[1:], kinds)]], names)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, license string, coverage double, first_word long, last_word long, n_matched long")
