"""Repeated passages by recompression against a plain search for equal windows."""

import hashlib
import random

import pytest

from backglance.llm import substrings
from backglance.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(rows, window):
    seen, found = set(), {}
    for doc, text in sorted(rows):
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            gram = tuple(words[i : i + window])
            if gram in seen:
                keep[i : i + window] = [False] * window
            seen.add(gram)
        kept = [w for w, k in zip(words, keep) if k]
        found[doc] = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return found


def lines(frame):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in frame.collect()}


@pytest.mark.parametrize("size", [60_000, 8 << 20])
def test_query_against_plain_python(spark, monkeypatch, size):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", size)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = lines(QUERIES["op7_recompression_repeats"](spark, SF))
    assert found == plain(rows, 20)
    assert sum(r[1] for r in found.values()) > 10_000


@pytest.mark.parametrize("seed", range(3))
def test_runs_periods_and_edges_of_windows(spark, monkeypatch, seed):
    """Few words, so that runs, periods and chance repeats abound; passages cut at every length near a window."""
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2_000)
    draw = random.Random(seed)
    passage = [draw.choice("abcdefgh") for _ in range(70)]
    rows = []
    for doc in range(150):
        words = [draw.choice("abc") + str(draw.randint(0, 30)) for _ in range(draw.randint(0, 40))]
        at, size = draw.randint(0, 40), draw.randint(17, 30)
        words += passage[at : at + size]
        words += ["r"] * draw.choice([0, 1, 2, 19, 20, 21, 45])
        words += ["p", "q"] * draw.choice([0, 1, 9, 10, 11, 30])
        words += [draw.choice("xyz") for _ in range(draw.randint(0, 25))]
        rows.append((doc * 3, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert lines(substrings.repeat_digests(frame)) == plain(rows, 20)


def test_other_windows_need_room_for_the_edges(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError):
        substrings.repeat_digests(frame, window=14)


def test_stage_changes_only_texts_with_repeats(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"start\n{passage}  end", 1), (2, f"other {passage} tail\tkept", 2), (3, passage, 3), (4, "clean\n text", 4), (5, None, None)]
    kept = {r.doc_id: r for r in substrings.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert kept[1].text == rows[0][1] and kept[4].text == "clean\n text" and kept[4].n_chars == 4
    assert kept[2].text == "other tail kept" and kept[2].n_chars == 15
    assert 3 not in kept and kept[5].text is None
