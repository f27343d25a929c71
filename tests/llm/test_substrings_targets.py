"""Known windows return to their own bucket: no target takes those of all buckets."""

from collections import Counter

import numpy as np
import pyarrow as pa

from backglance.llm import substrings


def test_no_target_takes_the_known_windows_of_all_buckets():
    """A third of all rows are copies; every bucket knows that their windows repeat."""
    buckets, passage = 12, " ".join(f"p{i}" for i in range(60))
    run = substrings._windows_of(buckets, 20, substrings.ROUNDS, substrings.LEAST)
    sent, compared = Counter(), Counter()
    for b in range(buckets):
        texts = [passage if i % 3 == 0 else " ".join(f"w{b}x{i}x{k}" for k in range(50)) for i in range(30)]
        ids = np.arange(30) + 100 * b
        columns = {"bucket": np.full(30, b, np.int32), "_key": ids, "_print": ids, "_id": ids, "text": texts}
        copies = ids[np.arange(30) % 3 == 0]
        told = pa.table({"bucket": pa.array([b], pa.int32()), "names": pa.array([[]], pa.list_(pa.int64())), "copies": pa.array([copies.tolist()])})
        found = run(pa.table(columns), told).to_pydict()
        for target, own, known, high in zip(found["target"], found["bucket"], found["known"], found["high"]):
            sent[target] += len(known)
            compared[target] += len(high)
            assert own == b and (not known or target == b)
    assert sum(sent.values()) == buckets * 10 * 41 and set(sent) >= set(range(buckets))
    assert max(sent.values()) <= 3 * np.median(list(sent.values()))


def test_copies_of_a_third_of_all_rows(spark, monkeypatch):
    """Whole copies lose all their words but for the first, over many buckets."""
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 4_000)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage if i % 3 == 0 else " ".join(f"w{i}x{k}" for k in range(40))) for i in range(1, 301)]
    found = {r.doc_id: r.n_removed for r in substrings.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: 60 if i % 3 == 0 and i > 3 else 0 for i, _ in rows}
