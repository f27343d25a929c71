"""Rows of equal id and text: one line in the buckets, every row in the result."""

import hashlib
from collections import Counter

import pyarrow as pa

from backglance.llm import substrings

PASSAGE = " ".join(f"p{i}" for i in range(30))


def plain(rows, window=20):
    """Lines of all rows, in the order of the ids (null last); rows of one id here have one text."""
    seen, found = set(), Counter()
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")):
        words = (text or "").split()
        keep = [True] * len(words)
        for i in range(len(words) - window + 1):
            gram = tuple(words[i : i + window])
            if gram in seen:
                keep[i : i + window] = [False] * window
            seen.add(gram)
        kept = " ".join(w for w, k in zip(words, keep) if k)
        found[doc, len(words), keep.count(False), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return found


def test_repeated_rows_follow_the_first(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(substrings, "_RUN", 7)
    period = " ".join(["x", "y"] * 30)
    rows = [(5, f"before {PASSAGE} after")] * 100 + [(3, "few words only")] * 40 + [(7, PASSAGE)] * 8 + [(9, None)] * 15
    rows += [(None, f"no id {PASSAGE}")] * 50 + [(6, period)] * 9 + [(2, f"{PASSAGE} own")] + [(11, "")] * 14
    rows += [(20 + i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substrings.repeat_digests(frame)
    assert Counter(tuple(r) for r in found.collect()) == plain(rows)


def test_a_bucket_holds_a_repeated_row_once(spark, monkeypatch, tmp_path):
    """No bucket sees more rows than there are distinct ones."""
    names_of = substrings._names_of

    def counted(*given):
        run, folder = names_of(*given), str(tmp_path)

        def count(table: pa.Table) -> pa.Table:
            with open(f"{folder}/{table['bucket'][0].as_py()}", "w") as out:
                out.write(str(table.num_rows))
            return run(table)

        return count

    monkeypatch.setattr(substrings, "_names_of", counted)
    rows = [(1, PASSAGE)] * 3000 + [(None, f"no id {PASSAGE}")] * 2000 + [(i, f"other {i}") for i in range(10, 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert substrings.repeat_digests(frame).count() == 5010
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 12
