"""The term matrix and the filter audit against plain Python."""

import re
from collections import Counter
from itertools import permutations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from backglance.llm import termmatrix, words

GOOD = " ".join(f"word{i}" for i in range(220))
ROWS = [
    (1, GOOD, "en"), (2, GOOD, "en"), (2, GOOD, "de"), (None, GOOD, "en"), (3, GOOD + " #", None), (4, "", ""), (5, None, "en"),
    (6, "SHOUT " * 250, "de"), (6, "SHOUT " * 250, "de"), (7, "few words only", "de"), (8, "few words only", "fr"), (9, " \t\x0b\n ", "fr"),
    (10, "same " * 300 + "é日🙂", "en"), (11, "Aa" * 60 + " $", "en"), (12, GOOD + "\x1c tail", "en"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 1), (8, 1, 1), (None, 1, 1), (99, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def plain(rows, labels):
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    documents = []
    for doc, text, lang in rows:
        text = text or ""
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" if len(found) < 200 else ""
        fails += "B" if 100 * len(set(found)) < 50 * len(found) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        fails += "D" if set(text) & set("#$%&*|") else ""
        fails += "E" if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows) else ""
        documents.append((lang or "", fails, doc in good, doc in toxic))
    orders = ["".join(p) for p in permutations("ABCDE")]
    shapley = Counter()
    for part, fails, *_ in documents:
        for order in orders:
            first = next((f for f in order if f in fails), None)
            shapley[part, first] += 1
    found = {}
    for part in {d[0] for d in documents}:
        mine = [d for d in documents if d[0] == part]
        for order in orders:
            for step, name in enumerate(order, 1):
                before = set(order[: step - 1])
                left = [d for d in mine if not before & set(d[1])]
                removed = [d for d in left if name in d[1]]
                found[part, order, step] = (
                    len(left) - len(removed), len(removed), sum(name in d[1] and bool(before & set(d[1])) for d in mine),
                    sum(d[1] == name for d in mine), sum(d[2] for d in removed), sum(d[3] for d in removed), shapley[part, name],
                )
    return found


@pytest.mark.parametrize("slice_bytes", [4 << 20, 100])
def test_audit_against_plain_python(docs, labels, monkeypatch, slice_bytes):
    monkeypatch.setattr(words.slices, "__defaults__", ("text", slice_bytes))
    found = {tuple(r)[:3]: tuple(r)[3:] for r in termmatrix.audit_filters(docs, labels).collect()}
    assert found == plain(ROWS, LABELS)


@pytest.mark.parametrize("targets", [1, 7])
def test_matrix_has_global_numbers_and_counts(docs, monkeypatch, targets):
    """The same word has one number in every shard, whatever the number of targets."""
    monkeypatch.setattr(termmatrix, "targets_for", lambda docs: targets)
    numbers = {r.term: r.word for r in termmatrix.dictionary(termmatrix.local_shards(docs, targets), targets).collect()}
    assert sorted(numbers.values()) == sorted({w for _, t, _ in ROWS for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")})
    found = Counter()
    for shard in termmatrix.csr_shards(docs).collect():
        for i, doc in enumerate(shard.doc_id):
            entries = slice(shard.first[i], shard.first[i + 1])
            assert shard.terms[entries] == sorted(set(shard.terms[entries]))
            found[doc, frozenset((numbers[t], n) for t, n in zip(shard.terms[entries], shard.counts[entries]))] += 1
    wanted = Counter()
    for doc, text, _ in ROWS:
        wanted[doc, frozenset(Counter(re.findall(r"[^\x20\x09-\x0D]+", text or "")).items())] += 1
    assert found == wanted


def test_edges(docs, labels):
    assert termmatrix.audit_filters(docs.limit(0), labels).count() == 0
    alone = termmatrix.audit_filters(docs, labels.limit(0))
    assert alone.agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[:] == (0, 0)
    clash = {c: F.lit(1) for c in ("part", "shard", "words", "term", "failed", "quality", "toxic", "n", "s", "_earliest", "of", "target", "joined")}
    wide = termmatrix.audit_filters(docs.withColumns(clash), labels.withColumns({"part": F.lit(1), "failed": F.lit(2), "text": F.lit("x")}))
    assert sorted(wide.collect()) == sorted(termmatrix.audit_filters(docs, labels).collect())


def test_a_frequent_word_costs_one_entry_per_shard(spark):
    rows = spark.createDataFrame([(i, "the " * 50 + f"own{i}", "en") for i in range(400)], "doc_id long, text string, lang string").repartition(4)
    for shard in termmatrix.local_shards(rows, 3).collect():
        sent = [w for line in shard.words for w in bytes(line.joined).split(b"\n")]
        assert sent.count(b"the") == 1 and len(sent) == len(set(sent))


def test_a_written_shard_is_a_row_group_of_its_own(spark, docs, monkeypatch):
    """A reader holds the lists of all rows of a group at once, so its memory must not grow with the shards of a file."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    pinned, pin = [], termmatrix.pin
    monkeypatch.setattr(termmatrix, "pin", lambda df, *a, **k: pinned.append(pin(df, *a, **k)) or pinned[-1])
    spark.conf.set(setting, 2)
    try:
        n_rows = sum(len(shard.doc_id) for shard in termmatrix.csr_shards(docs.coalesce(1)).collect())
    finally:
        spark.conf.set(setting, before)
    files = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in pinned[0].inputFiles()]
    groups = [file.row_group(i).num_rows for file in files for i in range(file.num_row_groups)]
    assert n_rows == len(ROWS) and set(groups) == {1} and len(groups) > len(files) == 1
