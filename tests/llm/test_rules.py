"""Counts of the rules against plain Python, sketches against exact quartiles, and the verdict."""

import re
from functools import cache

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from backglance.llm import rules
from backglance.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab\n \t#é\x0b日", max_size=60)), max_size=6))
def test_counts(texts):
    found = rules._measures(pa.array(texts, pa.string()))
    assert [list(map(int, line)) for line in zip(*found)] == [plain(t) for t in texts]


def bucket(value):
    drop = max(value.bit_length() - 7, 0)
    return value >> drop << drop


def verdicts(rows):
    """doc_id -> (counts, base_failed, kept), by sorting every group's bucketed measures.

    A group's quantiles are weighted with those of its language, and those with all documents'.
    """
    def measures(c):
        n_words, chars, symbols, dup, repeats, lines = c
        return {
            "symbol_share": 1000 * symbols // max(chars, 1), "line_share": 1000 * dup // max(lines, 1),
            "repeat_share": 1000 * repeats // max(n_words, 1), "word_length": 100 * chars // max(n_words, 1),
        }

    counts = {r.doc_id: plain(r.text) for r in rows}
    failed = {d: c[0] < 10 or 100 * c[4] > 20 * c[0] for d, c in counts.items()}
    groups = {}
    for r in rows:
        if not failed[r.doc_id]:
            for group in ((), (r.lang,), (r.lang, r.source)):
                groups.setdefault(group, []).append(measures(counts[r.doc_id]))

    @cache
    def quantile(group, name, level):
        held = sorted(bucket(m[name]) for m in groups[group])
        own = held[max(0, -(-len(held) * level // 1000) - 1)]
        return own if not group else (len(held) * own + 100 * quantile(group[:-1], name, level)) / (len(held) + 100)

    found = {}
    for r in rows:
        ok = not failed[r.doc_id]
        if ok:
            for name, value in measures(counts[r.doc_id]).items():
                low, high = (quantile((r.lang, r.source), name, level) for level in rules.LEVELS[name])
                reach = max(rules.REACH[name] * (high - low), rules.LEAST_REACH[name])
                ok = ok and value <= high + reach and (name not in rules.BOTH_SIDES or value >= low - reach)
        found[r.doc_id] = (*counts[r.doc_id][:5], failed[r.doc_id], ok)
    return found


def test_query_against_plain_python(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_adaptive_rules"](spark, SF).collect()}
    assert found == verdicts(rows)
    assert sum(1 for v in found.values() if not v[5] and not v[6]) > 5


def test_buckets(spark):
    values = [*range(200), 2**20 + 12345, 2**40 + 7]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", rules.bucket_of(F.col("v")).alias("b")).collect()
    assert {r.v: r.b for r in rows} == {v: bucket(v) for v in values}


def test_clean_labelled_documents_stay(spark):
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in QUERIES["op10_adaptive_rules"](spark, SF).where("kept or n_words < 10").collect()}
    assert len(good - kept) <= 0.02 * len(good)


def test_sources_get_cutoffs_of_their_own(spark):
    """The same text is usual in a source of tables, and junk in a source of prose."""
    prose = "plain words of ordinary length stand in this text and nothing else is here at all"
    table = " | ".join(prose.split())
    rows = [(i, "en", "prose", f"{prose} w{i}") for i in range(400)] + [(1000 + i, "en", "tables", f"{table if i % 2 else prose} w{i}") for i in range(400)]
    rows += [(5000, "en", "prose", f"{table} x"), (5001, "en", "tables", f"{table} x")]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    found = {r.doc_id: r.kept for r in rules.judge_documents(frame).collect()}
    assert [d for d, ok in found.items() if not ok] == [5000]
    counted = rules.measure(frame)
    cut = {r.source: r.symbol_share_most for r in rules.thresholds(counted, ["lang", "source"]).collect()}
    assert cut["tables"] > 2 * cut["prose"]


def test_cutoffs_of_word_length_follow_the_sketches(spark):
    """On sf0.1 the cutoffs of word length differ between languages, and none is the least distance."""
    rows = rules.measure(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("n_words >= 10 and 100 * n_repeat_words <= 20 * n_words")
    found = rules.thresholds(rows, ["lang", "source"]).collect()
    mean = {lang: sum(r.word_length_most for r in found if r.lang == lang) / 20 for lang in ("en", "de", "fr", "es")}
    assert mean["de"] > mean["en"] + 20 and len({r.word_length_most for r in found}) > 40
    assert all(r.word_length_most - r.word_length_least > 2 * rules.LEAST_REACH["word_length"] for r in found)
