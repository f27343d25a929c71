"""Every operator and stage on empty tables, nulls, ties, repeated rows, long texts and clashing names."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from backglance.llm import bpe, decontam, edits, knn, licenses, queries, rules, secrets, shards, simhash, substrings, termmatrix, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
ROWS = [
    (1, "You stupid idiot, what a pathetic loser.", "en", "a", 40),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "no id at all here", "en", None, 17),
    (None, None, None, "b", None),
    (4, LONG, "en", "a", len(LONG)),
    (5, " \t\n ", "en", "a", 4),
    (6, "one two three four five six seven eight nine ten eleven twelve", "en", "b", 62),
    (6, "one two three four five six seven eight nine ten eleven twelve", "en", "b", 62),
    (7, "x" * 5000 + " é 日本 🙂 <|endoftext|>", "de", "b", 5020),
]
CLASH = ["_row", "bits", "bucket", "_key", "key", "_id", "features", "score", "_leaks"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(8)] + [(None, 1, 1), (1, None, None), (1, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta epsilon. zeta eta theta."), (2, None), (3, ""), (1, "zzz")], "item_id long, text string")


def operators(labels, items):
    tokens = queries.byte_bpe()
    return {
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "shards": shards.shard_documents,
        "simhash": simhash.near_duplicates,
        "edits": lambda d: edits.count_edited(edits.with_redactions(d), **tokens),
        "repeats": substrings.repeat_digests,
        "bpe": lambda d: bpe.token_digests(d, **tokens),
        "quality": lambda d: knn.score_quality(d, labels),
        "rules": rules.judge_documents,
    }


NAMES = ["toxicity", "shards", "simhash", "edits", "repeats", "bpe", "quality", "rules"]


@pytest.mark.parametrize("name", NAMES)
def test_one_line_per_row_whatever_it_holds(docs, labels, items, name):
    run = operators(labels, items)[name]
    found = run(docs).select("doc_id").collect()
    assert sorted((r[0] is None, r[0]) for r in found if r[0] is not None) == sorted((False, r[0]) for r in ROWS if r[0] is not None)
    assert len(found) == len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_gives_no_rows(docs, labels, items, name):
    assert operators(labels, items)[name](docs.limit(0)).count() == 0


def test_finders_on_edges(docs, items):
    for frame in (docs, docs.limit(0)):
        assert decontam.find_leaks(frame, "doc_id", items).count() == 0
        assert decontam.find_leaks(frame, "doc_id", items.limit(0)).count() == 0
        assert licenses.find_licenses(frame).count() == 0


def test_without_labels(docs, labels):
    assert {r.predicted for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0}
    assert {r.score for r in knn.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_stages_keep_columns_and_extra_ones(spark, docs, labels, items, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    wide = docs.withColumns({name: F.lit(i) for i, name in enumerate(CLASH)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, str(tmp_path))
        assert out.dtypes == wide.dtypes
        assert out.count() <= len(ROWS)
        assert stage(spark, wide.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"


def test_near_duplicate_stage_keeps_one_of_each_group(docs):
    kept = simhash.drop_near_duplicates(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 4, 6, 7]
    assert [r.text for r in kept if r.doc_id is None] == ["no id at all here"]


# Names that the operators give to columns of their own.
HELPERS = """
_all _base _earliest _hash _id _key _label _least _left _md5 _n _order _part _place _print _run _start _times _until
anchor base_failed bits bucket component_id copies counts docs draw fingerprint grown_shard held_out high ids ids_sha256
item_id key kept label license low measure n n_tokens n_words names part predicted score shard size slot spans target
text_crc32 times weight word x y
""".split()


def lines(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("name", [*NAMES, "leaks", "licenses", "audit", "secrets"])
def test_extra_columns_with_clashing_names_change_nothing(docs, labels, items, name):
    more = {
        "leaks": lambda d: decontam.find_leaks(d, "doc_id", items),
        "licenses": licenses.find_licenses,
        "audit": lambda d: termmatrix.audit_filters(d, labels),
        "secrets": secrets.find_secrets,
    }
    run = {**operators(labels, items), **more}[name]
    wide = docs.withColumns({helper: F.lit(i) for i, helper in enumerate(HELPERS)})
    assert lines(run(wide)) == lines(run(docs))


def test_a_text_longer_than_a_slice_counts_whole(spark, docs, labels, items):
    text = LONG + " " + " ".join(f"more{i % 50_021}" for i in range(600_000)) + " password=abcdefghijklmn"
    assert len(text) > 5 << 20
    rows = docs.where("doc_id in (1, 7)").union(spark.createDataFrame([(77, text, "en", "a", len(text))], DOCS)).coalesce(1)
    (shard,) = shards.shard_documents(rows).where("doc_id = 77").collect()
    assert (shard.size, shard.text_crc32) == (len(text) + 8, zlib.crc32(text.encode()))
    (rule,) = rules.judge_documents(rows).where("doc_id = 77").collect()
    assert (rule.n_words, rule.word_chars) == (660_001, len(text) - 660_000)
    (secret,) = secrets.find_secrets(rows).where("doc_id = 77").collect()
    assert secret.spans == f"assign:{len(text) - 23}:{len(text)}"
    (repeat,) = substrings.repeat_digests(rows).where("doc_id = 77").collect()
    kept = " ".join([*text.split()[:997], *[f"more{i}" for i in range(50_021)], "password=abcdefghijklmn"])
    assert (repeat.n_words, repeat.kept_sha256) == (660_001, hashlib.sha256(kept.encode()).hexdigest())
    for run in (lambda d: toxicity.score_toxicity(d, labels), lambda d: knn.score_quality(d, labels)):
        (line,) = run(rows).where("doc_id = 77").collect()
        assert 0 <= line.score <= 1 and line.predicted in (0, 1)
