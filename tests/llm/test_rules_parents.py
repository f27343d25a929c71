"""Groups of few documents are judged with the quantiles of wider groups."""

from pyspark.sql import functions as F

from backglance.llm import rules

CLEAN = "plain words of ordinary length stand in this text and nothing else is here at all"
JUNK = "plain words #### of $$$$ ordinary **** length %%%% stand |||| in this &&&& text and nothing else is here"


def kept(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    return {r.doc_id: r.kept for r in rules.judge_documents(frame).collect()}


def test_junk_alone_in_its_source_goes(spark):
    rows = [(i, "en", f"s{i}", f"{CLEAN} w{i}") for i in range(200)]
    rows += [(1000 + i, "en", f"t{i}", f"{JUNK} w{i}") for i in range(10)]
    rows += [(2000, None, None, JUNK), (2001, "de", "t", JUNK)]  # no other document of their language
    found = kept(spark, rows)
    assert {d for d, ok in found.items() if not ok} == {*range(1000, 1010), 2000, 2001}


def test_a_source_with_over_a_quarter_of_junk_does_not_keep_it(spark):
    rows = [(i, "en", f"s{i % 5}", f"{CLEAN} w{i}") for i in range(400)]
    rows += [(1000 + i, "en", "few", f"{JUNK if i < 3 else CLEAN} x{i}") for i in range(7)]
    found = kept(spark, rows)
    assert {d for d, ok in found.items() if not ok} == {1000, 1001, 1002}


def test_quantiles_weigh_documents_at_every_size(spark):
    counts = {("en", "a"): (0, 100), ("en", "b"): (16, 1), ("de", "a"): (8, 300)}
    rows = [(lang, source, "symbol_share", bucket, n) for (lang, source), (bucket, n) in counts.items()]
    sketch = spark.createDataFrame(rows, "lang string, source string, measure string, bucket long, n long")
    found = {(r.lang, r.source): (r.low, r.high) for r in rules.weighted_quantiles(sketch, ["lang", "source"]).collect()}
    mix = lambda n, own, wider: (n * own + 100 * wider) / (n + 100)
    everything, en, de = 8, mix(101, 0, 8), mix(300, 8, 8)  # 300 of 401 documents lie at 8: the third quartile
    wanted = {("en", "a"): mix(100, 0, en), ("en", "b"): mix(1, 16, en), ("de", "a"): mix(300, 8, de)}
    assert everything == 8 and all(abs(found[g][1] - wanted[g]) < 1e-9 for g in wanted)


def test_sources_of_few_documents_are_judged_alike(spark):
    """The documents of sf0.1 dealt over 3,000 sources: nearly the verdicts of the sources as given."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    dealt = docs.withColumn("source", F.concat(F.lit("s"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3000))
    past = rules.judge_documents(dealt).where("not base_failed").select("doc_id", "kept")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 0")
    junk = [r.kept for r in past.join(labels, "doc_id").collect()]
    assert past.where("not kept").count() > 650
    assert len(junk) > 290 and sum(junk) <= 0.03 * len(junk)
