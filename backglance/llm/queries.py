"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from backglance.llm import bpe, decontam, edits, knn, licenses, rules, secrets, shards, simhash, substrings, termmatrix, toxicity, whitening
from backglance.llm.words import small_batches
from backglance.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query; it runs with small Arrow batches."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        small_batches(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def byte_bpe() -> dict[str, str]:
    """File and pre-token pattern of the byte-level tokenizer."""
    import public_tokenizers

    return {"path": public_tokenizers.path("byte_bpe_50k.json"), "pattern": public_tokenizers.PATTERN}


@query
def op1_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(load_table(spark, folder, "documents"), load_table(spark, folder, "labels"))


@query
def op2_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(load_table(spark, folder, "documents"), shards=24)


@query
def op3_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(load_table(spark, folder, "documents"), "doc_id", load_table(spark, folder, "benchmark"))


@query
def op4_simhash_anchors(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, folder, "documents"), shingle=3, most=2, seed=42)


@query
def op5_edited_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return edits.count_redacted(load_table(spark, folder, "documents"), **byte_bpe())


@query
def op6_license_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(load_table(spark, folder, "documents"))


@query
def op7_recompression_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeat_digests(load_table(spark, folder, "documents"), window=20)


@query
def op8_rank_array_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(load_table(spark, folder, "documents"), **byte_bpe())


@query
def op9_neighbour_quality(spark: SparkSession, folder: str) -> DataFrame:
    return knn.score_quality(load_table(spark, folder, "documents"), load_table(spark, folder, "labels"))


@query
def op10_adaptive_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge_documents(load_table(spark, folder, "documents"))


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return termmatrix.audit_filters(load_table(spark, folder, "documents"), load_table(spark, folder, "labels"))


@query
def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(load_table(spark, folder, "documents"))


@query
def op13_exact_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(load_table(spark, folder, "embeddings"))


def _drawn(sql: str) -> str:
    """DRAW(x) written out: an exponential number from the MD5 of key and node."""
    uniform = r"CAST(CAST('0x' || substr(md5(key || '|' || CAST(\1 AS VARCHAR) || '|11'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496"
    return re.sub(r"DRAW\(([^()]*)\)", f"(-ln(1 - {uniform}))", sql)


# The hash tree in SQL, level by level: the least draw, over the weight below, of 2 regions, of the
# region's 3 racks, of the rack's 4 shards; the 25th shard is a third region of weight 1.  Slots
# follow the MD5 of the id.  The CRC is the bitwise one, byte by byte.
ORACLES["op2_hash_tree_shards"] = _drawn("""
WITH crc_table AS (
    SELECT list(c ORDER BY n) AS t FROM (
        SELECT n, list_reduce([n] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
        FROM (SELECT unnest(range(256)) AS n)
    )
), texts AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents
), sums AS (
    SELECT doc_id, key, strlen(text) + 8 AS size,
        xor(4294967295, list_reduce(
            [4294967295] || list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
            lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])
        )) AS text_crc32
    FROM texts, crc_table
), regions AS (
    SELECT *, list_min(list_transform(range(2), lambda n: {'draw': DRAW('region' || n) / 12, 'n': n})) AS region FROM sums
), racks AS (
    SELECT *, list_min(list_transform(range(3 * region.n, 3 * region.n + 3),
        lambda n: {'draw': DRAW('region' || region.n || '/rack' || n) / 4, 'n': n})).n AS rack
    FROM regions
), leaves AS (
    SELECT *, list_min(list_transform(range(4 * rack, 4 * rack + 4), lambda n: {'draw': DRAW(n), 'n': n})).n AS shard FROM racks
), placed AS (
    SELECT *, CASE WHEN DRAW('region2') < region.draw THEN 24 ELSE shard END AS grown_shard FROM leaves
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
""")

# All texts at once: words as lists, equal texts by their text, orders as tuples of five.
ORACLES["op11_filter_audit"] = """
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS earliest FROM texts
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), flags AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
        'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
        'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(earliest < words.doc_id, false)
    } AS f
    FROM words LEFT JOIN marks ON words.doc_id = marks.doc_id
), failing AS (
    SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x:
        CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS fails
    FROM flags
), alike AS (
    SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step - 1] AS before
    FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders)
), laid AS (
    SELECT *, list_contains(fails, x) AS now, len(list_filter(fails, lambda y: contains(before, y))) > 0 AS earlier FROM alike, steps
)
SELECT part, filter_order, step,
    CAST(coalesce(sum(n) FILTER (NOT now AND NOT earlier), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (now AND NOT earlier), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (now AND earlier), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (now AND len(fails) = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (now AND NOT earlier AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (now AND NOT earlier AND toxic), 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(sum(n * (120 // nullif(len(fails), 0))) FILTER (now), 0) AS BIGINT) AS shapley
FROM laid GROUP BY part, filter_order, step
"""
