"""SimHash fingerprints, links and components against plain Python."""

import random
import re
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from backglance.llm import simhash
from backglance.llm.graph import connected_components
from backglance.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, most):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for x, y in combinations(sorted(nodes), 2):
        if (x ^ y).bit_count() <= most:
            a, b = find(x), find(y)
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_query_against_plain_python(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    component = plain_components(set(prints.values()), 2)
    least = {}
    for doc, bits in prints.items():
        least[component[bits]] = min(doc, least.get(component[bits], doc))
    wanted = {doc: (f"{bits:016x}", least[component[bits]]) for doc, bits in prints.items()}
    found = QUERIES["op4_simhash_anchors"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == wanted
    assert len(set(least.values())) < len(rows)


def test_spark_hashes_agree(spark):
    row = spark.createDataFrame([("añb c",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == xxhash.xxh64_intdigest("añb c".encode(), 42)


def test_links_are_all_pairs_within_the_distance(spark):
    draw = random.Random(3)
    prints = {0, 2**64 - 1}
    for _ in range(25):
        base = draw.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            flipped = base
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                flipped ^= 1 << bit
            prints.add(flipped)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "bits long")
    for most in (0, 1, 2):
        found = {frozenset((r.x % 2**64, r.y % 2**64)) for r in simhash.links(frame, "bits", most).collect()}
        wanted = {frozenset(p) for p in combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= most}
        assert found == wanted
    assert simhash.links(frame, "bits", 2).count() == len(wanted)


def test_the_code_is_perfect_with_radius_three():
    assert all(len(simhash._steps(0)[s, 0]) == 1 for s in range(1 << simhash.CHECKS))


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(9, 8), (8, 7), (7, 9), (3, 3), (None, 1)]
    found = connected_components(spark.createDataFrame(edges, "p long, q long"), "p", "q")
    wanted = {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 540)}, 7: 7, 8: 7, 9: 7}
    assert {r.node: r.root for r in found.collect()} == wanted and found.count() == len(wanted)


def test_a_large_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same few words in all of them").alias("text"))
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {0}
