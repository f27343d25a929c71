"""The hash tree's law, its slots and its weights."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

from backglance.llm import shards
from backglance.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.01"


def test_query_holds_its_laws(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_hash_tree_shards"](spark, SF).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r.grown_shard == 24 for r in rows) and len(slots) == 24


def test_query_agrees_with_sql(spark):
    assert difference(QUERIES["op2_hash_tree_shards"](spark, SF), connect(SF), ORACLES["op2_hash_tree_shards"]) is None


def placed(spark, tree, n=20_000):
    return {r.id: r.shard for r in shards.assign_shards(spark.range(n), "id", tree).collect()}


def test_any_number_of_shards_grows_into_the_new_one_alone(spark):
    before = placed(spark, shards.even_tree(24), 3000)
    for n in range(25, 39):
        after = placed(spark, shards.even_tree(n), 3000)
        assert all(after[i] in (before[i], n - 1) for i in before)
        assert abs(Counter(after.values())[n - 1] / 3000 - 1 / n) < 0.015
        before = after


def paths(tree):
    return {s: (region, rack, s) for region, racks in tree.items() for rack, leaves in racks.items() for s in leaves}


def test_weights_steer_and_confine_movement(spark):
    tree = {"east": {"a": {0: 1.0, 1: 1.0}, "b": {2: 2.0}}, "west": {"c": {3: 4.0}, "a": {4: 2.0, 5: 2.0}}}
    heavier = {"east": {"a": {0: 1.0, 1: 3.0}, "b": {2: 2.0}}, "west": tree["west"]}
    before, after, path = placed(spark, tree), placed(spark, heavier), paths(tree)
    for found, total, weights in ((before, 12, {0: 1, 1: 1, 2: 2, 3: 4, 4: 2, 5: 2}), (after, 14, {0: 1, 1: 3, 2: 2, 3: 4, 4: 2, 5: 2})):
        counts = Counter(found.values())
        assert all(abs(counts[s] / 20_000 - w / total) < 0.015 for s, w in weights.items())
    # Where the paths part, the new one follows the changed path, and the way back leaves it there.
    moved = [(path[before[i]], path[after[i]]) for i in before if before[i] != after[i]]
    parted = Counter(next(k for k in range(3) if old[k] != new[k]) for old, new in moved)
    assert set(parted) == {0, 1, 2}
    for old, new in moved:
        level = next(k for k in range(3) if old[k] != new[k])
        assert new[: level + 1] == path[1][: level + 1] and old[: level + 1] != path[1][: level + 1]
    assert not any(old[0] == new[0] == "west" for old, new in moved)


def test_descent_against_plain_python(spark):
    import hashlib
    import math

    tree = {"east": {"a": {0: 1.0, 1: 0.5}, "b": {2: 2.0}}, "west": {"a": {7: 4.0, 5: 3.0}}}

    def draw(key, name, weight):
        u = int(hashlib.md5(f"{key}|{name}|11".encode()).hexdigest()[:13], 16) / 2**52
        return -math.log(1 - u) / weight, str(name)

    def descend(key):
        region = min(tree, key=lambda r: draw(key, r, sum(sum(x.values()) for x in tree[r].values())))
        rack = min(tree[region], key=lambda k: draw(key, f"{region}/{k}", sum(tree[region][k].values())))
        return min(tree[region][rack], key=lambda s: draw(key, s, tree[region][rack][s]))

    assert placed(spark, tree, 2000) == {i: descend(i) for i in range(2000)}


def test_null_ids_clashing_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, shard string, _n int, _part int, _order int, slot int, size int"
    rows = [(None, None, "x", 1, 1, 1, 1, 1), (None, "\u00e9", None, 2, 2, 2, 2, 2), (3, "", "y", 3, 3, 3, 3, 3), (3, "", "y", 3, 3, 3, 3, 3)]
    found = shards.shard_documents(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id is None, r["size"]) for r in found) == [(False, 8), (False, 8), (True, 8), (True, 10)]
    assert len({r.shard for r in found if r.doc_id is None}) == 1 == len({r.shard for r in found if r.doc_id == 3})
    assert sorted(r.slot for r in found if r.doc_id == 3) in ([0, 1], [2, 3], [1, 2])
    assert shards.shard_documents(spark.createDataFrame([], schema)).count() == 0


def test_a_row_repeated_many_times_gets_gapless_slots(spark, monkeypatch):
    monkeypatch.setattr(shards, "_RUN", 100)
    docs = spark.range(2500).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    rows = shards.shard_documents(docs, 3).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == 2500 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bad_trees_are_errors(spark):
    import pytest

    for tree in ({}, {"r": {"a": {0: 0.0}}}, {"r": {"a": {0: 1.0}, "b": {0: 1.0}}}, {"r": {"a": {0: 1.0}, "b": {}}}, {"r": {"a": {0: 1.0}}, "s": {}}):
        with pytest.raises(ValueError):
            shards.assign_shards(spark.range(1), "id", tree)
