"""Shards by a weighted hash tree over regions, racks and shards.

A key descends from the root: every child of the node it has reached draws an exponential number
from a hash of key and child, at the rate of the weight of the child's subtree, and the least draw
wins; only the children of the chosen node are hashed.  A child is chosen with the share of its
weight.  A change of one weight changes the rates on one path only, so a key moves only where two
siblings' weights change against each other: at the first node where its old and new paths part,
it enters the child on the changed path (weight up) or leaves it (weight down).  Inside a subtree
that it enters it may reach any shard; a subtree whose weights stay sees no movement within.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from backglance.functions.hashing import unit_hash

# Rows of one key and text that one task writes out: larger groups of equal rows are split.
_RUN = 100_000
# Rows of a shard are numbered in this many parts; more parts for shards of over some 10^10 rows.
_PARTS_HEX = 3
# Shards that stand in full regions; later ones open regions of their own.
SETTLED = 24

Tree = Mapping[str, Mapping[str, Mapping[int, float]]]


def even_tree(shards: int, settled: int = SETTLED, per_rack: int = 4, racks: int = 3) -> Tree:
    """The first ``settled`` shards in regions of ``racks`` racks of ``per_rack`` shards, all of weight 1.

    Every later shard opens a region of its own.  A new region takes keys only into itself,
    so from ``settled`` shards on one more shard takes keys only into itself; one more shard in a
    standing region would also let keys enter the other shards of that region.
    """
    tree: dict = {}
    settled = min(shards, settled)
    for shard in range(settled):
        rack = shard // per_rack
        tree.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    regions, first_rack = len(tree), -(-settled // per_rack)
    for later in range(shards - settled):
        tree[f"region{regions + later}"] = {f"rack{first_rack + later}": {settled + later: 1.0}}
    return tree


def _node(name: str, weight: float, below: list[Column] | None = None) -> Column:
    fields = [F.lit(name).alias("name"), F.lit(float(weight)).alias("weight")]
    return F.struct(*fields, *([F.array(*below).alias("below")] if below else []))


def _tree_literal(tree: Tree) -> Column:
    """The regions as an array of name, weight of the subtree and what is below."""
    regions = []
    for region, racks in tree.items():
        nodes = [
            _node(f"{region}/{rack}", sum(shards.values()), [_node(str(shard), weight) for shard, weight in shards.items()])
            for rack, shards in racks.items()
        ]
        regions.append(_node(region, sum(sum(shards.values()) for shards in racks.values()), nodes))
    return F.array(*regions)


def _least_draw(key: Column, children: Column, last: bool, seed: int) -> Column:
    """Of the children the one with the least draw, with its name and what is below it."""

    def drawn(child: Column) -> Column:
        # 1 - u lies in (0, 1], so the draw is finite.
        draw = -F.log(1 - unit_hash(key, child["name"], seed=seed)) / child["weight"]
        return F.struct(draw.alias("draw"), child["name"].alias("name"), *([] if last else [child["below"].alias("below")]))

    return F.array_min(F.transform(children, drawn))


def assign_shards(df: DataFrame, key: str, tree: Tree, out: str = "shard", seed: int = 11) -> DataFrame:
    """Add the shard of each row; a null key is a key like any other.

    Equal keys share a shard whatever their text; rows keep their other columns.  ``tree``
    maps regions to racks to shards to weights; a weight must be positive, a shard must occur
    once, and no region or rack may be empty.  Between equal draws the smallest name wins.
    """
    racks = [shards for region in tree.values() for shards in region.values()]
    leaves = [leaf for shards in racks for leaf in shards.items()]
    if not leaves or min(w for _, w in leaves) <= 0 or len({s for s, _ in leaves}) < len(leaves):
        raise ValueError("a tree needs shards that occur once and have positive weights")
    if not all(tree.values()) or not all(racks):
        raise ValueError("a tree needs a shard in every region and rack")
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    region = _least_draw(text, _tree_literal(tree), False, seed)
    rack = _least_draw(text, region["below"], False, seed)
    shard = _least_draw(text, rack["below"], True, seed)
    return df.withColumn(out, shard["name"].cast("int"))


def number_rows(df: DataFrame, shard: str, key: str, out: str = "slot") -> DataFrame:
    """Number the rows of each shard 0, 1, 2 ... by the MD5 of the key, the key and the other columns.

    Equal rows are counted before the shuffle and written out at the end in runs, so a
    repeated row loads no task; rows of a shard are numbered in parts by their MD5.
    """
    columns = df.columns
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_order", order).withColumn("_part", F.substring("_order", 1, _PARTS_HEX))
    parts = rows.groupBy(shard, "_part").agg(F.sum("_n").alias("_size"))
    # One line per part: at most 16 ** _PARTS_HEX for a shard.
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(shard, "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(shard, "_part").orderBy("_order", *columns).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_within", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    rows = rows.join(parts, [shard, "_part"]).withColumn("_start", F.col("_base") + F.col("_within"))
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_RUN).cast("long")))
    rows = rows.withColumn("_run", runs)
    places = F.sequence(F.col("_run"), F.least(F.col("_run") + _RUN, F.col("_n")) - 1)
    return rows.select(*columns, F.explode(places).alias("_place"), "_start").select(
        *columns, (F.col("_start") + F.col("_place")).alias(out)
    )


def shard_documents(docs: DataFrame, shards: int = 24, settled: int = SETTLED) -> DataFrame:
    """One line per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 8 and 8 alone for a null text, whose CRC is
    that of the empty text; texts of any length are read whole.  ``grown_shard`` is the shard
    with one more shard in the tree, in a region of its own; ``settled`` has to stay the same
    as ``shards`` grows past it.  Null ids share a key, repeated rows share a shard and get
    slots of their own, an empty table gives no rows, and further columns of ``docs`` are not read.
    """
    settled = min(shards, settled)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    lines = assign_shards(lines, "doc_id", even_tree(shards, settled))
    lines = assign_shards(lines, "doc_id", even_tree(shards + 1, settled), out="grown_shard")
    lines = number_rows(lines, "shard", "doc_id")
    return lines.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
