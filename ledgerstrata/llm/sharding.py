"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless

#: Fixed shape of the tree: shards of a rack, racks of a region.
RACK, REGION = 4, 2

Tree = list[list[list[int]]]


def tree(shards: int, rack: int = RACK, region: int = REGION) -> Tree:
    """Regions of racks of shard numbers."""
    racks = [list(range(i, min(i + rack, shards))) for i in range(0, shards, rack)]
    return [racks[i : i + region] for i in range(0, len(racks), region)]


def grown(layout: Tree) -> Tree:
    """The tree with one more shard in a region of its own, so that no total of the others changes."""
    return [*layout, [[1 + max(s for region in layout for rack in region for s in rack)]]]


def _descend(key: Column, level: int, nodes: list[tuple[int, float, Column]]) -> Column:
    """The result of the node with the best draw; `nodes` are (number, total weight, result)."""

    def draw(number: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(number)), 11)
        return F.log((bits.cast("double") + 0.5) / F.lit(float(2**53))) / F.lit(weight)

    alive = [node for node in nodes if node[1] > 0]
    if len(alive) == 1:
        return alive[0][2]
    drawn = [F.struct(draw(number, weight).alias("draw"), F.lit(number).alias("node")) for number, weight, _ in alive]

    def chosen(node: Column) -> Column:
        taken = F.when(node == alive[0][0], alive[0][2])
        for number, _, result in alive[1:]:
            taken = taken.when(node == number, result)
        return taken

    return F.transform(F.array(F.greatest(*drawn)["node"]), chosen)[0]


def shard_of(key: Column, layout: Tree, weights: Sequence[float] | None = None) -> Column:
    """The shard of a key: descend region, rack and shard, each time to the child of the best weighted draw.

    Every node draws log(u) / weight, u a hash of key, level and number in (0, 1) and weight the total below it, so a
    child is chosen in proportion to its weight. A changed weight changes the draws of the nodes above it alone: rows
    move into or out of these subtrees and, inside them, by the same rule; all others stay. Ties go to the greater number.
    """
    numbers = [s for region in layout for rack in region for s in rack]
    weights = [1.0] * len(numbers) if weights is None else list(map(float, weights))
    if len(weights) != len(numbers) or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("one weight for each shard, none negative, not all zero")
    weight = dict(zip(numbers, weights, strict=True))
    regions, n_racks = [], 0
    for r, region in enumerate(layout):
        racks = []
        for rack in region:
            leaves = [(s, weight[s], F.lit(s)) for s in rack]
            total = sum(w for _, w, _ in leaves)
            racks.append((n_racks, total, _descend(key, 2, leaves) if total else F.lit(None).cast("int")))
            n_racks += 1
        total = sum(w for _, w, _ in racks)
        regions.append((r, total, _descend(key, 1, racks) if total else F.lit(None).cast("int")))
    return _descend(key, 0, regions)


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Deal documents into shards by the law `key`: doc_id and shard count alone decide.

    Returns doc_id, size (UTF-8 bytes plus 1; null text: 1), text_crc32 (null text: that of no bytes), law, shard, slot
    (gapless from 0 in each shard) and grown_shard (with one more shard, in a region of its own). A null doc_id is a key like any other;
    repeated rows get the same shard and slots of their own. An empty table gives no rows. Other columns are not read.
    Only numbers are shuffled, never a text; `bases` of the slots are shards times buckets rows.
    """
    data = F.coalesce(F.col("text").cast("binary"), F.lit(bytearray()))
    rows = docs.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree(shards)).alias("shard"),
        shard_of(F.col("doc_id"), grown(tree(shards))).alias("grown_shard"),
    )
    slots = gapless(rows, ["shard"], ["doc_id", "text_crc32"], "slot")
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
