"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

A row descends level by level: it draws a region, then a rack of that region, then a shard of that
rack. A node draws -ln(u) / weight from the hash of the row's key, the level and the node's number,
with the sum of the weights below it as its weight; the least draw wins, so every level is weighted
as asked. A draw depends on its own node only: a changed weight changes the draws on the path from
its shard to the root, so rows move into or out of the changed region, within it into or out of the
changed rack, within that into or out of the changed shard, and nowhere else. Shards that fill a
region of their own therefore take rows only into themselves; one that is added to a rack in use
takes rows into that rack's region, where the rack and the shard are drawn anew.

Everything is a column expression; no shuffle is needed to place a row. Slots need one shuffle of
narrow rows, in buckets of each shard.

Defined results: the key is the id (null counts as a value of its own); a null text has size
``overhead`` and CRC 0; repeated rows get the same shard and slots of their own; an empty table
gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.session import materialize

RACK_SHARDS = 4
REGION_RACKS = 2
BUCKET_ROWS = 20_000


def _tree(weights: Sequence[float], rack_shards: int, region_racks: int) -> Column:
    """Regions of (node, weight, racks of (node, weight, shards of (node, weight))), without empty subtrees."""

    def node(number: int, weight: float, *below: Column) -> Column:
        parts = [F.lit(number).alias("node"), F.lit(float(weight)).alias("weight")]
        return F.struct(*parts, *(c.alias("below") for c in below))

    racks: dict[int, dict[int, list[Column]]] = {}
    sums: dict[tuple[int, int], float] = {}
    for leaf, weight in enumerate(weights):
        if weight > 0:
            rack, region = leaf // rack_shards, leaf // rack_shards // region_racks
            racks.setdefault(region, {}).setdefault(rack, []).append(node(leaf, weight))
            sums[region, rack] = sums.get((region, rack), 0.0) + weight
    if not racks:
        raise ValueError("no shard has a weight over 0")
    regions = []
    for region, inner in racks.items():
        below = F.array(*(node(rack, sums[region, rack], F.array(*leaves)) for rack, leaves in inner.items()))
        regions.append(node(region, sum(sums[region, rack] for rack in inner), below))
    return F.array(*regions)


def _least(key: Column, level: int, nodes: Column, seed: int) -> Column:
    """The node of the least draw; 53 bits of the hash make u, which is never 0."""

    def drawn(n: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(level), n["node"]), 11)
        return F.struct((-F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / n["weight"]).alias("draw"), n.alias("at"))

    return F.array_min(F.transform(nodes, drawn))["at"]


def place(
    key: Column,
    weights: Sequence[float],
    rack_shards: int = RACK_SHARDS,
    region_racks: int = REGION_RACKS,
    seed: int = 11,
) -> Column:
    """Struct (region, rack, shard) for a key; shard i stands in rack i // rack_shards and so on.

    A weight of 0 closes a shard. Ties go to the smaller number.
    """
    # each level is bound to a name once, so a level is drawn once a row
    step = lambda nodes, level, then: F.transform(F.array(_least(key, level, nodes, seed)), then)[0]
    return step(
        _tree(weights, rack_shards, region_racks),
        0,
        lambda region: step(
            region["below"],
            1,
            lambda rack: step(
                rack["below"],
                2,
                lambda leaf: F.struct(region["node"].alias("region"), rack["node"].alias("rack"), leaf["node"].alias("shard")),
            ),
        ),
    )


def with_slots(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, seed: int = 3) -> DataFrame:
    """Number the rows of each shard gapless from 0, without one task for a whole shard.

    Rows fall into buckets drawn at random, so equal rows spread too; the drawn buckets are written
    once, hence a repeated task sees the same ones.
    """
    buckets = max(1, -(-rows.count() // bucket_rows))
    rows = materialize(rows.withColumn("bucket", F.floor(F.rand(seed) * buckets).cast("int")), "buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    own = Window.partitionBy("shard", "bucket").orderBy(*[c for c in rows.columns if c not in ("shard", "bucket")])
    return (
        rows.withColumn("own", F.row_number().over(own))
        .join(reach, ["shard", "bucket"])
        .withColumn("slot", (F.col("before") + F.col("own") - 1).cast("long"))
        .drop("bucket", "own", "before")
    )


def shard(
    docs: DataFrame,
    weights: Sequence[float],
    grown_weights: Sequence[float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    overhead: int = 16,
    rack_shards: int = RACK_SHARDS,
    region_racks: int = REGION_RACKS,
    seed: int = 11,
) -> DataFrame:
    """Per document: doc_id, size, text_crc32, region, rack, shard, slot and the shard under ``grown_weights``."""
    key, text = F.col(id_column).cast("string"), F.col(text_column).cast("string")
    tree = (rack_shards, region_racks, seed)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        place(key, weights, *tree).alias("at"),
        (place(key, grown_weights, *tree)["shard"] if grown_weights else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return with_slots(rows.select("doc_id", "size", "text_crc32", "at.*", "grown_shard"))
