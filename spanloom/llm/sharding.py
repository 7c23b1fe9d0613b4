"""Sharding by a hierarchical weighted hash tree (native DataFrame operations only).

The tree has three levels: regions hold racks, racks hold shards, shards have weights.
A row descends it: at each level every child draws ``-ln(u) / weight`` with ``u`` hashed
from the row's key and the child's name, and the smallest draw wins, so a child gets
its share of the weight below the parent. The draw of a child whose subtree keeps its
weight never changes; rows move only into subtrees that grew and out of ones that
shrank, and inside them only along the changed path.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.common import whole_text


@dataclass(frozen=True)
class Shard:
    """A leaf: its number, its place in the tree and its weight."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def shard_tree(n_shards: int, base: tuple[int, int, int] = (4, 2, 5)) -> list[Shard]:
    """A tree of ``n_shards`` equal shards.

    The first ``regions * racks * shards`` of ``base`` fill a regular tree; every further
    shard is a region of its own with its own weight, so adding it takes rows only into it. A
    base of more than ``n_shards`` can't grow in that way, so it isn't used: every shard is
    then a region of its own.
    """
    regions, racks, shards = base
    full = regions * racks * shards
    if full > n_shards:
        full = 0
    out = [Shard(s, f"r{s // (racks * shards)}", f"k{s // shards % racks}") for s in range(full)]
    return out + [Shard(s, f"x{s}", "k0") for s in range(full, n_shards)]


def _least_draw(key: Column, children: list[tuple[str, Column]]) -> Column:
    """Index of the child with the smallest weighted draw; weight 0 or null never wins."""
    draws = []
    for i, (name, weight) in enumerate(children):
        h = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
        u = (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        draw = F.when(weight > 0, -F.ln(u) / weight).otherwise(F.lit(float("inf")))
        draws.append(F.struct(draw.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*draws))["i"] if len(draws) > 1 else F.lit(0)


def assign_shard(key: Column, tree: list[Shard]) -> Column:
    """The shard of a key, as one expression over the tree's weights.

    A row evaluates only the branches it descends (CASE is lazy), so it costs one draw for
    each region, each rack of its region and each shard of its rack.
    """
    regions: dict[str, dict[str, list[Shard]]] = {}
    for leaf in tree:
        regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    names = list(regions)

    def weight(leaves: list[Shard]) -> float:
        return float(sum(x.weight for x in leaves))

    region = _least_draw(
        key, [(f"region/{r}", F.lit(sum(weight(k) for k in regions[r].values()))) for r in names]
    )
    # Regions of one shard are looked up together, so the draw among regions is written out few times.
    single = [next(iter(regions[r].values()))[0].shard if sum(map(len, regions[r].values())) == 1 else None for r in names]
    alone = F.element_at(F.array(*[F.lit(s).cast("int") for s in single]), region + 1)
    chosen = None
    for i, r in enumerate(names):
        if single[i] is not None:
            continue
        racks = list(regions[r])
        rack = _least_draw(key, [(f"rack/{r}/{k}", F.lit(weight(regions[r][k]))) for k in racks])
        leaf = None
        for j, k in enumerate(racks):
            leaves = regions[r][k]
            pick = _least_draw(key, [(f"shard/{r}/{k}/{x.shard}", F.lit(float(x.weight))) for x in leaves])
            number = F.element_at(F.array(*[F.lit(x.shard) for x in leaves]), pick + 1)
            leaf = F.when(rack == j, number) if leaf is None else leaf.when(rack == j, number)
        chosen = F.when(region == i, leaf) if chosen is None else chosen.when(region == i, leaf)
    if chosen is None:
        return alone
    return chosen if all(s is None for s in single) else chosen.otherwise(alone)


def shard_documents(
    docs: DataFrame, n_shards: int = 40, tree: list[Shard] | None = None, grown: list[Shard] | None = None
) -> DataFrame:
    """Place every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``key``: doc_id and the tree alone decide, so equal ids meet in one shard, also
    null ones. Null text has no bytes and counts 16; repeated rows are numbered apart.
    Only ids and sizes are shuffled, never texts, and no task numbers a whole shard:
    slots are given within hashed parts, about four for each shuffle partition, each
    part starting where the parts before it end. Columns other than doc_id and text are ignored.
    grown_shard is the place in ``grown``: beside an own tree it is null where none is given,
    beside the standard tree the same tree with one shard more.
    """
    if tree is None:
        tree = shard_tree(n_shards)
        more = Shard(n_shards, f"x{n_shards}", "k0")
        grown = grown if grown is not None else [*tree, more]
    key = F.col("doc_id")
    rows = docs.select(
        key,
        (F.octet_length(whole_text()) + F.lit(16)).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        assign_shard(key, tree).alias("shard"),
    )
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(16, -(-4 * tasks // max(1, len(tree))))
    part = F.pmod(F.xxhash64(key, F.lit("slot")), F.lit(parts)).cast("int")
    rows = rows.withColumn("_part", part)
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = W.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("_rank", F.row_number().over(within)).join(counts, ["shard", "_part"])
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_before") + F.col("_rank") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard") if grown is None else assign_shard(key, grown).cast("int").alias("grown_shard"),
    )
