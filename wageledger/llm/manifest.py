"""Merkle manifest of a dataset by concatenated-level strings.

Leaves are digests of rows. Within a group they stand in order, and every 16
consecutive nodes have the digest of their hex digests in a row as parent, level
by level up to the group's root; the roots of the groups, in order, form a tree
of the same kind.

The tree is cut into aligned blocks of 256 nodes, two levels high. A block keeps
each level as one string of 64 hex digits per node, so parents are digests of
substrings of 1024 digits, and the siblings of a node are what flanks its own 64
digits in such a substring. The digests of the blocks are the nodes of the next
tier, which is cut into blocks alike, until each group has one node. Proofs are
built downwards: a block hands the path above it to its nodes.

Positions come from one range sort with the number of rows before each
partition, so a group with a third of all rows is spread like the others, and
blocks are bounded whatever the groups are. Built-in functions only.

Defined results: a null group is a group of its own, the first; null keys come
first in their group; rows with equal keys stand by their leaves, so that any
run gives the same tree; equal rows are leaves each; the proof of a lone leaf of
a lone group is empty; an empty table has no rows, and no root.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wageledger.sinks.scratch import stored

# Fixed values of the contract: nodes under one parent, and hex digits of a digest.
RUN, WIDTH = 16, 64
# Two levels a block: bounds its string to 16 KB. The tree does not depend on it.
BLOCK = RUN * RUN


def digest(*parts: Column) -> Column:
    """Hex SHA-256 of the parts in a row; a null part is ``-``, others follow their length in bytes."""
    texts = [p.cast("string") for p in parts]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def ranked(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` with ``at``, their place in the order from 0."""
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("mark", F.monotonically_increasing_id()), name)
    part = F.shiftright("mark", 33)
    sizes = dealt.groupBy(part.alias("part")).count().collect()  # one row per shuffle partition
    starts, before = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        starts.append((r["part"], before))
        before += r["count"]
    starts = spark.createDataFrame(starts, "part long, before long")
    place = F.col("before") + F.col("mark").bitwiseAND((1 << 33) - 1)
    return dealt.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("at", place).drop("part", "mark", "before")


def _blocks(nodes: DataFrame) -> DataFrame:
    """The blocks of ``gid, n, pos, digest, item``: levels as strings, and the digest of the block."""
    member = F.struct("pos", "digest", "item")
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    rows = nodes.groupBy("gid", "n", block).agg(F.array_sort(F.collect_list(member)).alias("members"))
    rows = rows.select("gid", "n", "block", F.col("members.item").alias("items"), F.array_join(F.col("members.digest"), "").alias("level0"))
    runs = F.sequence(F.lit(0), F.floor((F.size("items") - 1) / RUN).cast("int"))
    parents = F.transform(runs, lambda i: F.sha2(F.substring(F.col("level0"), i * RUN * WIDTH + 1, F.lit(RUN * WIDTH)), 256))
    rows = rows.withColumn("level1", F.array_join(parents, ""))
    # a group that fits a block stops at its own root
    top = F.when(F.col("n") == 1, F.col("level0")).when(F.col("n") <= RUN, F.col("level1")).otherwise(F.sha2("level1", 256))
    return rows.withColumn("digest", top)


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The tiers of blocks; in the last one each group has a single block."""
    tiers = []
    while True:
        tiers.append(stored(_blocks(nodes), "manifest_tier"))
        most = tiers[-1].agg(F.max("n")).first()[0]
        if not most or most <= BLOCK:
            return tiers
        nodes = tiers[-1].select("gid", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("pos"), "digest", F.lit(None).cast("int").alias("item"))


def _flanks(level: Column, place: Column) -> Column:
    """What stands left and right of the node at a place."""
    return F.struct(
        F.substring(level, F.lit(1), place * WIDTH).alias("left"), F.substring(level, (place + 1) * WIDTH + 1, F.lit(RUN * WIDTH)).alias("right")
    )


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """``gid, pos, digest, item, path`` of the lowest nodes, and the other columns of ``above``.

    ``above`` has ``gid, pos`` and ``path`` of each group's root; a path is the
    flanks of the nodes on the way up.
    """
    others = [c for c in above.columns if c not in ("gid", "pos", "path")]
    for tier in reversed(tiers):
        rows = tier.join(above.withColumnRenamed("pos", "block"), ["gid", "block"])
        rows = rows.select("gid", "n", "block", "level0", "level1", "path", *others, F.posexplode("items").alias("k", "item"))
        run = F.floor(F.col("k") / RUN).cast("int")
        low = _flanks(F.substring(F.col("level0"), run * RUN * WIDTH + 1, F.lit(RUN * WIDTH)), F.col("k") % RUN)
        high = _flanks(F.col("level1"), run)
        own = F.when(F.col("n") > RUN, F.array(low, high)).when(F.col("n") > 1, F.array(low)).otherwise(F.slice(F.array(low), 1, 0))
        above = rows.select(
            "gid",
            (F.col("block") * BLOCK + F.col("k")).alias("pos"),
            F.substring(F.col("level0"), F.col("k") * WIDTH + 1, F.lit(WIDTH)).alias("digest"),
            "item",
            F.concat(own, "path").alias("path"),
            *others,
        )
    return above


@dataclass(frozen=True)
class Manifest:
    """The tree: tiers of blocks within groups, tiers over the groups' roots, the groups, and the root."""

    tiers: list[DataFrame]
    upper: list[DataFrame]
    groups: DataFrame
    root: str | None

    def proofs(self) -> DataFrame:
        """``digest, item, subroot, path`` of each leaf."""
        start = self.upper[-1].select("gid", F.col("block").alias("pos"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
        above = _descend(self.upper, start)
        above = above.select(F.col("item").alias("gid"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"))
        return _descend(self.tiers, above).select("digest", "item", "subroot", "path")


def build(leaves: DataFrame, group: str, key: str, leaf: str, item: Column) -> Manifest:
    """The tree over ``leaves``; ``item`` comes with each leaf's proof."""
    rows = leaves.select(F.col(group).alias("group"), F.col(key).alias("key"), F.col(leaf).alias("digest"), item.alias("item"), F.monotonically_increasing_id().alias("salt"))
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest"), F.col("salt")]
    rows = ranked(stored(rows, "manifest_leaves"), order, "manifest_ranked")
    groups = stored(rows.groupBy("group").agg(F.min("at").alias("gid"), F.count("*").alias("n")), "manifest_groups")
    starts = groups.withColumnRenamed("group", "its_group")
    nodes = rows.join(starts, F.col("group").eqNullSafe(F.col("its_group")))
    tiers = _climb(nodes.select("gid", "n", (F.col("at") - F.col("gid")).alias("pos"), "digest", "item"))

    # a group starts where those before it end, so its start gives its place
    tops = ranked(tiers[-1].select("gid", "digest"), [F.col("gid")], "manifest_roots")
    whole = tops.select(F.lit(0).cast("long").alias("gid"), F.lit(groups.count()).alias("n"), F.col("at").alias("pos"), "digest", F.col("gid").alias("item"))
    upper = _climb(whole)
    top = upper[-1].select("digest").first()
    listed = groups.join(tiers[-1].select("gid", F.col("digest").alias("subroot")), "gid").select(F.col("group").alias(group), "n", "subroot")
    return Manifest(tiers, upper, listed, top and top[0])


def fold(leaf: Column, path: str) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings(path: str) -> Column:
    """All siblings on the way up, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
