"""Connected components of an edge table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.sinks.scratch import stored


def components(edges: DataFrame, name: str = "edges", rounds: int = 60) -> DataFrame:
    """``(node, component)``: the smallest node reachable from each node of an edge ``(a, b)``.

    Alternates two steps until nothing changes: every node points its larger
    neighbours to the smallest one it knows, then its smaller ones too. Both
    take a minimum per node, combined before the shuffle, and join it back, so
    a node with a third of all edges is split like any skewed join. Each round
    is a written table: lost executors cost one round at most.
    """
    now = stored(
        edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), name
    )
    mark = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # (v, u) with u > v: u points to the smallest neighbour of v
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = stored(large.where("v != u").distinct(), name)
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(
            F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u"))
        )).alias("e")).select("e.*")
        now = stored(small.where("v != u").distinct(), name)
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))")).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)
