"""Embedding near-duplicates by NN-descent.

Equal vectors are one class. Classes get first neighbours from small cells of
random hyperplanes. Then the neighbour graph is refined in rounds: the nearest
neighbours of a vector, in both directions, are compared with each other where
the last round found anything new, each round brings cells of new hyperplanes,
and each vector keeps its nearest. A list is saturated if even its last
neighbour reaches the threshold; it is enlarged, up to a bound.

Before it ends, the descent has used so many cells that a pair at the threshold
has met in one with the probability that recall is to reach, whatever the
refinement adds. Vectors whose lists are saturated at the bound are then
compared, in blocks, with all vectors of their connected group, once. So is all
of any group that fits a block. Edges of the threshold are the links. Recall is
audited against brute force over a bounded set of query vectors, half of them
with links; the descent goes on while it is short of the goal, and fails if it
does not get there.

Cells, neighbourhoods and blocks are bounded: a larger one is dealt into parts
at random, anew for each cell and round, so no vector is left out and no hot
vector fills a task.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite components links with nothing; vectors of different lengths do not
link; repeated rows are separate vectors that link with each other; null ids
do not name a component.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wageledger.llm.graph import components
from wageledger.sinks.scratch import stored

log = logging.getLogger(__name__)

NEIGHBOURS, ENLARGED = 8, 64  # of a list, and of a saturated one
CELL = 512  # vectors compared with each other at once
BLOCK = 2048
TABLES = 3  # sets of cells a round
QUERIES = 128
RECALL = 0.98
# The descent fails when a pair at the threshold would still be missed with less than this probability.
HOPELESS = 1e-9


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision."""
    flat = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _by_group(df: DataFrame, keys: list[str], work: Callable[[pa.RecordBatch], Iterator[dict]], fields: str) -> DataFrame:
    """``work`` on the rows of each group; groups are bounded, and streamed from sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            held = here if held is None else pa.concat_tables([held, here])
            marks = np.stack([held.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in keys])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            if not len(cuts):
                continue
            yield from whole(held.slice(0, int(cuts[-1])), [0, *cuts.tolist()])
            held = held.slice(int(cuts[-1]))
        if held is not None and held.num_rows:
            yield from whole(held, [0, held.num_rows])

    def whole(rows: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        flat = rows.combine_chunks().to_batches()[0]
        made: list[dict] = []
        for a, b in zip(cuts, cuts[1:]):  # noqa: B905
            made.extend(work(flat.slice(a, b - a)))
        if made:
            yield pa.RecordBatch.from_pydict({k: np.concatenate([m[k] for m in made]) for k in made[0]})

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, fields)


PAIRS = "a long, b long, sim double"


def _nearest(threshold: float) -> Callable[[pa.RecordBatch], Iterator[dict]]:
    """The nearest of each vector within its group; more of them if they reach the threshold."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, at = np.unique(batch.column("id").to_numpy(), return_index=True)
        if len(ids) < 2:
            return
        v = _unit(batch.column("v").take(pa.array(at)))
        sims = v @ v.T
        np.fill_diagonal(sims, -2)
        n = min(ENLARGED, len(ids) - 1)
        near = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1), 1)
        found = np.take_along_axis(sims, near, 1)
        keep = (found >= threshold) | (np.arange(n) < NEIGHBOURS)
        rows = np.broadcast_to(np.arange(len(ids))[:, None], keep.shape)
        yield {"a": ids[rows[keep]], "b": ids[near[keep]], "sim": found[keep]}

    return work


def _parts(groups: DataFrame, sizes: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """``groups`` with ``part``, which deals those above a cell, by their ``size``, into parts of about a cell."""
    rows = groups.join(sizes.where(F.col("size") > CELL), keys, "left")
    parts = F.coalesce(F.ceil(F.col("size") / CELL), F.lit(1))
    return rows.withColumn("part", F.pmod(F.xxhash64(salt, "id"), parts)).drop("size")


def _bits(n: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n / CELL))))


def _met(n: int, threshold: float) -> float:
    """The probability that two vectors at the threshold share a cell."""
    return (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** _bits(n)


def _numbered(batch: pa.RecordBatch, bits: int, turn: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The vectors of a batch, and their cells in one set of hyperplanes of this round after the other."""
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        some = batch.take(pa.array(np.flatnonzero(dims == d)))
        planes = np.random.default_rng([turn, int(d)]).normal(size=(int(d), TABLES * max(1, bits)))
        signs = (_unit(some.column("v")) @ planes) > 0
        for t in range(TABLES):
            mine = signs[:, t * bits : (t + 1) * bits]
            yield some, (mine @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(some.num_rows, np.int64)) * TABLES + t


def _from_cells(vectors: DataFrame, n: int, turn: int, threshold: float) -> DataFrame:
    """Neighbours within the cells of every set of hyperplanes of this round."""
    bits = _bits(n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, cells in _numbered(batch, bits, turn):
                at, sizes = np.unique(cells, return_counts=True)
                dim = pa.array(np.full(len(at), some.column("dim")[0].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays([dim, pa.array(at, pa.int64()), pa.array(sizes, pa.int64())], names=["dim", "cell", "n"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, cells in _numbered(batch, bits, turn):
                columns = [some.column("id"), some.column("dim"), pa.array(cells, pa.int64()), some.column("v")]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "dim", "cell", "v"])

    rows, keys = vectors.select("id", "dim", "v"), ["dim", "cell"]
    schema = T.StructType([vectors.schema["id"], vectors.schema["dim"], T.StructField("cell", T.LongType()), vectors.schema["v"]])
    sizes = rows.mapInArrow(count, "dim long, cell long, n long").groupBy(*keys).agg(F.sum("n").alias("size"))
    dealt = _parts(rows.mapInArrow(deal, schema), sizes, keys, F.hash(F.lit(turn), "cell"))
    return _by_group(dealt, [*keys, "part"], _nearest(threshold), PAIRS)


def _from_neighbours(graph: DataFrame, vectors: DataFrame, turn: int, threshold: float) -> DataFrame:
    """The local join: neighbours of one vector, in both directions, meet where any of them is new.

    Of lists that are saturated at their bound only the nearest, as their
    vectors will be compared with all of their group.
    """
    linked = (F.col("sim") >= threshold) & (F.col("links") < ENLARGED)
    edges = graph.where((F.col("rank") <= NEIGHBOURS) | linked).select("a", "b", "turn")
    both = edges.select(F.col("a").alias("of"), F.col("b").alias("id"), "turn").union(edges.select(F.col("b").alias("of"), F.col("a").alias("id"), "turn"))
    both = both.union(edges.select(F.col("a").alias("of"), F.col("a").alias("id"), "turn"))
    fresh = both.where(F.col("turn") == turn - 1).select("of").distinct()
    both = both.join(fresh, "of", "left_semi").select("of", "id").distinct()
    sizes = both.groupBy("of").agg(F.count("*").alias("size"))
    met = _parts(both, sizes, ["of"], F.hash(F.lit(turn), "of")).join(vectors.select("id", "v"), "id")
    return _by_group(met, ["of", "part"], _nearest(threshold), PAIRS)


def _keep_nearest(pairs: DataFrame, threshold: float) -> DataFrame:
    """The list of each vector: ``a, b, sim, turn, rank``, and ``links``, how many of it reach the threshold."""
    pairs = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("turn").alias("turn"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    pairs = pairs.withColumn("rank", rank).where(F.col("rank") <= ENLARGED)
    pairs = pairs.where((F.col("rank") <= NEIGHBOURS) | (F.col("sim") >= threshold))
    return pairs.withColumn("links", F.count_if(F.col("sim") >= threshold).over(Window.partitionBy("a")))


def _in_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """Links between saturated vectors and all of their group: ``id, links``; pairs are never written out.

    ``members``: ``root, id, full, m, v``. Saturated vectors and the others of a
    group are dealt into blocks; each pair of blocks, one of them saturated, is
    one task-sized comparison.
    """
    sizes = members.groupBy("root").agg(F.count_if("full").alias("x"), F.count_if(~F.col("full")).alias("y"))
    blocks = sizes.select("root", *(F.ceil(F.col(c) / BLOCK).cast("long").alias(c) for c in ("x", "y")))
    rows = members.join(blocks, "root")
    dealt = F.when(F.col("full"), F.pmod(F.xxhash64("id"), "x")).otherwise(F.col("x") + F.pmod(F.xxhash64("id"), F.greatest("y", F.lit(1))))
    last = F.when(F.col("full"), F.col("x") + F.col("y")).otherwise(F.col("x")) - 1
    rows = rows.withColumn("block", dealt).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.select("root", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), (F.col("block") > F.col("other")).alias("second"), "id", "m", "v")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        second = np.asarray(batch.column("second"))
        ids, m, v = batch.column("id").to_numpy(), batch.column("m").to_numpy(), _unit(batch.column("v"))
        if batch.column("x")[0] == batch.column("y")[0]:
            near = v @ v.T >= threshold
            np.fill_diagonal(near, False)
            yield {"id": ids, "links": near @ m}
            return
        near = v[~second] @ v[second].T >= threshold
        yield {"id": ids[~second], "links": near @ m[second]}
        yield {"id": ids[second], "links": near.T @ m[~second]}

    counted = _by_group(rows, ["root", "x", "y"], work, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def _links(graph: DataFrame, vectors: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Weighted link counts ``id, links``, and groups ``id, root``."""
    near = graph.where(F.col("sim") >= threshold).select("a", "b")
    edges = stored(near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near")
    roots = stored(components(edges, "near_links").select(F.col("node").alias("id"), F.col("component").alias("root")), "roots")
    saturated = near.groupBy("a").count().where(F.col("count") >= ENLARGED).select(F.col("a").alias("id"), F.lit(True).alias("saturated"))
    marked = stored(roots.join(saturated, "id", "left").select("root", "id", F.coalesce("saturated", F.lit(False)).alias("full")), "marked")
    groups = marked.groupBy("root").agg(F.count("*").alias("size"), F.max("full").alias("any"))
    groups = groups.where((F.col("size") <= BLOCK) | F.col("any")).select("root", (F.col("size") <= BLOCK).alias("small"))
    members = marked.join(groups, "root").select("root", "id", (F.col("full") | F.col("small")).alias("full"))
    members = stored(members.join(vectors.select("id", "m", "v"), "id").select("root", "id", "full", "m", "v"), "members")
    # edges between vectors that no block compares
    compared = members.where("full").select("id")
    plain = edges.join(compared.withColumnRenamed("id", "a"), "a", "left_anti").join(compared.withColumnRenamed("id", "b"), "b", "left_anti")
    plain = plain.join(vectors.select(F.col("id").alias("b"), "m"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("m").alias("links"))
    links = plain.union(_in_blocks(members, threshold)).groupBy("id").agg(F.sum("links").alias("links"))
    return stored(links, "links"), roots


def _audit(vectors: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """``id, true``: links, by brute force, of query vectors: some of all, some of those with links."""
    linked = graph.where(F.col("sim") >= threshold).select(F.col("a").alias("id")).distinct()
    order = F.xxhash64(F.lit(5), "id")
    picked = vectors.select("id").orderBy(order).limit(QUERIES).union(linked.orderBy(order).limit(QUERIES)).distinct()
    rows = vectors.join(F.broadcast(picked), "id").select("id", "v", "dim").collect()  # at most twice QUERIES
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {r["dim"] for r in rows}:
        some = [r for r in rows if r["dim"] == d]
        q = np.array([r["v"] for r in some], dtype=np.float64)
        by_dim[d] = (np.array([r["id"] for r in some]), q / np.linalg.norm(q, axis=1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ids, m = (batch.column(c).to_numpy() for c in ("dim", "id", "m"))
            for d, (names, q) in by_dim.items():
                at = np.flatnonzero(dims == d)
                if len(at):
                    near = q @ _unit(batch.column("v").take(pa.array(at))).T >= threshold
                    near &= names[:, None] != ids[at][None, :]
                    yield pa.RecordBatch.from_pydict({"id": names, "links": near @ m[at]})

    true = vectors.select("id", "v", "dim", "m").mapInArrow(run, "id long, links long")
    return stored(true.groupBy("id").agg(F.sum("links").alias("true")), "audit")


def recall(true: DataFrame, found: DataFrame) -> float:
    """Share of the links of the query vectors that ``found`` (``id, links``) counts."""
    sums = true.join(found, "id", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return 1.0 if not sums[0] else float(sums[1] or 0) / float(sums[0])


def _descent(vectors: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links and groups, at the recall that is the goal."""
    n = vectors.count()
    missed = 1 - _met(n, threshold)
    graph, turn, true = None, 0, None
    while True:
        found = _from_cells(vectors, n, turn, threshold)
        if graph is not None:
            found = found.union(_from_neighbours(graph, vectors, turn, threshold))
        found = found.withColumn("turn", F.lit(turn))
        if graph is not None:
            found = graph.select("a", "b", "sim", "turn").union(found)
        graph = stored(_keep_nearest(found, threshold), "graph")
        turn += 1
        if (missed and turn < 2) or missed ** (turn * TABLES) > 1 - RECALL:
            continue
        links, roots = _links(graph, vectors, threshold)
        true = _audit(vectors, graph, threshold) if true is None else true
        got = recall(true, links)
        log.info("recall %.4f after %d rounds", got, turn)
        if got >= RECALL:
            return links, roots
        if missed ** (turn * TABLES) < HOPELESS:
            raise RuntimeError(f"recall of links is {got:.4f} after {turn} rounds, {RECALL} is the goal")


def near_duplicates(rows: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, n_links, component_id, kept`` of every row."""
    kind = rows.schema[vector].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    # single precision is widened where it is used, so that half the bytes are shuffled
    v = F.col(vector) if single else F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))
    raw = rows.select(F.col(key).alias("key"), F.when(usable, v).alias("v"))
    # two hashes name a class; the vector itself is kept once
    raw = raw.withColumn("h", F.xxhash64("v")).withColumn("g", F.xxhash64(F.lit(3), "v"))
    classes = raw.where("v is not null").groupBy("h", "g").agg(F.min("key").alias("first"), F.count("*").alias("m"), F.first("v").alias("v"))
    vectors = stored(classes.select(F.monotonically_increasing_id().alias("id"), "*", F.size("v").cast("long").alias("dim")), "vectors")
    links, roots = _descent(vectors, threshold)

    grouped = vectors.select("id", "h", "g", "first", "m").join(links, "id", "left").join(roots, "id", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "id"))
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    grouped = grouped.join(named, "root").select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    keyed = raw.select("key", F.when(F.col("v").isNotNull(), F.col("h")).alias("h"), F.when(F.col("v").isNotNull(), F.col("g")).alias("g"))
    component = F.coalesce("component_id", "key")
    return keyed.join(grouped, ["h", "g"], "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
