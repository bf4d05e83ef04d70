"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents become pieces of at most ``limit`` tokens. Pieces are dealt into
blocks of bounded size, and each block is evolved by several islands: separate
populations of packings that start from perturbed best-fit orders. Crossover
injects whole well-filled bins of one parent into the other, removes the bins
that hold duplicates of their pieces, and best-fits the displaced pieces.
After each epoch the elite of every island migrates to the next one. The best
island gives the block's packing. Bins that are still poorly filled are then
dissolved, and their pieces dealt into new blocks and packed again.

Every step is a grouped task over ``(piece number, length)`` rows; texts are
read once. Dealing goes by a number that each piece got when it was written,
so copies spread like any other pieces.

Defined results: a null or empty text is the end token alone; repeated rows
and null ids are packed as separate documents; an empty table gives no row;
other columns of the input are not touched.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wageledger.llm.text import map_text
from wageledger.llm.tokens import Encoder
from wageledger.sinks.scratch import stored

END_ID = 1
BLOCK = 4000
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 5
POPULATION = 4
PASSES = 2
WELL_FILLED = 0.99


def pieces(docs: DataFrame, tokenizer: str | Path, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32``; only documents over ``limit`` tokens are cut."""
    config = Path(tokenizer).read_text(encoding="utf-8")
    name, config = hashlib.sha256(config.encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(config)
    end = np.asarray([END_ID], "<u4").tobytes()

    def measure(value: str | None) -> Iterator[tuple]:
        ids = Encoder.shared(name, lambda: config.value).encode(value or "") + end
        for piece, at in enumerate(range(0, len(ids), 4 * limit)):
            part = ids[at : at + 4 * limit]
            yield piece, at // 4, len(part) // 4, zlib.crc32(part)

    return map_text(docs, text, measure, "piece int, start long, length long, ids_crc32 long", [key])


class Packing:
    """A chromosome: the bin of each piece, and the load of each bin."""

    def __init__(self, bins: np.ndarray, lengths: np.ndarray) -> None:
        names, self.bins = np.unique(bins, return_inverse=True)
        self.loads = np.bincount(self.bins, weights=lengths, minlength=len(names)).astype(np.int64)

    def fitness(self, limit: int) -> tuple[int, float]:
        """Fewer bins first, then fuller full ones."""
        return -len(self.loads), float(np.square(self.loads / limit).sum())


def best_fit(order: np.ndarray, lengths: np.ndarray, bins: np.ndarray, loads: list[int], limit: int) -> None:
    """Puts the pieces of ``order``, one by one, into the fullest bin that takes them, or a new one."""
    room = sorted((limit - load, b) for b, load in enumerate(loads))
    for i in order.tolist():
        size = int(lengths[i])
        at = bisect.bisect_left(room, (size, -1))
        if at == len(room):
            left, b = limit, len(loads)
            loads.append(0)
        else:
            left, b = room.pop(at)
        bins[i] = b
        loads[b] += size
        bisect.insort(room, (left - size, b))


def crossover(a: Packing, b: Packing, lengths: np.ndarray, limit: int, rng: np.random.Generator) -> Packing:
    """Whole well-filled bins of ``b`` injected into ``a``."""
    good = np.flatnonzero(b.loads >= np.quantile(b.loads, 0.5))
    chosen = good[rng.random(len(good)) < 0.5]
    taken = np.isin(b.bins, chosen)
    hit = np.zeros(len(a.loads), bool)
    hit[a.bins[taken]] = True
    # mutation: the emptiest bins are dissolved too
    hit[np.argsort(a.loads)[: max(1, len(a.loads) // 50)]] = True
    displaced = np.flatnonzero(hit[a.bins] & ~taken)
    stay = ~taken & ~hit[a.bins]
    bins = np.full(len(lengths), -1, np.int64)
    names, kept = np.unique(a.bins[stay], return_inverse=True)
    bins[stay] = kept
    more, injected = np.unique(b.bins[taken], return_inverse=True)
    bins[taken] = len(names) + injected
    loads = [*a.loads[names].tolist(), *b.loads[more].tolist()]
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    best_fit(order, lengths, bins, loads, limit)
    return Packing(bins, lengths)


def evolve(lengths: np.ndarray, seeds: list[np.ndarray], limit: int, rng: np.random.Generator) -> np.ndarray:
    """The bins of the best packing after the generations of one epoch."""
    people = [Packing(s, lengths) for s in seeds]
    while len(people) < POPULATION:
        noise = rng.normal(1, 0.05 * len(people), len(lengths)) if people or seeds else np.ones(len(lengths))
        bins, loads = np.empty(len(lengths), np.int64), []
        best_fit(np.argsort(-lengths * noise, kind="stable"), lengths, bins, loads, limit)
        people.append(Packing(bins, lengths))
    least = -(-int(lengths.sum()) // limit)
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: p.fitness(limit), reverse=True)
        if len(people[0].loads) <= least:
            break
        i, j = rng.choice(len(people), 2, replace=False)
        child = crossover(people[min(i, j)], people[max(i, j)], lengths, limit, rng)
        other = crossover(people[max(i, j)], people[min(i, j)], lengths, limit, rng)
        people = sorted([*people, child, other], key=lambda p: p.fitness(limit), reverse=True)[:POPULATION]
    return max(people, key=lambda p: p.fitness(limit)).bins


def _epoch(limit: int, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["migrant", "number"], kind="stable")
        kinds = [g for _, g in rows.groupby("migrant")]
        mine = kinds[0]
        lengths = mine["length"].to_numpy()
        seeds = [k["bin"].to_numpy() for k in kinds if (k["bin"].to_numpy() >= 0).all()]
        block, island = int(mine["block"].iat[0]), int(mine["island"].iat[0])
        rng = np.random.default_rng((seed, block, island))
        bins = evolve(lengths, seeds, limit, rng)
        return mine[["block", "island", "number", "length"]].assign(bin=bins, migrant=0)

    return run


EVOLVED = "block long, island int, number long, length long, bin long, migrant int"


def pack_blocks(items: DataFrame, limit: int, seed: int) -> DataFrame:
    """``block, number, length, bin`` of the best island of each block of ``items`` (``block, number, length``)."""
    rows = items.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        "number",
        "length",
        F.lit(-1).cast("long").alias("bin"),
        F.lit(0).alias("migrant"),
    )
    for epoch in range(EPOCHS):
        if epoch:
            next_ = ((F.col("island") + 1) % ISLANDS).cast("int")
            rows = rows.union(rows.withColumn("island", next_).withColumn("migrant", F.lit(1)))
        rows = rows.groupBy("block", "island").applyInPandas(_epoch(limit, seed + epoch), EVOLVED)
        rows = stored(rows, "islands")
    best = rows.groupBy("block", "island").agg(F.countDistinct("bin").alias("n"))
    best = best.groupBy("block").agg(F.min(F.struct("n", "island")).alias("best")).select("block", F.col("best.island").alias("island"))
    return rows.join(best, ["block", "island"]).select("block", "number", "length", "bin")


def pack(parts: DataFrame, limit: int = 4096, seed: int = 0) -> DataFrame:
    """``parts`` (pieces) with ``sequence_id`` and ``offset``, gapless from 0 in each sequence."""
    parts = stored(parts.withColumn("number", F.monotonically_increasing_id()), "pieces")
    light = parts.select("number", "length")
    done = light.where(F.col("length") >= limit).select("number", "length", (-F.col("number") - 1).alias("sequence_id"))
    open_ = light.where(F.col("length") < limit)
    for turn in range(PASSES):
        blocks = max(1, open_.count() // BLOCK)
        dealt = F.pmod(F.xxhash64(F.lit(seed + turn), "number"), F.lit(blocks))
        packed = stored(pack_blocks(open_.withColumn("block", dealt), limit, seed + 97 * turn), "packed")
        # bins of a block are fewer than its pieces
        name = (F.col("block") * F.lit(PASSES) + F.lit(turn)) * F.lit(1 << 32) + F.col("bin")
        packed = packed.select("number", "length", name.alias("sequence_id"))
        loads = packed.groupBy("sequence_id").agg(F.sum("length").alias("load"))
        packed = packed.join(loads, "sequence_id")
        full = F.col("load") >= WELL_FILLED * limit
        if turn == PASSES - 1 or blocks == 1:
            done = done.union(packed.select("number", "length", "sequence_id"))
            break
        done = done.union(packed.where(full).select("number", "length", "sequence_id"))
        open_ = packed.where(~full).select("number", "length")
    # a sequence holds at most ``limit`` pieces, each of a token or more
    within = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("length").over(within) - F.col("length")
    placed = done.select("number", "sequence_id", before.alias("offset"))
    return parts.join(placed, "number").drop("number")

