"""SimHash near-duplicates by an inverted index over byte positions.

A fingerprint is eight bytes at fixed positions. Two fingerprints that differ
in at most ``distance`` bits differ in at most that many bytes, so they share
at least ``8 - distance`` positional bytes. The index posts each fingerprint
under sets of positional bytes, chosen so that every such pair meets in at least
one posting. The positions of all postings that a pair meets in are tallied,
pairs below the minimum that the sets guarantee go, and the rest is verified bit
by bit.

Documents of one fingerprint are one class, and only classes are linked.
Postings with many classes are not paired. Two fingerprints within two bits
have a common neighbour within one bit of both, so there each class posts
itself under its one-bit neighbours instead, and those that meet are within
two bits by construction: as many rows as classes, no pair lost.

Defined results: null and empty texts, and those of blanks only, have the
fingerprint zero and are linked like any other; a null id does not name a
component; repeated rows each get the component of their fingerprint.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.llm.graph import components
from wageledger.llm.text import free_name, map_text, words
from wageledger.sinks.scratch import stored

SEED = 42
BYTES = 8
# A posting with more classes than this is linked through common neighbours.
PAIRED = 32


def fingerprint(text: str | None, shingle: int) -> int:
    """The unsigned 64-bit SimHash of a text."""
    found = words(text or "")
    found = [w.lower() for w in found]  # bytes: A-Z only
    if not found:
        return 0
    grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)))) if len(found) >= shingle else [b" ".join(found)]  # noqa: B905
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3, text: str = "text") -> DataFrame:
    """``keep`` and the fingerprint ``fp`` as a signed long."""

    def measure(value: str | None) -> list[tuple]:
        bits = fingerprint(value, shingle)
        return [(bits - (1 << 64) if bits >> 63 else bits,)]

    return map_text(docs, text, measure, "fp long", keep)


def position_sets(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``distance`` lost positions leave one set whole.

    The complements are blocks that cover every choice of lost positions. For
    two lost bytes they are triples, taken greedily.
    """
    lost = min(distance, BYTES - 1)
    width = min(lost + 1, BYTES - 1)
    open_, blocks = set(combinations(range(BYTES), lost)), []
    while open_:
        best = max(combinations(range(BYTES), width), key=lambda b: len(open_ & set(combinations(b, lost))))
        blocks.append(best)
        open_ -= set(combinations(best, lost))
    return [tuple(p for p in range(BYTES) if p not in b) for b in blocks]


def masks(distance: int) -> list[int]:
    """The position sets as signed 64-bit masks."""
    found = [sum(0xFF << (8 * p) for p in s) for s in position_sets(distance)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def guaranteed(distance: int) -> int:
    """The least number of positions that the postings of a pair within ``distance`` bits tally."""
    sets = position_sets(distance)
    lost = combinations(range(BYTES), min(distance, BYTES - 1))
    return min(len({p for s in sets if not set(s) & set(gone) for p in s}) for gone in lost)


def links(classes: DataFrame, distance: int = 2) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` that join the same groups as all links do.

    Exact for distances up to two: every edge is within ``distance`` bits, and
    fingerprints within it are connected.
    """
    if not 0 <= distance <= 2:
        raise ValueError("links are exact for distances 0 to 2")
    if distance == 0:
        return classes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    mask = F.array(*(F.lit(m) for m in masks(distance)))
    posted = classes.select("fp", F.posexplode(mask).alias("set", "mask"))
    posted = posted.select("fp", "set", F.col("mask").bitwiseAND(F.col("fp")).alias("shared"))
    sizes = posted.groupBy("set", "shared").agg(F.count("*").alias("n")).where("n > 1")
    sized = stored(posted.join(sizes, ["set", "shared"]), "postings")
    few = sized.where(F.col("n") <= PAIRED)
    left, right = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b").drop("n")
    places = F.element_at(F.array(*(F.lit(sum(1 << p for p in s)) for s in position_sets(distance))), F.col("set") + 1)
    met = left.join(right, ["set", "shared"]).where("a < b").select("a", "b", places.alias("places"))
    tally = met.groupBy("a", "b").agg(F.bit_count(F.bit_or("places")).alias("tally")).where(F.col("tally") >= guaranteed(distance))
    pairs = tally.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")

    # bits outside the mask may differ in a hot posting; flip each of them
    flips = []
    for m in masks(distance):
        free = [b for b in range(64) if not (m >> b) & 1]
        flips.append(F.array(F.lit(0).cast("long"), *(F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b) for b in free)))
    hot = sized.where(F.col("n") > PAIRED).select(
        "fp", F.explode(F.element_at(F.array(*flips), F.col("set") + 1)).alias("flip")
    )
    if distance == 2:
        near = hot.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near")).distinct()
        least = near.groupBy("near").agg(F.min("fp").alias("m"), F.count("*").alias("n")).where("n > 1")
        met = near.join(least, "near").select(F.col("m").alias("a"), F.col("fp").alias("b")).where("a != b").distinct()
    else:  # one bit apart: the neighbour itself is there
        near = hot.select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("b")).where("a < b")
        met = near.join(classes.select(F.col("fp").alias("b")), "b").select("a", "b").distinct()
    return pairs.union(met)


def near_duplicates(prints: DataFrame, key: str = "doc_id", distance: int = 2) -> DataFrame:
    """``prints`` (with ``key`` and ``fp``), ``root``, a fingerprint that names the group, and ``component_id``,
    the smallest key reachable by links."""
    prints = stored(prints, "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min(key).alias("first")), "classes")
    grouped = stored(components(links(classes, distance), "simhash_links"), "groups")
    linked = classes.join(grouped, classes.fp == grouped.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    first = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(linked.join(first, "root").select("fp", "root", "component_id"), "fp")


def hexadecimal(column: str = "fp"):
    """Sixteen lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def deduplicate(docs: DataFrame, key: str = "doc_id", shingle: int = 3, distance: int = 2, text: str = "text") -> DataFrame:
    """One document of each group, that with the smallest key; all columns stay.

    A row is told by two hashes of all its columns, so of equal rows one
    stays, and of rows that share the smallest key that with the smallest
    hashes. A null key counts as the largest.
    """
    columns = docs.columns
    rows = [free_name(docs, name) for name in ("row_1", "row_2")]
    docs = docs.withColumns({r: F.xxhash64(F.lit(i), *(docs[c] for c in columns)) for i, r in enumerate(rows)})
    groups = near_duplicates(fingerprints(docs, [key, *rows], shingle, text), key, distance)
    first = F.min(F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"), *rows))
    winners = groups.groupBy("root").agg(first.alias("first")).select(*(F.col(f"first.{r}") for r in rows))
    return docs.join(winners, rows, "left_semi").dropDuplicates(rows).select(*columns)
