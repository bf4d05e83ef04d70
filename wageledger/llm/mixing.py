"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate that brings its share of all characters
to its target weight. Each document gets a count from the Poisson distribution
of that mean, found by inverting the distribution at a number hashed from the
seed, the id and, where ids repeat or are null, the number of the occurrence:
any run gives the same counts. Documents are then exploded by their counts and
shuffled globally by a hashed key.

Built-in functions only. Sizes per source are summed before the shuffle, and
the rates are literals: one per named source and one for the rest, so no join
meets a hot source.

Defined results: a null source belongs to the rest; a null text counts no
characters; a group without characters keeps mean 1; rows that repeat an id, and
rows with null ids, are occurrences that draw each for itself, numbered in the
order of a hash of the row; a weight of zero drops the source; an empty table
stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wageledger.llm.text import free_name
from wageledger.sinks.scratch import stored

REST = "*"
# A mean above this is drawn as a sum of draws, as their distributions add up.
MEAN = 32.0
# Rows of one id that are numbered together.
BUCKET = 1 << 14


def _hashed(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _id(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("null"))


def _if_later(occurrence: Column) -> Column:
    """The occurrence as a part of the hash; the first has none."""
    return F.when(occurrence > 0, F.concat(F.lit("#"), occurrence.cast("string")))


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits, hashed from the parts."""
    return F.conv(F.substring(_hashed(seed, *parts), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_table(mean: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... until no 52-bit number lies above."""
    p = total = math.exp(-mean)
    table = [total]
    while total < 1 - 2.0**-52 and (p > 2.0**-60 or len(table) <= mean):
        p *= mean / len(table)
        total += p
        table.append(total)
    return table


def rates(docs: DataFrame, weights: Mapping[str, float], total: float | None = None, source: str = "source", text: str = "text") -> dict[str, float]:
    """Mean repetitions per named source and for the rest, for ``total`` characters (as many as there are, if None)."""
    if any(w < 0 or not math.isfinite(w) for w in weights.values()) or abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("weights must be at least 0 and sum to 1")
    named = [s for s in weights if s != REST]
    group = F.when(F.col(source).isin(named), F.col(source)).otherwise(F.lit(REST)) if named else F.lit(REST)
    sums = docs.groupBy(group.alias("group")).agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("size")).collect()
    sizes = {r["group"]: r["size"] for r in sums}  # one row per weight at most
    wanted = float(sum(sizes.values())) if total is None else float(total)
    return {g: weights.get(g, 0.0) * wanted / sizes[g] if sizes.get(g) else 1.0 for g in {*weights, REST}}


def occurrences(docs: DataFrame, key: str, name: str) -> DataFrame:
    """``docs`` with the number of the row, from 0, among those of its id.

    Rows of ids that occur once, nearly all, stay where they are. Of the others,
    equal rows are counted and exploded again, as it does not matter which is
    which; different ones are numbered in the order of their hash, in buckets
    of it, so an id, or null, with a third of all rows is spread over many tasks.
    """
    columns = docs.columns
    many, which, times, row, bucket, before, start = (free_name(docs, n) for n in ("many", "which", "times", "row", "bucket", "before", "start"))
    ids = docs.groupBy(F.col(key).alias(which)).agg(F.count("*").alias(many)).where(F.col(many) > 1)
    ids = stored(ids, "repeated_ids")
    if ids.isEmpty():
        return docs.withColumn(name, F.lit(0).cast("long"))
    joined = docs.join(ids, docs[key].eqNullSafe(ids[which]), "left")
    single = joined.where(F.col(many).isNull()).select(*columns, F.lit(0).cast("long").alias(name))
    rows = joined.where(F.col(many).isNotNull()).groupBy(*columns, many).agg(F.count("*").alias(times))
    rows = rows.withColumn(row, F.struct(F.xxhash64(*columns).alias("h"), F.xxhash64(F.lit(1), *columns).alias("g")))
    rows = stored(rows.withColumn(bucket, F.pmod(F.col(f"{row}.h"), F.ceil(F.col(many) / BUCKET))), "repeated_rows")
    sizes = rows.groupBy(F.col(key).alias(which), F.col(bucket).alias("b")).agg(F.sum(times).alias("n"))
    earlier = Window.partitionBy(which).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.select(which, "b", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)), "occurrence_buckets")
    inside = Window.partitionBy(key, bucket).orderBy(row).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(start, F.coalesce(F.sum(times).over(inside), F.lit(0)))
    rows = rows.join(sizes, rows[key].eqNullSafe(sizes[which]) & (rows[bucket] == sizes["b"]))
    nth = F.explode(F.sequence(F.col(before) + F.col(start), F.col(before) + F.col(start) + F.col(times) - 1))
    return single.unionByName(rows.select(*columns, nth.alias(name)))


def copies(means: Mapping[str, float], seed: int, key: str = "doc_id", source: str = "source", occurrence: Column | None = None) -> Column:
    """The count of a row."""
    more = () if occurrence is None else (_if_later(occurrence),)
    count = None
    for group in sorted(means, key=lambda g: g == REST):
        mean = means[group]
        parts = max(1, math.ceil(mean / MEAN))
        table = F.array(*(F.lit(x) for x in poisson_table(mean / parts)))
        drawn = F.lit(0)
        for i in range(parts):
            drawn = drawn + _below(table, uniform(seed, _id(key), F.lit(str(i)), *more))
        if group == REST:
            return drawn if count is None else count.otherwise(drawn)
        test = F.col(source) == group
        count = F.when(test, drawn) if count is None else count.when(test, drawn)
    raise ValueError("no mean for the rest")


def _below(table: Column, u: Column) -> Column:
    return F.size(F.filter(table, lambda c: c <= u))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float],
    total: float | None = None,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    places: bool = True,
) -> DataFrame:
    """Replicated documents in a random order.

    With ``places``, ``copy_no`` (from 0) and ``place``, the key that orders
    the rows, follow; a trailing underscore sets them apart from columns of
    the same name.
    """
    means = rates(docs, weights, total, source, text)
    number, place, nth = (free_name(docs, n) for n in ("copy_no", "place", "occurrence"))
    counted = occurrences(docs, key, nth)
    counted = counted.select("*", copies(means, seed, key, source, F.col(nth)).alias(number)).where(F.col(number) > 0)
    rows = counted.withColumn(number, F.explode(F.sequence(F.lit(0), F.col(number) - 1)))
    hashed = _hashed(seed, F.lit("place"), _id(key), F.col(number).cast("string"), _if_later(F.col(nth)))
    rows = rows.withColumn(place, hashed).repartition(place).sortWithinPartitions(place)
    return rows.select(*docs.columns, number, place) if places else rows.select(*docs.columns)
