"""Distinct people as exact bitmaps.

A distinct count cannot be added up: who is paid in two years or by two agencies
would count twice. A bitmap over dense person numbers can: the union of two
groups is the bitwise or of theirs. Bitmaps are stored per year and agency, in
blocks of 32,768 people, and any coarser headcount is taken from them alone,
without the records.

Numbers are dense so that blocks are full: a block of 4 KB holds 32,768 people,
one bit each. New people get the numbers after the last, so stored bitmaps stay
right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.sinks.scratch import stored

PERSON, NUMBER = "employee_key", "person_no"
_PART = (1 << 33) - 1  # of a generated id, the place within its partition


def numbered(people: DataFrame, known: DataFrame | None = None, person: str = PERSON) -> DataFrame:
    """``person, person_no`` of every non-NULL person: those ``known`` keep theirs, others get the next ones.

    People are counted per partition of a stored table and numbered from there:
    no sort, and no task sees them all.
    """
    fresh = people.where(F.col(person).isNotNull()).select(person).distinct()
    before = 0
    if known is not None:
        fresh = fresh.join(known, person, "left_anti")
        before = known.agg(F.coalesce(F.max(NUMBER) + 1, F.lit(0))).first()[0]
    marked = stored(fresh.withColumn("mark", F.monotonically_increasing_id()), "people")
    part = F.shiftright("mark", 33)
    sizes = marked.groupBy(part.alias("part")).count().collect()  # one row per partition
    starts = []
    for row in sorted(sizes, key=lambda row: row["part"]):
        starts.append((row["part"], before))
        before += row["count"]
    starts = people.sparkSession.createDataFrame(starts, "part long, start long")
    number = F.col("start") + F.col("mark").bitwiseAND(_PART)
    rows = marked.withColumn("part", part).join(F.broadcast(starts), "part").select(person, number.alias(NUMBER))
    return rows if known is None else known.select(person, NUMBER).unionByName(rows)


def bitmaps(records: DataFrame, numbers: DataFrame, by: Sequence[str], person: str = PERSON) -> DataFrame:
    """``by, block, people``: the people of each group. A person counts once per group and task before the shuffle."""
    seen = records.where(F.col(person).isNotNull()).select(*by, person).distinct().join(numbers, person)
    # blocks are counted from 1 by the function
    block = F.bitmap_bucket_number(NUMBER).alias("block")
    return seen.groupBy(*by, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("people"))


def united(maps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups, or of several sets of bitmaps of the same groups."""
    return maps.groupBy(*by, "block").agg(F.bitmap_or_agg("people").alias("people"))


def headcount(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by, headcount``: distinct people of each group, or of all."""
    counts = united(maps, by).groupBy(*by) if by else united(maps, ())
    return counts.agg(F.coalesce(F.sum(F.bitmap_count("people")), F.lit(0)).alias("headcount"))
