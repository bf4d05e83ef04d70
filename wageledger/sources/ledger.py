"""Landed objects by what they hold: size, time of change, and a digest of their lines.

A ledger of names alone never sees a file that is replaced under its name. Size
and time of change cost nothing to list; where either differs from the ledger,
the lines decide: a digest that is the sum of a hash per line, taken by as many
tasks as the text has splits. A file that was only touched is not loaded again.
Lines that changed places make the same digest, as they make the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.functions.paths import decoded, landed_name, landed_object

LEDGER = "source_file string, landed_object string, parts long, bytes long, modified timestamp, digest string, loaded_at timestamp"
NEW, UNRECORDED, SUSPECT, SAME = "new", "unrecorded", "suspect", "same"


def list_objects(spark: SparkSession, folder: str) -> DataFrame:
    """``source_file, landed_object, in_parts, parts, bytes, modified`` of the landed .csv objects, contents unread."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(folder).select("path", "length", "modificationTime")
    )
    whole = landed_object(F.col("path"))
    named = files.select(landed_name(F.col("path")).alias("source_file"), whole.alias("landed_object"), (whole != F.col("path")).alias("in_parts"), "length", "modificationTime")
    return named.groupBy("source_file", "landed_object", "in_parts").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")
    )


def classified(landed: DataFrame, loaded: DataFrame | None, ledger: DataFrame | None) -> DataFrame:
    """``landed`` with ``kind`` and ``known_digest``.

    New files are neither ``loaded`` nor recorded; unrecorded ones are loaded
    but the ledger lacks them, and are taken as they are; suspects differ from
    the ledger in size, parts or time; the others are the same.
    """
    objects = landed.where(F.col("source_file").endswith(".csv"))
    if loaded is None:
        return objects.select("*", F.lit(NEW).alias("kind"), F.lit(None).cast("string").alias("known_digest"))
    rows = objects.join(loaded.select("source_file", F.lit(True).alias("loaded")).distinct(), "source_file", "left")
    if ledger is None:
        kind = F.when(F.col("loaded"), UNRECORDED).otherwise(NEW)
        return rows.select(*landed.columns, kind.alias("kind"), F.lit(None).cast("string").alias("known_digest"))
    recorded = ledger.select("source_file", *(F.col(c).alias(f"known_{c}") for c in ("parts", "bytes", "modified", "digest")))
    rows = rows.join(recorded, "source_file", "left")
    alike = F.lit(True)
    for c in ("parts", "bytes", "modified"):
        alike = alike & F.col(c).eqNullSafe(F.col(f"known_{c}"))
    kind = (
        F.when(F.col("loaded").isNull(), NEW).when(F.col("known_digest").isNull(), UNRECORDED).when(alike, SAME).otherwise(SUSPECT)
    )
    return rows.select(*landed.columns, kind.alias("kind"), "known_digest")


def line_digest(line: str = "value") -> Column:
    """Of many lines: their number, and the sum of a 64-bit hash of each."""
    total = F.sum(F.xxhash64(line).cast("decimal(38,0)"))
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), total.cast("string"))


def digests(spark: SparkSession, objects: Sequence[str]) -> DataFrame:
    """``source_file, digest`` of the objects; those without any line have none."""
    lines = spark.read.text(list(objects)).select("value", landed_name(decoded(F.col("_metadata.file_path"))).alias("source_file"))
    return lines.groupBy("source_file").agg(line_digest().alias("digest"))
