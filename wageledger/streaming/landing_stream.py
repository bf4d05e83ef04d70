"""Loading of objects as they land with Structured Streaming: the checkpoint is the ledger."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wageledger.functions.paths import landed_name, landed_object
from wageledger.plans.ingest import BATCH_FILES, ensure_raw, load_objects
from wageledger.schemas import landed_schema
from wageledger.sources.landing import is_complete

# The columns of Spark's binary file source; contents are not read unless asked for.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, landing: str) -> DataFrame:
    """(source_file, landed_object, in_parts) of every file that lands; a folder comes once per part."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", BATCH_FILES)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
    )
    whole = landed_object(F.col("path"))
    return files.select(
        landed_name(F.col("path")).alias("source_file"), whole.alias("landed_object"), (whole != F.col("path")).alias("in_parts")
    ).where(F.col("source_file") != "")


class Incomplete(RuntimeError):
    """A landed folder is still being written; the batch is tried again by the next run."""


def ingest_stream(
    spark: SparkSession,
    landing: str,
    raw: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> StreamingQuery:
    """Load what has landed since the checkpoint, then stop.

    The stream carries names only. An object that gained a file is read again
    as a whole and replaces its partition, so parts that arrive in different
    batches do not push each other out, and a batch that is run again leaves
    the table the same. A batch with a folder that lacks its ``_SUCCESS``
    marker fails after loading its whole objects and is retried by the next run.
    """
    schema = schema or landed_schema()
    ensure_raw(spark, raw, schema)

    def load(files: DataFrame, batch: int) -> None:
        objects = files.distinct().orderBy("source_file").collect()  # BATCH_FILES names at most
        whole = [row for row in objects if not row["in_parts"] or is_complete(spark, row["landed_object"])]
        names = {row["source_file"] for row in whole}
        if len(names) < len(whole):
            raise ValueError("two objects landed under one name")
        if whole:
            load_objects(spark, [row["landed_object"] for row in whole], raw, datetime.now(UTC), schema, multiline=multiline)
        if len(whole) < len(objects):
            raise Incomplete(f"{len(objects) - len(whole)} landed folders are not complete yet")

    return (
        arrivals(spark, landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
