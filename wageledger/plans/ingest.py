"""Landing and loading: each landed file reaches the raw table once."""

from __future__ import annotations

import logging
from datetime import datetime, timedelta
from itertools import batched

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wageledger.operators.checks import reconcile_files
from wageledger.operators.names import anonymize, missing_count
from wageledger.operators.staging import with_audit, with_file_stamps
from wageledger.schemas import landed_schema, raw_schema
from wageledger.sinks import versions
from wageledger.sinks.landing import land_snapshot
from wageledger.sinks.scratch import stored
from wageledger.sinks.tables import replace_partitions
from wageledger.sources.landing import is_complete, loaded_files, read_landed, read_snapshot, repeated_names
from wageledger.sources.ledger import LEDGER, NEW, SAME, SUSPECT, classified, digests, list_objects
from wageledger.sources.quoted import read_quoted, read_quoted_snapshot

log = logging.getLogger(__name__)

# Files per load job: bounds the file list one job carries. It has no effect on what is loaded.
BATCH_FILES = 10_000


def extract(spark: SparkSession, snapshot: str, landing: str, salt: str, run_ts: datetime, multiline: bool = False) -> str:
    """Anonymize a published snapshot and land it in one pass; returns the landed path."""
    df = read_quoted_snapshot(spark, snapshot) if multiline else read_snapshot(spark, snapshot)
    if "Name" not in df.columns:
        log.warning("no column 'Name': nothing to anonymize")
        return land_snapshot(df, landing, run_ts)
    seen = Observation("names")
    path = land_snapshot(anonymize(df.observe(seen, missing_count("Name").alias("missing")), salt), landing, run_ts)
    if seen.get["missing"]:
        log.warning("%d rows without a name", seen.get["missing"])
    return path


def _column(field: T.StructField) -> str:
    note = field.metadata.get("comment")
    text = f"`{field.name}` {field.dataType.simpleString()}"
    if note:
        text += " COMMENT '" + note.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return text


def ensure_raw(spark: SparkSession, name: str, schema: T.StructType | None = None) -> None:
    """Create the raw table on first use, with the described columns, one partition per source file."""
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(_column(f) for f in raw_schema(schema).fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (source_file)")


def required(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` as they are; a NULL in a column that ``schema`` requires fails the job that reads them."""
    checked = {
        f.name: F.when(F.col(f.name).isNull(), F.raise_error(F.lit(f"required column {f.name} is NULL")).cast(f.dataType)).otherwise(
            F.col(f.name)
        )
        for f in schema.fields
        if not f.nullable
    }
    return rows.withColumns(checked) if checked else rows


def append_raw(rows: DataFrame, name: str) -> None:
    """Add audited rows to the raw table.

    Rows go to the partition of their source file, which is replaced as a
    whole: a retry after a failed load cannot double a file. Nothing is
    shuffled, as every task writes the files it has read.
    """
    replace_partitions(rows, name)


def load_objects(
    spark: SparkSession,
    paths: list[str],
    raw: str,
    run_ts: datetime,
    schema: T.StructType,
    mode: str = "FAILFAST",
    multiline: bool = False,
) -> None:
    """Load whole landed objects, replacing what the raw table has of them.

    Each file has an ingestion time of its own: a microsecond later than the
    file before it, in the order of ``paths``.
    """
    rows = read_quoted(spark, paths, schema, mode) if multiline else read_landed(spark, paths, schema, mode)
    stamps = [(path.rsplit("/", 1)[-1], run_ts + timedelta(microseconds=i)) for i, path in enumerate(paths)]
    stamps = spark.createDataFrame(stamps, "source_file string, stamp timestamp")
    append_raw(with_file_stamps(with_audit(required(rows, schema), run_ts), stamps), raw)


def refuse_repeated(landed: DataFrame) -> None:
    """Raises if two objects share a name: the raw table could keep only one of them."""
    twice = [row["source_file"] for row in repeated_names(landed).limit(5).collect()]
    if twice:
        raise ValueError(f"landed more than once under one name: {', '.join(sorted(twice))}")


def ledger_of(raw: str) -> str:
    """The name of the ledger beside a raw table."""
    return f"{raw}__ledger"


def _recorded(spark: SparkSession, raw: str) -> DataFrame | None:
    """The ledger; one whose raw table is gone is dropped with it."""
    name = ledger_of(raw)
    if not spark.catalog.tableExists(raw):
        versions.drop(spark, name)
    return spark.table(name) if spark.catalog.tableExists(name) else None


def _record(entries: DataFrame, raw: str) -> None:
    """Write ledger entries, replacing those of the same files."""
    name = ledger_of(raw)
    if not entries.sparkSession.catalog.tableExists(name):
        versions.commit(entries.limit(0), name, ["source_file"], buckets=16)
    versions.merge(entries, name)


def ingest(
    spark: SparkSession,
    landing: str,
    raw: str,
    run_ts: datetime,
    schema: T.StructType | None = None,
    mode: str = "FAILFAST",
    multiline: bool = False,
) -> int | None:
    """Load the landed files that are new or changed; returns the raw table's row count, or None if there were none.

    A ledger keeps size, time of change and digest of what was loaded, so a file
    that is replaced under its name is loaded again, once, and one that was
    merely touched is not. Landed folders without their ``_SUCCESS`` marker are
    still being written and wait for a later run. Raises if two objects share a
    name, before anything is loaded, and if the landed and loaded file counts
    disagree afterwards, whether or not anything was new.
    """
    schema = schema or landed_schema()
    landed = stored(list_objects(spark, landing), "landed")
    refuse_repeated(landed)
    ledger = _recorded(spark, raw)
    there = loaded_files(spark.table(raw)) if spark.catalog.tableExists(raw) else None
    todo = stored(classified(landed, there, ledger).where(F.col("kind") != SAME), "todo").orderBy("source_file")
    loaded, waiting, at = 0, 0, run_ts
    # one batch of file names at a time on the driver
    for batch in batched(todo.toLocalIterator(), BATCH_FILES):
        whole = [row for row in batch if not row["in_parts"] or is_complete(spark, row["landed_object"])]
        waiting += sum(row["kind"] == NEW for row in batch) - sum(row["kind"] == NEW for row in whole)
        if not whole:
            continue
        found = stored(digests(spark, [row["landed_object"] for row in whole]), "digests")
        now = {row["source_file"]: row["digest"] for row in found.collect()}  # of one batch
        fresh = [row for row in whole if row["kind"] == NEW or row["kind"] == SUSPECT and now.get(row["source_file"], "") != row["known_digest"]]
        if fresh:
            ensure_raw(spark, raw, schema)
            load_objects(spark, [row["landed_object"] for row in fresh], raw, at, schema, mode, multiline)
            at += timedelta(microseconds=len(fresh))
            loaded += len(fresh)
        entries = [
            (row["source_file"], row["landed_object"], row["parts"], row["bytes"], row["modified"], now.get(row["source_file"], ""), run_ts) for row in whole
        ]
        _record(spark.createDataFrame(entries, LEDGER), raw)
    if waiting:
        log.warning("%d landed folders are not complete yet", waiting)
    rows = reconcile_load(landed, spark.table(raw), waiting) if spark.catalog.tableExists(raw) else None
    if not loaded:
        log.info("no new files in %s", landing)
        return None
    return rows


def reconcile_load(landed: DataFrame, raw: DataFrame, waiting: int = 0) -> int:
    """Rows in the raw table; raises if it has other than all landed files but those ``waiting``."""
    found = reconcile_files(landed, raw).first()
    if found["landed_files"] - waiting != found["loaded_files"]:
        raise ValueError(f"{found['landed_files'] - waiting} files landed but {found['loaded_files']} loaded")
    return found["loaded_rows"]
