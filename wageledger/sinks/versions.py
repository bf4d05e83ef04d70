"""Versioned tables: rows in buckets, each bucket in versions, and a pointer that is flipped last.

The rows of a table ``t`` lie in ``t__files``, partitioned by bucket and version;
a partition is written once and never changed. ``t`` itself is a view that names
one version of each bucket. A write makes new partitions and then replaces the
text of the view, which the catalog does in one step: readers see the former
version or the new one, and a writer that dies leaves the former one. A merge
writes only the buckets its keys fall into; the other buckets keep their files.

The bucket and version tests of the view are on partition columns alone, so a
reader lists and opens the files of its version only. Former versions stay for
readers that have begun, and can be read, until ``vacuum``. A write reserves its
number beforehand, so what a dead writer left is never taken for a version. One
writer at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.operators.upsert import merge_upsert
from wageledger.sinks.scratch import stored

BUCKET, VERSION = "_bucket", "_version"
# Table properties of the files: the last number reserved, the key, and the version of each bucket as of a write.
_LAST, _KEY, _AS_OF = "wageledger.last", "wageledger.key", "wageledger.as_of."
_POINTER = re.compile(rf"FROM (\S+) WHERE {VERSION} = array\(([\d, ]+)\)\[{BUCKET}\]")


@dataclass(frozen=True)
class Pointer:
    """The files a table is in, and the version of each bucket."""

    files: str
    versions: tuple[int, ...]

    def query(self, columns: Sequence[str]) -> str:
        listed = ", ".join(f"`{c}`" for c in columns)
        return f"SELECT {listed} FROM {self.files} WHERE {VERSION} = array({', '.join(map(str, self.versions))})[{BUCKET}]"

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows with their bucket."""
        version = F.get(F.array(*(F.lit(v) for v in self.versions)), F.col(BUCKET))
        return spark.table(self.files).where(F.col(VERSION) == version).drop(VERSION)


def _pointer(spark: SparkSession, name: str) -> Pointer | None:
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()
    found = text and _POINTER.search(text["data_type"])
    return Pointer(found[1], tuple(int(v) for v in found[2].split(","))) if found else None


def is_versioned(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and _pointer(spark, name) is not None


def current(spark: SparkSession, name: str) -> Pointer | None:
    """What the table points to; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    if (found := _pointer(spark, name)) is None:
        raise ValueError(f"{name} is not a versioned table")
    return found


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")


def _reserved(spark: SparkSession, files: str) -> int:
    number = int(_properties(spark, files).get(_LAST, 0)) + 1
    _set(spark, files, _LAST, str(number))
    return number


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, files: str, number: int, cluster: Sequence[str]) -> None:
    """Add the partitions of one version; ``rows`` have their bucket."""
    spark = rows.sparkSession
    rows = rows.withColumn(VERSION, F.lit(number)).select(*spark.table(files).columns)
    rows = rows.hint("rebalance", BUCKET, *cluster).sortWithinPartitions(BUCKET, *cluster)
    rows.write.mode("append").insertInto(files)


def _point(spark: SparkSession, name: str, pointer: Pointer, number: int) -> None:
    _set(spark, pointer.files, f"{_AS_OF}{number}", json.dumps(pointer.versions))
    columns = [c for c in spark.table(pointer.files).columns if c not in (BUCKET, VERSION)]
    # replacing a view would drop and create it; altering its text is one step
    verb = "ALTER" if spark.catalog.tableExists(name) else "CREATE"
    spark.sql(f"{verb} VIEW {name} AS {pointer.query(columns)}")


def _files_for(df: DataFrame, name: str, keys: Sequence[str], now: Pointer | None) -> str:
    """The table of files for rows of this shape: the present one, or a new one beside it."""
    spark = df.sparkSession
    shape = [(f.name, f.dataType) for f in df.schema.fields]
    if now:
        there = spark.table(now.files)
        if [(f.name, f.dataType) for f in there.schema.fields[:-2]] == shape and _properties(spark, now.files).get(_KEY) == json.dumps(list(keys)):
            return now.files
    number = 0
    while spark.catalog.tableExists(files := f"{name}__files{number or ''}"):
        number += 1
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(
        f"CREATE TABLE {files} ({columns}, {BUCKET} int, {VERSION} int) USING parquet PARTITIONED BY ({BUCKET}, {VERSION}) "
        f"TBLPROPERTIES ('{_KEY}' = '{json.dumps(list(keys))}')"
    )
    return files


def commit(df: DataFrame, name: str, keys: Sequence[str] = (), buckets: int = 1, cluster: Sequence[str] = ()) -> None:
    """Replace the table by ``df``, dealt into buckets by its ``keys``."""
    spark = df.sparkSession
    now = current(spark, name)
    files = _files_for(df, name, keys, now)
    number = _reserved(spark, files)
    dealt = bucket_of(keys, buckets) if keys else F.lit(0)
    _write(df.withColumn(BUCKET, dealt), files, number, cluster)
    _point(spark, name, Pointer(files, (number,) * (buckets if keys else 1)), number)


Combine = Callable[[DataFrame, DataFrame], DataFrame]


def merge(updates: DataFrame, name: str, combine: Combine | None = None, cluster: Sequence[str] = ()) -> list[int]:
    """Merge ``updates`` into the buckets that their keys fall into; returns those buckets.

    ``combine`` makes the new rows of a bucket from the rows it has and the
    updates; by default an update replaces the row of its key. Updates are
    stored first, as they are read more than once and may derive from the table.
    """
    spark = updates.sparkSession
    now = current(spark, name)
    if now is None:
        raise ValueError(f"{name} does not exist")
    keys = json.loads(_properties(spark, now.files)[_KEY])
    if not keys:
        raise ValueError(f"{name} has no key to merge by")
    updates = stored(updates.withColumn(BUCKET, bucket_of(keys, len(now.versions))), "updates")
    touched = sorted(row[0] for row in updates.select(BUCKET).distinct().collect())  # one per bucket at most
    if not touched:
        return []
    combine = combine or (lambda old, new: merge_upsert(old, new.select(*old.columns), keys[0]))
    there = now.read(spark).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    rows = combine(there, updates.drop(BUCKET)).withColumn(BUCKET, bucket_of(keys, len(now.versions)))
    number = _reserved(spark, now.files)
    _write(rows, now.files, number, cluster)
    versions = tuple(number if b in touched else v for b, v in enumerate(now.versions))
    _point(spark, name, Pointer(now.files, versions), number)
    return touched


def history(spark: SparkSession, name: str) -> list[Pointer]:
    """What the table points to and has pointed to, the latest first, as far as it is kept."""
    now = current(spark, name)
    if now is None:
        return []
    made = {int(k.removeprefix(_AS_OF)): v for k, v in _properties(spark, now.files).items() if k.startswith(_AS_OF)}
    # a version that was written but never pointed to is later than the current one
    return [Pointer(now.files, tuple(json.loads(made[n]))) for n in sorted(made, reverse=True) if n <= max(now.versions)]


def as_of(spark: SparkSession, name: str, back: int) -> DataFrame:
    """The table as it was ``back`` writes ago."""
    return history(spark, name)[back].read(spark).drop(BUCKET)


def vacuum(spark: SparkSession, name: str, keep: int = 2) -> int:
    """Delete what the last ``keep`` versions do not need, and what dead writers left; returns the partitions deleted."""
    kept = history(spark, name)[:keep]
    if not kept:
        return 0
    files, oldest = kept[0].files, min(max(p.versions) for p in kept)
    needed = {pair for p in kept for pair in enumerate(p.versions)}
    there = [tuple(int(part.split("=")[1]) for part in row["partition"].split("/")) for row in spark.sql(f"SHOW PARTITIONS {files}").collect()]
    gone = [pair for pair in there if pair not in needed]
    for bucket, version in gone:
        spark.sql(f"ALTER TABLE {files} DROP PARTITION ({BUCKET} = {bucket}, {VERSION} = {version})")
    for key in _properties(spark, files):
        if key.startswith(_AS_OF) and int(key.removeprefix(_AS_OF)) < oldest:
            spark.sql(f"ALTER TABLE {files} UNSET TBLPROPERTIES ('{key}')")
    return len(gone)


def drop(spark: SparkSession, name: str) -> None:
    """Drop the table with all its versions."""
    now = current(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    if now:
        spark.sql(f"DROP TABLE IF EXISTS {now.files}")
