"""Catalog tables in Parquet: full refresh, touched partitions only, merge, and views."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wageledger.operators.upsert import merge_upsert
from wageledger.sinks.scratch import stored


def create_databases(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_table(df: DataFrame, name: str, partition: Sequence[str] = (), cluster: Sequence[str] = ()) -> None:
    """Replace a table; rows are gathered by partition and cluster columns and sorted by them.

    The sort gives narrow Parquet min/max ranges per file. The rebalance lets
    adaptive execution cut a hot combination into files of the advisory size
    and merge the small ones, where a plain repartition would leave a third of
    the table to one task.

    The table keeps its former version until the new data is written:
    partitions are then exchanged in place, and an unpartitioned table is
    pointed to the folder of the new version.
    """
    spark = df.sparkSession
    keys = [*partition, *cluster]
    if keys:
        df = df.hint("rebalance", *keys).sortWithinPartitions(*keys)
    writer = df.write.format("parquet").mode("overwrite")
    if not partition:
        _point_table(df, name)
    elif spark.catalog.tableExists(name) and set(spark.table(name).columns) == set(df.columns):
        _exchange_partitions(df, name, partition)
    else:
        writer.partitionBy(*partition).saveAsTable(name)


# How long the folders of former versions stay for readers that have begun, and for sessions that remember them.
RETAINED = timedelta(days=1)


def _point_table(df: DataFrame, name: str) -> None:
    """Write a version of an unpartitioned table to a folder of its own, and point the table to it.

    The pointer is the table's location, which the catalog changes in one step:
    the table is never missing, and a writer that dies leaves it as it was.
    Former versions stay for a day: sessions that have read the table keep to
    the version they know until they refresh it. Only a change of columns, or a
    table that was made otherwise, is dropped and created anew.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    versions = f"{base.rstrip('/')}/{table}__versions"
    folder = f"{versions}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    former = _location(spark, name) if spark.catalog.tableExists(name) else None
    if former and f"{table}__versions/" in former and [f.simpleString() for f in spark.table(name).schema] == [f.simpleString() for f in df.schema]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
    _forget(spark, versions, {folder, former})


def _forget(spark: SparkSession, versions: str, kept: set[str | None]) -> None:
    """Delete the versions that are older than ``RETAINED`` and not among the ``kept``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(versions)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = {k.rsplit("/", 1)[-1] for k in kept if k}
    oldest = (time.time() - RETAINED.total_seconds()) * 1000
    for status in files.listStatus(path):
        if status.getPath().getName() not in names and status.getModificationTime() < oldest:
            files.delete(status.getPath(), True)


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _exchange_partitions(df: DataFrame, name: str, partition: Sequence[str]) -> None:
    """Overwrite the partitions ``df`` has rows for and drop the others.

    Which ones those are is collected while writing: one entry per partition,
    as the catalog holds them. Blank text is stored in the partition of NULL.
    """
    spark = df.sparkSession
    spec = F.to_json(F.array(*[F.col(c).cast("string") for c in partition]))
    written = Observation("partitions")
    replace_partitions(df.observe(written, F.collect_set(spec).alias("specs")), name)
    kept = {tuple(v or None for v in json.loads(s)) for s in written.get["specs"]}
    drop_partitions(spark, name, partition, [v for v in partition_values(spark, name) if v not in kept])


def partition_values(spark: SparkSession, name: str) -> list[tuple[str | None, ...]]:
    """The values of every partition as text, without the escapes of folder names."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    texts = [[unquote(part.split("=", 1)[1]) for part in row["partition"].split("/")] for row in rows]
    return [tuple(None if v == NO_VALUE else v for v in values) for values in texts]


def drop_partitions(spark: SparkSession, name: str, partition: Sequence[str], gone: Iterable[tuple[str | None, ...]]) -> None:
    for values in gone:
        terms = []
        for c, v in zip(partition, values, strict=True):
            text = "NULL" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
            terms.append(f"`{c}` = {text}")
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({', '.join(terms)})")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """As a setting of the session, since an insert into a table ignores the writer's option of that name."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_partitions(df: DataFrame, name: str, cluster: Sequence[str] = ()) -> None:
    """Replace exactly the partitions that ``df`` has rows for; running it again changes nothing."""
    spark = df.sparkSession
    df = df.select(*spark.table(name).columns)
    if cluster:
        df = df.hint("rebalance", *cluster).sortWithinPartitions(*cluster)
    with _dynamic_overwrite(spark):
        df.write.mode("overwrite").insertInto(name)


def refresh_aggregate(
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    name: str,
    changed: DataFrame | None = None,
    partition: str = "fiscal_year",
    cluster: Sequence[str] = ("job_title",),
) -> None:
    """Keep the stored aggregate ``build(source)`` up to date.

    With ``changed``, rows holding the ``partition`` values that are out of
    date, only those are read again and rewritten; the ones without rows in
    the source are dropped. The values, not rows, pass through the driver, so
    that they prune the partitions of the source.
    """
    spark = source.sparkSession
    if changed is None or not spark.catalog.tableExists(name):
        write_table(build(source), name, [partition], cluster)
        return
    touched = [row[0] for row in changed.select(partition).distinct().collect()]
    if not touched:
        return
    stale = source.where(among(partition, touched))
    there = {row[0] for row in stale.select(partition).distinct().collect()}
    refresh_partitions(build(stale), name, partition, touched, there, cluster)


def refresh_partitions(df: DataFrame, name: str, partition: str, touched: Iterable, there: set, cluster: Sequence[str] = ()) -> None:
    """Replace the ``touched`` partitions by ``df``, and drop those of them that are not ``there`` any more."""
    spark = df.sparkSession
    replace_partitions(df, name, [partition, *cluster])
    gone = {(None if v is None else str(v),) for v in touched if v not in there}
    drop_partitions(spark, name, [partition], [v for v in partition_values(spark, name) if v in gone])


def among(column: str, values: Sequence) -> Column:
    """Whether the column has one of the values, of which NULL may be one; prunes partitions."""
    met = F.col(column).isin([v for v in values if v is not None])
    return met | F.col(column).isNull() if None in values else met


def stale_partitions(fresh: DataFrame, kept: DataFrame, partition: str = "fiscal_year") -> DataFrame:
    """Partition values whose rows differ between an aggregate as it would be built now and as it was stored.

    Compares every row, amounts to the cent, so it finds corrections that
    leave counts and totals alike, partitions that vanished, and what an
    interrupted run has left behind.
    """

    def digests(df: DataFrame, sign: int) -> DataFrame:
        columns = [
            F.round(f.name, 2) + F.lit(0.0) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in sorted(df.schema.fields, key=lambda f: f.name)
        ]
        return df.groupBy(partition).agg(F.sum(F.lit(sign)).alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("x"))

    both = digests(fresh, 1).unionByName(digests(kept, -1)).groupBy(partition)
    return both.agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x")).where("n != 0 or x != 0").select(partition)


def merge_table(updates: DataFrame, name: str, key: str, cluster: Sequence[str] = (), gone: DataFrame | None = None) -> None:
    """Upsert into an unpartitioned table, by writing its merged version and pointing the table to it.

    The updates are stored first: they are read twice, may be derived from the
    table itself, and if small are then broadcast instead of shuffling it. Rows
    whose key is in ``gone`` and not among the updates are removed. A run that
    dies leaves the table as it was. ``versions.merge`` writes touched buckets
    only, for tables that are worth it.
    """
    spark = updates.sparkSession
    recover_swap(spark, name)
    if spark.catalog.tableExists(name):
        kept = spark.table(name)
        if gone is not None:
            kept = kept.join(stored(gone.select(key), "gone"), key, "left_anti")
        updates = merge_upsert(kept, stored(updates, "updates"), key)
    write_table(updates, name, cluster=cluster)


def recover_swap(spark: SparkSession, name: str) -> None:
    """Finish the swap of names that an earlier release began: the next version becomes the table when the table is gone."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__next"):
        spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Store a view in the catalog: later sessions find it, and it costs nothing until it is queried."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
