"""Versioned tables: readers during a write, dead writers, buckets that a merge leaves alone."""

import os
import threading
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from wageledger.sinks import tables, versions
from wageledger.sinks.tables import create_databases, write_table


@pytest.fixture
def name(spark, request):
    create_databases(spark, ["silver"])
    name = f"silver.{request.node.originalname}"
    versions.drop(spark, name)
    yield name
    if versions.is_versioned(spark, name):
        versions.drop(spark, name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def keyed(spark, n, label):
    return spark.range(n).select("id", F.lit(label).alias("v"), F.lit(7).alias("_x"))


def files(spark, name):
    return {r[0] for r in versions.current(spark, name).read(spark).select("_metadata.file_path").distinct().collect()}


def reading_while(spark, read, write, times=6):
    """What a reader in another session sees, again and again, while ``write`` runs."""
    seen, failed, stop = [], [], threading.Event()

    def loop():
        other = spark.newSession()
        while not stop.is_set():
            try:
                seen.append(read(other))
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=loop)
    reader.start()
    try:
        for i in range(times):
            write(i)
    finally:
        stop.set()
        reader.join()
    assert not failed and len(seen) > times
    return seen


def test_readers_never_miss_a_versioned_table(spark, name):
    versions.commit(keyed(spark, 100, "a"), name, ["id"], 4)

    def read(session):
        return tuple(sorted((r["v"], r["count"]) for r in session.table(name).groupBy("v").count().collect()))

    seen = reading_while(spark, read, lambda i: versions.commit(keyed(spark, 100, f"b{i}"), name, ["id"], 4))
    # one whole version at a time
    assert all(len(s) == 1 and s[0][1] == 100 for s in seen) and len(set(seen)) > 1


def test_readers_never_miss_a_pointed_table(spark, name):
    write_table(keyed(spark, 100, "a"), name)
    seen = reading_while(spark, lambda s: s.table(name).count(), lambda i: write_table(keyed(spark, 100, f"b{i}"), name))
    assert set(seen) == {100}
    assert {r["v"] for r in spark.table(name).collect()} == {"b5"}


def test_pointed_table_forgets_old_versions(spark, name, monkeypatch):
    for i in range(3):
        write_table(keyed(spark, 10, str(i)), name)
    folder = spark.table(name).inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert len(os.listdir(folder)) == 3
    monkeypatch.setattr(tables, "RETAINED", timedelta(seconds=-60))
    write_table(keyed(spark, 10, "3"), name)
    # the one before stays
    assert len(os.listdir(folder)) == 2 and spark.table(name).first()["v"] == "3"
    write_table(spark.range(4), name)
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 4


def test_dead_writers_leave_the_version(spark, name):
    versions.commit(keyed(spark, 50, "a"), name, ["id"], 4)
    bad = keyed(spark, 50, "b").withColumn("v", F.when(F.col("id") > 40, F.raise_error(F.lit("no"))).otherwise("b"))
    for _ in range(2):
        with pytest.raises(Exception, match="no"):
            versions.commit(bad, name, ["id"], 4)
        with pytest.raises(Exception, match="no"):
            versions.merge(bad, name)
    assert {(r["v"], r["count"]) for r in spark.table(name).groupBy("v").count().collect()} == {("a", 50)}


def test_a_writer_that_dies_before_the_flip(spark, name, monkeypatch):
    versions.commit(keyed(spark, 50, "a"), name, ["id"], 4)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_point", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versions.commit(keyed(spark, 60, "b"), name, ["id"], 4)
    assert spark.table(name).count() == 50
    versions.commit(keyed(spark, 70, "c"), name, ["id"], 4)
    assert spark.table(name).count() == 70
    # what it left is nobody's version
    assert versions.vacuum(spark, name, keep=2) == 4
    assert versions.as_of(spark, name, 1).count() == 50 and spark.table(name).count() == 70


def test_merge_writes_touched_buckets_only(spark, name):
    versions.commit(keyed(spark, 1000, "a"), name, ["id"], 16)
    before = files(spark, name)
    touched = versions.merge(spark.createDataFrame([(3, "b", 8), (5000, "b", 8)], "id long, v string, _x int"), name)
    after = files(spark, name)
    assert len(touched) <= 2 and len(before & after) >= 14 and len(after - before) <= 2
    assert spark.table(name).count() == 1001
    assert {r["id"] for r in spark.table(name).where("v = 'b'").collect()} == {3, 5000}
    # merging again changes nothing, merging nothing writes nothing
    versions.merge(spark.createDataFrame([(3, "b", 8), (5000, "b", 8)], "id long, v string, _x int"), name)
    assert spark.table(name).count() == 1001
    now = versions.current(spark, name)
    assert versions.merge(keyed(spark, 0, "z"), name) == [] and versions.current(spark, name) == now


def test_merge_may_combine(spark, name):
    versions.commit(spark.createDataFrame([(i, 1) for i in range(20)], "id long, n long"), name, ["id"], 4)

    def add(old, new):
        return old.unionByName(new).groupBy("id").agg(F.sum("n").alias("n")).where("n > 0")

    versions.merge(spark.createDataFrame([(1, 5), (2, -1), (30, 1)], "id long, n long"), name, add)
    got = {r["id"]: r["n"] for r in spark.table(name).collect()}
    assert got == {i: 1 for i in range(20) if i != 2} | {1: 6, 30: 1}


def test_readers_open_the_files_of_one_version(spark, name):
    for label in "abc":
        versions.commit(keyed(spark, 40, label), name, ["id"], 2)
    plan = spark.table(name)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_version" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = spark.table(name).select(F.input_file_name().alias("f")).distinct().collect()
    assert all("_version=3/" in r["f"] for r in read)


def test_former_versions_until_vacuum(spark, name):
    for label in "abc":
        versions.commit(keyed(spark, 40, label), name, ["id"], 2)
    assert [versions.as_of(spark, name, i).first()["v"] for i in range(3)] == ["c", "b", "a"]
    assert versions.vacuum(spark, name, keep=2) == 2
    assert len(versions.history(spark, name)) == 2 and versions.as_of(spark, name, 1).count() == 40
    with pytest.raises(IndexError):
        versions.as_of(spark, name, 2)


def test_columns_may_change(spark, name):
    versions.commit(keyed(spark, 10, "a"), name)
    versions.commit(spark.range(5).withColumn("more", F.lit(1.5)), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 5
    with pytest.raises(ValueError, match="no key"):
        versions.merge(spark.table(name), name)


def test_other_tables_are_not_versioned(spark, name):
    spark.range(3).write.saveAsTable(name)
    with pytest.raises(ValueError, match="not a versioned table"):
        versions.current(spark, name)


def test_null_keys_are_kept_and_added(spark, name):
    rows = "id long, v string"
    versions.commit(spark.createDataFrame([(None, "a"), (1, "a")], rows), name, ["id"], 4)
    versions.merge(spark.createDataFrame([(None, "b"), (1, "b")], rows), name)
    assert sorted((r["id"] or 0, r["v"]) for r in spark.table(name).collect()) == [(0, "a"), (0, "b"), (1, "b")]
