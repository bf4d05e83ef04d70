"""Landed files are known by what they hold: replaced ones are loaded again, touched ones are not."""

import os
from datetime import UTC, timedelta

import pytest
from test_ingest import RUN, line, put

from wageledger.plans.ingest import ingest, ledger_of
from wageledger.sinks import scratch, versions
from wageledger.sinks.tables import create_databases
from wageledger.streaming import landing_stream


@pytest.fixture
def raw(spark, request):
    create_databases(spark, ["bronze"])
    name = f"bronze.ledger_{request.node.name}"
    yield name
    versions.drop(spark, ledger_of(name))
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def later(n):
    return RUN + timedelta(hours=n)


def names(spark, raw):
    return sorted(r["name_hash"] for r in spark.table(raw).collect())


def test_replaced_file_is_loaded_again_once(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line(who="h1"))
    put(landing, "payroll_2.csv", line(who="h2"))
    assert ingest(spark, str(landing), raw, RUN) == 2
    put(landing, "payroll_1.csv", line(who="h3"), line(who="h4"))
    assert ingest(spark, str(landing), raw, later(1)) == 3
    assert names(spark, raw) == ["h2", "h3", "h4"]
    assert ingest(spark, str(landing), raw, later(2)) is None
    at = {r["source_file"]: r["raw_ingested_at"].astimezone(UTC) for r in spark.table(raw).collect()}
    assert at["payroll_1.csv"] >= later(1) > at["payroll_2.csv"]


def test_replaced_by_a_file_of_the_same_size(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line(who="h1"))
    ingest(spark, str(landing), raw, RUN)
    put(landing, "payroll_1.csv", line(who="h9"))
    os.utime(landing / "payroll_1.csv", (2_000_000_000, 2_000_000_000))
    assert ingest(spark, str(landing), raw, later(1)) == 1
    assert names(spark, raw) == ["h9"]


def test_touched_file_is_not_loaded(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line())
    ingest(spark, str(landing), raw, RUN)
    for n in (1, 2):
        os.utime(landing / "payroll_1.csv", (2_000_000_000 + n, 2_000_000_000 + n))
        assert ingest(spark, str(landing), raw, later(n)) is None
    assert spark.table(ledger_of(raw)).first()["modified"].timestamp() == 2_000_000_002


def test_files_of_one_load_have_times_of_their_own(spark, tmp_path, raw, monkeypatch):
    monkeypatch.setattr("wageledger.plans.ingest.BATCH_FILES", 2)
    landing = tmp_path / "landing"
    for i in range(5):
        put(landing, f"payroll_{i}.csv", line(who=f"a{i}"), line(who=f"b{i}"))
    ingest(spark, str(landing), raw, RUN)
    rows = sorted({(r["source_file"], r["raw_ingested_at"].astimezone(UTC)) for r in spark.table(raw).collect()})
    assert [t for _, t in rows] == [RUN + timedelta(microseconds=i) for i in range(5)]


def test_table_without_a_ledger_is_taken_as_it_is(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line())
    ingest(spark, str(landing), raw, RUN)
    versions.drop(spark, ledger_of(raw))
    assert ingest(spark, str(landing), raw, later(1)) is None
    put(landing, "payroll_1.csv", line(who="h2"), line(who="h3"))
    assert ingest(spark, str(landing), raw, later(2)) == 2


def test_ledger_goes_with_its_table(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line())
    ingest(spark, str(landing), raw, RUN)
    spark.sql(f"DROP TABLE {raw}")
    assert ingest(spark, str(landing), raw, later(1)) == 1


def test_ledger_holds_a_digest_of_the_lines(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line())
    ingest(spark, str(landing), raw, RUN)
    assert spark.table(ledger_of(raw)).first()["digest"].startswith("2:")


def test_stream_takes_files_in_bounded_batches(spark, tmp_path, raw, monkeypatch):
    monkeypatch.setattr(landing_stream, "BATCH_FILES", 2)
    for i in range(5):
        put(tmp_path / "landing", f"payroll_{i}.csv", line(who=f"h{i}"))
    query = landing_stream.ingest_stream(spark, str(tmp_path / "landing"), raw, str(tmp_path / "checkpoint"))
    assert query.awaitTermination(120)
    assert names(spark, raw) == [f"h{i}" for i in range(5)]
    assert query.lastProgress["batchId"] >= 2


def test_scratch_is_cleaned(spark):
    with scratch.cleaned(spark):
        df = scratch.stored(spark.range(3), "numbers")
        path = df.inputFiles()[0].removeprefix("file://")
        with scratch.cleaned(spark):
            scratch.stored(spark.range(3), "more")
        assert os.path.exists(path)
    assert not os.path.exists(path)
    assert "run-" not in scratch.new_path(spark, "x")

