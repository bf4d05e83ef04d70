from datetime import UTC, datetime

import pytest
from helpers import dicts
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from wageledger.plans.ingest import extract, ingest, reconcile_load
from wageledger.schemas import RAW_COLUMNS, landed_schema, raw_schema, schema_from_fields
from wageledger.sinks.landing import land_snapshot
from wageledger.sinks.tables import create_databases
from wageledger.sources.landing import list_landed, new_files, read_landed, read_snapshot
from wageledger.streaming.landing_stream import ingest_stream

FAILED = (PySparkException, Py4JJavaError)
RUN = datetime(2025, 3, 4, 5, 6, 7, tzinfo=UTC)


def line(year="2025", who="h1", agency="Bus"):
    return f"{year},{who},{agency},01/05/2025,,Driver,D,Hourly,20,100,20,0,0,0,120,06/01/2025"


def put(folder, name, *lines, header=",".join(RAW_COLUMNS)):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


@pytest.fixture
def raw(spark, request):
    create_databases(spark, ["bronze"])
    name = f"bronze.raw_{request.node.name}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_snapshot_keeps_text(spark, tmp_path):
    put(tmp_path, "s.csv", '007," Doe ""Q"", Jo ",,', header="Year,Name,A,B")
    row = read_snapshot(spark, str(tmp_path / "s.csv")).first()
    assert (row["Year"], row["Name"], row["A"]) == ("007", ' Doe "Q", Jo ', None)


def test_multiline_snapshot(spark, tmp_path):
    put(tmp_path, "s.csv", '1,"a\nb"', header="Year,Name")
    assert read_snapshot(spark, str(tmp_path / "s.csv"), multiline=True).first()["Name"] == "a\nb"


def test_landing_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'q"x, y', None)], "a string, b string, c string")
    path = land_snapshot(df, str(tmp_path), RUN)
    assert path.endswith("/payroll_20250304_050607.csv")
    assert dicts(read_snapshot(spark, path)) == dicts(df)
    with pytest.raises(FAILED):
        land_snapshot(df, str(tmp_path), RUN)


def test_landed_files_bind_by_position(spark, tmp_path):
    put(tmp_path, "p.csv", line(), header=",".join(f"x{i}" for i in range(len(RAW_COLUMNS))))
    row = read_landed(spark, str(tmp_path / "p.csv")).first()
    assert (row["Year"], row["name_hash"], row["Updated_At"]) == ("2025", "h1", "06/01/2025")
    assert row["landed_path"].endswith("/p.csv")


def test_short_row_fails_the_load(spark, tmp_path):
    put(tmp_path, "p.csv", "2025,h1")
    with pytest.raises(FAILED):
        read_landed(spark, str(tmp_path / "p.csv")).collect()
    assert read_landed(spark, str(tmp_path / "p.csv"), mode="PERMISSIVE").count() == 1


def test_schema_from_fields():
    schema = schema_from_fields(
        [{"name": "Year", "type": "STRING", "mode": "NULLABLE", "description": "d"}, {"name": "n", "type": "INT64", "mode": "REQUIRED"}]
    )
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [("Year", "string", True), ("n", "bigint", False)]
    with pytest.raises(ValueError):
        schema_from_fields([{"name": "g", "type": "GEOGRAPHY"}])
    assert raw_schema().names[-2:] == ["raw_ingested_at", "source_file"]


def test_names_with_odd_characters(spark, tmp_path):
    put(tmp_path, "pay roll+1%.csv", line())
    listed = list_landed(spark, str(tmp_path)).first()
    assert listed["source_file"] == "pay roll+1%.csv"
    assert read_landed(spark, str(tmp_path / "pay*.csv")).first()["landed_path"].endswith("/pay roll+1%.csv")


def test_new_files_are_sorted_and_unloaded(spark):
    landed = spark.createDataFrame([("b.csv",), ("a.csv",), ("c.csv",), ("notes.txt",)], "source_file string")
    raw = spark.createDataFrame([("a.csv",), ("a.csv",), (None,)], "source_file string")
    assert [r[0] for r in new_files(landed, raw).collect()] == ["b.csv", "c.csv"]
    assert [r[0] for r in new_files(landed, None).collect()] == ["a.csv", "b.csv", "c.csv"]


def test_ingest_loads_each_file_once(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line(), line(who="h2"))
    put(landing, "ignored.txt", "x")
    assert ingest(spark, str(landing), raw, RUN) == 2
    assert ingest(spark, str(landing), raw, RUN) is None
    put(landing, "payroll_2.csv", line(who="h3"))
    assert ingest(spark, str(landing), raw, datetime(2025, 3, 5, tzinfo=UTC)) == 3
    per_file = spark.table(raw).groupBy("source_file", "raw_ingested_at").count().collect()
    assert {(r["source_file"], r["count"]) for r in per_file} == {("payroll_1.csv", 2), ("payroll_2.csv", 1)}
    assert set(spark.table(raw).columns) == set(raw_schema().names)


def test_failed_file_can_be_loaded_again(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line())
    put(landing, "payroll_2.csv", "broken")
    with pytest.raises(FAILED):
        ingest(spark, str(landing), raw, RUN)
    put(landing, "payroll_2.csv", line(who="h2"))
    assert ingest(spark, str(landing), raw, RUN) == 2


def test_landed_folder_counts_as_one_file(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    rows = spark.createDataFrame([tuple(line(who=f"h{i}").split(",")) for i in range(40)], landed_schema())
    land_snapshot(rows.repartition(4), str(landing), RUN)
    assert ingest(spark, str(landing), raw, RUN) == 40
    assert [r[0] for r in spark.table(raw).select("source_file").distinct().collect()] == ["payroll_20250304_050607.csv"]


def test_file_counts_must_agree(spark):
    landed = spark.createDataFrame([("a.csv",), ("b.csv",)], "source_file string")
    raw = spark.createDataFrame([("a.csv",)], "source_file string")
    with pytest.raises(ValueError, match="2 files landed but 1 loaded"):
        reconcile_load(landed, raw)
    assert reconcile_load(landed.limit(1), raw) == 1


def test_extract_then_load(spark, tmp_path, raw, caplog):
    header = ",".join(["Year", "Name", *RAW_COLUMNS[2:]])
    put(tmp_path, "published.csv", line(who=" Doe "), line(who=""), header=header)
    extract(spark, str(tmp_path / "published.csv"), str(tmp_path / "landing"), "salt", RUN)
    assert "1 rows without a name" in caplog.text
    assert ingest(spark, str(tmp_path / "landing"), raw, RUN) == 2
    hashes = [r["name_hash"] for r in spark.table(raw).collect()]
    assert all(len(h) == 16 for h in hashes) and len(set(hashes)) == 2


def test_stream_loads_each_file_once(spark, tmp_path, raw):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    put(landing, "payroll_1.csv", line(), line(who="h2"))
    for new in ("payroll_2.csv", None):
        query = ingest_stream(spark, str(landing), raw, checkpoint)
        assert query.awaitTermination(120)
        if new:
            put(landing, new, line(who="h3"))
    counts = {r["source_file"]: r["count"] for r in spark.table(raw).groupBy("source_file").count().collect()}
    assert counts == {"payroll_1.csv": 2, "payroll_2.csv": 1}
    assert ingest(spark, str(landing), raw, RUN) is None


def test_damaged_snapshot_lands_nothing(spark, tmp_path):
    header = ",".join(["Year", "Name", *RAW_COLUMNS[2:]])
    put(tmp_path, "published.csv", line(), line(who='"Doe\nJo"'), header=header)
    landing = tmp_path / "landing"
    with pytest.raises(FAILED):
        extract(spark, str(tmp_path / "published.csv"), str(landing), "salt", RUN)
    assert not list(landing.rglob("_SUCCESS"))


def test_multiline_snapshot_round_trip(spark, tmp_path, raw):
    header = ",".join(["Year", "Name", *RAW_COLUMNS[2:]])
    put(tmp_path, "published.csv", line(), line(who='"Doe\nJo"', agency='"Bus\nNorth"'), line(who="Doe"), header=header)
    landing = str(tmp_path / "landing")
    extract(spark, str(tmp_path / "published.csv"), landing, "salt", RUN, multiline=True)
    assert ingest(spark, landing, raw, RUN, multiline=True) == 3
    rows = spark.table(raw).collect()
    assert sorted(r["Working_Agency"] for r in rows) == ["Bus", "Bus", "Bus\nNorth"]
    assert not any("Doe" in str(v) or "Jo" in str(v) for r in rows for v in r)


def test_one_name_in_two_folders_is_refused(spark, tmp_path, raw, monkeypatch):
    monkeypatch.setattr("wageledger.plans.ingest.BATCH_FILES", 1)
    landing = tmp_path / "landing"
    put(landing, "payroll_0.csv", line())
    for folder in ("a", "b"):
        put(landing / folder, "payroll_1.csv", line(who=folder))
    with pytest.raises(ValueError, match="payroll_1.csv"):
        ingest(spark, str(landing), raw, RUN)
    assert not spark.catalog.tableExists(raw)


def test_batches_load_what_one_job_loads(spark, tmp_path, raw, monkeypatch):
    monkeypatch.setattr("wageledger.plans.ingest.BATCH_FILES", 2)
    for i in range(5):
        put(tmp_path / "landing", f"payroll_{i}.csv", line(who=f"h{i}"))
    assert ingest(spark, str(tmp_path / "landing"), raw, RUN) == 5
    assert {r["name_hash"] for r in spark.table(raw).collect()} == {f"h{i}" for i in range(5)}


def test_late_part_of_a_folder(spark, tmp_path, raw):
    part = tmp_path / "landing" / "payroll_1.csv"
    part.parent.mkdir()
    put(part, "part-0.csv", line())
    assert ingest(spark, str(tmp_path / "landing"), raw, RUN) is None
    put(part, "part-1.csv", line(who="h2"))
    (part / "_SUCCESS").touch()
    assert ingest(spark, str(tmp_path / "landing"), raw, RUN) == 2


def test_late_part_in_a_stream(spark, tmp_path, raw):
    part, checkpoint = tmp_path / "landing" / "payroll_1.csv", str(tmp_path / "checkpoint")
    part.parent.mkdir()
    put(part, "part-0.csv", line())
    with pytest.raises(FAILED, match="not complete"):
        ingest_stream(spark, str(part.parent), raw, checkpoint).awaitTermination(120)
    put(part, "part-1.csv", line(who="h2"))
    (part / "_SUCCESS").touch()
    assert ingest_stream(spark, str(part.parent), raw, checkpoint).awaitTermination(120)
    assert sorted(r["name_hash"] for r in spark.table(raw).collect()) == ["h1", "h2"]


def test_lost_file_is_noticed_without_news(spark, tmp_path, raw):
    landing = tmp_path / "landing"
    put(landing, "payroll_1.csv", line())
    ingest(spark, str(landing), raw, RUN)
    (landing / "payroll_1.csv").rename(landing / "kept.txt")
    put(landing, "notes.txt", "x")
    with pytest.raises(ValueError, match="0 files landed but 1 loaded"):
        ingest(spark, str(landing), raw, RUN)


def test_required_columns_and_descriptions(spark, tmp_path, raw):
    schema = schema_from_fields([{"name": "a", "mode": "REQUIRED", "description": "the 'a'"}, {"name": "b"}])
    put(tmp_path / "landing", "payroll_1.csv", ",x", header="a,b")
    with pytest.raises(FAILED, match="required column a"):
        ingest(spark, str(tmp_path / "landing"), raw, RUN, schema)
    put(tmp_path / "landing", "payroll_1.csv", "1,", header="a,b")
    assert ingest(spark, str(tmp_path / "landing"), raw, RUN, schema) == 1
    assert {c.name: c.description for c in spark.catalog.listColumns(raw)}["a"] == "the 'a'"
