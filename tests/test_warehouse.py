import re
from dataclasses import fields
from datetime import UTC, date, datetime, timedelta

import pytest
from helpers import dicts
from pyspark.sql import functions as F

from wageledger.operators import rollups
from wageledger.plans import suite
from wageledger.plans.ingest import append_raw, ensure_raw
from wageledger.plans.suite import ChecksFailed, declared, violations
from wageledger.plans.warehouse import LAYERS, Tables, Views, transform
from wageledger.schemas import RAW_COLUMNS
from wageledger.sinks import versions
from wageledger.sinks.tables import (
    among,
    create_databases,
    merge_table,
    recover_swap,
    refresh_aggregate,
    stale_partitions,
    write_table,
)

DAY_1, DAY_2 = datetime(2025, 7, 1, tzinfo=UTC), datetime(2025, 7, 2, tzinfo=UTC)


def record(who, **changes):
    row = dict.fromkeys(RAW_COLUMNS, "10")
    row |= {"Year": "2025", "name_hash": who, "Working_Agency": " bus ", "Start_Date": "02/01/2025"}
    row |= {"Separation_Date": None, "Title": "Driver", "Department": None, "Pay_Basis": "Hourly"}
    return row | {"Total_Earnings": "50", "Updated_At": "06/01/2025"} | changes


def load(spark, name, file, at, *records):
    ensure_raw(spark, name)
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    rows = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in records], schema)
    append_raw(rows.withColumns({"raw_ingested_at": F.lit(at), "source_file": F.lit(file)}), name)


@pytest.fixture
def names(spark, request, monkeypatch):
    monkeypatch.setattr("wageledger.plans.warehouse.STATE_BUCKETS", 4)
    create_databases(spark, LAYERS)
    tables = Tables()
    tables = Tables(**{f.name: f"{getattr(tables, f.name)}_{request.node.originalname}" for f in fields(tables)})
    yield tables
    drop_all(spark, tables)


def drop_all(spark, tables):
    for f in fields(Views):
        spark.sql(f"DROP VIEW IF EXISTS {f.default}")
    for name in (tables.state, tables.totals):
        versions.drop(spark, name)
    for f in fields(tables):
        spark.sql(f"DROP TABLE IF EXISTS {getattr(tables, f.name)}")


def test_full_refresh(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"), record("h2", Working_Agency="Rail"))
    assert transform(spark, DAY_1 + timedelta(hours=1), names) == []
    assert spark.table(names.calendar).count() == 1827
    assert spark.table(names.fact).count() == spark.table(names.wide).count() == 2
    kpis = {r["agency_name"]: r["total_payroll"] for r in spark.table(Views.v_payroll_kpis).collect()}
    assert kpis == {"BUS": 50.0, "RAIL": 50.0}
    # another session on the same catalog finds the views, and they equal the operators
    other, wide = spark.newSession(), spark.table(names.wide)
    for view, build in (
        (Views.v_payroll_kpis, rollups.payroll_kpis),
        (Views.v_hr_dynamics, rollups.hr_dynamics),
        (Views.v_payroll_composition, rollups.payroll_composition),
    ):
        assert dicts(other.table(view)) == dicts(build(wide)) != []
    assert dicts(other.table(Views.stg_payroll)) == dicts(spark.table(names.staged)) != []
    again = dicts(spark.table(names.wide).drop("dbt_updated_at"))
    transform(spark, DAY_1 + timedelta(hours=2), names)
    assert dicts(spark.table(names.wide).drop("dbt_updated_at")) == again


def test_failed_check_stops_the_run(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1", Year="FY25"))
    with pytest.raises(ChecksFailed, match=r"not_null\(fiscal_year\) 1 rows"):
        transform(spark, DAY_1, names)
    assert not spark.catalog.tableExists(names.fact)


def test_lenient_run_reports_failures(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h1"))
    failures = transform(spark, DAY_2, names, strict=False)
    assert any(f.startswith("fct_payroll: unique(payroll_key)") for f in failures)


def test_incremental_equals_full_refresh(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"), record("h2"))
    transform(spark, DAY_1 + timedelta(hours=1), names, full_refresh=False)
    files = {r[0] for r in spark.table(names.overtime).select("_metadata.file_path").collect()}
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h2", Year="2026", Pay_Basis="Weekly"), record("h3", Year="2026"))
    transform(spark, DAY_2 + timedelta(hours=1), names, full_refresh=False)
    # the aggregate of 2025 was left alone
    assert files < {r[0] for r in spark.table(names.overtime).select("_metadata.file_path").collect()}
    stamped = {r["name_hash"]: r["dbt_updated_at"] for r in spark.table(names.employee).collect()}
    assert len(stamped) == 3 and stamped["h1"] < stamped["h2"] == stamped["h3"]
    merged = dicts(spark.table(names.wide).drop("dbt_updated_at"))
    transform(spark, DAY_2 + timedelta(hours=2), names)
    assert dicts(spark.table(names.wide).drop("dbt_updated_at")) == merged


ORDERED = ("fact", "wide", "employee", "overtime")


def contents(spark, names):
    return {t: dicts(spark.table(getattr(names, t)).drop("dbt_updated_at")) for t in ORDERED}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_incremental_equals_full_refresh_in_any_order(spark, names, order):
    """An open position that came before the closed record stays open; files are added, replaced and taken away."""
    loads = [
        ("payroll_1.csv", DAY_1, [record("h1"), record("h2", Year="2025", Title="Guard")]),
        ("payroll_2.csv", DAY_2, [record("h1", Year="2026", Separation_Date="03/01/2025", Pay_Basis="Weekly")]),
        ("payroll_3.csv", DAY_2 + timedelta(days=1), [record("h3", Year="2027", Overtime_Pay="0.1"), record("h2", Year="2026", Title="Guard", Department="X")]),
    ]
    for i in order:
        load(spark, names.raw, loads[i][0], loads[i][1], *loads[i][2])
        transform(spark, DAY_2 + timedelta(hours=1), names, full_refresh=False)
    # the second file is replaced: another person, another year
    load(spark, names.raw, "payroll_2.csv", DAY_2 + timedelta(days=2), record("h4", Year="2028"))
    transform(spark, DAY_2 + timedelta(hours=2), names, full_refresh=False)
    spark.sql(f"ALTER TABLE {names.raw} DROP PARTITION (source_file = 'payroll_3.csv')")
    transform(spark, DAY_2 + timedelta(hours=3), names, full_refresh=False)
    incremental = contents(spark, names)
    assert {r["name_hash"] for r in incremental["wide"]} == {"h1", "h2", "h4"}
    transform(spark, DAY_2 + timedelta(hours=4), names)
    assert contents(spark, names) == incremental


def test_nothing_new_rewrites_nothing(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    transform(spark, DAY_1, names)
    files = {t: spark.table(getattr(names, t)).select("_metadata.file_path").first()[0] for t in ORDERED}
    transform(spark, DAY_2, names, full_refresh=False)
    assert files == {t: spark.table(getattr(names, t)).select("_metadata.file_path").first()[0] for t in ORDERED}


def test_big_table_is_written_for_touched_years(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"), record("h2", Year="2026"), record("h3", Year="2027"))
    transform(spark, DAY_1, names)
    # h1 gets another basis, which shows in 2025; 2027 is nobody's who changed
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h1", Year="2026", Pay_Basis="Weekly"))
    transform(spark, DAY_2, names, full_refresh=False)
    stamps = {(r["name_hash"], r["fiscal_year"]): r["dbt_updated_at"] for r in spark.table(names.wide).collect()}
    assert stamps["h1", 2025] == stamps["h1", 2026] == stamps["h2", 2026] > stamps["h3", 2027]


def test_row_rules_are_checked_while_writing(spark, names, monkeypatch):
    """Only what no run writes whole, or what aggregates, is scanned for them."""
    scanned, plain = set(), suite.violations

    def recording(table, tables, rules, rows_too=True):
        scanned.update({table} if rows_too else ())
        return plain(table, tables, rules, rows_too)

    monkeypatch.setattr(suite, "violations", recording)
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    transform(spark, DAY_1, names)
    assert scanned == {"raw_payroll", "mv_overtime_by_job", "v_payroll_kpis", "v_hr_dynamics", "v_payroll_composition"}
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h2", Year="2031", Total_Earnings="9e9"))
    with pytest.raises(ChecksFailed, match=r"stg_payroll: in_set\(fiscal_year\) 1 rows; between\(total_earnings\) 1 rows"):
        transform(spark, DAY_2, names, full_refresh=False)


def test_quarantine(spark):
    rules = suite.Rules(("a",), (suite.InSet("a", (1, 2)), suite.Between("b", 0, 5)))
    good, bad = suite.quarantined(spark.createDataFrame([(1, 1), (1, 9), (3, None), (None, -1)], "a int, b int"), rules)
    assert dicts(good) == [{"a": 1, "b": 1}]
    assert {tuple(r["broken_rules"]) for r in bad.collect()} == {("between(b)",), ("in_set(a)",), ("not_null(a)", "between(b)")}


def test_views_follow_the_tables(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    transform(spark, DAY_1, names)
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h2"))
    transform(spark, DAY_2, names)
    assert spark.table(Views.v_payroll_kpis).first()["headcount"] == 2


def test_file_stamped_before_the_last_run_is_not_missed(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    transform(spark, DAY_2, names, full_refresh=False)
    load(spark, names.raw, "payroll_0.csv", DAY_1 - timedelta(days=1), record("h2"))
    transform(spark, DAY_2 + timedelta(hours=1), names, full_refresh=False)
    assert {r["name_hash"] for r in spark.table(names.wide).collect()} == {"h1", "h2"}


def test_interrupted_run_is_followed_by_a_full_one(spark, names, monkeypatch):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    transform(spark, DAY_1, names, full_refresh=False)
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h2"))
    with monkeypatch.context() as broken:
        broken.setattr("wageledger.plans.warehouse.merge_table", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            transform(spark, DAY_2, names, full_refresh=False)
    transform(spark, DAY_2, names, full_refresh=False)
    assert {r["name_hash"] for r in spark.table(names.employee).collect()} == {"h1", "h2"}


def test_latest_snapshot_only(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"), record("gone"))
    load(spark, names.raw, "payroll_2.csv", DAY_2, record("h1"), record("h2"))
    assert transform(spark, DAY_2, names, latest_only=True) == []
    assert {r["name_hash"] for r in spark.table(names.wide).collect()} == {"h1", "h2"}


def wide(spark, *rows):
    return spark.createDataFrame(
        list(rows), "fiscal_year long, agency_name string, job_title string, overtime_pay double, regular_pay double, total_earnings double"
    )


def test_refresh_rewrites_touched_years_only(spark, names):
    build = rollups.overtime_by_job
    first = [(2025, "A", "J", 1.0, 2.0, 3.0), (2026, "A", "J", 1.0, 2.0, 3.0), (None, "A", "J", 1.0, 2.0, 3.0)]
    refresh_aggregate(wide(spark, *first), build, names.overtime)
    # a later state in which 2025 also differs, but only 2026 and NULL are said to have changed
    later = [(2025, "A", "J", 9.0, 9.0, 9.0), (2026, "A", "J", 5.0, 5.0, 5.0), (None, "A", "J", 7.0, 7.0, 7.0)]
    refresh_aggregate(wide(spark, *later), build, names.overtime, changed=wide(spark, later[1], later[2]))
    got = {r["fiscal_year"]: r["total_overtime_pay"] for r in spark.table(names.overtime).collect()}
    assert got == {2025: 1.0, 2026: 5.0, None: 7.0}


def test_stale_partitions(spark):
    source = wide(spark, (2025, "A", "J", 1.0, 2.0, 3.0), (2026, "A", "J", 1.0, 2.0, 3.0), (None, "A", "J", 1.0, 2.0, 3.0))
    build = rollups.overtime_by_job
    stale = stale_partitions(build(source), build(source.where("fiscal_year = 2025")))
    assert {r["fiscal_year"] for r in stale.collect()} == {2026, None}
    assert stale_partitions(build(source), build(source)).count() == 0


def test_refresh_after_add_correct_and_remove(spark, names):
    build = rollups.overtime_by_job
    refresh_aggregate(wide(spark, *[(y, t, "J", 1.0, 2.0, 3.0) for y in (2024, 2025, None) for t in "AB"]), build, names.overtime)
    # 2024 is gone, 2025 moved an amount from A to B, 2026 is new, NULL stays
    rows = [(2025, "A", "J", 0.0, 2.0, 3.0), (2025, "B", "J", 2.0, 2.0, 3.0), (2026, "A", "J", 1.0, 2.0, 3.0)]
    source = wide(spark, *rows, (None, "A", "J", 1.0, 2.0, 3.0), (None, "B", "J", 1.0, 2.0, 3.0))
    stale = stale_partitions(build(source), spark.table(names.overtime))
    assert {r["fiscal_year"] for r in stale.collect()} == {2024, 2025, 2026}
    refresh_aggregate(source, build, names.overtime, stale)
    assert dicts(spark.table(names.overtime).select(*build(source).columns)) == dicts(build(source))


def test_refresh_prunes_the_source(spark, names):
    write_table(wide(spark, *[(y, "A", "J", 1.0, 2.0, 3.0) for y in (2024, 2025)]), names.fact, ["fiscal_year"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = spark.table(names.fact).where(among("fiscal_year", [2025, None]))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^]]*fiscal_year", plan)


def test_partition_values_of_any_text(spark, names):
    values = ["", "x:y", "a=b", "o'k", "50%", None, "c/d", "back\\slash"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, label string")
    for _ in range(2):
        write_table(df, names.fact, ["label"])
        assert {r["id"]: r["label"] for r in spark.table(names.fact).collect()} == {i: v or None for i, v in enumerate(values)}
    write_table(df.where("id = 1"), names.fact, ["label"])
    assert [r["label"] for r in spark.table(names.fact).collect()] == ["x:y"]


@pytest.mark.parametrize("times", [1, 2])
def test_table_is_partitioned_and_sorted(spark, names, times):
    df = spark.range(9000).select((F.col("id") % 3).alias("year"), (F.col("id") % 7).alias("k"), "id")
    for _ in range(times):
        write_table(df.repartition(4, "id"), names.fact, ["year"], ["k"])
    table = spark.table(names.fact)
    assert table.count() == 9000
    assert {c.name for c in spark.catalog.listColumns(names.fact) if c.isPartition} == {"year"}
    rows = table.select("k", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    in_file = sorted((r["f"], r["i"], r["k"]) for r in rows)
    assert all(x[2] <= y[2] for x, y in zip(in_file, in_file[1:]) if x[0] == y[0])


def test_full_refresh_drops_vanished_partitions(spark, names):
    def years(*values):
        return spark.createDataFrame([(i, y) for i, y in enumerate(values)], "id int, year int")

    for values in ([2024, 2025, None], [2025, 2026, 2026], [2027, None], [2025]):
        write_table(years(*values), names.fact, ["year"], ["id"])
        assert sorted((r["year"] or 0) for r in spark.table(names.fact).collect()) == sorted(v or 0 for v in values)
        assert spark.sql(f"SHOW PARTITIONS {names.fact}").count() == len(set(values))
    write_table(years(2025).withColumn("more", F.lit(1)), names.fact, ["year"])
    assert set(spark.table(names.fact).columns) == {"id", "year", "more"}


def test_failed_refresh_leaves_the_table(spark, names):
    bad = spark.range(10).select("id", F.when(F.col("id") < 20, F.raise_error(F.lit("no"))).cast("int").alias("year"))
    for table, partition in ((names.fact, ["year"]), (names.agency, [])):
        write_table(spark.range(5).withColumn("year", F.lit(2025)), table, partition)
        with pytest.raises(Exception, match="no"):
            write_table(bad, table, partition)
        spark.catalog.refreshTable(table)
        assert spark.table(table).count() == 5


def test_merge_table_twice_is_merge_once(spark, names):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    merge_table(target, names.employee, "k", ["v"])
    for _ in range(2):
        merge_table(updates, names.employee, "k", ["v"])
        assert {r["k"]: r["v"] for r in spark.table(names.employee).collect()} == {1: "a", 2: "B", 3: "c"}
    assert not spark.catalog.tableExists(f"{names.employee}__next")


def test_interrupted_swap_is_finished(spark, names):
    write_table(spark.range(3), f"{names.employee}__next")
    recover_swap(spark, names.employee)
    assert spark.table(names.employee).count() == 3


def test_declared_checks_are_complete():
    rules = declared()
    kinds = [type(r).__name__ for table in rules.values() for r in table.others]
    assert sum(len(t.not_null) for t in rules.values()) == 71
    assert {k: kinds.count(k) for k in set(kinds)} == {"Unique": 6, "InSet": 5, "Between": 5, "Parent": 4}


def test_violations_name_the_rule(spark):
    rules = suite.Rules(
        ("a",), (suite.InSet("a", (1, 2)), suite.Between("b", 0, 5), suite.Unique("a"), suite.Parent("a", "p", "id"))
    )
    tables = {
        "t": spark.createDataFrame([(1, 1), (1, 9), (3, None), (None, -1)], "a int, b int"),
        "p": spark.createDataFrame([(1,)], "id int"),
    }
    found = {(r["rule"], r["column_name"]): r["rows"] for r in violations("t", tables, rules).collect()}
    assert found == {
        ("not_null", "a"): 1,
        ("in_set", "a"): 1,
        ("between", "b"): 2,
        ("unique", "a"): 2,
        ("relationships", "a"): 1,
    }
    two = suite.Rules((), (suite.Between("b", low=0), suite.Between("b", high=100)))
    assert [r["rows"] for r in violations("t", tables, two).collect()] == [1]
    assert [r["rows"] for r in violations("t", tables, suite.Rules((), (suite.Unique("a"),))).collect()] == [2]
    fine = {**tables, "t": tables["t"].limit(0)}
    assert violations("t", fine, rules).count() == 0


def test_calendar_range_is_an_argument(spark, names):
    load(spark, names.raw, "payroll_1.csv", DAY_1, record("h1"))
    transform(spark, DAY_1, names, calendar_range=(date(2025, 1, 1), date(2025, 1, 31)))
    assert spark.table(names.calendar).count() == 31


def test_jobs_run_from_the_command_line(spark, tmp_path):
    from wageledger.__main__ import main

    header = ",".join(["Year", "Name", *RAW_COLUMNS[2:]])
    rows = [",".join(v or "" for v in record(who).values()) for who in ("Doe", "Roe")]
    (tmp_path / "published.csv").write_text("\n".join([header, *rows]), encoding="utf-8")
    (tmp_path / "salt").write_text("secret", encoding="utf-8")
    extracting = ["--snapshot", str(tmp_path / "published.csv"), "--salt-file", str(tmp_path / "salt")]
    landing = ["--landing", str(tmp_path / "landing")]
    main(["all", *extracting, *landing], spark)
    main(["load", *landing], spark)
    main(["transform", "--incremental"], spark)
    assert spark.table(Views.v_payroll_kpis).first()["headcount"] == 2
    # the feed is a full snapshot each time
    main(["all", "--latest-snapshot", *extracting, *landing], spark)
    assert spark.table(Views.v_payroll_kpis).first()["total_payroll"] == 100
    drop_all(spark, Tables())
