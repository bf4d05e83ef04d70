from datetime import date, datetime

import pytest
from helpers import dicts, staged
from pyspark.sql import functions as F

from wageledger.operators import checks, dimensions, lookups, rollups, upsert
from wageledger.operators.staging import latest_snapshot

MARCH = date(2025, 3, 1)


def golden(spark, *rows):
    return dimensions.dim_employee(staged(spark, *rows)).collect()


def test_open_record_beats_closed_one(spark):
    rows = golden(
        spark,
        {"raw_ingested_at": datetime(2025, 1, 1), "separation_date": None, "pay_basis": "OLD"},
        {"raw_ingested_at": datetime(2025, 9, 1), "separation_date": MARCH, "pay_basis": "NEW"},
    )
    assert [(r["separation_date"], r["pay_basis"]) for r in rows] == [(None, "OLD")]


def test_later_load_breaks_a_tie(spark):
    rows = golden(
        spark,
        {"raw_ingested_at": datetime(2025, 9, 1), "pay_basis": "NEW"},
        {"raw_ingested_at": datetime(2025, 1, 1), "pay_basis": "OLD"},
    )
    assert [r["pay_basis"] for r in rows] == ["NEW"]


def test_later_file_of_a_load_breaks_a_tie(spark):
    rows = golden(
        spark,
        {"source_file": "payroll_2.csv", "pay_basis": "NEW"},
        {"source_file": "payroll_1.csv", "pay_basis": "OLD"},
    )
    assert [r["pay_basis"] for r in rows] == ["NEW"]


def test_order_is_an_argument(spark):
    stg = staged(spark, {"pay_basis": "A"}, {"pay_basis": "B"})
    assert dimensions.dim_employee(stg, order=[F.col("pay_basis").desc()]).first()["pay_basis"] == "B"


def test_missing_keys_group_together(spark):
    rows = golden(spark, {"name_hash": None}, {"name_hash": None}, {"start_date": None}, {"start_date": None})
    assert len(rows) == 2
    assert sum(r["employee_key"] is None for r in rows) == 1


def test_hot_person_is_still_one_row(spark):
    hot = spark.range(20_000).select(F.lit("n").alias("k"), F.col("id"))
    latest = dimensions.latest_per_key(hot, ["k"], [F.col("id").desc()])
    assert [r["id"] for r in latest.collect()] == [19_999]


def star(spark, *rows):
    stg = staged(spark, *rows)
    return stg, dimensions.dim_employee(stg), dimensions.dim_agency(stg), dimensions.dim_job_title(stg)


ODD_ROWS = (
    {},
    {"pay_basis": "WEEKLY", "separation_date": MARCH},
    {"name_hash": None},
    {"start_date": None},
    {"start_date": None, "fiscal_year": None},
    {"agency_name": "", "job_title": "CLERK"},
    {"name_hash": "n2", "fiscal_year": 2026, "total_earnings": -1.0},
)


def test_lookups_equal_derived_keys(spark):
    stg, *dims = star(spark, *ODD_ROWS)
    looked_up = lookups.fact_payroll(lookups.lookup_keys(stg, *dims))
    derived = lookups.fact_payroll(lookups.derive_keys(stg))
    assert dicts(looked_up) == dicts(derived)
    assert looked_up.count() == len(ODD_ROWS)


def test_missing_start_dates_match_and_missing_names_do_not(spark):
    stg, people, _, _ = star(spark, {"start_date": None}, {"name_hash": None})
    keys = {r["name_hash"]: r["employee_key"] for r in lookups.lookup_employee(stg, people).collect()}
    assert keys["n1"] is not None and keys[None] is None


def test_label_without_dimension_row_keeps_the_record(spark):
    stg = staged(spark, {})
    none = dimensions.dim_agency(staged(spark, {"agency_name": "RAIL"}))
    assert lookups.lookup_dim(stg, none, "agency_name", "agency_key").first()["agency_key"] is None


def test_wide_records_equal_the_star(spark):
    stg, people, agencies, titles = star(spark, *ODD_ROWS)
    fact = lookups.fact_payroll(lookups.derive_keys(stg))
    assert dicts(lookups.denormalize(fact, people, agencies, titles)) == dicts(lookups.wide_records(stg, people))


def test_payroll_kpis_count_people_once(spark):
    wide = lookups.derive_keys(staged(spark, {}, {}))
    row = rollups.payroll_kpis(wide).first()
    assert (row["headcount"], row["total_records"], row["total_payroll"]) == (1, 2, 264.0)


def test_overtime_by_job_counts_records(spark):
    row = rollups.overtime_by_job(lookups.derive_keys(staged(spark, {}, {}))).first()
    assert (row["employee_count"], row["total_overtime_pay"]) == (2, 40.0)


def wide(spark, *rows):
    stg = staged(spark, *rows)
    return lookups.wide_records(stg, dimensions.dim_employee(stg))


def test_hr_dynamics_counts_events_of_the_year(spark):
    out = dicts(rollups.hr_dynamics(wide(spark, {"separation_date": date(2026, 1, 5)}, {"name_hash": "n2"})))
    assert [(r["event_type"], r["volume_events"]) for r in out] == [("Hire", 2)]


def test_workforce_balance_fills_the_absent_side(spark):
    left = {"start_date": date(2020, 1, 1), "separation_date": MARCH}
    dynamics = rollups.hr_dynamics(wide(spark, left, {**left, "name_hash": "n2"}, {"agency_name": "RAIL"}))
    out = {r["agency_name"]: (r["hires"], r["separations"], r["net_balance"]) for r in rollups.workforce_balance(dynamics).collect()}
    assert out == {"BUS": (0, 2, -2), "RAIL": (1, 0, 1)}


def test_composition_has_five_types_that_add_up(spark):
    out = dicts(rollups.payroll_composition(staged(spark, {}, {})))
    assert len(out) == 5
    assert sum(r["total_amount"] for r in out) == 2 * 132.0


def test_composition_keeps_groups_without_amounts(spark):
    nothing = {m: None for m in rollups.PAY_TYPES}
    assert rollups.payroll_composition(staged(spark, nothing)).count() == 5


def test_overtime_shares(spark):
    kpis = rollups.payroll_kpis(
        lookups.derive_keys(
            staged(spark, {"total_earnings": 80.0}, {"agency_name": "RAIL"}, {"agency_name": "X", "total_earnings": 0.0})
        )
    )
    shares = {r["agency_name"]: (r["overtime_share"], r["is_critical"]) for r in rollups.overtime_share_agency(kpis).collect()}
    assert shares["BUS"] == (0.25, True)
    assert shares["RAIL"][1] is False
    assert shares["X"] == (None, None)
    assert rollups.overtime_share_total(kpis).first()["overtime_share"] == pytest.approx(60 / 212)


def test_headcount_payroll_corr(spark):
    rows = [{"agency_name": a, "name_hash": f"{a}{i}"} for n, a in enumerate("ABC", 1) for i in range(n)]
    row = rollups.headcount_payroll_corr(rollups.payroll_kpis(lookups.derive_keys(staged(spark, *rows)))).first()
    assert row["headcount_payroll_corr"] == pytest.approx(1.0)
    assert row["agencies"] == 3


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def test_merge_updates_and_inserts(spark):
    target, updates = pairs(spark, (1, "1"), (2, "2"), (None, "t")), pairs(spark, (2, "2'"), (3, "3"))
    once = upsert.merge_upsert(target, updates, "k")
    want = [{"k": 1, "v": "1"}, {"k": 2, "v": "2'"}, {"k": 3, "v": "3"}, {"k": None, "v": "t"}]
    assert dicts(once) == sorted(want, key=repr)
    assert dicts(upsert.merge_upsert(once, updates, "k")) == dicts(once)


def test_high_water_mark(spark):
    src = staged(spark, {"raw_ingested_at": datetime(2025, 1, 1)}, {"raw_ingested_at": datetime(2025, 3, 1)})
    target = spark.createDataFrame([(datetime(2025, 2, 1),)], "dbt_updated_at timestamp")
    assert [r["raw_ingested_at"] for r in upsert.since_high_water(src, target).collect()] == [datetime(2025, 3, 1)]
    assert upsert.since_high_water(src, target.limit(0)).count() == 0


def test_latest_snapshot_is_one_file(spark):
    stg = staged(spark, {}, {"source_file": "payroll_2.csv"}, {"source_file": "payroll_0.csv"})
    assert [r["source_file"] for r in latest_snapshot(stg).collect()] == ["payroll_2.csv"]


def test_not_null(spark):
    stg = staged(spark, {"name_hash": None}, {"fiscal_year": None}, {"fiscal_year": None})
    out = dicts(checks.not_null(stg, ["name_hash", "fiscal_year", "agency_name"]))
    assert out == [{"column_name": "fiscal_year", "null_rows": 2}, {"column_name": "name_hash", "null_rows": 1}]


def test_unique_ignores_nulls(spark):
    out = dicts(checks.unique(pairs(spark, (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")), "k"))
    assert out == [{"value": 1, "n_records": 2}]


def test_doubled_snapshot_fails_unique(spark):
    twice = [{"source_file": f, "name_hash": n} for f in ("a.csv", "b.csv") for n in ("n1", "n2")]
    fact = lookups.fact_payroll(lookups.derive_keys(staged(spark, *twice)))
    assert checks.unique(fact, "payroll_key").count() == fact.select("payroll_key").distinct().count() == 2


def test_in_set_ignores_nulls(spark):
    out = dicts(checks.in_set(pairs(spark, (1, "a"), (7, "b"), (7, "c"), (None, "d")), "k", [1, 2]))
    assert out == [{"value": 7, "n_records": 2}]


def test_between(spark):
    stg = staged(spark, *[{"total_earnings": x} for x in (-5.0, 0.0, 10.0, 11.0, None)])
    assert {r["total_earnings"] for r in checks.between(stg, "total_earnings", 0, 10).collect()} == {-5.0, 11.0}
    assert {r["total_earnings"] for r in checks.between(stg, "total_earnings", low=0).collect()} == {-5.0}
    positive = checks.between(stg, "total_earnings", 0, 10, where=F.col("total_earnings") > 0)
    assert {r["total_earnings"] for r in positive.collect()} == {11.0}


def test_relationships(spark):
    child = pairs(spark, (1, "a"), (9, "b"), (9, "c"), (None, "d"))
    assert dicts(checks.relationships(child, "k", pairs(spark, (1, "x"), (1, "y")), "k")) == [{"value": 9, "n_records": 2}]


def test_totals_reconcile(spark):
    keyed = lookups.derive_keys(staged(spark, {}, {"agency_name": "RAIL"}))
    assert checks.reconcile_totals(keyed).count() == 0
    fewer = rollups.payroll_kpis(keyed.where("agency_name = 'BUS'"))
    row = checks.reconcile_totals(keyed, fewer).first()
    assert (row["src_total_payroll"], row["view_total_payroll"]) == (264.0, 132.0)
    assert checks.reconcile_totals(keyed.limit(0)).count() == 0
