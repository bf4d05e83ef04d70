"""States, partials and bitmaps that are kept equal what is built from all records."""

import random
from datetime import date, datetime

import pytest
from helpers import dicts, staged
from pyspark.sql import functions as F

from wageledger.functions.keys import employee_key
from wageledger.operators import dimensions, golden, headcounts, partials, rollups

FILES = [f"payroll_{i}.csv" for i in range(4)]


def records(spark, seed, n=60):
    rng = random.Random(seed)
    rows = [
        {
            "name_hash": rng.choice(["n1", "n2", "n3", None]),
            "agency_name": rng.choice(["BUS", "RAIL"]),
            "start_date": rng.choice([None, date(2025, 1, 1)]),
            "separation_date": rng.choice([None, date(2025, 3, 1), date(2025, 9, 1)]),
            "department_name": rng.choice(["D", "E", None]),
            "pay_basis": rng.choice(["HOURLY", "WEEKLY"]),
            "fiscal_year": rng.choice([2024, 2025, None]),
            "overtime_pay": rng.choice([0.1, 0.2, -7.35, 1e9]),
            "source_file": (file := rng.choice(FILES)),
            "raw_ingested_at": datetime(2025, 7, 1 + FILES.index(file) % 3),
        }
        for _ in range(n)
    ]
    return staged(spark, *rows).cache()


@pytest.mark.parametrize("seed", range(5))
def test_golden_states_merge_in_any_order(spark, seed):
    stg = records(spark, seed)
    order = random.Random(seed).sample(FILES, len(FILES))
    state = golden.golden_state(stg.where(F.col("source_file") == order[0]))
    for file in order[1:]:
        state = golden.merged(state, golden.golden_state(stg.where(F.col("source_file") == file))).cache()
    assert dicts(golden.employees(state)) == dicts(dimensions.dim_employee(stg))
    # a file twice changes nothing; a file that goes leaves what the others make
    assert dicts(golden.merged(state, golden.golden_state(stg))) == dicts(state)
    left = stg.where(F.col("source_file") != order[0])
    state = golden.replayed(state, golden.touched_keys(stg.where(F.col("source_file") == order[0])), left)
    assert dicts(golden.employees(state)) == dicts(dimensions.dim_employee(left))


def test_open_position_outlives_a_closed_record_that_comes_later(spark):
    first = staged(spark, {})
    later = staged(spark, {"separation_date": date(2025, 3, 1), "source_file": "payroll_2.csv", "raw_ingested_at": datetime(2025, 8, 1)})
    state = golden.merged(golden.golden_state(first), golden.golden_state(later))
    assert state.first()["separation_date"] is None


BY, AMOUNTS = ["fiscal_year", "agency_name", "job_title"], ["overtime_pay", "regular_pay", "total_earnings"]
REPORT = dict(zip(AMOUNTS, ["total_overtime_pay", "total_regular_pay", "total_earnings_combined"], strict=True))


@pytest.mark.parametrize("seed", range(3))
def test_partials_add_and_take_back(spark, seed):
    """Add, correct and remove files: the totals are exactly those of the records there are."""
    stg = records(spark, seed, 200)
    corrected = stg.where("source_file = 'payroll_1.csv'").withColumn("overtime_pay", F.lit(5.25)).withColumn("fiscal_year", F.lit(2026).cast("long"))

    def of(df):
        return partials.partials(df, BY, AMOUNTS)

    def file(*names):
        return stg.where(F.col("source_file").isin(*names))

    totals = partials.applied(of(stg.limit(0)), partials.difference(of(file(*FILES[:2])), of(stg.limit(0)), BY, AMOUNTS), BY, AMOUNTS)
    steps = [(of(file(FILES[2])), of(stg.limit(0))), (of(corrected), of(file(FILES[1]))), (of(file(FILES[3])), of(file(FILES[0])))]
    for new, former in steps:
        totals = partials.applied(totals, partials.difference(new, former, BY, AMOUNTS), BY, AMOUNTS).cache()
    now = file(FILES[2], FILES[3]).unionByName(corrected)
    want = of(now.withColumn("source_file", F.lit("x"))).drop("source_file")
    assert dicts(totals) == dicts(want)
    named = partials.named(totals, BY, REPORT, "employee_count")
    rounded = [F.round(c, 2).alias(c) for c in REPORT.values()]
    assert dicts(named.select(*BY, *rounded, "employee_count")) == dicts(rollups.overtime_by_job(now).select(*BY, *rounded, "employee_count"))


def test_same_partials_change_nothing(spark):
    one = partials.partials(records(spark, 1), BY, AMOUNTS)
    assert partials.difference(one, one, BY, AMOUNTS).count() == 0


def people(spark, seed, n=3000):
    rng = random.Random(seed)
    rows = [(rng.choice([2024, 2025, None]), rng.choice("AB"), rng.choice([None, rng.randrange(10**12)])) for _ in range(n)]
    rows += rows[: n // 3] + [(2025, "A", 7)] * (n // 3)  # a third of all rows is one person
    return spark.createDataFrame(rows, "fiscal_year int, agency_name string, employee_key long").cache()


def test_headcounts_from_bitmaps_are_exact(spark):
    df = people(spark, 3)
    numbers = headcounts.numbered(df).cache()
    n = df.select("employee_key").distinct().where("employee_key is not null").count()
    assert sorted(r["person_no"] for r in numbers.collect()) == list(range(n))
    maps = headcounts.bitmaps(df, numbers, ["fiscal_year", "agency_name"]).cache()
    for by in (["fiscal_year", "agency_name"], ["fiscal_year"], ["agency_name"], []):
        want = df.where("employee_key is not null").groupBy(*by).agg(F.count_distinct("employee_key").alias("headcount"))
        assert dicts(headcounts.headcount(maps, by)) == dicts(want)
    assert dicts(headcounts.headcount(maps.limit(0))) == [{"headcount": 0}]


def test_new_people_get_the_next_numbers(spark):
    old, new = people(spark, 4), people(spark, 5)
    known = headcounts.numbered(old).cache()
    both = headcounts.numbered(new, known).cache()
    assert {r["employee_key"]: r["person_no"] for r in known.collect()}.items() <= {r["employee_key"]: r["person_no"] for r in both.collect()}.items()
    assert sorted(r["person_no"] for r in both.collect()) == list(range(both.count()))
    by = ["agency_name"]
    maps = headcounts.united(headcounts.bitmaps(old, known, by).unionByName(headcounts.bitmaps(new, both, by)), by)
    want = old.unionByName(new).where("employee_key is not null").groupBy(*by).agg(F.count_distinct("employee_key").alias("headcount"))
    assert dicts(headcounts.headcount(maps, by)) == dicts(want)
    assert headcounts.numbered(old.limit(0)).count() == 0
    one = spark.createDataFrame([(1,)], "employee_key long")
    assert headcounts.numbered(spark.createDataFrame([(2,)], "employee_key long"), headcounts.numbered(one)).count() == 2


def test_person_keys_of_states(spark):
    stg = records(spark, 9)
    people = golden.employees(golden.golden_state(stg))
    keys = stg.select(employee_key(*[F.col(c) for c in dimensions.EMPLOYEE_KEYS]).alias("k")).distinct()
    assert {r["k"] for r in keys.collect()} == {r["employee_key"] for r in people.collect()}
