"""Plan shapes that must hold at any size, and behaviour when one key holds a third of all rows."""

import re
from contextlib import contextmanager

import pytest
from helpers import STAGED, staged
from pyspark.sql import functions as F

from wageledger.operators import dimensions, lookups, rollups, upsert
from wageledger.sinks.tables import create_databases, write_table

ROWS = 60_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **changes):
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Thresholds scaled to a test: no broadcast, and a partition above 50 kB is large.
SCALED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Staged records of which one person has a third and missing names a sixth."""
    path = str(tmp_path_factory.mktemp("skewed") / "stg")
    one = staged(spark, {}).drop("name_hash", "regular_pay")
    name = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, None).otherwise(F.concat(F.lit("n"), F.col("id")))
    )
    ids = spark.range(0, ROWS, 1, 16).select(name.alias("name_hash"), F.col("id").cast("double").alias("regular_pay"))
    columns = [c.split()[0] for c in STAGED.split(", ")]
    ids.withColumns({c: F.lit(one.first()[c]).cast(one.schema[c].dataType) for c in one.columns}).select(
        *columns
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_golden_records_are_thinned_before_the_shuffle(spark, skewed):
    text = plan(dimensions.dim_employee(skewed))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange hashpartitioning.*WindowGroupLimit.*Partial", text, re.S)
    assert "regular_pay" not in text


def test_hot_person_does_not_reach_one_task(spark, skewed):
    people = dimensions.dim_employee(skewed)
    with settings(spark, **SCALED):
        for joined in (lookups.wide_records(skewed, people), lookups.lookup_employee(skewed, people)):
            assert joined.count() == ROWS
            narrow = joined.select("employee_key", "regular_pay", *(["pay_basis"] if "pay_basis" in joined.columns else []))
            rows = narrow.collect()
            assert len(rows) == ROWS and sum(r["regular_pay"] for r in rows) == ROWS * (ROWS - 1) / 2
            assert "skew=true" in plan(narrow)


def test_person_years_collapse_before_the_join(spark, skewed):
    years = lookups.person_years(skewed, dimensions.dim_employee(skewed))
    # one year, place and start date: a row per person, and one for all without a name
    assert years.count() == skewed.select("name_hash").distinct().count()
    full = rollups.hr_dynamics(lookups.wide_records(skewed, dimensions.dim_employee(skewed)))
    assert rollups.hr_dynamics(years).collect() == full.collect()


def test_hot_cluster_is_written_as_several_files(spark, skewed):
    create_databases(spark, ["gold"])
    with settings(spark, **SCALED):
        write_table(skewed, "gold.skewed", ["fiscal_year"], ["agency_name", "job_title"])
    table = spark.table("gold.skewed")
    per_file = [r["count"] for r in table.groupBy("_metadata.file_path").count().collect()]
    assert sum(per_file) == ROWS and len(per_file) > 3 and max(per_file) < ROWS / 2
    spark.sql("DROP TABLE gold.skewed")


def test_reports_read_only_their_columns_and_partitions(spark, skewed):
    create_databases(spark, ["gold"])
    write_table(lookups.wide_records(skewed, dimensions.dim_employee(skewed)), "gold.wide", ["fiscal_year"])
    with settings(spark, **{"spark.sql.maxMetadataStringLength": "1000"}):
        text = plan(rollups.payroll_kpis(spark.table("gold.wide")).where("fiscal_year = 2025"))
    spark.sql("DROP TABLE gold.wide")
    assert re.search(r"PartitionFilters: \[[^]]*fiscal_year[^]]*= 2025", text)
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "agency_name",
        "employee_key",
        "overtime_pay",
        "regular_pay",
        "total_earnings",
    }


def test_composition_scans_once(spark, skewed):
    assert plan(rollups.payroll_composition(skewed)).count("FileScan") == 1


def test_derived_keys_need_no_shuffle(spark, skewed):
    assert "Exchange" not in plan(lookups.fact_payroll(lookups.derive_keys(skewed)))


def test_high_water_filter_reaches_the_scan(spark, skewed, tmp_path):
    mark = spark.createDataFrame([(None,)], "dbt_updated_at timestamp")
    text = plan(upsert.since_high_water(skewed, mark))
    assert re.search(r"DataFilters: \[[^]]*raw_ingested_at", text)
