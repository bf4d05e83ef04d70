"""Registered queries over what is kept between runs: versions, states, partials, bitmaps, ledgers and landed files.

Each builds its tables from the order tables, changes them as later runs would,
and returns what they then hold. Catalog tables have names of their own and are
dropped when the result is stored.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.operators import dimensions, golden, headcounts, lookups, partials, rollups, staging
from wageledger.operators.upsert import since_high_water
from wageledger.plans import inputs, suite
from wageledger.plans.ingest import ingest, ledger_of
from wageledger.plans.inputs import AS_OF, RUN_TS, YEARS, Query, employees_as_of, plain
from wageledger.plans.inputs import before as _before
from wageledger.plans.warehouse import OVERTIME, OVERTIME_BY, Tables, Views, create_views
from wageledger.schemas import RAW_COLUMNS
from wageledger.sinks import versions
from wageledger.sinks.landing import land_snapshot
from wageledger.sinks.scratch import new_path, stored
from wageledger.sinks.tables import create_databases, refresh_aggregate, write_table
from wageledger.sources.ledger import classified, digests, list_objects
from wageledger.sources.order_ledger import order_raw
from wageledger.sources.quoted import read_quoted

DATABASE = "temporary"
FILES = tuple(f"payroll_{i}.csv" for i in range(4))


def _name(spark: SparkSession, base: str) -> str:
    create_databases(spark, [DATABASE])
    return f"{DATABASE}.{base}_{uuid.uuid4().hex}"


def _of_files(df: DataFrame, *files: str) -> DataFrame:
    return df.where(F.col("source_file").isin(*files))


def table_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The employee dimension before the last loads and now, both read after the second was written."""
    stg, name = inputs.staged(spark, folder), _name(spark, "employees")
    versions.commit(dimensions.dim_employee(_before(stg)), name, ["employee_key"], 16)
    versions.commit(dimensions.dim_employee(stg), name, ["employee_key"], 16)
    both = [df.withColumn("version", F.lit(label)) for label, df in (("before", versions.as_of(spark, name, 1)), ("now", spark.table(name)))]
    counts = both[0].unionByName(both[1]).groupBy("version", "agency_name").agg(
        F.count(F.lit(1)).alias("positions"), F.count_if(F.col("separation_date").isNull()).alias("open_positions")
    )
    result = stored(counts, "table_versions")
    versions.drop(spark, name)
    return result


def bucket_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The employees of the last loads merged into the buckets of their keys."""
    stg, name = inputs.staged(spark, folder), _name(spark, "employees")
    target = stored(employees_as_of(stg), "target")
    versions.commit(target, name, ["employee_key"], 64)
    versions.merge(dimensions.dim_employee(since_high_water(stg, target), RUN_TS), name)
    result = stored(plain(spark.table(name)), "bucket_merge")
    versions.drop(spark, name)
    return result


def golden_state(spark: SparkSession, folder: str) -> DataFrame:
    """Golden records after the files came out of order, one by one, and the last of them was taken back."""
    stg, name = stored(inputs.staged(spark, folder), "staged"), _name(spark, "golden")
    versions.commit(golden.golden_state(_of_files(stg, FILES[2])), name, [golden.STATE_KEY], 16)
    for file in (FILES[0], FILES[3], FILES[1]):
        versions.merge(golden.golden_state(_of_files(stg, file)), name, golden.merged)
    left = _of_files(stg, *FILES[:3])
    state = golden.replayed(spark.table(name), golden.touched_keys(_of_files(stg, FILES[3])), left)
    result = stored(plain(golden.employees(state)), "golden_state")
    versions.drop(spark, name)
    return result


def aggregate_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The overtime report after a file was added and another taken back, by their partials alone."""
    stg, name, amounts = stored(inputs.staged(spark, folder), "staged"), _name(spark, "totals"), list(OVERTIME)

    def of(*files: str) -> DataFrame:
        return partials.partials(_of_files(stg, *files), OVERTIME_BY, amounts)

    first = of(*FILES[:3])
    versions.commit(partials.difference(first, first.limit(0), OVERTIME_BY, amounts), name, OVERTIME_BY, 16)
    change = partials.difference(of(FILES[3]), of(FILES[1]), OVERTIME_BY, amounts)
    versions.merge(change, name, lambda old, new: partials.applied(old, new, OVERTIME_BY, amounts))
    report = partials.named(spark.table(name), OVERTIME_BY, OVERTIME, "employee_count")
    result = stored(plain(report), "aggregate_refresh")
    versions.drop(spark, name)
    return result


def headcount_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct people per year and agency, per agency, per year and over all, from one set of bitmaps.

    The bitmaps of the first two loads are united with those of the others,
    whose new people got the next numbers.
    """
    keyed = stored(inputs.keyed(spark, folder).select("fiscal_year", "agency_name", "employee_key", "raw_ingested_at"), "keyed")
    by = ("fiscal_year", "agency_name")
    early, late = _before(keyed), keyed.where(F.col("raw_ingested_at") >= F.lit(AS_OF))
    numbers = stored(headcounts.numbered(early), "numbers")
    maps = headcounts.bitmaps(early, numbers, by)
    numbers = stored(headcounts.numbered(late, numbers), "numbers")
    maps = stored(headcounts.united(maps.unionByName(headcounts.bitmaps(late, numbers, by)), by), "headcount_maps")
    rows = [
        headcounts.headcount(maps, some).select(
            F.lit(level).alias("level"),
            *(F.col(c) if c in some else F.lit(None).cast(maps.schema[c].dataType).alias(c) for c in by),
            "headcount",
        )
        for level, some in (("group", by), ("agency", by[1:]), ("year", by[:1]), ("all", ()))
    ]
    return reduce(DataFrame.unionByName, rows)


def _land(spark: SparkSession, raw: DataFrame, landing: str, *files: str) -> None:
    """Land the records of some files as objects of their names."""
    for file in files:
        _of_files(raw, file).select(*RAW_COLUMNS).write.mode("overwrite").option("header", "true").option("escape", '"').csv(f"{landing}/{file}")


def quoted_records(spark: SparkSession, folder: str) -> DataFrame:
    """Landed records whose agency spans lines, read by many tasks per file."""
    rows = order_raw(spark, folder).select(*RAW_COLUMNS)
    rows = rows.withColumn("Working_Agency", F.concat("Working_Agency", F.lit('\n"'), "Department", F.lit('"\n,')))
    path = land_snapshot(rows, new_path(spark, "quoted"), RUN_TS)
    read = read_quoted(spark, path, rows.schema).withColumnRenamed("Working_Agency", "agency")
    return read.groupBy("name_hash", "agency").agg(F.count(F.lit(1)).alias("n_records"))


def changed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Which objects a load would read after one came anew, one was replaced and one written again as it was."""
    raw, landing = stored(order_raw(spark, folder), "raw"), new_path(spark, "landing")
    _land(spark, raw, landing, *FILES[:3])
    known = list_objects(spark, landing)
    ledger = stored(known.join(digests(spark, [f"{landing}/{f}" for f in FILES[:3]]), "source_file"), "ledger")
    _land(spark, raw, landing, FILES[3], FILES[2])
    replaced = _of_files(raw, FILES[1]).withColumn("Year", F.concat(F.lit("FY"), "Year"))
    _land(spark, replaced, landing, FILES[1])
    kinds = stored(classified(list_objects(spark, landing), _of_files(raw, *FILES[:3]), ledger), "kinds")
    now = digests(spark, [f"{landing}/{f}" for f in FILES])
    read = (F.col("kind") == "new") | ((F.col("kind") == "suspect") & (F.col("digest") != F.col("known_digest")))
    return kinds.join(now, "source_file").select("source_file", "kind", read.alias("is_read"))


def ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Records, load times and their order per file, after two loads and a third without news."""
    raw, landing, name = stored(order_raw(spark, folder), "raw"), new_path(spark, "landing"), _name(spark, "raw")
    raw = raw.where(F.col("name_hash").isNotNull())
    _land(spark, raw, landing, *FILES[:2])
    for at in range(3):
        ingest(spark, landing, name, RUN_TS + timedelta(hours=at))
        if not at:
            _land(spark, raw, landing, *FILES[2:])
    times = spark.table(name).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("raw_ingested_at").alias("load_times"), F.min("raw_ingested_at").alias("at")
    )
    hour = F.floor((F.unix_micros("at") - F.unix_micros(F.lit(RUN_TS))) / F.lit(3_600_000_000)).alias("hour")
    place = F.pmod(F.unix_micros("at"), F.lit(3_600_000_000)).alias("place")
    result = stored(times.select("source_file", "n_records", "load_times", hour, place), "ingest_twice")
    versions.drop(spark, ledger_of(name))
    spark.sql(f"DROP TABLE {name}")
    return result


def partitioned_table(spark: SparkSession, folder: str) -> DataFrame:
    """Pay per year and agency from the fact table, written by year, and again when the later years had lost their first loads."""
    keyed, name = stored(inputs.keyed(spark, folder), "keyed"), _name(spark, "fact")
    fact = lookups.fact_payroll(keyed)
    write_table(fact, name, ("fiscal_year",), ("agency_key",))
    write_table(fact.where((F.col("fiscal_year") < YEARS[2]) | (F.col("raw_ingested_at") >= F.lit(AS_OF))), name, ("fiscal_year",), ("agency_key",))
    sums = spark.table(name).groupBy("fiscal_year", "agency_key").agg(F.sum("total_earnings").alias("total"), F.count(F.lit(1)).alias("n_records"))
    result = stored(plain(sums), "partitioned_table")
    spark.sql(f"DROP TABLE {name}")
    return result


def stored_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    """The stored overtime report after its touched years were built again from records that have changed."""
    keyed, name = stored(inputs.keyed(spark, folder), "keyed"), _name(spark, "overtime")
    old = keyed.where(F.col("raw_ingested_at") < F.lit(AS_OF))
    refresh_aggregate(old, rollups.overtime_by_job, name)
    some = keyed.where((F.col("fiscal_year") >= YEARS[1]) | (F.col("raw_ingested_at") < F.lit(AS_OF)))
    refresh_aggregate(some, rollups.overtime_by_job, name, some.where(F.col("fiscal_year") >= YEARS[1]))
    result = stored(plain(spark.table(name)), "stored_aggregate")
    spark.sql(f"DROP TABLE {name}")
    return result


def stored_views(spark: SparkSession, folder: str) -> DataFrame:
    """The KPI and composition views over a stored big table, side by side."""
    stg, name = stored(inputs.staged(spark, folder), "staged"), _name(spark, "wide")
    write_table(lookups.wide_records(stg, dimensions.dim_employee(stg)), name, ("fiscal_year",), ("agency_name",))
    write_table(stg, f"{name}_stg")
    views = Views(*(f"{name}_{v}" for v in ("stg", "kpis", "dynamics", "composition")))
    views = Views(f"{name}_v_stg", views.v_payroll_kpis, views.v_hr_dynamics, views.v_payroll_composition)
    create_views(spark, Tables(staged=f"{name}_stg", wide=name), views)
    dynamics = spark.table(views.v_hr_dynamics).groupBy("fiscal_year", "agency_name").agg(F.sum("volume_events").alias("events"))
    parts = spark.table(views.v_payroll_composition).groupBy("fiscal_year", "agency_name").agg(F.count(F.lit(1)).alias("pay_types"))
    place = ["fiscal_year", "agency_name"]
    both = [df.withColumnsRenamed({c: f"_{c}" for c in place}) for df in (dynamics, parts)]
    rows = spark.table(views.v_payroll_kpis)
    for other in both:
        match = F.lit(True)
        for c in place:
            match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
        rows = rows.join(other, match, "left").drop(*(f"_{c}" for c in place))
    result = stored(plain(rows.withColumn("events", F.coalesce("events", F.lit(0)))), "stored_views")
    for view in vars(views).values():
        spark.sql(f"DROP VIEW {view}")
    for table in (name, f"{name}_stg"):
        spark.sql(f"DROP TABLE {table}")
    return result


def dq_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Staged records that break a declared rule on one row, by the rules they break; good ones are counted too."""
    rules = suite.declared(YEARS)["stg_payroll"]
    stg = stored(staging.stage_records(order_raw(spark, folder), datetime(2025, 2, 1, tzinfo=UTC)), "staged")
    good, bad = suite.quarantined(stg, rules)
    by_rules = bad.groupBy(F.array_join("broken_rules", ", ").alias("rules")).agg(F.count(F.lit(1)).alias("n_records"))
    return by_rules.unionByName(good.agg(F.lit("none").alias("rules"), F.count(F.lit(1)).alias("n_records")))


STATEFUL: dict[str, Query] = {
    "table_versions": table_versions,
    "bucket_merge": bucket_merge,
    "golden_state": golden_state,
    "aggregate_refresh": aggregate_refresh,
    "headcount_bitmaps": headcount_bitmaps,
    "quoted_records": quoted_records,
    "changed_files": changed_files,
    "ingest_twice": ingest_twice,
    "partitioned_table": partitioned_table,
    "stored_aggregate": stored_aggregate,
    "stored_views": stored_views,
    "dq_quarantine": dq_quarantine,
}
