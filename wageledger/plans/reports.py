"""The registered queries: each takes a session and a folder of order tables.

Dates and times leave as text and amounts rounded to cents, so that results
compare exactly with other engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.functions import salted_hash
from wageledger.operators import checks, dimensions, golden, lookups, names, rollups, staging, upsert
from wageledger.plans.ingest import extract
from wageledger.plans.inputs import RUN_TS, YEARS, Query, employees_as_of, keyed, plain, rounded, staged
from wageledger.plans.inputs import before as _before
from wageledger.plans.stateful import STATEFUL
from wageledger.sinks.landing import land_snapshot
from wageledger.sinks.scratch import new_path, stored
from wageledger.sources.dates import calendar, date_range_of
from wageledger.sources.landing import new_files, read_landed
from wageledger.sources.order_ledger import SALT, order_raw, order_snapshot, table

def _dynamics(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    return rollups.hr_dynamics(lookups.person_years(stg, dimensions.dim_employee(stg)))


def _kpis(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.payroll_kpis(keyed(spark, folder))


def _label_dims(stg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two label dimensions, from one distinct as in a warehouse build."""
    pairs = stg.select("agency_name", "job_title").distinct()
    return dimensions.dim_agency(pairs), dimensions.dim_job_title(pairs)


def anonymize_names(spark: SparkSession, folder: str) -> DataFrame:
    return names.anonymize(order_snapshot(spark, folder), SALT).select("record_id", "name_hash")


def fill_names(spark: SparkSession, folder: str) -> DataFrame:
    return names.fill_names(order_snapshot(spark, folder)).select("record_id", "Name")


def missing_names(spark: SparkSession, folder: str) -> DataFrame:
    return names.missing_names(order_snapshot(spark, folder))


def customer_name_hash(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return customers.select("c_custkey", salted_hash(F.col("c_name"), SALT).alias("name_hash"))


def stage_records(spark: SparkSession, folder: str) -> DataFrame:
    return plain(staged(spark, folder))


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return plain(staging.latest_snapshot(staged(spark, folder)))


def dim_agency(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_agency(staged(spark, folder))


def dim_job_title(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_job_title(staged(spark, folder))


def latest_employee(spark: SparkSession, folder: str) -> DataFrame:
    return plain(dimensions.dim_employee(staged(spark, folder)))


def latest_event(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id", "value")
    latest = dimensions.latest_per_key(
        events, ["user_id", "event_type"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    )
    return plain(latest)


def calendar_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    return plain(calendar(date_range_of(table(spark, folder, "orders"), "o_orderdate")))


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    return order_raw(spark, folder).select("source_file").distinct()


def new_source_files(spark: SparkSession, folder: str) -> DataFrame:
    return new_files(_landed(spark, folder), _before(order_raw(spark, folder)))


def raw_append_audit(spark: SparkSession, folder: str) -> DataFrame:
    raw = order_raw(spark, folder)
    part = F.format_string("s3://landing/csv/raw/%s/part-%05d.csv", "source_file", F.col("record_id") % 7)
    landed = raw.select("record_id", "Year", "name_hash", "Total_Earnings", part.alias("landed_path"))
    return plain(staging.with_audit(landed, RUN_TS))


def fact_keys(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    agencies, titles = _label_dims(stg)
    keyed = lookups.lookup_keys(stg, dimensions.dim_employee(stg), agencies, titles)
    return plain(lookups.fact_payroll(keyed))


def one_big_table(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    agencies, titles = _label_dims(stg)
    fact = lookups.fact_payroll(lookups.derive_keys(stg))
    return plain(lookups.denormalize(fact, dimensions.dim_employee(stg), agencies, titles))


def wide_records(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    return plain(lookups.wide_records(stg, dimensions.dim_employee(stg)))


def payroll_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_kpis(spark, folder))


def overtime_by_job(spark: SparkSession, folder: str) -> DataFrame:
    return plain(rollups.overtime_by_job(keyed(spark, folder)))


def hr_dynamics(spark: SparkSession, folder: str) -> DataFrame:
    return _dynamics(spark, folder)


def payroll_composition(spark: SparkSession, folder: str) -> DataFrame:
    return plain(rollups.payroll_composition(keyed(spark, folder)))


def lineitem_composition(spark: SparkSession, folder: str) -> DataFrame:
    measures = {c: c.removeprefix("l_") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    lines = table(spark, folder, "lineitem")
    return plain(rollups.sums_long(lines, ["l_returnflag", "l_linestatus"], measures, "measure", "total"))


def overtime_share_total(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.overtime_share_total(_kpis(spark, folder)).select(
        rounded("total_overtime", 2), rounded("total_payroll", 2), rounded("overtime_share", 6)
    )


def overtime_share_agency(spark: SparkSession, folder: str) -> DataFrame:
    return plain(rollups.overtime_share_agency(_kpis(spark, folder), critical=0.33), 6)


def overtime_share_job(spark: SparkSession, folder: str) -> DataFrame:
    return plain(rollups.overtime_share_job(rollups.overtime_by_job(keyed(spark, folder))), 6)


def workforce_balance(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.workforce_balance(_dynamics(spark, folder))


def workforce_balance_job(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.workforce_balance(_dynamics(spark, folder), ("fiscal_year", "agency_name", "job_title"))


def headcount_payroll_corr(spark: SparkSession, folder: str) -> DataFrame:
    return plain(rollups.headcount_payroll_corr(_kpis(spark, folder)), 6)


def incremental_since(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    return plain(upsert.since_high_water(stg, employees_as_of(stg)))


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    target = employees_as_of(stg)
    updates = dimensions.dim_employee(upsert.since_high_water(stg, target), RUN_TS)
    return plain(upsert.merge_upsert(target, updates, "employee_key"))


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    stg = staged(spark, folder)
    return checks.not_null(stg, stg.columns)


def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.unique(lookups.fact_payroll(keyed(spark, folder)), "payroll_key")


def dq_unique_documents(spark: SparkSession, folder: str) -> DataFrame:
    # hashes are shuffled, not texts
    hashed = table(spark, folder, "documents").select(F.sha2("text", 256).alias("text_sha256"))
    return checks.unique(hashed, "text_sha256").withColumnRenamed("value", "text_sha256")


def dq_document_ids(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "documents").where(F.col("doc_id").isNotNull())
    times = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return times.agg(F.count(F.lit(1)).alias("ids"), F.count(F.when(F.col("n") > 1, 1)).alias("repeated_ids"))


def dq_in_set(spark: SparkSession, folder: str) -> DataFrame:
    return checks.in_set(staged(spark, folder), "fiscal_year", YEARS)


def dq_conversation_roles(spark: SparkSession, folder: str) -> DataFrame:
    return checks.in_set(table(spark, folder, "conversations"), "role", ["user"])


def dq_between(spark: SparkSession, folder: str) -> DataFrame:
    known = F.col("total_earnings").isNotNull()
    return plain(checks.between(staged(spark, folder), "total_earnings", 1_000.0, 450_000.0, where=known))


def dq_range(spark: SparkSession, folder: str) -> DataFrame:
    return plain(checks.between(_kpis(spark, folder), "total_records", low=100))


def dq_declared_ranges(spark: SparkSession, folder: str) -> DataFrame:
    lows = {"headcount": 1, "total_payroll": 0, "total_overtime": 0, "total_regular_pay": 0}
    counts = checks.count_where(_kpis(spark, folder), {c: checks.out_of_range(c, low=low) for c, low in lows.items()})
    return counts.unpivot([], list(lows), "column_name", "out_of_range")


def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    # what keys and golden records take, once for the three checks
    stg = stored(staged(spark, folder).select(*golden.STATE[1:]), "staged_keys")
    fact = lookups.derive_keys(stg)
    agencies, titles = _label_dims(stg)
    parents = {"employee_key": dimensions.dim_employee(stg), "agency_key": agencies, "job_title_key": titles}
    rows = [checks.relation_summary(f"fct_payroll.{key}", fact, key, dim, key) for key, dim in parents.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def dq_late_employees(spark: SparkSession, folder: str) -> DataFrame:
    """Fact rows of people who are not in the dimension as it was before the last loads."""
    stg = staged(spark, folder)
    fact = lookups.fact_payroll(lookups.derive_keys(stg))
    return checks.relationships(fact, "employee_key", employees_as_of(stg), "employee_key")


def dq_orphan_lineitems(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return checks.relation_summary("lineitem.l_orderkey", lines, "l_orderkey", orders, "o_orderkey")


def dq_orphan_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels, docs = table(spark, folder, "labels"), table(spark, folder, "documents")
    return checks.relation_summary("labels.doc_id", labels, "doc_id", docs, "doc_id")


def reconcile_totals(spark: SparkSession, folder: str) -> DataFrame:
    """All records against the KPIs of known years: what records without a readable year amount to."""
    records = keyed(spark, folder)
    kpis = rollups.payroll_kpis(records).where(F.col("fiscal_year").isNotNull())
    return plain(checks.reconcile_totals(records, kpis))


def totals_agree(spark: SparkSession, folder: str) -> DataFrame:
    return plain(checks.compare_totals(keyed(spark, folder)))


def landed_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot to landed files and back: published, read strictly, anonymized, landed, loaded by position.

    Departments are put behind a line break, so that quoted fields span lines.
    """
    wide = order_snapshot(spark, folder).drop("record_id")
    wide = wide.withColumn("Working_Agency", F.concat("Working_Agency", F.lit("\n"), "Department"))
    published = land_snapshot(wide, new_path(spark, "published"), RUN_TS)
    landed = new_path(spark, "landed")
    path = extract(spark, published, landed, SALT, RUN_TS, multiline=True)
    rows = read_landed(spark, path, multiline=True)
    rows = staging.with_audit(rows, RUN_TS).withColumnRenamed("Working_Agency", "agency")
    return rows.groupBy("name_hash", "agency").agg(F.count(F.lit(1)).alias("n_records"))


def reconcile_files(spark: SparkSession, folder: str) -> DataFrame:
    return checks.reconcile_files(_landed(spark, folder), order_raw(spark, folder))


REPORTS: dict[str, Query] = {
    "payroll_kpis": payroll_kpis,
    "overtime_by_job": overtime_by_job,
    "hr_dynamics": hr_dynamics,
    "payroll_composition": payroll_composition,
    "overtime_share_total": overtime_share_total,
    "overtime_share_agency": overtime_share_agency,
    "overtime_share_job": overtime_share_job,
    "workforce_balance": workforce_balance,
    "workforce_balance_job": workforce_balance_job,
    "headcount_payroll_corr": headcount_payroll_corr,
    "one_big_table": one_big_table,
    "wide_records": wide_records,
    "fact_keys": fact_keys,
    "dim_agency": dim_agency,
    "dim_job_title": dim_job_title,
    "latest_employee": latest_employee,
    "latest_event": latest_event,
    "calendar": calendar_of_orders,
    "stage_records": stage_records,
    "latest_snapshot": latest_snapshot,
    "anonymize_names": anonymize_names,
    "fill_names": fill_names,
    "missing_names": missing_names,
    "customer_name_hash": customer_name_hash,
    "new_source_files": new_source_files,
    "raw_append_audit": raw_append_audit,
    "incremental_since": incremental_since,
    "merge_upsert": merge_upsert,
    "lineitem_composition": lineitem_composition,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_documents": dq_unique_documents,
    "dq_in_set": dq_in_set,
    "dq_conversation_roles": dq_conversation_roles,
    "dq_between": dq_between,
    "dq_range": dq_range,
    "dq_relationships": dq_relationships,
    "dq_orphan_lineitems": dq_orphan_lineitems,
    "dq_orphan_labels": dq_orphan_labels,
    "reconcile_totals": reconcile_totals,
    "reconcile_files": reconcile_files,
    "dq_declared_ranges": dq_declared_ranges,
    "dq_document_ids": dq_document_ids,
    "dq_late_employees": dq_late_employees,
    "totals_agree": totals_agree,
    "landed_round_trip": landed_round_trip,
    **STATEFUL,
}
