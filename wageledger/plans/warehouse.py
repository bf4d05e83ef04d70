"""From the raw table to the reports: one call per layer, checks in between."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wageledger.functions.keys import employee_key
from wageledger.operators import dimensions, golden, lookups, partials, rollups
from wageledger.operators.checks import reconcile_totals
from wageledger.operators.dimensions import EMPLOYEE_KEYS
from wageledger.operators.staging import latest_snapshot, stage_records
from wageledger.plans.suite import YEARS, ChecksFailed, declared, enforce, observed
from wageledger.sinks import versions
from wageledger.sinks.scratch import stored
from wageledger.sinks.tables import (
    among,
    create_databases,
    create_view,
    drop_partitions,
    merge_table,
    recover_swap,
    refresh_partitions,
    replace_partitions,
    write_table,
)
from wageledger.sources.dates import CALENDAR_END, CALENDAR_START, calendar, date_range

LAYERS = ("bronze", "silver", "gold", "analytics")


@dataclass(frozen=True)
class Tables:
    """Catalog names of the stored tables."""

    raw: str = "bronze.raw_payroll"
    staged: str = "silver.payroll_records"
    agency: str = "gold.dim_agency"
    title: str = "gold.dim_job_title"
    employee: str = "gold.dim_employee"
    calendar: str = "gold.dim_calendar"
    fact: str = "gold.fct_payroll"
    wide: str = "analytics.obt_payroll"
    overtime: str = "analytics.mv_overtime_by_job"
    # what an incremental run builds on: golden states, the overtime report's partials by file, and their exact totals
    state: str = "silver.employee_state"
    partials: str = "silver.overtime_partials"
    totals: str = "silver.overtime_totals"


@dataclass(frozen=True)
class Views:
    """Catalog names of the stored views."""

    stg_payroll: str = "silver.stg_payroll"
    v_payroll_kpis: str = "analytics.v_payroll_kpis"
    v_hr_dynamics: str = "analytics.v_hr_dynamics"
    v_payroll_composition: str = "analytics.v_payroll_composition"


def create_views(spark: SparkSession, tables: Tables = Tables(), views: Views = Views()) -> None:
    """Store the four views in the catalog; they give what the operators of the same names give."""
    pay = ", ".join(f"'{kind}', {column}" for column, kind in rollups.PAY_TYPES.items())
    sums = ", ".join(f"sum({c}) AS {c}" for c in rollups.PAY_TYPES)
    create_view(spark, views.stg_payroll, f"SELECT * FROM {tables.staged}")
    create_view(
        spark,
        views.v_payroll_kpis,
        f"""SELECT fiscal_year, agency_name, count(DISTINCT employee_key) AS headcount, sum(total_earnings) AS total_payroll,
              sum(overtime_pay) AS total_overtime, sum(regular_pay) AS total_regular_pay, count(*) AS total_records
            FROM {tables.wide} GROUP BY fiscal_year, agency_name""",
    )
    create_view(
        spark,
        views.v_hr_dynamics,
        f"""SELECT fiscal_year, agency_name, job_title, event_type, count(DISTINCT employee_key) AS volume_events
            FROM (SELECT fiscal_year, agency_name, job_title, employee_key,
                    stack(2, '{rollups.HIRE}', start_date, '{rollups.SEPARATION}', separation_date) AS (event_type, event_date)
                  FROM {tables.wide})
            WHERE year(event_date) = fiscal_year GROUP BY fiscal_year, agency_name, job_title, event_type""",
    )
    create_view(
        spark,
        views.v_payroll_composition,
        f"""SELECT fiscal_year, agency_name, stack({len(rollups.PAY_TYPES)}, {pay}) AS (pay_type, total_amount)
            FROM (SELECT fiscal_year, agency_name, {sums} FROM {tables.wide} GROUP BY fiscal_year, agency_name)""",
    )


# Table property: the last run went through, so that the next one may build on what it left.
_DONE = "wageledger.done"


def _is_done(spark: SparkSession, name: str) -> bool:
    if not spark.catalog.tableExists(name):
        return False
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return any((row["key"], row["value"]) == (_DONE, "true") for row in found)


def _set_done(spark: SparkSession, name: str, done: bool) -> None:
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_DONE}' = '{str(done).lower()}')")


# Buckets of the golden states and of the report's totals: a merge writes those its keys fall into.
STATE_BUCKETS, TOTAL_BUCKETS = 256, 16
OVERTIME_BY = ("fiscal_year", "agency_name", "job_title")
# Amounts of the overtime report and their names there.
OVERTIME = {"overtime_pay": "total_overtime_pay", "regular_pay": "total_regular_pay", "total_earnings": "total_earnings_combined"}


@dataclass(frozen=True)
class Changes:
    """What an incremental run has to look at: records that arrived, and those of files that were replaced or are gone."""

    arrived: DataFrame
    former: DataFrame
    gone_files: list[str]

    def touched(self, column: str) -> DataFrame:
        return self.arrived.select(column).unionByName(self.former.select(column)).distinct()

    def touched_people(self) -> DataFrame:
        both = self.arrived.select(*EMPLOYEE_KEYS).unionByName(self.former.select(*EMPLOYEE_KEYS)).distinct()
        return both.select(employee_key(*[F.col(c) for c in EMPLOYEE_KEYS]).alias("employee_key"))


def changes(raw: DataFrame, staged: DataFrame, run_ts: datetime) -> Changes:
    """Files that are not staged, or were staged as they were before they were loaded again, or are no longer loaded."""
    # a struct, so that a file without a time still differs from no file
    now, then = (
        df.where(F.col("source_file").isNotNull()).groupBy("source_file").agg(F.struct(F.max("raw_ingested_at").alias("at")).alias("at")) for df in (raw, staged)
    )
    files = stored(
        now.withColumnRenamed("at", "now").join(then.withColumnRenamed("at", "then"), "source_file", "full").where("not now <=> then"), "changed_files"
    )
    arrived = raw.join(files.where("now is not null"), "source_file", "left_semi")
    former = staged.join(files.where("then is not null"), "source_file", "left_semi")
    gone = [row["source_file"] for row in files.where("now is null").select("source_file").collect()]  # partitions to drop
    return Changes(stored(stage_records(arrived, run_ts), "arrived"), stored(former, "former"), gone)


def _merge_states(found: Changes, staged: DataFrame, name: str) -> None:
    """Bring the golden states up to date; only keys of former records are read again from all records."""
    spark = staged.sparkSession
    again = stored(golden.touched_keys(found.former), "replayed_keys")
    if again.isEmpty():
        versions.merge(golden.golden_state(found.arrived), name, golden.merged)
        return
    # a key to be read again also names a bucket to be written
    marks = again.select(golden.STATE_KEY, *(F.lit(None).cast(spark.table(name).schema[c].dataType).alias(c) for c in golden.STATE if c != golden.STATE_KEY))
    fresh = stored(golden.golden_state(found.arrived), "arrived_states")

    def combine(old: DataFrame, _: DataFrame) -> DataFrame:
        return golden.replayed(golden.merged(old, fresh), again, staged)

    versions.merge(fresh.unionByName(marks), name, combine)


def _refresh_overtime(found: Changes | None, staged: DataFrame, names: Tables) -> None:
    """The overtime report by what files add and take away, exact to the last place."""
    spark, amounts = staged.sparkSession, list(OVERTIME)
    report = lambda totals: partials.named(totals, OVERTIME_BY, OVERTIME, "employee_count")
    if found is None or not all(spark.catalog.tableExists(t) for t in (names.partials, names.totals, names.overtime)):
        write_table(partials.partials(staged, OVERTIME_BY, amounts), names.partials, ("source_file",))
        stored_partials = spark.table(names.partials)
        totals = stored_partials.groupBy(*OVERTIME_BY).agg(
            *(F.sum(c).cast("decimal(38,6)").alias(c) for c in amounts), F.sum(partials.ROWS).alias(partials.ROWS)
        )
        versions.commit(totals, names.totals, OVERTIME_BY, TOTAL_BUCKETS)
        write_table(report(spark.table(names.totals)), names.overtime, ("fiscal_year",), ("job_title",))
        return
    fresh = stored(partials.partials(found.arrived, OVERTIME_BY, amounts), "fresh_partials")
    touched_files = found.touched("source_file")
    former = stored(spark.table(names.partials).join(F.broadcast(touched_files), "source_file", "left_semi"), "former_partials")
    change = stored(partials.difference(fresh, former, OVERTIME_BY, amounts), "change")
    if not fresh.isEmpty():
        replace_partitions(fresh, names.partials)
    drop_partitions(spark, names.partials, ["source_file"], [(f,) for f in found.gone_files])
    versions.merge(change, names.totals, lambda old, new: partials.applied(old, new, OVERTIME_BY, amounts))
    years = [row[0] for row in change.select("fiscal_year").distinct().collect()]
    if years:
        totals = spark.table(names.totals).where(among("fiscal_year", years))
        there = {row[0] for row in totals.select("fiscal_year").distinct().collect()}
        refresh_partitions(report(totals), names.overtime, "fiscal_year", years, there, ("job_title",))


def transform(
    spark: SparkSession,
    run_ts: datetime,
    names: Tables = Tables(),
    full_refresh: bool = True,
    years: Iterable[int] = YEARS,
    calendar_range: tuple[date, date] = (CALENDAR_START, CALENDAR_END),
    strict: bool = True,
    latest_only: bool = False,
    views: Views = Views(),
) -> list[str]:
    """Build dimensions, fact, one big table, stored aggregate and views from the raw table.

    Staged records are written once, partitioned by source file, and read by
    all that follows; keys are derived from the records, without joins. Without
    ``full_refresh`` only files that are not staged as they are loaded are read:
    whatever the clocks said when they came. Their golden states are merged into
    those there are, so the employee dimension is that of a full refresh in
    whatever order files come, are replaced or go. The fact's years that they
    touch are rewritten; of the big table also the years of anyone whose golden
    record changed; the overtime report changes by the difference of its files.
    If the last run did not come to its end the refresh is a full one.
    ``latest_only`` uses the last file only, for feeds that land a whole snapshot
    each time, and is always full. Rules that look at one row are checked while
    a table is written. With ``strict`` the first table whose checks fail stops
    the run; without, the failures are returned.
    """
    create_databases(spark, LAYERS)
    rules = declared(years)
    failures: list[str] = []

    def check(table: str, seen: Observation | None = None, **frames: DataFrame) -> None:
        try:
            enforce(table, frames, rules[table], seen)
        except ChecksFailed as error:
            if strict:
                raise
            failures.append(str(error))

    def watched(df: DataFrame, table: str) -> tuple[DataFrame, Observation | None]:
        return observed(df, rules[table])

    raw = spark.table(names.raw)
    check("raw_payroll", raw_payroll=raw)
    recover_swap(spark, names.employee)
    built = all(spark.catalog.tableExists(t) for t in (names.employee, names.state, names.fact, names.wide))
    full = full_refresh or latest_only or not _is_done(spark, names.staged) or not built
    _set_done(spark, names.staged, False)
    people = ("agency_name", "job_title")
    found: Changes | None = None
    touched: list[int | None] = []
    if full:
        records, seen = watched(stage_records(raw, run_ts), "stg_payroll")
        if latest_only:
            records, seen = watched(latest_snapshot(stage_records(raw, run_ts)), "stg_payroll")
        write_table(records, names.staged, ("source_file",))
        _set_done(spark, names.staged, False)
        check("stg_payroll", seen, stg_payroll=spark.table(names.staged))
    else:
        found = changes(raw, spark.table(names.staged), run_ts)
        touched = [row[0] for row in found.touched("fiscal_year").collect()]  # years
        if not found.arrived.isEmpty():
            arrived, seen = watched(found.arrived, "stg_payroll")
            replace_partitions(arrived, names.staged)
            check("stg_payroll", seen, stg_payroll=spark.table(names.staged))
        drop_partitions(spark, names.staged, ["source_file"], [(f,) for f in found.gone_files])
    stg = spark.table(names.staged)

    labels = stored(stg.select("agency_name", "job_title").distinct(), "labels")
    dims_of = {
        "dim_agency": (names.agency, dimensions.dim_agency(labels, run_ts)),
        "dim_job_title": (names.title, dimensions.dim_job_title(labels, run_ts)),
        "dim_calendar": (names.calendar, calendar(date_range(spark, *calendar_range), run_ts)),
    }
    seen_of: dict[str, Observation | None] = {}
    for table, (name, df) in dims_of.items():
        df, seen_of[table] = watched(df, table)
        write_table(df, name)
    if full:
        versions.commit(golden.golden_state(stg), names.state, [golden.STATE_KEY], STATE_BUCKETS)
        df, seen_of["dim_employee"] = watched(golden.employees(spark.table(names.state), run_ts), "dim_employee")
        write_table(df, names.employee, cluster=people)
    elif touched:
        _merge_states(found, stg, names.state)
        keys = stored(golden.touched_keys(found.arrived).union(golden.touched_keys(found.former)).distinct(), "touched_keys")
        updates = golden.employees(spark.table(names.state).join(keys, golden.STATE_KEY, "left_semi"), run_ts)
        former = lookups.derive_keys(found.former).select("employee_key").distinct()
        merge_table(updates, names.employee, "employee_key", people, former)
    dims = {
        "dim_agency": spark.table(names.agency),
        "dim_job_title": spark.table(names.title),
        "dim_employee": spark.table(names.employee),
        "dim_calendar": spark.table(names.calendar),
    }
    for table in dims:
        check(table, seen_of.get(table), **dims)

    def write_years(table: str, name: str, df: DataFrame, some: list[int | None], cluster: tuple[str, ...]) -> None:
        """Write the whole table, or the years ``some``, with the rules observed."""
        df, seen = watched(df, table)
        if full:
            write_table(df, name, ("fiscal_year",), cluster)
        else:
            there = {row[0] for row in stg.where(among("fiscal_year", some)).select("fiscal_year").distinct().collect()}
            refresh_partitions(df, name, "fiscal_year", some, there, cluster)
        check(table, seen, **{table: spark.table(name)}, **dims)

    if full or touched:
        rows = stg if full else stg.where(among("fiscal_year", touched))
        write_years("fct_payroll", names.fact, lookups.fact_payroll(lookups.derive_keys(rows), run_ts), touched, ("agency_key", "job_title_key"))
        wide_years = touched
        if not full:
            # a golden record shows in every year of its person
            changed = found.touched_people()
            theirs = lookups.derive_keys(stg).join(changed, "employee_key", "left_semi").select("fiscal_year").distinct().collect()
            wide_years = list({*touched, *(row[0] for row in theirs)})
            rows = stg.where(among("fiscal_year", wide_years))
        wide = dimensions.audited(lookups.wide_records(rows, dims["dim_employee"]), run_ts)
        write_years("obt_payroll", names.wide, wide, wide_years, ("agency_name", "job_title"))
        _refresh_overtime(found, stg, names)
    wide = spark.table(names.wide)
    check("mv_overtime_by_job", mv_overtime_by_job=spark.table(names.overtime))
    create_views(spark, names, views)
    reports = {f.name: spark.table(getattr(views, f.name)) for f in fields(Views)}
    for table in ("v_payroll_kpis", "v_hr_dynamics", "v_payroll_composition"):
        check(table, **reports)
    if reconcile_totals(wide, reports["v_payroll_kpis"]).first() is not None:
        message = "payroll totals of records and KPIs differ"
        if strict:
            raise ChecksFailed(message)
        failures.append(message)
    _set_done(spark, names.staged, True)
    return failures
