"""The declared checks of every table, and one job per table that counts their violations."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wageledger.operators import checks
from wageledger.operators.rollups import HIRE, PAY_TYPES, SEPARATION


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class InSet:
    column: str
    values: tuple


@dataclass(frozen=True)
class Between:
    column: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Parent:
    """Every value of ``column`` occurs in ``table``.``parent``."""

    column: str
    table: str
    parent: str


@dataclass(frozen=True)
class Rules:
    not_null: tuple[str, ...] = ()
    others: tuple[Unique | InSet | Between | Parent, ...] = ()


# Reported years, plausible earnings, columns that must be filled.
YEARS = (2025, 2026, 2027, 2028, 2029, 2030)
EARNINGS = (-100_000.0, 1_000_000.0)


def declared(years: Iterable[int] = YEARS) -> dict[str, Rules]:
    """The checks by table; ``years`` are the fiscal years allowed."""
    fiscal_year = InSet("fiscal_year", tuple(years))
    return {
        "raw_payroll": Rules(not_null=("name_hash", "source_file")),
        "stg_payroll": Rules(
            not_null=(
                "name_hash",
                "fiscal_year",
                "agency_name",
                "job_title",
                "department_name",
                "pay_basis",
                "total_earnings",
                "hourly_rate",
                "regular_pay",
                "overtime_pay",
                "cash_outs",
                "retro_pay",
                "other_pay",
                "record_updated_at",
                "source_file",
                "raw_ingested_at",
                "stg_processed_at",
            ),
            others=(fiscal_year, Between("total_earnings", *EARNINGS)),
        ),
        "dim_agency": Rules(("agency_key", "agency_name", "dbt_updated_at"), (Unique("agency_key"),)),
        "dim_calendar": Rules(
            ("calendar_key", "fiscal_year", "dbt_updated_at"),
            (Unique("calendar_key"), fiscal_year, InSet("day_is_weekday", (0, 1))),
        ),
        "dim_job_title": Rules(("job_title_key", "job_title", "dbt_updated_at"), (Unique("job_title_key"),)),
        "dim_employee": Rules(
            (
                "employee_key",
                "name_hash",
                "agency_name",
                "department_name",
                "job_title",
                "pay_basis",
                "dbt_updated_at",
            ),
            (Unique("employee_key"),),
        ),
        "fct_payroll": Rules(
            (
                "payroll_key",
                "employee_key",
                "agency_key",
                "job_title_key",
                "fiscal_year",
                "raw_ingested_at",
                "dbt_updated_at",
            ),
            (
                Unique("payroll_key"),
                Parent("employee_key", "dim_employee", "employee_key"),
                Parent("agency_key", "dim_agency", "agency_key"),
                Parent("job_title_key", "dim_job_title", "job_title_key"),
                Parent("fiscal_year", "dim_calendar", "fiscal_year"),
            ),
        ),
        "obt_payroll": Rules(
            (
                "payroll_key",
                "agency_name",
                "agency_key",
                "job_title_key",
                "job_title",
                "fiscal_year",
                "name_hash",
                "employee_key",
                "raw_ingested_at",
                "dbt_updated_at",
            ),
            (Unique("payroll_key"),),
        ),
        "v_payroll_kpis": Rules(
            ("fiscal_year", "agency_name", "headcount", "total_payroll", "total_overtime", "total_regular_pay"),
            (
                Between("headcount", low=1),
                Between("total_payroll", low=0),
                Between("total_overtime", low=0),
                Between("total_regular_pay", low=0),
            ),
        ),
        "mv_overtime_by_job": Rules(
            ("agency_name", "job_title", "fiscal_year", "total_overtime_pay", "total_regular_pay", "employee_count")
        ),
        "v_hr_dynamics": Rules(
            ("fiscal_year", "agency_name", "job_title"), (InSet("event_type", (HIRE, SEPARATION)),)
        ),
        "v_payroll_composition": Rules(
            ("fiscal_year", "agency_name", "pay_type", "total_amount"),
            (InSet("pay_type", tuple(PAY_TYPES.values())),),
        ),
    }


def _row_rules(rules: Rules) -> list[tuple[str, str, Column]]:
    """(rule, column, what breaks it) of the rules that look at one row at a time."""
    found = [("not_null", c, F.col(c).isNull()) for c in rules.not_null]
    for rule in rules.others:
        match rule:
            case InSet(column, values):
                found.append(("in_set", column, checks.not_among(column, values)))
            case Between(column, low, high):
                found.append(("between", column, checks.out_of_range(column, low, high)))
    return found


def observed(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation | None]:
    """``df`` with its row rules counted while it is written, so that no scan has to follow.

    A task that runs again may count its rows twice: whether a rule holds is
    right in any case, the number of rows that break it is at least right.
    """
    row_rules = _row_rules(rules)
    if not row_rules:
        return df, None
    seen = Observation(f"rules-{uuid.uuid4().hex}")
    return df.observe(seen, *[F.count(F.when(met, 1)).alias(str(i)) for i, (_, _, met) in enumerate(row_rules)]), seen


def _counts(seen: Observation) -> dict[str, int]:
    try:
        return seen.get
    except Py4JJavaError:  # a write of no rows may be planned away, and its counts with it
        return {}


def broken(table: str, seen: Observation | None, rules: Rules) -> list[tuple[str, str, int]]:
    """(rule, column, rows) of the row rules that the write has seen broken."""
    counts = _counts(seen) if seen else {}
    return [(kind, column, counts[str(i)]) for i, (kind, column, _) in enumerate(_row_rules(rules)) if counts.get(str(i))]


def quarantined(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """The rows that keep all row rules, and those that do not, with the ``broken_rules``; nothing is read twice if ``df`` is stored."""
    names = F.filter(F.array(*[F.when(met, F.lit(f"{kind}({column})")) for kind, column, met in _row_rules(rules)]), lambda r: r.isNotNull())
    marked = df.withColumn("broken_rules", names)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)


def violations(table: str, tables: Mapping[str, DataFrame], rules: Rules, rows_too: bool = True) -> DataFrame:
    """(table, rule, column_name, rows) for every rule of ``table`` that does not hold.

    Rules that look at one row at a time share a single scan, which is left out
    without ``rows_too``; unique keys and parents take one shuffle each.
    """
    df = tables[table]
    # by place, since several rules may be of one kind and column
    row_rules = _row_rules(rules) if rows_too else []
    grouped: list[tuple[str, str, DataFrame]] = []
    for rule in rules.others:
        match rule:
            case Unique(column):
                grouped.append(("unique", column, checks.unique(df, column)))
            case Parent(column, parent, parent_column):
                grouped.append(("relationships", column, checks.relationships(df, column, tables[parent], parent_column)))

    names = [(kind, column) for kind, column, _ in row_rules]
    parts: list[DataFrame] = []
    if row_rules:
        counts = checks.count_where(df, {str(i): met for i, (_, _, met) in enumerate(row_rules)})
        parts.append(counts.unpivot([], [f"`{i}`" for i in range(len(row_rules))], "place", "rows"))
    for kind, column, values in grouped:
        total = F.coalesce(F.sum("n_records"), F.lit(0)).alias("rows")
        parts.append(values.agg(F.lit(str(len(names))).alias("place"), total))
        names.append((kind, column))
    if not parts:
        raise ValueError(f"no rules for {table}")
    found = reduce(DataFrame.unionByName, parts).where(F.col("rows") > 0)
    place = F.col("place").cast("int")
    return found.select(
        F.lit(table).alias("table"),
        F.get(F.array(*[F.lit(kind) for kind, _ in names]), place).alias("rule"),
        F.get(F.array(*[F.lit(column) for _, column in names]), place).alias("column_name"),
        "rows",
    )


class ChecksFailed(ValueError):
    """Raised with the violations found in a table."""


def enforce(table: str, tables: Mapping[str, DataFrame], rules: Rules, seen: Observation | None = None) -> None:
    """Run the checks of ``table``; raises if any rule does not hold. At most one row per rule reaches the driver.

    With what was ``seen`` while the table was written, row rules need no scan.
    """
    found = broken(table, seen, rules)
    if seen is None or any(isinstance(rule, (Unique, Parent)) for rule in rules.others):
        rows = violations(table, tables, rules, rows_too=seen is None).collect()
        found += [(r["rule"], r["column_name"], r["rows"]) for r in rows]
    if found:
        raise ChecksFailed(f"{table}: " + "; ".join(f"{rule}({column}) {rows} rows" for rule, column, rows in found))
