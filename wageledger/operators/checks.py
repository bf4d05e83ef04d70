"""Data-quality checks. Each returns what violates it; no rows means it passed.

Checks on one column return the offending values with their number of rows,
counted on the map side, so a third of a table in violation is still one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wageledger.operators.rollups import payroll_kpis


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) of each column that holds NULLs, all columns in one scan."""
    nulls = count_where(df, {c: F.col(c).isNull() for c in columns})
    return nulls.unpivot([], list(columns), "column_name", "null_rows").where(F.col("null_rows") > 0)


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: for every named condition, how many rows meet it; a single scan however many there are."""
    return df.agg(*[F.count(F.when(met, 1)).alias(name) for name, met in conditions.items()])


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return _counted(df, column).where(F.col("n_records") > 1)


def in_set(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Non-NULL values outside ``values``."""
    return _counted(df.where(not_among(column, values)), column)


def not_among(column: str, values: Iterable) -> Column:
    return ~F.col(column).isin(list(values))


def out_of_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return outside


def between(
    df: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Rows outside the range; either end may be open. NULLs and rows not meeting ``where`` are ignored."""
    return (df if where is None else df.where(where)).where(out_of_range(column, low, high))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child values without a parent.

    Both sides are reduced to one row per value on the map side, so the join
    never sees a hot value more than once.
    """
    values = _counted(child, column).where(F.col("n_records") > 0)
    parents = parent.select(F.col(parent_column).alias("value")).distinct()
    return values.join(parents, "value", "left_anti")


def relation_summary(name: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: (relation, child_values, child_rows, orphan_values, orphan_rows), so that none missing is a result too."""
    values = _counted(child, column).where(F.col("n_records") > 0)
    parents = parent.select(F.col(parent_column).alias("value"), F.lit(True).alias("known")).distinct()
    orphan = F.col("known").isNull()
    return values.join(parents, "value", "left").agg(
        F.lit(name).alias("relation"),
        F.count(F.lit(1)).alias("child_values"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("child_rows"),
        F.count(F.when(orphan, 1)).alias("orphan_values"),
        F.coalesce(F.sum(F.when(orphan, F.col("n_records"))), F.lit(0)).alias("orphan_rows"),
    )


def _counted(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; NULLs count as none, which drops them without evaluating the column twice."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(column).alias("n_records"))


def _totals(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(name) for c, name in columns.items()])


def reconcile_totals(wide: DataFrame, kpis: DataFrame | None = None, tolerance: float = 0.01) -> DataFrame:
    """One row if payroll, overtime or regular pay differ between records and KPIs by more than ``tolerance``."""
    return compare_totals(wide, kpis, tolerance).where(~F.col("is_reconciled")).drop("is_reconciled")


def compare_totals(wide: DataFrame, kpis: DataFrame | None = None, tolerance: float = 0.01) -> DataFrame:
    """One row: the three totals of records and of KPIs, and whether they agree."""
    pairs = {
        "total_payroll": "total_earnings",
        "total_overtime": "overtime_pay",
        "total_regular_pay": "regular_pay",
    }
    src = _totals(wide, {c: f"src_{name}" for name, c in pairs.items()})
    view = _totals(payroll_kpis(wide) if kpis is None else kpis, {name: f"view_{name}" for name in pairs})
    both = src.unionByName(view, allowMissingColumns=True)
    # two one-row totals side by side
    side_by_side = both.agg(*[F.max(c).alias(c) for c in both.columns])
    differs = F.lit(False)
    for name in pairs:
        differs = differs | (F.abs(F.col(f"src_{name}") - F.col(f"view_{name}")) > tolerance)
    return side_by_side.withColumn("is_reconciled", ~F.coalesce(differs, F.lit(False)))


def reconcile_files(landed: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: landed .csv objects, distinct files loaded, rows loaded, and whether the two counts agree."""
    files = landed.where(F.col("source_file").endswith(".csv")).agg(F.count(F.lit(1)).alias("landed_files"))
    loaded = raw.agg(F.count_distinct("source_file").alias("loaded_files"), F.count(F.lit(1)).alias("loaded_rows"))
    both = files.unionByName(loaded, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn(
        "is_reconciled", F.col("landed_files") == F.col("loaded_files")
    )
