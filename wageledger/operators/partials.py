"""Aggregates kept up to date by the difference that files make.

A partial is the aggregate of one source file: exact sums and a row count per
group. Partials add up to the aggregate, so a file that is new, replaced or gone
changes it by its new partials less its former ones, and nothing else is read.
Amounts are summed as decimals of six places, since sums of doubles cannot be
taken back exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS, SOURCE = "n_rows", "source_file"
# Twelve digits before the point a row, and room for as many rows as a long counts.
_AMOUNT, _SUM = "decimal(18,6)", "decimal(38,6)"


def _sum(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast(_SUM).alias(column)


def partials(records: DataFrame, by: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """``by``, the sums, the number of rows, and the file, per file and group."""
    exact = records.select(*by, SOURCE, *(F.col(c).cast(_AMOUNT).alias(c) for c in amounts))
    rows = exact.groupBy(*by, SOURCE).agg(*(_sum(c) for c in amounts), F.count(F.lit(1)).alias(ROWS))
    return rows.select(*by, *amounts, ROWS, SOURCE)


def difference(new: DataFrame, former: DataFrame, by: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """What the partials of changed files add to each group; groups that stay as they are have no row."""
    measures = [*amounts, ROWS]
    less = former.select(*by, *((-F.col(c)).alias(c) for c in measures))
    sums = new.select(*by, *measures).unionByName(less).groupBy(*by).agg(*(_sum(c) for c in amounts), F.sum(ROWS).alias(ROWS))
    changed = F.lit(False)
    for c in measures:
        changed = changed | (F.col(c) != 0)
    return sums.where(changed)


def applied(aggregate: DataFrame, change: DataFrame, by: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """The aggregate after the change; groups without rows go."""
    both = aggregate.select(*by, *amounts, ROWS).unionByName(change.select(*by, *amounts, ROWS))
    return both.groupBy(*by).agg(*(_sum(c) for c in amounts), F.sum(ROWS).alias(ROWS)).where(F.col(ROWS) > 0)


def named(aggregate: DataFrame, by: Sequence[str], amounts: Mapping[str, str], rows: str) -> DataFrame:
    """The aggregate as it is reported: doubles, under the names of the report."""
    return aggregate.select(*by, *(F.col(c).cast("double").alias(n) for c, n in amounts.items()), F.col(ROWS).alias(rows))
