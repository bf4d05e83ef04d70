"""Incremental building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def since_high_water(
    src: DataFrame, target: DataFrame, arrived: str = "raw_ingested_at", mark: str = "dbt_updated_at"
) -> DataFrame:
    """Rows of ``src`` that arrived after the newest ``mark`` of ``target``.

    An empty target has no mark and yields no rows, so the first build must
    not use this filter.
    """
    return src.where(F.col(arrived) > target.select(F.max(mark)).scalar())


def merge_upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Target rows replaced by the update of the same key, plus updates of new keys.

    ``updates`` must hold each key once. A NULL key matches nothing: such
    target rows are kept and such updates added.
    """
    kept = target.join(updates.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))
