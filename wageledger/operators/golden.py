"""Golden records as a state that merges.

The state of a key is the first of its records in the order of
``dimensions.employee_order``, with the columns that decide the order beside it.
Such states merge: the state of all records is the first among the states of any
parts of them, in whatever order the parts arrive. So a file adds its own states
and reads nothing else. A file that goes, or is replaced, can only change keys
it has records of; those are read again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.functions.keys import employee_key
from wageledger.operators.dimensions import EMPLOYEE_KEYS, audited, employee_order, latest_per_key

# Names every key, missing parts included, so that states can be bucketed and joined by it.
STATE_KEY = "state_key"
STATE = (STATE_KEY, *EMPLOYEE_KEYS, "separation_date", "department_name", "pay_basis", "raw_ingested_at", "source_file")


def with_state_key(stg: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in (F.col(c).cast("string") for c in EMPLOYEE_KEYS)]
    return stg.withColumn(STATE_KEY, F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def golden_state(records: DataFrame) -> DataFrame:
    """One row per key of staged records, or of states."""
    rows = records if STATE_KEY in records.columns else with_state_key(records)
    return latest_per_key(rows.select(*STATE), [STATE_KEY], employee_order())


def merged(state: DataFrame, more: DataFrame) -> DataFrame:
    """The state of the records of both; one row per key and task is shuffled."""
    return golden_state(state.select(*STATE).unionByName(more.select(*STATE)))


def touched_keys(records: DataFrame) -> DataFrame:
    return with_state_key(records).select(STATE_KEY).distinct()


def replayed(state: DataFrame, keys: DataFrame, records: DataFrame) -> DataFrame:
    """``state`` with the ``keys`` read again from all ``records`` there are now; keys without records go."""
    kept = state.join(keys, STATE_KEY, "left_anti")
    return kept.select(*STATE).unionByName(golden_state(with_state_key(records).join(keys, STATE_KEY, "left_semi")))


def employees(state: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """The employee dimension that a state holds."""
    people = state.select(
        employee_key(*[F.col(c) for c in EMPLOYEE_KEYS]).alias("employee_key"),
        "name_hash",
        "start_date",
        "separation_date",
        "agency_name",
        "department_name",
        "job_title",
        "pay_basis",
    )
    return audited(people, run_ts)
