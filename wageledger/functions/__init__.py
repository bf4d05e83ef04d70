"""Column expressions; every one is a composition of Spark built-ins."""

from wageledger.functions.dates import (
    calendar_fields,
    safe_date,
    utc_stamp,
    week_of_year_sunday,
)
from wageledger.functions.keys import employee_key, payroll_key, salted_hash, surrogate_key
from wageledger.functions.numbers import safe_double, safe_long
from wageledger.functions.paths import landed_name, landed_object
from wageledger.functions.text import clean_label, fill_name, trim_space

__all__ = [
    "calendar_fields",
    "clean_label",
    "employee_key",
    "fill_name",
    "landed_name",
    "landed_object",
    "payroll_key",
    "safe_date",
    "safe_double",
    "safe_long",
    "salted_hash",
    "surrogate_key",
    "trim_space",
    "utc_stamp",
    "week_of_year_sunday",
]
