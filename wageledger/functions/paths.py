"""Names of landed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A landed object is a .csv file, or a .csv folder of Spark part files.
_OBJECT = r"^(.*?[^/]+\.csv)(?:/part-[^/]+)?$"
_NAME = r"([^/]+\.csv)(?:/part-[^/]+)?$"


def decoded(path: Column) -> Column:
    """File paths in ``_metadata`` are percent-encoded."""
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


def landed_object(path: Column) -> Column:
    return F.regexp_extract(path, _OBJECT, 1)


def landed_name(path: Column) -> Column:
    """Base name of the landed object; '' when the path is not a .csv."""
    return F.regexp_extract(path, _NAME, 1)
