"""Names of people: filling, hashing, and how many are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wageledger.functions.keys import salted_hash
from wageledger.functions.text import fill_name


def fill_names(df: DataFrame, column: str = "Name") -> DataFrame:
    return df.withColumn(column, fill_name(F.col(column)))


def anonymize(df: DataFrame, salt: str, column: str = "Name", hashed: str = "name_hash") -> DataFrame:
    """Replace ``column`` by its salted hash, at the same position; without the column, no change."""
    if column not in df.columns:
        return df
    return fill_names(df, column).withColumn(column, salted_hash(F.col(column), salt)).withColumnRenamed(column, hashed)


def missing_count(column: str = "Name") -> Column:
    return F.count(F.when(F.col(column).isNull(), 1))


def missing_names(df: DataFrame, column: str = "Name") -> DataFrame:
    """One row: how many names are NULL, out of how many rows."""
    return df.agg(missing_count(column).alias("missing_names"), F.count(F.lit(1)).alias("total_rows"))
