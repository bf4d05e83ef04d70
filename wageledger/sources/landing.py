"""CSV snapshots and the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wageledger.functions.paths import decoded, landed_name, landed_object
from wageledger.schemas import landed_schema

# Doubled quotes inside quoted fields, as spreadsheet exports write them.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_snapshot(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A snapshot as published, every column a string, names from its header.

    A record with more or fewer fields than the header fails the read: its
    values would sit in other columns, a name perhaps in one that is not
    hashed. ``multiline`` accepts line breaks inside quoted fields, but such
    files cannot be split, so each one is read by a single task; without it a
    broken field leaves records that are too short, which fail.
    """
    return spark.read.options(**CSV_OPTIONS, mode="FAILFAST", multiLine=str(multiline).lower()).csv(path)


def read_landed(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    mode: str = "FAILFAST",
    multiline: bool = False,
) -> DataFrame:
    """Landed files bound to ``schema`` by position, plus ``landed_path``.

    The header line is skipped, not matched. A row with too few or too many
    fields fails the load unless ``mode`` says otherwise.
    """
    reader = spark.read.schema(schema or landed_schema()).options(
        **CSV_OPTIONS, enforceSchema="true", mode=mode, multiLine=str(multiline).lower()
    )
    return reader.csv(paths).withColumn("landed_path", decoded(F.col("_metadata.file_path")))


def list_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Landed objects under ``folder``: (source_file, landed_object, in_parts), contents unread.

    ``in_parts`` marks a folder of part files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select("path")
    )
    return files.select(
        landed_name(F.col("path")).alias("source_file"),
        landed_object(F.col("path")).alias("landed_object"),
        (landed_object(F.col("path")) != F.col("path")).alias("in_parts"),
    ).distinct()


def repeated_names(landed: DataFrame) -> DataFrame:
    """File names under which more than one object has landed."""
    objects = landed.where(F.col("source_file").endswith(".csv")).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return objects.where("n > 1").select("source_file")


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a landed folder has the marker that is written after its last part."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def loaded_files(raw: DataFrame) -> DataFrame:
    """The load ledger: file names already present in the raw table."""
    return raw.where(F.col("source_file").isNotNull()).select("source_file").distinct()


def new_files(landed: DataFrame, raw: DataFrame | None) -> DataFrame:
    """Landed .csv names that the raw table does not hold yet, sorted."""
    names = landed.where(F.col("source_file").endswith(".csv")).select("source_file").distinct()
    if raw is not None:
        names = names.join(loaded_files(raw), "source_file", "left_anti")
    return names.orderBy("source_file")
