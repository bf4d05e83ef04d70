"""CSV with line breaks inside quoted fields, read by many tasks per file.

Whether a line break ends a record depends on the quotes before it in the whole
file, so a reader of such files usually takes each by a single task. Here lines
are read as text, split at any line break by any number of tasks. Each task
counts the quotes of its lines, vectorised, which gives for every line the parity
and the record start before it under both assumptions about the beginning of its
byte range. A prefix sum over the ranges of a file, one row each, tells which
assumption holds. Lines that are whole records, nearly all, then stay where they
are; only the lines of broken records are shuffled, by the place their record
starts, and joined.

Quotes inside fields are doubled, which keeps the parity. A line feed ends a
line, and a carriage return before it is dropped. A file with an odd number of
quotes fails, and so does a record of more than ``MAX_LINES`` lines, which a
stray quote would make of all that follows it.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wageledger.functions.paths import decoded
from wageledger.sinks.scratch import stored
from wageledger.sources.landing import CSV_OPTIONS

MAX_LINES = 100_000

# parity: quotes before the line within its range; start0, start1: the last record start up to the line if the
# range begins outside, or inside, a quoted field (-1: none yet)
_LINES = "file string, range long, place long, line string, odd int, parity int, start0 long, start1 long"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, place, parity, starts = None, 0, 0, [-1, -1]
    for batch in batches:
        quotes = pc.count_substring(batch.column("line"), '"').to_numpy(zero_copy_only=False).astype(np.int64)
        files, ranges = batch.column("file"), batch.column("range").to_numpy()
        new_file = pc.not_equal(files.slice(1), files.slice(0, max(0, batch.num_rows - 1))).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((ranges[1:] != ranges[:-1]) | new_file) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if a == b:
                continue
            if (mark := (files[int(a)].as_py(), int(ranges[a]))) != here:
                here, place, parity, starts = mark, 0, 0, [-1, -1]
            n = int(b - a)
            after = (parity + np.cumsum(quotes[a:b])) % 2
            before = np.concatenate([[parity], after[:-1]])
            places = place + np.arange(n)
            last = [np.maximum.accumulate(np.concatenate([[starts[h]], np.where(before == h, places, -1)]))[1:] for h in (0, 1)]
            part = batch.slice(int(a), n)
            columns = [part.column("file"), part.column("range"), pa.array(places), part.column("line")]
            columns += [pa.array((quotes[a:b] % 2).astype(np.int32)), pa.array(before.astype(np.int32)), pa.array(last[0]), pa.array(last[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "range", "place", "line", "odd", "parity", "start0", "start1"])
            place, parity, starts = place + n, int(after[-1]), [int(last[0][-1]), int(last[1][-1])]


def _ranges(lines: DataFrame) -> DataFrame:
    """Per byte range of a file: whether it begins inside a quoted field, and where the record it begins with started."""
    sums = lines.groupBy("file", "range").agg(F.sum("odd").alias("odd"), F.max("start0").alias("last0"), F.max("start1").alias("last1"))
    # one row per byte range of a file
    upto = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("inside", (F.coalesce(F.sum("odd").over(upto), F.lit(0)) % 2).cast("int"))
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    found = sums.withColumn("mine", F.when(last >= 0, F.struct(F.col("range"), last.alias("place"))))
    return found.select("file", "range", "odd", "inside", F.last("mine", ignorenulls=True).over(upto).alias("carried"))


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, first, record``: the text of each record, and whether it is the first of its file; blank records are skipped."""
    text = spark.read.option("lineSep", "\n").text(paths)
    text = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.rtrim("value", F.lit("\r")).alias("line"))
    lines = stored(text.mapInArrow(_measure, _LINES), "csv_lines")
    ranges = stored(_ranges(lines.select("file", "range", "odd", "start0", "start1")), "csv_ranges")
    broken = ranges.groupBy("file").agg(F.sum("odd").alias("odd")).where(F.col("odd") % 2 == 1).limit(5).collect()
    if broken:
        raise ValueError("quotes do not match in " + ", ".join(sorted(row["file"] for row in broken)))

    both = lines.join(ranges.select("file", "range", "inside", "carried"), ["file", "range"])
    outside = F.col("parity") == F.col("inside")
    start = F.when(F.col("inside") == 0, F.col("start0")).otherwise(F.col("start1"))
    begun = F.when(start >= 0, F.struct(F.col("range"), start.alias("place"))).otherwise(F.col("carried"))
    single = both.where(outside & (F.col("odd") == 0)).select("file", ((F.col("range") == 0) & (F.col("place") == 0)).alias("first"), F.col("line").alias("record"))
    pieces = both.where(~outside | (F.col("odd") == 1)).select("file", begun.alias("begun"), "range", "place", "line")
    pieces = stored(pieces, "csv_pieces")
    longest = pieces.groupBy("file", "begun").count().agg(F.max("count")).first()[0] or 0
    if longest > MAX_LINES:
        raise ValueError(f"a record of {longest} lines: a quote is missing")
    whole = pieces.groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("range", "place", "line"))).alias("lines"))
    first = (F.col("begun.range") == 0) & (F.col("begun.place") == 0)
    joined = whole.select("file", first.alias("first"), F.array_join(F.col("lines.line"), "\n").alias("record"))
    return single.unionByName(joined).where(F.length(F.btrim("record", F.lit(" \t"))) > 0)


def _parsed(record: Column, schema: T.StructType, mode: str) -> Column:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(record, ddl, {**CSV_OPTIONS, "header": "false", "mode": mode})


def read_quoted(spark: SparkSession, paths: str | list[str], schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Rows bound to ``schema`` by position, plus ``landed_path``, as ``read_landed`` with ``multiline`` gives them."""
    rows = records(spark, paths).where(~F.col("first"))
    parsed = rows.select("file", _parsed(F.col("record"), schema, mode).alias("row"))
    return parsed.select("row.*", decoded(F.col("file")).alias("landed_path"))


def read_quoted_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot as published, every column a string, names from its header, as ``read_snapshot`` gives it."""
    rows = stored(records(spark, path), "csv_records")
    header = rows.where("first").orderBy("file").select("record").first()
    names = next(csv.reader([header["record"]], doublequote=True)) if header else []
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return rows.where(~F.col("first")).select(_parsed(F.col("record"), schema, "FAILFAST").alias("row")).select("row.*")
