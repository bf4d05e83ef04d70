"""Exact dedup by Grace hash partitioning.

Contents are partitioned by hash into buckets, written to files, until each
bucket fits an open-addressing table that compares complete contents. Two
things keep a hot content from making a bucket that no hash can split. Every
task that reads the texts has such a table itself, so a content leaves it once
however often it occurs there. And a bucket in which one hash is all there is
gets cut by place instead, its pieces are merged in tables of their own, and
what is left of them is partitioned again under another hash.

Only distinct contents of a task are shuffled, once each; rows travel as
numbers. A row points to the first row of its content in its task, and that
one, over the merges, to the row that names the group.

Texts are equal if they are identical after each run of ASCII white space is
replaced by one space.

Defined results: a null text is empty; empty texts are a group like any other;
null keys come last, and a group of null keys only has a null ``keep_id``; of
rows with the same text and key exactly one stays; an empty table stays empty;
``carry`` columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wageledger.sinks.scratch import stored

# What a table may hold: distinct contents, in bytes. A bucket of a few contents fits whatever their length.
TABLE_BYTES = 16 << 20
FEW = 8


class ContentTable:
    """Numbers of distinct contents: linear probing, complete contents compared, doubled when half full."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def number(self, h: int, content: bytes) -> int:
        """The number of the content, which is added if it is new."""
        last = len(self.slots) - 1
        at = h & last
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            at = (at + 1) & last
        self.slots[at] = entry = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        last = 2 * len(self.slots) - 1
        self.slots = [-1] * (last + 1)
        for entry, h in enumerate(self.hashes):
            at = h & last
            while self.slots[at] >= 0:
                at = (at + 1) & last
            self.slots[at] = entry


def normalised(text: str | None) -> bytes:
    """The text in UTF-8, with each run of ASCII white space as one space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return raw
    body = b" ".join(raw.split())
    # a text of blanks alone is one space
    return b" " * raw[:1].isspace() + body + b" " * (bool(body) and raw[-1:].isspace())


def _hash(content: bytes, seed: int) -> int:
    h = xxhash.xxh64_intdigest(content, seed)
    return h - (1 << 64) if h >= 1 << 63 else h


def _first_tables(docs: DataFrame, key: str, text: str, carry: Sequence[str], table_bytes: int) -> DataFrame:
    """``row, rep, h, size, content`` of each row, its key and the carried columns.

    ``rep`` is the first row of the content in the table of the task; only that
    row has the content. A table that is full is left for a new one.
    """
    source = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"), F.struct(F.lit(0), *(docs[c] for c in carry)).alias("carried"))
    fields = [source.schema["key"], *T._parse_datatype_string("row long, rep long, h long, size long, content binary").fields, source.schema["carried"]]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, table, firsts = TaskContext.get().partitionId() << 33, ContentTable(), []
        for batch in batches:
            made: tuple[list, ...] = ([], [], [], [], [])
            for value in batch.column("text"):
                content = normalised(value.as_py())
                h = _hash(content, 0)
                entry = table.number(h, content)
                new = entry == len(firsts)
                if new:
                    firsts.append(row)
                for column, item in zip(made, (row, firsts[entry], h, len(content), content if new else None), strict=True):
                    column.append(item)
                row += 1
                if table.bytes > table_bytes:
                    table, firsts = ContentTable(), []
            columns = [pa.array(v, arrow.field(i + 1).type) for i, v in enumerate(made)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns, batch.column("carried").cast(arrow.field("carried").type)], schema=arrow)

    return source.mapInArrow(run, schema)


def _tables(entries: DataFrame, group: Sequence[str], seed: int | None) -> DataFrame:
    """``rep, root`` of each entry by one table per group; the roots keep more.

    With a ``seed`` roots are to be partitioned again: they keep bucket, size and
    content, and get another hash. Without, the group is complete, and roots get
    the digest of their content.
    """
    fields = "rep long, root long, sha string" if seed is None else "rep long, root long, bucket long, h long, size long, content binary"
    arrow = to_arrow_schema(T._parse_datatype_string(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, table, roots = None, ContentTable(), []
        for batch in batches:
            made: list[tuple] = []
            groups = zip(*(batch.column(c).to_pylist() for c in group), strict=True)
            rows = zip(batch.column("rep").to_pylist(), batch.column("h").to_pylist(), batch.column("content"), strict=True)
            for mark, (rep, h, value) in zip(groups, rows, strict=True):
                if mark != here:
                    here, table, roots = mark, ContentTable(), []
                content = value.as_py()
                entry = table.number(h, content)
                new = entry == len(roots)
                if new:
                    roots.append(rep)
                if seed is None:
                    made.append((rep, roots[entry], hashlib.sha256(content).hexdigest() if new else None))
                elif new:
                    made.append((rep, rep, mark[0], _hash(content, seed), len(content), content))
                else:
                    made.append((rep, roots[entry], None, None, None, None))
            columns = [pa.array(v, t) for v, t in zip(zip(*made, strict=True), arrow.types, strict=True)] if made else [pa.array([], t) for t in arrow.types]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return entries.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, fields)


def _roots(entries: DataFrame, table_bytes: int) -> DataFrame:
    """``rep, root`` of each entry ``rep, h, size, content``; of a root also the digest ``sha``."""
    total = entries.agg(F.sum("size")).first()[0] or 0
    # small buckets: many to a shuffle partition make the partitions even, and none is too large by chance
    first = max(1, -(-8 * total // table_bytes))
    entries = entries.withColumn("bucket", F.pmod(F.xxhash64(F.lit(0), "h"), F.lit(first)))
    done: list[DataFrame] = []
    links: list[DataFrame] = []
    level = 0
    while True:
        level += 1
        sizes = entries.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), (F.min("h") == F.max("h")).alias("one"))
        large = sizes.where((F.col("bytes") > table_bytes) & (F.col("n") > FEW))
        pieces = F.least(F.ceil(2 * F.col("bytes") / table_bytes), F.ceil(F.col("n") / FEW)).cast("long")
        large = stored(large.select("bucket", pieces.alias("pieces"), "one"), "grace_large")
        if large.isEmpty():
            done.append(_tables(entries, ["bucket"], None))
            break
        done.append(stored(_tables(entries.join(large, "bucket", "left_anti"), ["bucket"], None), "grace_done"))
        split = entries.join(large, "bucket")
        # several hashes: each piece is a bucket of its own
        by_hash = split.where("not one").select("rep", "h", "size", "content", F.xxhash64("bucket", F.lit(level), F.pmod(F.xxhash64(F.lit(level), "h"), F.col("pieces"))).alias("bucket"))
        # one hash: pieces by place are merged first
        by_place = split.where("one").withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces")))
        merged = stored(_tables(by_place, ["bucket", "piece"], level), "grace_merged")
        links.append(merged.where("rep != root").select("rep", F.col("root").alias("to")))
        left = merged.where("rep = root").select("rep", "h", "size", "content", "bucket")
        entries = stored(by_hash.unionByName(left), "grace_spilled")
    found = done[0]
    for more in done[1:]:
        found = found.union(more)
    for step in reversed(links):
        ends = found.select(F.col("rep").alias("to"), "root")
        found = found.union(step.join(ends, "to").select("rep", "root", F.lit(None).cast("string")))
    return found


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256`` and a struct ``carried`` of the ``carry`` columns, per row."""
    rows = stored(_first_tables(docs, key, text, carry, table_bytes), "grace_rows")
    entries = rows.where(F.col("content").isNotNull()).select("rep", "h", "size", "content")
    roots = stored(_roots(entries, table_bytes), "grace_roots")
    low = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "row")).alias("low")
    reps = rows.groupBy("rep").agg(low, F.count("*").alias("n")).join(roots, "rep")
    whole = reps.groupBy("root").agg(F.min("low").alias("low"), F.sum("n").alias("group_size"), F.max("sha").alias("text_sha256"))
    named = roots.select("rep", "root").join(whole, "root").drop("root")
    return rows.select("key", "row", "rep", "carried").join(named, "rep").select(
        F.col("key").alias(key),
        F.col("low.key").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("low.row")).alias("kept"),
        "text_sha256",
        "carried",
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay."""
    found = groups(docs, key, text, docs.columns, table_bytes)
    return found.where("kept").select(*(F.col("carried")[c].alias(c) for c in docs.columns))
