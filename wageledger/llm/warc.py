"""WARC archives: writing pages as captures, reading records, assembling transactions.

Archives are written by Spark's text sink with CRLF as the line separator and
gzip around each file: any file system Spark knows, committed per task, so a
lost executor leaves no half file. They are read by the text source with the
same separator. A gzip file is one split, so its lines arrive in order, and a
record ends where its Content-Length says, whatever its payload holds.

Defined results: a null payload is empty; a null or blank address leaves out
the address header and reads back as null; control characters and blanks in an
address are percent-encoded; a null page id is not written and reads back as
null; repeated rows become separate captures with ids of their own; a record
cut short raises an error that names its file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

END = "\r\n"
CAPTURES = ("response", "revisit", "resource")
RECORD = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, "
    "refers_to string, declared_digest string, content_type string, fields map<string,string>, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column | None]], block: Column) -> Column:
    """The text of one record but for its last line end; headers that are null are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    # concat_ws leaves nulls out, concat of a null is null
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), block, F.lit(END))


def captures_of(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 1000) -> DataFrame:
    """Captures to write: who stores the payload, who only refers to it.

    Of equal payloads of at least ``least`` bytes the one with the largest key
    is stored. Payloads are compared by SHA-256. Each distinct payload is
    shuffled once, copies are combined before; everything else is light.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    seen = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    seen = seen.withColumn("content", F.sha2("body", 256))
    rows = seen.select(
        "id", "url", "content", F.sha1("body").alias("digest"), F.octet_length("body").cast("long").alias("length")
    )
    rows = rows.groupBy("id", "url", "content", "digest", "length").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")
    this = F.struct(F.col("id").isNotNull().alias("named"), "id", F.coalesce("url", F.lit("")).alias("url"), "copy")
    first = rows.where(F.col("length") >= least).groupBy("content").agg(F.max(this).alias("stored"))
    rows = rows.join(first, "content", "left").withColumn("revisits", ~this.eqNullSafe(F.col("stored")) & F.col("stored").isNotNull())
    bodies = seen.groupBy("content").agg(F.first("body").alias("body"))
    rows = rows.join(bodies, "content").withColumn("body", F.when(~F.col("revisits"), F.col("body")))
    me = _uuid(F.lit("capture"), F.col("id"), F.coalesce("url", F.lit("")), F.col("copy"), F.col("content"))
    other = _uuid(F.lit("capture"), F.col("stored.id"), F.col("stored.url"), F.col("stored.copy"), F.col("content"))
    return rows.select(
        "id", "url", "digest", "length", "revisits", "body", me.alias("record"), F.when(F.col("revisits"), other).alias("refers")
    )


def write(captures: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", records_per_file: int = 100_000) -> None:
    """Three records per capture: the response or revisit, its request, and its metadata."""
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    uri = F.when(F.trim("url") != "", uri)
    when = ("WARC-Date", F.lit(date))
    record, address = F.col("record"), ("WARC-Target-URI", uri)
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "),
        F.col("length").cast("string"),
        F.lit(END + END),
    )
    answer = _record(
        F.when(F.col("revisits"), F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", record),
            when,
            address,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Refers-To", F.col("refers")),
            ("WARC-Profile", F.when(F.col("revisits"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(head, F.coalesce("body", F.lit(""))),
    )
    target = F.coalesce(F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    get = F.concat(F.lit("GET "), F.when(target == "", F.lit("/")).otherwise(target), F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    beside = [when, address, ("WARC-Concurrent-To", record)]
    request = _record(
        F.lit("request"),
        [("WARC-Record-ID", _uuid(F.lit("request"), record)), *beside, ("Content-Type", F.lit("application/http; msgtype=request"))],
        get,
    )
    fields = F.concat_ws(
        END,
        F.concat(F.lit("page_id: "), F.col("id").cast("string")),
        F.concat(F.lit("payload_bytes: "), F.col("length").cast("string")),
        F.lit(""),
    )
    about = _record(
        F.lit("metadata"),
        [("WARC-Record-ID", _uuid(F.lit("metadata"), record)), *beside, ("Content-Type", F.lit("application/warc-fields"))],
        fields,
    )
    # the request first, as fetched; the sink adds the last line end of each record
    lines = captures.select(F.explode(F.array(request, answer, about)).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the gzip archives under ``path``; without ``payloads`` only their lengths and digests."""
    lines = spark.read.option("lineSep", END).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    schema = T._parse_datatype_string(RECORD)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for row in records(((f, v) for b in batches for f, v in zip(*(c.to_pylist() for c in b.columns), strict=True)), payloads):
            rows.append(row)
            held += len(row[-1] or b"")
            if len(rows) >= 4096 or held >= 16 << 20:
                yield table(rows)
                rows, held = [], 0
        if rows:
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return lines.mapInArrow(run, schema)


def records(lines: Iterator[tuple[str, bytes]], payloads: bool) -> Iterator[tuple]:
    """Parses the lines of whole files, one record at a time."""
    file, head, parts, left = None, None, [], 0  # head: None between records
    for name, line in lines:
        if name != file:
            if head is not None:
                raise ValueError(f"{file}: the last record is cut short")
            file = name
        if head is None:
            if line.startswith(b"WARC/"):
                head, parts, left = [], [], -1
            elif line:
                raise ValueError(f"{file}: a record starts with {line[:40]!r}")
            continue
        if left < 0:  # in the headers
            if line:
                head.append(line.decode("utf-8", "replace"))
                continue
            head = _fields(head)
            left = int(_one(head, "content-length") or 0)
            parts = []
            continue
        parts.append(line)
        left -= len(line)
        if left > 0:
            left -= len(END)
            if left >= 0:
                continue
        if left < 0:
            raise ValueError(f"{file}: a record is longer or shorter than its Content-Length")
        yield _parsed(head, b"\r\n".join(parts), payloads)
        head = None
    if head is not None:
        raise ValueError(f"{file}: the last record is cut short")


def _fields(lines: list[str]) -> list[tuple[str, str]]:
    split = (line.partition(":") for line in lines)
    return [(name.strip().lower(), value.strip()) for name, _, value in split]


def _one(fields: list[tuple[str, str]], name: str) -> str | None:
    return next((v for k, v in fields if k == name), None)


def _parsed(head: list[tuple[str, str]], block: bytes, payloads: bool) -> tuple:
    kind, content = _one(head, "warc-type"), _one(head, "content-type") or ""
    fields: dict[str, str] = {}
    payload = block
    if content.startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        fields = dict(_fields(top.decode("utf-8", "replace").split(END)[1:]))
    elif content.startswith("application/warc-fields"):
        fields = dict(_fields([x for x in block.decode("utf-8", "replace").split(END) if x]))
    return (
        _one(head, "warc-record-id"),
        kind,
        _one(head, "warc-target-uri"),
        _one(head, "warc-date"),
        [v for k, v in head if k == "warc-concurrent-to"],
        _one(head, "warc-refers-to"),
        _one(head, "warc-payload-digest"),
        content or None,
        list(fields.items()),
        len(payload),
        hashlib.sha1(payload).hexdigest(),
        payload if payloads else None,
    )


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response``, ``request`` and the list ``metadata``.

    Records belong together if one names the other in WARC-Concurrent-To;
    metadata of a request belongs to the capture of the request. Several
    requests of one capture leave that with the smallest id; metadata is listed
    by id. A capture without them has a null request and an empty list.
    """
    whole = F.struct(*records.columns)
    captures = records.where(F.col("record_type").isin(*CAPTURES))
    others = records.where(F.col("record_type").isin("request", "metadata"))
    named = others.select(F.col("record_id").alias("member"), F.explode("concurrent_to").alias("of"))
    back = captures.select(F.explode("concurrent_to").alias("member"), F.col("record_id").alias("of"))
    edges = named.union(back).distinct()
    ids = captures.select(F.col("record_id").alias("of")).distinct()
    direct = edges.join(ids, "of").select("member", F.col("of").alias("capture"))
    through = named.withColumnRenamed("of", "request").join(direct.withColumnRenamed("member", "request"), "request")
    members = direct.union(through.select("member", "capture")).distinct()
    rows = others.select(F.col("record_id").alias("member"), "record_type", whole.alias("row")).join(members, "member")
    grouped = rows.groupBy("capture").agg(
        F.min_by("row", F.when(F.col("record_type") == "request", F.col("member"))).alias("request"),
        F.max(F.col("record_type") == "request").alias("asked"),
        F.array_sort(
            F.collect_list(F.when(F.col("record_type") == "metadata", F.col("row"))),
            lambda a, b: F.when(a["record_id"] < b["record_id"], -1).when(a["record_id"] > b["record_id"], 1).otherwise(0),
        ).alias("metadata"),
    )
    answers = captures.select(F.col("record_id").alias("capture"), whole.alias("response"))
    return answers.join(grouped, "capture", "left").select(
        "capture",
        "response",
        F.when(F.col("asked"), F.col("request")).alias("request"),
        F.coalesce("metadata", F.array().cast(answers.schema["response"].dataType.simpleString().join(("array<", ">")))).alias("metadata"),
    )
