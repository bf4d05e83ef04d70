"""A quality classifier by co-training.

Two views of a document are learned apart: its content (hashed trigrams of its
bytes) and its metadata (source, language, length and the layout of the page:
lines, capitals, digits, punctuation). In each round both classifiers are
fitted and score all documents on the cluster, and the pseudo-labels that one is
most confident of go to the training set of the other. Both views are then
calibrated on labelled documents that were kept apart, combined, and applied to
all documents.

Labels come from a bounded sample, the first ``LABELLED`` labelled documents by
hashed id; pseudo-labels may come from any other document, at most ``EXCHANGED``
per class, view and round, so what the driver fits is bounded. Every pass reads
every text whole.

Defined results: a null text has no content and null metadata is a value of
its own; contradicting labels of a document count by their majority, a tie as
good; without both classes among the labels every document has score 1 and is
kept; repeated rows are scored alike, and used once for fitting.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wageledger.llm.text import free_name
from wageledger.sinks.scratch import stored

LABELLED = 4000
CONTENT, SOURCES, LANGS = 2048, 64, 16
ROUNDS = 3
CONFIDENT, EXCHANGED = 0.95, 200  # per class, round and view
THRESHOLD = 0.5


def content(text: str) -> np.ndarray:
    """Dampened counts of hashed byte trigrams, of unit length."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(CONTENT, np.float32)
    mixed = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA6B) + raw[2:] * np.uint32(0xC2B2AE35)
    counts = np.log1p(np.bincount(mixed >> np.uint32(21), minlength=CONTENT).astype(np.float32))
    return counts / np.linalg.norm(counts)


def metadata(text: str, source: str | None, lang: str | None) -> np.ndarray:
    """Hashed source and language, and layout in numbers of about unit size."""
    row = np.zeros(SOURCES + LANGS + 8, np.float32)
    row[zlib.crc32(repr(source).encode()) % SOURCES] = 1
    row[SOURCES + zlib.crc32(repr(lang).encode()) % LANGS] = 1
    raw = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    kinds = np.bincount(raw, minlength=256) / max(1, len(raw))
    lines = text.count("\n") + 1
    row[SOURCES + LANGS :] = (
        np.log1p(len(text)) / 10,
        np.log1p(lines) / 5,
        np.log1p(len(text) / lines) / 5,
        kinds[65:91].sum() * 2,  # capitals
        kinds[48:58].sum() * 5,  # digits
        (kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()) * 3,
        (kinds[32] + kinds[10]) * 3,
        1.0 if not text else 0.0,
    )
    return row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class Linear:
    """Logistic regression."""

    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    @classmethod
    def fit(cls, parts: list[np.ndarray], y: np.ndarray, l2: float = 1e-4, steps: int = 150, rate: float = 0.1, balanced: bool = True) -> Linear:
        """Full-batch Adam over the rows of all ``parts``, none of which is copied.

        ``balanced`` gives both classes equal weight, else scores are calibrated to the rows.
        """
        parts, y = [x.astype(np.float32, copy=False) for x in parts], y.astype(np.float32)
        ends = np.cumsum([len(x) for x in parts])[:-1]
        share = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum())).astype(np.float32)
        if not balanced:
            share = np.full(len(y), 1 / len(y), np.float32)
        w = np.zeros(parts[0].shape[1] + 1, np.float32)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):
            error = share * (_sigmoid(np.concatenate([x @ w[:-1] for x in parts]) + w[-1]) - y)
            steepest = sum(x.T @ e for x, e in zip(parts, np.split(error, ends), strict=True))
            grad = np.append(steepest + l2 * w[:-1], error.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return cls(w[:-1].astype(np.float32), float(w[-1]))


@dataclass(frozen=True)
class Model:
    """Both views and their calibrated combination."""

    content: Linear
    metadata: Linear
    combined: Linear

    def score(self, text: str | None, source: str | None, lang: str | None) -> float:
        text = text or ""
        views = [self.content.logit(content(text)), self.metadata.logit(metadata(text, source, lang))]
        return float(_sigmoid(self.combined.logit(np.clip(np.asarray(views), -20, 20) / 4)))


def set_apart(y: np.ndarray) -> np.ndarray:
    """Marks every fourth row of each class, for calibration; none if that leaves a class out."""
    apart = np.zeros(len(y), bool)
    for c in (0, 1):
        apart[np.flatnonzero(y == c)[3::4]] = True
    return apart if len(set(y[apart].tolist())) == 2 else np.zeros(len(y), bool)


Exchange = Callable[[list[Linear], list[Linear]], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, exchange: Exchange, apart: int) -> Model | None:
    """None without two classes.

    ``a``, ``b``: the views of labelled rows with labels ``y``, of which the
    first ``apart`` calibrate and the rest are fitted (all do both if it is 0).
    ``exchange`` takes the classifiers and the scales of their confidence, and
    gives what each is most confident of: both views of those rows, and labels.
    """
    if len(set(y.tolist())) < 2:
        return None
    test, fit = slice(0, apart or None), slice(apart, None)
    views = [a, b]
    sets = [([a[fit]], y[fit]), ([b[fit]], y[fit])]
    models = [Linear.fit(*s) for s in sets]
    for _ in range(ROUNDS):
        # confidence is judged on the calibrated scale of the view
        scales = [Linear.fit([model.logit(view[test])[:, None] / 4], y[test], balanced=False) for model, view in zip(models, views, strict=True)]
        given = exchange(models, scales)
        if not any(len(labels) for *_, labels in given):
            break
        for k, (*rows, labels) in enumerate(given):
            x, z = sets[1 - k]
            sets[1 - k] = ([*x, rows[1 - k]], np.concatenate([z, labels]))
        models = [Linear.fit(*s) for s in sets]
    both = np.stack([model.logit(view[test]) for model, view in zip(models, views, strict=True)], axis=1)
    return Model(*models, Linear.fit([np.clip(both, -20, 20) / 4], y[test], steps=300, balanced=False))


def _confident(rows: DataFrame, used: set, models: list[Linear], scales: list[Linear]) -> DataFrame:
    """``id, view, label``: per view and class the ``EXCHANGED`` rows that the view is surest of, but the ``used`` ids.

    ``rows``: ``id, t, s, l``. A task passes on as many of each at most.
    """
    shared = rows.sparkSession.sparkContext.broadcast((frozenset(used), models, scales))
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string("view int, label double, sure double").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, models, scales = shared.value
        best: dict[tuple[int, float], list[tuple]] = {(k, label): [] for k in (0, 1) for label in (0.0, 1.0)}

        def trimmed(found: list[tuple]) -> list[tuple]:
            # of repeated ids one
            return sorted({name: (-sure, order, name) for sure, order, name in sorted(found)}.values())[:EXCHANGED]

        for batch in batches:
            for name, text, source, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name in used:
                    continue
                text = text or ""
                order = zlib.crc32(repr(name).encode())
                for k, x in enumerate((content(text), metadata(text, source, lang))):
                    p = float(_sigmoid(scales[k].logit(np.array([models[k].logit(x) / 4]))))
                    label = 1.0 if p >= 0.5 else 0.0
                    if max(p, 1 - p) >= CONFIDENT:
                        best[k, label].append((max(p, 1 - p), order, name))
            for key, found in best.items():
                if len(found) > 8 * EXCHANGED:
                    best[key] = [(-s, o, n) for s, o, n in trimmed(found)]
        out = [(name, k, label, -sure) for (k, label), found in best.items() for sure, _, name in trimmed(found)]
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrow.types, strict=True)] if out else [pa.array([], t) for t in arrow.types]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    found = rows.mapInArrow(run, schema).groupBy("id", "view", "label").agg(F.max("sure").alias("sure"))
    rank = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc("sure"), F.xxhash64(F.lit(8), "id"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= EXCHANGED).select("id", "view", "label")


def _features(docs: DataFrame) -> list[tuple[object, bytes, bytes]]:
    """The id and both views of few documents ``id, t, s, l``."""
    schema = T.StructType([docs.schema["id"], *T._parse_datatype_string("a binary, b binary").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(arrow.types[0]),
                    pa.array([content(r[0] or "").astype(np.float16).tobytes() for r in rows], pa.binary()),
                    pa.array([metadata(r[0] or "", r[1], r[2]).tobytes() for r in rows], pa.binary()),
                ],
                schema=arrow,
            )

    return [(r["id"], bytes(r["a"]), bytes(r["b"])) for r in docs.mapInArrow(run, schema).collect()]


def _views(found: list[tuple[object, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.empty((len(found), CONTENT), np.float32), np.empty((len(found), SOURCES + LANGS + 8), np.float32)
    for i, (_, mine, other) in enumerate(found):
        a[i], b[i] = np.frombuffer(mine, np.float16), np.frombuffer(other, np.float32)
    return a, b


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", source: str = "source", lang: str = "lang"
) -> Model | None:
    """Fits on the first ``LABELLED`` labelled documents by hashed id, and on what both views learn from all others."""
    named = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id"))
    named = named.agg((F.avg(F.col(label)) >= 0.5).cast("double").alias("label"))
    ids = docs.select(F.col(key).alias("id")).where("id is not null").distinct()
    first = stored(ids.join(named, "id").orderBy(F.xxhash64(F.lit(8), "id"), "id").limit(LABELLED), "labelled")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("t"), F.col(source).cast("string").alias("s"), F.col(lang).cast("string").alias("l"))
    rows = rows.where("id is not null")

    def of(few: DataFrame) -> list[tuple[object, bytes, bytes]]:
        """Features of few ids; of rows that repeat an id one counts."""
        sample = rows.join(F.broadcast(few.select("id").distinct()), "id")
        least = F.min(F.struct(F.xxhash64("t", "s", "l").alias("h"), "t", "s", "l")).alias("row")
        return _features(sample.groupBy("id").agg(least).select("id", "row.t", "row.s", "row.l"))

    y_of = {r["id"]: r["label"] for r in first.collect()}  # LABELLED at most
    found = sorted(of(first), key=lambda r: (y_of[r[0]], r[1:]))
    apart = set_apart(np.array([y_of[r[0]] for r in found]))
    found = [r for flag in (True, False) for r, here in zip(found, apart, strict=True) if here == flag]
    y = np.array([y_of[r[0]] for r in found])
    a, b = _views(found)
    used = set(y_of)
    del found  # the driver holds the sample once

    def exchange(models: list[Linear], scales: list[Linear]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        picked = stored(_confident(rows, used, models, scales), "confident")
        sure = picked.collect()  # EXCHANGED per view and class at most
        views = {r[0]: r for r in of(picked)} if sure else {}
        given = []
        for k in (0, 1):
            mine = sorted((views[r["id"]][1:], r["label"], r["id"]) for r in sure if r["view"] == k)
            given.append((*_views([views[i] for *_, i in mine]), np.array([z for _, z, _ in mine])))
        used.update(views)
        return given

    return co_train(a, b, y, exchange, int(apart.sum()))


def score(docs: DataFrame, model: Model | None, text: str = "text", source: str = "source", lang: str = "lang", name: str = "score") -> DataFrame:
    """``docs`` and the score, 0 to 1. Only the three columns it is made of go to Python."""
    name = free_name(docs, name)
    if model is None:
        return docs.withColumn(name, F.lit(1.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array, sources: pa.Array, langs: pa.Array) -> pa.Array:
        given = zip(texts, sources, langs, strict=True)
        return pa.array([shared.value.score(t.as_py(), s.as_py(), x.as_py()) for t, s, x in given], pa.float64())

    return docs.withColumn(name, scored(docs[text], docs[source].cast("string"), docs[lang].cast("string")))
