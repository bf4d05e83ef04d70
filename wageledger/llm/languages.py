"""Language identification as the inference of a mixture.

Each language is a distribution over hashed character trigrams, counted over
all documents of known language. A text is a mixture of languages: expectation
maximisation estimates the proportions from its trigrams, for growing sets of
languages, and a language joins the set only if the likelihood gains more than
the penalty. The prediction is the language of the largest proportion, its
score that proportion.

Counting and inference run in Arrow batches, texts one by one and whole. The
model is languages x buckets; its size does not depend on the corpus, and more
than ``LANGUAGES`` different values, which no clean column has, are refused
before anything reaches the driver.

Defined results: a text that is null or has no letters is ``und`` with score 0;
so is every text if no document of known language was given; a null or blank
language is not learned from; equal likelihoods go to the language first in
order of name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.llm.text import map_text
from wageledger.sinks.scratch import stored

BUCKETS = 1 << 16
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
SMOOTHING = 0.5
# Trigrams overlap and repeat, so a token counts less than an independent one.
PENALTY = 4.0
STEPS = 25
# Languages counted at once in a task.
HELD = 64
# 100 MB of model.
LANGUAGES = 200


def trigrams(text: str) -> np.ndarray:
    """Buckets of the trigrams of letters, with blanks around words; empty if there are none."""
    letters = NOT_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):  # numerals such as fractions are no letters
        return np.empty(0, np.uint32)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B) + codes[2:] * np.uint32(0xC2B2AE35)
    return (mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)


def count_trigrams(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, bucket, n`` over all rows with a language; each task adds up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                name = name.as_py()
                if name not in sums:
                    if len(sums) >= HELD:
                        yield from out(sums)
                        sums = {}
                    sums[name] = np.zeros(BUCKETS, np.int64)
                found = trigrams(value.as_py())
                if len(found):
                    sums[name] += np.bincount(found, minlength=BUCKETS) if len(found) > 4096 else 0
                    if len(found) <= 4096:
                        np.add.at(sums[name], found, 1)
        yield from out(sums)

    def out(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    known = docs.where(F.col(text).isNotNull() & (F.trim(lang) != "")).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    partial = known.mapInArrow(run, "lang string, bucket int, n long")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Languages in order of name, and the probability of each bucket in each."""

    names: tuple[str, ...]
    likelihood: np.ndarray  # buckets x languages

    def mixture(self, text: str | None) -> dict[str, float]:
        """Proportions of the languages in a text, of those selected; empty if there is nothing to tell by."""
        found = trigrams(text or "")
        if not len(found) or not self.names:
            return {}
        buckets, counts = np.unique(found, return_counts=True)
        seen = self.likelihood[buckets]
        single = counts @ np.log(seen)
        chosen = [int(np.argmax(single))]
        best, share = float(single[chosen[0]]), np.ones(1)
        cost = PENALTY * np.log(len(found))
        while len(chosen) < len(self.names):
            tried = [(*_fit(seen[:, [*chosen, j]], counts), j) for j in range(len(self.names)) if j not in chosen]
            gain, more, j = max(tried, key=lambda t: (t[0], -t[2]))
            if gain - best <= cost:
                break
            best, share = gain, more
            chosen.append(j)
        return {self.names[j]: float(p) for j, p in zip(chosen, share, strict=True)}


def _fit(seen: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Log-likelihood and proportions after expectation maximisation."""
    share = np.full(seen.shape[1], 1 / seen.shape[1])
    total = counts.sum()
    for _ in range(STEPS):
        joint = seen @ share
        new = share * (seen.T @ (counts / joint)) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return float(counts @ np.log(seen @ share)), share


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """The model of all rows of ``docs`` with a language."""
    counts = stored(count_trigrams(docs, lang, text), "trigrams")
    seen = counts.select("lang").distinct().count()
    if seen > LANGUAGES:
        raise ValueError(f"{seen} languages to learn, {LANGUAGES} are the bound: is {lang} a language column?")
    counts = counts.toPandas()  # LANGUAGES x BUCKETS rows at most
    names = tuple(sorted(counts["lang"].unique()))
    table = np.full((BUCKETS, len(names)), SMOOTHING)
    places = {n: i for i, n in enumerate(names)}
    table[counts["bucket"].to_numpy(), counts["lang"].map(places).to_numpy(dtype=int)] += counts["n"].to_numpy()
    return Model(names, table / table.sum(axis=0))


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``lang_pred``, ``score`` and the whole ``mixture`` of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(value: str | None) -> list[tuple]:
        shares = shared.value.mixture(value)
        if not shares:
            return [(UNKNOWN, 0.0, [])]
        name = min(shares, key=lambda n: (-shares[n], n))
        return [(name, min(1.0, max(0.0, shares[name])), list(shares.items()))]

    return map_text(docs, text, measure, "lang_pred string, score double, mixture map<string,double>", keep)
