"""Audit of how the sources of a language differ in their terms.

Every group, a source of a language, has a smoothed price per kept term, in
billionths. Two groups differ by the sum of the differences of their prices over
all kept terms of the language.

That sum is taken by sparse merges. A group is a set of sorted (term id, count)
arrays, cut into slices of the id range so that no array grows with the corpus.
For every unordered pair of groups the arrays of a slice come together in one
row; a galloping search of the shorter array in the longer finds the overlap,
which is priced both ways, then the terms that only one has. Terms that neither
has differ by the same amount each, so their number is enough. One merge serves
both directions.

Terms are counted in the tasks that read the texts, in tables of bounded size,
so a hot term, whatever its sources, leaves a task as one row. All arithmetic is
exact.

Defined results: null text, language and source are empty; a group without terms
is still a group, and its prices are those of count zero; a language without
kept terms has differences of 0; repeated rows count each; an empty table gives
no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wageledger.sinks.scratch import stored

# Fixed values of the contract: smoothing, and prices of one.
PRIOR, UNIT = 5, 10**9
LEAST_DOCUMENTS, TOP = 30, 50
# Bounds of memory only: terms of an array, and distinct (source, term) of a task at a time.
SLICE, HELD = 1 << 14, 1 << 19
# Kept terms are sent to all tasks up to this many bytes, and joined by a shuffle beyond.
BROADCAST = 64 << 20
# Bytes that end a term become blanks, A-Z become a-z; every byte above 0x7F stays.
_CUT = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_CUT).split()


def counted(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """``lang, term, docs, sources, counts``: documents with the term, and its occurrences by source; several rows per term.

    Most terms are rare and go with the first bound, so a task passes on one row
    for all sources of a term.
    """
    fields = "lang string, term string, docs long, sources array<string>, counts array<long>"

    def flush(held: dict[str, tuple[Counter, dict[str, Counter]]]) -> Iterator[pa.RecordBatch]:
        for of, (seen, by_source) in held.items():
            if not seen:
                continue
            place = {t: i for i, t in enumerate(seen)}
            sizes = [len(c) for c in by_source.values()]
            at = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in by_source.values()])
            count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in by_source.values()])
            order = np.argsort(at, kind="stable")
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(seen)))]), pa.int32())
            names = pa.array(list(by_source), pa.string()).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)[order]))
            whole = pa.RecordBatch.from_arrays(
                [
                    pa.array([of] * len(seen), pa.string()),
                    pa.array([t.decode("utf-8", "replace") for t in seen], pa.string()),
                    pa.array(list(seen.values()), pa.int64()),
                    pa.ListArray.from_arrays(ends, names),
                    pa.ListArray.from_arrays(ends, pa.array(count[order])),
                ],
                names=["lang", "term", "docs", "sources", "counts"],
            )
            for i in range(0, whole.num_rows, 1 << 14):
                yield whole.slice(i, 1 << 14)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, dict[str, Counter]]] = {}
        size = 0
        for batch in batches:
            for of, at, value in zip(*(batch.column(c) for c in ("lang", "source", "text")), strict=True):
                words = terms(value.as_py())
                seen, by_source = held.setdefault(of.as_py(), (Counter(), {}))
                count = by_source.setdefault(at.as_py(), Counter())
                size -= len(count)
                count.update(words)
                size += len(count)
                seen.update(set(words))
                if size > HELD:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    rows = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    return rows.mapInArrow(run, fields)


def price(count: Column, total: Column) -> Column:
    """``1 + floor(UNIT * (count + PRIOR) / total)``, exact."""
    return F.lit(1) + F.call_function("div", (count + PRIOR).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), total.cast("decimal(20,0)"))


def prices(count: np.ndarray, total: int) -> np.ndarray:
    """The same by long division in steps of a thousand, so that 64 bits hold all steps."""
    rest = (count.astype(object) if total > (1 << 62) // 1000 else count) + PRIOR
    made = 0
    for _ in range(3):
        step = rest * 1000 // total
        rest = rest * 1000 - step * total
        made = made * 1000 + step
    return made + 1


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where each id of ``short`` stands, or would stand, in ``long``; both ascend.

    All ids gallop at once: steps double until the id is passed, then the last
    step is halved.
    """
    low, high = np.zeros(len(short), np.int64), np.ones(len(short), np.int64)
    while (on := (high <= len(long)) & (long[np.minimum(high, len(long)) - 1] < short)).any():
        low, high = np.where(on, high, low), np.where(on, 2 * high, high)
    high = np.minimum(high - 1, len(long))
    while (wide := low < high).any():
        middle = (low + high) // 2
        less = wide & (long[np.minimum(middle, len(long) - 1)] < short)
        low, high = np.where(less, middle + 1, low), np.where(wide & ~less, middle, high)
    return low


def merged(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> tuple[int, int]:
    """Sum of the differences over the terms of either, and their number; ids, counts and the divisor of each."""
    (ids, count, total), (other_ids, other_count, other_total) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    mine, theirs = prices(count, total), prices(other_count, other_total)
    none, other_none = prices(np.zeros(1, np.int64), total)[0], prices(np.zeros(1, np.int64), other_total)[0]
    one_sided = np.ones(len(other_ids), bool)
    found = np.zeros(len(ids), bool)
    at = np.zeros(len(ids), np.int64)
    if len(ids):
        at = np.minimum(gallop(ids, other_ids), len(other_ids) - 1)
        found = other_ids[at] == ids
        one_sided[at[found]] = False
    value = abs(mine[found] - theirs[at[found]]).sum() + abs(mine[~found] - other_none).sum() + abs(theirs[one_sided] - none).sum()
    return int(value), int(len(ids) + one_sided.sum())


def _pair_sums(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """``lang, a, b, value, met`` per slice: the difference over terms that a pair has, and their number."""
    keys = ["lang", "a", "b", "slice"]
    left, right = (pairs.join(arrays.withColumnRenamed("source", s), ["lang", s]) for s in ("a", "b"))
    left = left.select(*keys, "a_total", "b_total", F.col("ids").alias("a_ids"), F.col("counts").alias("a_counts"))
    right = right.select(*keys, F.col("a_total").alias("x"), F.col("b_total").alias("y"), F.col("ids").alias("b_ids"), F.col("counts").alias("b_counts"))
    tasks = left.join(right, keys, "full").withColumns({"a_total": F.coalesce("a_total", "x"), "b_total": F.coalesce("b_total", "y")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)

        def array(batch: pa.RecordBatch, column: str, i: int) -> np.ndarray:
            value = batch.column(column)[i]
            return np.asarray(value.values, np.int64) if value.is_valid else empty

        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                sides = [(array(batch, f"{s}_ids", i), array(batch, f"{s}_counts", i), batch.column(f"{s}_total")[i].as_py()) for s in "ab"]
                made.append(merged(*sides))
            values, met = zip(*made, strict=True) if made else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("lang", "a", "b")), pa.array(values, pa.int64()), pa.array(met, pa.int64())], names=["lang", "a", "b", "value", "met"]
            )

    return tasks.select("lang", "a", "b", "a_total", "b_total", "a_ids", "a_counts", "b_ids", "b_counts").mapInArrow(
        run, "lang string, a string, b string, value long, met long"
    )


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources by difference, and the terms a source has most above its language."""
    sums = stored(counted(docs, lang, source, text), "term_counts")
    kept = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    # ids are dense within a partition of the written table, so a slice of ids is full
    kept = stored(kept.select("lang", "term", F.monotonically_increasing_id().alias("id")), "kept_terms")
    held = kept.agg(F.sum(F.octet_length("term") + F.octet_length("lang") + 64)).first()[0] or 0
    # most rows are of terms that are not kept: a small table of those that are spares their shuffle, a large one is joined
    terms_kept = F.broadcast(kept) if held <= BROADCAST else kept
    by_source = sums.join(terms_kept, ["lang", "term"]).select("lang", "term", "id", F.explode(F.arrays_zip("sources", "counts")).alias("one"))
    counts = by_source.groupBy("lang", F.col("one.sources").alias("source"), "term", "id").agg(F.sum("one.counts").alias("count"))
    counts = stored(counts, "kept_counts")
    totals = counts.groupBy("lang", "id").agg(F.sum("count").alias("lang_count"))

    langs = totals.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_n"))
    sizes = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    named = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    v, n = F.coalesce("v", F.lit(0)), F.coalesce("n", F.lit(0))
    groups = named.join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
    groups = stored(groups.select("lang", "source", v.alias("v"), (n + PRIOR * v).alias("total"), (F.col("lang_n") + PRIOR * v).alias("lang_total")), "term_groups")

    slices = counts.groupBy("lang", "source", F.shiftright("id", SLICE.bit_length() - 1).alias("slice")).agg(F.array_sort(F.collect_list(F.struct("id", "count"))).alias("both"))
    arrays = stored(slices.select("lang", "source", "slice", F.col("both.id").alias("ids"), F.col("both.count").alias("counts")), "term_arrays")
    ours = groups.select("lang", F.col("source").alias("a"), "v", F.col("total").alias("a_total"))
    pairs = ours.join(groups.select("lang", F.col("source").alias("b"), F.col("total").alias("b_total")), "lang").where("a < b")
    pairs = stored(pairs, "term_pairs")
    met = _pair_sums(pairs.drop("v"), arrays).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met"))
    absent = F.when(F.col("v") > 0, F.abs(price(F.lit(0), F.col("a_total")) - price(F.lit(0), F.col("b_total"))))
    value = F.coalesce("value", F.lit(0)) + (F.col("v") - F.coalesce("met", F.lit(0))) * F.coalesce(absent, F.lit(0))
    both = stored(pairs.join(met, ["lang", "a", "b"], "left").select("lang", "a", "b", value.alias("value")), "pair_values")
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    by_pair = both.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    over = counts.join(totals, ["lang", "id"]).join(groups, ["lang", "source"]).withColumns({"p": price(F.col("count"), F.col("total")), "q": price(F.col("lang_count"), F.col("lang_total"))})
    by_term = over.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    best = by_term.select("*", rank).where(F.col("rank") <= top)
    return by_pair.select("*", rank).unionByName(best)
