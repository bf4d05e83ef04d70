"""Secrets in whole texts: fixed patterns, and a battery of randomness tests.

Runs of letters of the usual encodings are tested for what a random key looks
like: a chi-squared test of uniformity over the alphabet of the inferred
encoding, a runs test about the middle of the alphabet, and the serial
correlation of neighbours. The three p-values are combined by Fisher's method.
A random run has a uniform combined p-value, text has one near zero.

Which p-values count as random is decided per encoding and length band by
false-discovery control: the number of truly random runs is estimated from
those above one half, and the lowest threshold is taken at which the expected
share of text among the reported runs stays below ``rate``. Short runs, where
the tests are weak, thus get stricter thresholds than long ones. Each distinct
run counts once.

Built-in functions only; texts are read once. What reaches the driver is a
histogram of encodings, length bands and twenty bins, and thresholds are joined
back as a table: the plan does not depend on what is found.

Defined results: a null text is empty; overlapping findings of different fixed
kinds all stay; a random run that overlaps a fixed finding is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wageledger.sinks.scratch import stored

# Fixed values of the contract: patterns, the group to measure, and its least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run of 20 or more from its start: what a failing shorter match would take is not in it
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
SHORTEST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Encodings from the narrowest to the widest, with their alphabets in order of value.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", DIGITS),
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("upper_hex", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", UPPER + "234567"),
    ("alphanumeric", r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
)
CELLS, BINS = 8, 20
BANDS = (32, 48, 96)


def _steps(text: Column, pattern: str, group: int, rank: int) -> Column:
    """Each match of a pattern: how much text lies before it, its length, and that of its group; of a run also the text."""
    hits, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    run = (lambda m: m) if rank == len(KINDS) else (lambda m: F.lit(None).cast("string"))
    steps = F.zip_with(
        F.zip_with(hits, between, lambda m, b: F.struct(m.alias("m"), F.length(b).alias("b"))),
        sized,
        lambda s, g: F.struct(F.lit(rank).alias("rank"), s["b"].alias("gap"), F.length(s["m"]).alias("size"), F.length(g).alias("g"), run(s["m"]).alias("run")),
    )
    steps = F.filter(steps, lambda s: s["size"].isNotNull())  # the text after the last match
    # most texts have no match: one search tells
    return F.when(text.rlike(pattern), steps).otherwise(F.array().cast("array<struct<rank:int,gap:int,size:int,g:int,run:string>>"))


def _placed(found: DataFrame) -> DataFrame:
    """``row, rank, start, stop, run`` in code points, matches with too short a group left out.

    The lengths before a match are summed by a window over the matches of its
    text, so the work is in proportion to them.
    """
    each = found.select("row", F.posexplode("steps").alias("i", "s")).select("row", "i", "s.*")
    upto = Window.partitionBy("row", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("size")).over(upto).cast("int")
    least = F.element_at(F.array(*(F.lit(x) for *_, x in KINDS), F.lit(SHORTEST)), F.col("rank") + 1)
    placed = each.withColumn("stop", stop).where(F.col("g") >= least)
    return placed.select("row", "rank", (F.col("stop") - F.col("size")).alias("start"), "stop", "run")


def _free(spans: DataFrame) -> DataFrame:
    """The runs that meet no fixed finding."""
    base = F.col("rank") < len(KINDS)
    order = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    met = spans.withColumns({"reach": F.max(F.when(base, F.col("stop"))).over(order), "ahead": F.min(F.when(base, F.col("start"))).over(back)})
    apart = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("ahead") >= F.col("stop"), F.lit(True))
    return met.where(~base & apart).select("row", "start", "stop", "run")


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a rational approximation good to 1e-7 (floor 1e-12)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * series
    return F.greatest(F.lit(1e-12), F.when(z < 0, 1 - tail).otherwise(tail))


def tested(runs: DataFrame, run: str = "run") -> DataFrame:
    """``runs`` with ``encoding`` (null: none fits), ``band`` and the combined ``p``."""
    core = F.regexp_replace(run, "[=]+$", "")
    encoding, size, letters = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(None).cast("string")
    for name, pattern, alphabet in reversed(ENCODINGS):
        fits = F.col("core").rlike(pattern)
        encoding = F.when(fits, name).otherwise(encoding)
        size = F.when(fits, len(alphabet)).otherwise(size)
        letters = F.when(fits, alphabet).otherwise(letters)
    rows = runs.withColumn("core", core).withColumns({"encoding": encoding, "size": size, "letters": letters, "n": F.length("core")})
    rows = rows.withColumn("v", F.transform(F.split("core", ""), lambda c: F.instr(F.col("letters"), c) - 1))
    n = F.col("n").cast("double")
    cell = F.transform("v", lambda x: F.floor(x * CELLS / F.col("size")).cast("int"))
    rows = rows.withColumn("cell", cell)
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x).cast("double"))
    chi = F.lit(0.0)
    for c in range(CELLS):
        # letters whose cell is c: from ceil(c * size / CELLS) up to the next
        width = F.ceil((c + 1) * F.col("size") / CELLS) - F.ceil(c * F.col("size") / CELLS)
        expected = n * width / F.col("size")
        seen = F.size(F.filter("cell", _equals(c)))
        chi = chi + (seen - expected) * (seen - expected) / expected
    k = CELLS - 1
    z_chi = (F.pow(chi / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / (2 / (9 * k)) ** 0.5
    rows = rows.withColumn("p1", _upper_tail(z_chi))

    high = F.transform("v", lambda x: (2 * x >= F.col("size")).cast("int"))
    rows = rows.withColumn("high", high).withColumn("ups", total(F.col("high"), lambda x: x))
    pairs = F.zip_with(F.slice("high", 1, F.col("n") - 1), F.slice("high", 2, F.col("n") - 1), lambda x, y: (x != y).cast("int"))
    rows = rows.withColumn("turns", total(pairs, lambda x: x))
    mean = 2 * F.col("ups") * (n - F.col("ups")) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(var > 1e-9, (F.col("turns") + 1 - mean) / F.sqrt(F.greatest(var, F.lit(1e-9)))).otherwise(F.lit(6.0))
    rows = rows.withColumn("p2", 2 * _upper_tail(F.abs(z_runs)))

    rows = rows.withColumn("avg", total(F.col("v"), lambda x: x) / n)
    square = total(F.col("v"), lambda x: (x - F.col("avg")) * (x - F.col("avg")))
    products = F.zip_with(F.slice("v", 1, F.col("n") - 1), F.slice("v", 2, F.col("n") - 1), lambda x, y: (x - F.col("avg")) * (y - F.col("avg")))
    rows = rows.withColumn("square", square)
    r = F.when(F.col("square") > 0, total(products, lambda x: x) / F.greatest(F.col("square"), F.lit(1e-9))).otherwise(F.lit(1.0))
    rows = rows.withColumn("p3", 2 * _upper_tail(F.abs((r + 1 / n) * F.sqrt(n))))

    half = -F.log(F.least(F.lit(1.0), F.col("p1"))) - F.log(F.least(F.lit(1.0), F.col("p2"))) - F.log(F.least(F.lit(1.0), F.col("p3")))
    rows = rows.withColumn("half", half)
    p = F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2)
    band = F.lit(0)
    for b in BANDS:
        band = band + (F.col("n") >= b).cast("int")
    # a core cut short by its padding is too short to test
    # and whatever is tested is stored at once: a filter on p would be pushed through all of this
    return rows.where("n >= 8").select(*runs.columns, "encoding", band.alias("band"), F.when(F.col("encoding").isNotNull(), p).alias("p"))


def _equals(c: int):
    return lambda x: x == c


def thresholds(runs: DataFrame, rate: float) -> DataFrame:
    """``encoding, band, least``: the lowest reported p of each group that reports any.

    What the tests reject by themselves, p under one bin, is never reported.
    """
    each = runs.where("encoding is not null").groupBy("encoding", "band", "run").agg(F.min("p").alias("p"))
    bins = F.least(F.lit(BINS - 1), F.floor(F.col("p") * BINS)).cast("int")
    counts: dict[tuple[str, int], list[int]] = {}
    for r in each.groupBy("encoding", "band", bins.alias("bin")).count().collect():  # encodings x bands x bins at most
        counts.setdefault((r["encoding"], r["band"]), [0] * BINS)[r["bin"]] = r["count"]
    least = []
    for group, by_bin in sorted(counts.items()):
        random = min(sum(by_bin), 2 * sum(by_bin[BINS // 2 :]))
        for b in range(1, BINS):
            reported = sum(by_bin[b:])
            if reported and max(0.0, reported - random * (1 - b / BINS)) / reported <= rate:
                least.append((*group, b / BINS))
                break
    return runs.sparkSession.createDataFrame(least, "encoding string, band int, least double")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.05) -> DataFrame:
    """``key``, ``base`` (spans of the fixed kinds) and ``spans`` (with the random runs), each in order of place.

    A span is ``(start, rank, stop, kind)``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    steps = [_steps(body, pattern, group, rank) for rank, (_, pattern, group, _) in enumerate(KINDS)]
    steps = F.concat(*steps, _steps(body, RUN, 0, len(KINDS)))
    found = stored(docs.select(F.col(key).alias("key"), steps.alias("steps"), F.monotonically_increasing_id().alias("row")), "findings")
    spans = stored(_placed(found), "spans")
    tests = stored(tested(_free(spans)), "tested")
    # one row per encoding and band at most
    random = tests.join(F.broadcast(thresholds(tests, rate)), ["encoding", "band"]).where("p >= least")
    kinds = F.element_at(F.array(*(F.lit(k) for k, *_ in KINDS), F.lit("random")), F.col("rank") + 1)
    every = spans.where(F.col("rank") < len(KINDS)).select("row", "rank", "start", "stop")
    every = every.union(random.select("row", F.lit(len(KINDS)), "start", "stop"))
    span = F.struct("start", "rank", "stop", kinds.alias("kind"))
    by_row = every.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    rows = found.select("key", "row").join(by_row, "row", "left").withColumn("spans", F.coalesce("spans", none))
    return rows.select(F.col("key").alias(key), F.filter("spans", lambda s: s["rank"] < len(KINDS)).alias("base"), "spans")


def listed(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
