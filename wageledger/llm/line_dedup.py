"""Fuzzy line dedup by a deletion-neighbourhood join.

Lines are sequences of words. Two lines are near-equal if one word edit
(changed, added or dropped) turns one into the other, or none. Each line emits
its variants, the line with one word deleted, as hashed keys; lines that meet
in a variant are verified word by word, and the earliest of them keeps its
place. An occurrence is removed if an earlier occurrence of an equal or
near-equal line exists, by (document, line number).

Two observations keep this small. Lines one edit apart agree in their first or
in their last half, so only lines that share a half with another line of a
fitting length emit variants at all. And lines that meet in the same variant
at the same place differ in that one word only, so a group passes on its
earliest member instead of all its pairs: as many rows as lines, however hot.

Built-in functions only.

Defined results: a null text has no lines; blank lines are never touched; lines
under ``least`` words, of which one edit changes much, are only compared for
equality; blanks between words do not count; equal rows count as one occurrence,
so copies of a row are cleaned alike; null ids come last in the order; other
columns stay as they are, but ``n_chars``, if there, follows the new text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wageledger.llm.text import BLANKS, free_name
from wageledger.sinks.scratch import stored

# Words from which on lines one edit apart are near-equal.
LEAST = 8


def _words(line: Column) -> Column:
    # a line of blanks is one empty word
    return F.split(F.btrim(line, F.lit(BLANKS)), "[\\x20\\x09-\\x0D]+")


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``occ`` (place of the row in the order, and line number), ``words`` and ``n`` of each line that is not blank."""
    row = F.xxhash64(*(docs[c] for c in docs.columns))
    # words are split inside the generator, so once per line, however often they are used
    lines = F.transform(F.split(text, "\n"), _words)
    cut = docs.select(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"), row.alias("row"), F.posexplode(lines).alias("line_no", "words"))
    cut = cut.select(F.struct("unnamed", "key", "row", "line_no").alias("occ"), "words")
    return cut.where(F.get("words", F.lit(0)) != "").withColumn("n", F.size("words"))


def _named(lines: DataFrame) -> DataFrame:
    """With ``h`` and ``g``, two hashes that name a line."""
    return lines.withColumn("h", F.xxhash64("words")).withColumn("g", F.xxhash64(F.lit(7), "words"))


def _halves() -> list[Column]:
    """Hashes of the halves that a line shares with any line one edit away."""
    keys = []
    for n in (F.col("n"), F.col("n") - 1):
        half = F.floor(n / 2).cast("int")
        rest = n - half
        keys.append(F.xxhash64(F.lit(1), n, F.slice("words", F.lit(1), half)))
        keys.append(F.xxhash64(F.lit(2), n, F.slice("words", F.col("n") - rest + 1, rest)))
    return keys


def _one_edit(a: str, b: str) -> Column:
    """Whether the word arrays are at most one edit apart."""
    differ = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda d: d))
    short = F.when(F.size(a) < F.size(b), F.col(a)).otherwise(F.col(b))
    long = F.when(F.size(a) < F.size(b), F.col(b)).otherwise(F.col(a))
    at = F.array_position(F.zip_with(short, long, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")  # from 1
    tails = F.slice(short, at, F.size(long)) == F.slice(long, at + 1, F.size(long))
    return F.when(F.size(a) == F.size(b), differ <= 1).when(F.abs(F.size(a) - F.size(b)) == 1, tails).otherwise(False)


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``occ`` and ``kept`` (both with key and line_no), and the number of ``edits``, per removed occurrence."""
    if least < 2:
        raise ValueError("lines of one word are all one edit apart")
    all_lines = _named(_lines(docs, key, text))
    halves = [f"k{i}" for i in range(4)]
    all_lines = all_lines.select("h", "g", "n", "occ", *(k.alias(a) for k, a in zip(_halves(), halves, strict=True)))
    all_lines = stored(all_lines, "all_lines")  # hashes and places only
    known = all_lines.groupBy("h", "g").agg(
        F.min("occ").alias("rep"), F.count("*").alias("times"), F.min("n").alias("n"), *(F.min(k).alias(k) for k in halves)
    )
    known = stored(known, "lines")

    keys = known.where(F.col("n") >= least).select("h", F.explode(F.array(*halves)).alias("k"))
    shared = keys.groupBy("k").agg(F.count("*").alias("c")).where("c > 1")
    suspects = keys.join(shared, "k").select("h").distinct()
    where = known.where(F.col("n") >= least).join(suspects, "h", "left_semi").groupBy("rep.row").agg(F.collect_set("rep").alias("wanted"))
    # only these columns, so that no others can clash with them
    here = docs.select(F.xxhash64(*(docs[c] for c in docs.columns)).alias("row"), docs[key].alias("key"), docs[text].alias("body"))
    here = here.join(where, "row").dropDuplicates(["row", "key"]).select(
        "key", "row", F.split("body", "\n").alias("lines"), F.explode("wanted").alias("rep")
    ).where(F.col("key").eqNullSafe(F.col("rep.key")))
    texts = here.select("rep", _words(F.get("lines", F.col("rep.line_no"))).alias("words")).withColumn("n", F.size("words"))
    texts = stored(_named(texts), "suspects")

    # hashes of the line without word i, from running xors: words before i at their place, those after one place down
    each = texts.select("h", "g", "n", "rep", F.posexplode("words").alias("i", "w"))
    each = each.withColumn("a", F.xxhash64("i", "w")).withColumn("b", F.xxhash64(F.col("i") - 1, F.col("w")))
    line = Window.partitionBy("h", "g")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.select(
        "h", "g", "n", "rep", "i", "a", F.bit_xor("a").over(upto).alias("a_to"), F.bit_xor("b").over(upto).alias("b_to"),
        F.bit_xor("b").over(line).alias("b_all"),
    )
    v = F.col("a_to").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b_all")).bitwiseXOR(F.col("b_to"))
    me = F.struct("rep", "h", "g")
    variants = stored(each.select(me.alias("me"), v.alias("v"), "i", (F.col("n") - 1).alias("m"), F.when(F.col("i") == F.col("n") - 1, F.col("a_to")).alias("whole")), "variants")
    wholes = variants.where(F.col("whole").isNotNull()).select("me", F.col("whole").alias("v"), F.lit(-1).alias("i"), (F.col("m") + 1).alias("m"))
    # only variants in which lines meet go on
    emitted = variants.select("me", "v", "i", "m").union(wholes)
    meeting = emitted.groupBy("v", "m").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    emitted = stored(emitted.join(meeting, ["v", "m"], "left_semi"), "meeting")
    variants, wholes = emitted.where("i >= 0"), emitted.where("i < 0").select(F.col("me").alias("short"), "v", "m")

    earliest = variants.groupBy("v", "i", "m").agg(F.min("me").alias("other"), F.count("*").alias("c")).where("c > 1").drop("c")
    changed = variants.join(earliest, ["v", "i", "m"]).select("me", "other")
    longer = variants.groupBy("v", "m").agg(F.min("me").alias("other"))
    dropped = wholes.join(longer, ["v", "m"]).select(F.col("short").alias("me"), "other")
    added = variants.join(wholes, ["v", "m"]).select("me", F.col("short").alias("other"))
    pairs = changed.union(dropped).union(added).where("other.rep < me.rep").distinct()
    mine = texts.select("h", "g", F.col("words").alias("mine"))
    theirs = texts.select(F.col("h").alias("oh"), F.col("g").alias("og"), F.col("words").alias("theirs"))
    pairs = pairs.select("me.h", "me.g", F.col("other.h").alias("oh"), F.col("other.g").alias("og"), "other.rep")
    near = pairs.join(mine, ["h", "g"]).join(theirs, ["oh", "og"]).where(_one_edit("mine", "theirs"))
    near = near.groupBy("h", "g").agg(F.min("rep").alias("near"))

    firsts = known.join(near, ["h", "g"], "left").where("times > 1 or near is not null")
    firsts = stored(firsts.select("h", "g", "rep", F.coalesce("near", "rep").alias("kept")), "firsts")
    found = all_lines.select("h", "g", "occ").join(firsts, ["h", "g"]).where("occ != kept")
    return found.select("occ", "kept", (F.col("kept") != F.col("rep")).cast("int").alias("edits"))


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` without the removed lines."""
    columns = docs.columns
    gone = removed_lines(docs, key, text, least)
    row, lines, gone_row, gone_key = (free_name(docs, n) for n in ("row_lines", "gone_lines", "gone_row", "gone_key"))
    gone = gone.groupBy("occ.key", "occ.row").agg(F.collect_set("occ.line_no").alias(lines))
    gone = gone.withColumnsRenamed({"key": gone_key, "row": gone_row})
    rows = docs.withColumn(row, F.xxhash64(*(docs[c] for c in columns)))
    rows = rows.join(gone, (rows[row] == gone[gone_row]) & rows[key].eqNullSafe(gone[gone_key]), "left")
    stay = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(lines, i))
    rows = rows.withColumn(text, F.when(F.col(lines).isNull(), F.col(text)).otherwise(F.array_join(stay, "\n")))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length(text)))
    return rows.select(*columns)
