"""Hot ids in the mix, clashing columns and short lines in the line dedup, tokenizer rules, language bounds."""

import json
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from wageledger.llm import languages, line_dedup, mixing
from wageledger.llm.tokens import Encoder

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bucket", [mixing.BUCKET, 100])
def test_half_the_ids_are_null(spark, monkeypatch, bucket):
    """Weights hold, and no partition has over twice the median."""
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.format_string("t%04d", F.col("id") % 5000).alias("text"), F.when(F.col("id") % 3 == 0, "a").alias("source")
    )
    mixed = mixing.mix(rows, {"a": 0.75, "*": 0.25}, seed=1)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["a"] - 15_000) < 500 and abs(n[None] - 5_000) < 300
    assert mixed.select("place").distinct().count() == mixed.count()
    sizes = sorted(r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    again = mixing.mix(rows.repartition(13, "text"), {"a": 0.75, "*": 0.25}, seed=1)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, mixed.collect()))


def test_occurrences_are_numbered(spark):
    rows = [(1, "a")] * 5 + [(1, "b")] * 2 + [(None, "a")] * 3 + [(None, None)] * 2 + [(2, "x"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("many", "row", "bucket")})
    got = mixing.occurrences(frame, "doc_id", "nth").collect()
    numbers = {i: sorted(r.nth for r in got if r.doc_id == i) for i in (1, 2, 3, None)}
    assert numbers == {1: list(range(7)), 2: [0], 3: [0], None: list(range(5))}
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)


def test_clashing_columns_of_line_dedup(spark):
    names = ("wanted", "gone_row", "gone_key", "row", "row_lines", "gone_lines", "key", "rep", "lines", "h")
    line = "one two three four five six seven eight nine"
    rows = spark.createDataFrame([(1, line), (2, f"{line} ten\nkept line")], "doc_id long, text string").withColumns({c: F.lit(c) for c in names})
    out = {r.doc_id: r for r in line_dedup.clean(rows).collect()}
    assert out[1].text == line and out[2].text == "kept line" and out[2].wanted == "wanted" and out[2].gone_row == "gone_row"


def test_short_lines_are_compared_for_equality(spark):
    texts = ["accept all cookies\n\nx", "Accept all cookies\naccept  all cookies\n\n", "x\naccept all cookie\n \n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in line_dedup.clean(rows).orderBy("doc_id").collect()] == [texts[0], "Accept all cookies\n\n", "accept all cookie\n \n"]


def test_very_long_lines(spark):
    words = [f"w{i}" for i in range(30_000)]
    texts = [" ".join(words), " ".join(words[:15_000] + ["new"] + words[15_000:]), " ".join(words[:-2])]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [len(r.text) for r in line_dedup.clean(rows).orderBy("doc_id").collect()] == [len(texts[0]), 0, len(texts[2])]


def test_removed_lines_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    result = con.execute(contract.oracle_sql()["op5_removed_lines"])
    names = [d[0] for d in result.description]
    df = contract.queries()["op5_removed_lines"](spark, FOLDER)
    assert sorted(repr([r[names.index(c)] for c in df.columns]) for r in result.fetchall()) == sorted(repr(list(r)) for r in df.collect())


def test_other_tokenizer_rules_go_to_the_tokenizer():
    config = json.loads(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    text = "It's A Test of 12 Words, cased"
    assert Encoder(json.dumps(config)).by_word
    config["normalizer"] = {"type": "NFC"}
    other = Encoder(json.dumps(config))
    assert not other.by_word
    ids = Tokenizer.from_str(json.dumps(config)).encode(text, add_special_tokens=False).ids
    assert other.encode(text) == Encoder._bytes(ids)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(languages, "LANGUAGES", 2)
    rows = spark.createDataFrame([("a b c", lang) for lang in "xyz"], "text string, lang string")
    with pytest.raises(ValueError, match="3 languages"):
        languages.learn(rows)


def test_languages_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert languages.identify(empty, languages.learn(empty), ["doc_id"]).collect() == []


HARD = [None, "", "   ", "ok", "the same words in the same order again and again here", "the same words in the same order again and again here"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, label int, row int, score double, copy_no int, wanted string, fp long, place string"


@pytest.mark.parametrize("rows", [[], HARD], ids=["empty", "hard"])
def test_pipeline_stages_take_any_rows(spark, rows):
    given = [(i if i % 4 else None, t, None, None, None, 1, 2, 0.5, 3, "w", 4, "p") for i, t in enumerate(rows)]
    docs = spark.createDataFrame(given + given[-1:], COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert out.count() <= 3 * docs.count(), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.collect()} == {r[0] for r in given}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_pipeline_equals_its_stages(spark):
    """Line dedup, groups and mix of the pipeline on documents of which the outcome is plain."""
    line = "a line of nine words that every document has"
    texts = {1: f"{line}\nfirst own text with several more words in it", 2: f"{line}\nsecond own text that says another thing altogether now", 3: f"{line}\nsecond own text that says another thing altogether now"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    lines = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.fuzzy_lines(spark, docs, FOLDER).collect()}
    own = {i: t.split("\n")[1] for i, t in texts.items()}
    assert lines == {1: (texts[1], len(texts[1])), 2: (own[2], len(own[2])), 3: ("", 0)}
    groups = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect())
    assert groups == [1, 2]
