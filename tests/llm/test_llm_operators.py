"""The operators on small inputs: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import json
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import re
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from wageledger.llm import embedding_groups, graph, languages, line_dedup, mixing, packing, quality_model, quality_rules, secrets, simhash, warc
from wageledger.sinks.scratch import new_path

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_1 int, copy_no int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
TEXTS = [None, "", " \n\t ", "one", "one two", LONG, "a b c d e f g h i j", "a b c d e f g h i j", "a b c d e x g h i j\n\na b c d e f g h i"]


def docs(spark, rows=None):
    rows = rows if rows is not None else [(i, t, None if i % 3 else "en", None if i % 4 else "s", None, 1, 2) for i, t in enumerate(TEXTS)]
    rows = rows and [*rows, rows[-1], (None, "null id a b c d e f g h", "en", "s", 3, None, None)]
    return spark.createDataFrame(rows, DOCS)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force(spark):
    got = {r.doc_id: r.fingerprint for r in contract.queries()["op1_simhash_groups"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        assert got[r.doc_id] == f"{brute_fingerprint(r.text):016x}"


@pytest.mark.parametrize("paired", [32, 1])
@pytest.mark.parametrize("distance", [1, 2])
def test_components_equal_brute_force(spark, monkeypatch, paired, distance):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = np.random.default_rng(7)
    prints = []
    for base in rng.integers(0, 2**63, 12):
        here = int(base)
        for _ in range(8):
            prints.append(here)
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                here ^= 1 << int(b)
    prints += prints[:5] + [0, 0]
    group = list(range(len(prints)))
    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= distance and group[i] != group[j]:
            a, b = sorted((group[i], group[j]))
            group = [a if g == b else g for g in group]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    rows = simhash.near_duplicates(spark.createDataFrame(signed, "doc_id long, fp long"), distance=distance).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(group))


def test_position_sets_cover_every_loss():
    for lost in combinations(range(8), 2):
        assert any(not set(s) & set(lost) for s in simhash.position_sets(2))


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = graph.components(edges).collect()
    assert len(rows) == 201 and {r.component for r in rows} == {0}


def test_deduplicate_keeps_one_row_of_each_group(spark):
    rows = simhash.deduplicate(docs(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows)[0] == (False, 0)  # null, empty and blank texts are one group
    assert Counter(r.doc_id for r in rows)[6] == 1 and not any(r.doc_id == 7 for r in rows)
    assert simhash.deduplicate(docs(spark, [])).count() == 0


def test_rules_and_ablation(spark):
    rows = quality_rules.ledger(docs(spark))
    found = rows.collect()
    assert len(found) == len(TEXTS) + 2
    assert {r.doc_id: r.n_words for r in found}[5] == 60_000
    assert {r.doc_id for r in found if r.n_words == 0} == {0, 1, 2}
    report = {r.rule: r for r in quality_rules.ablation(rows, quality_rules.STANDARD).collect()}
    fails = [r.failures for r in found]
    for rule in quality_rules.RULES:
        bit = 1 << rule.bit
        assert report[rule.name].fails == sum(bool(f & bit) for f in fails)
        assert report[rule.name].fails_alone == sum(f == bit for f in fails)
        assert report[rule.name].passes_without == sum(not f & ~bit for f in fails)
    assert quality_rules.ledger(docs(spark, [])).count() == 0


def test_archives_round_trip(spark):
    body = "x\r\nWARC/1.1\r\n\r\nWARC-Type: response\r\n" + "é" * 1000
    rows = [(1, "http://a/b c", body), (2, None, body), (2, None, body), (3, "", None), (None, "http://n", ""), (4, "http://a", "\r\n")]
    path = new_path(spark, "archives")
    warc.write(warc.captures_of(spark.createDataFrame(rows, "page_id long, url string, html string")), path)
    records = warc.read(spark, path).cache()
    assert records.count() == 18 and records.select("record_id").distinct().count() == 18
    captures = warc.transactions(records).collect()
    assert len(captures) == 6
    by_type = Counter(c.response.record_type for c in captures)
    assert by_type == {"response": 4, "revisit": 2}
    whole = next(c for c in captures if c.response.payload_bytes > 1000)
    assert bytes(whole.response.payload) == body.encode() and whole.metadata[0].fields["page_id"] == "2"
    assert all(c.request and len(c.metadata) == 1 for c in captures)


def test_lines(spark):
    gone = line_dedup.removed_lines(docs(spark)).collect()
    found = {(r.occ.key, r.occ.line_no): (r.kept.key, r.kept.line_no, r.edits) for r in gone}
    assert found == {(7, 0): (6, 0, 0), (8, 0): (6, 0, 1), (8, 2): (6, 0, 1)}
    clean = {r.doc_id: r for r in line_dedup.clean(docs(spark)).collect()}
    assert clean[7].text == "" and clean[8].text == "" and clean[6].text == TEXTS[6] and clean[0].text is None
    assert line_dedup.clean(docs(spark, [])).count() == 0


def brute_spans(text):
    found = []
    kinds = (
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
        ("hex", r"[0-9a-f]+", 0, 0, 24),
    )
    for rank, (kind, pattern, flags, group, least) in enumerate(kinds):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return ",".join(s for _, _, s in sorted(found))


def test_secrets(spark):
    import random

    rng = random.Random(3)
    letters = "".join(chr(c) for c in range(48, 123) if chr(c).isalnum())
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(60)]
    texts = [None, "", "é token='abcdef' AKIA" + "A" * 20, "password=token:abcdefgh secret = short", "api_key: " + "ab12" * 8, "x" * 40, "deadbeef" * 3 + " AKIAAKIA" + "Z9" * 8]
    texts += [f"key {k} end" for k in keys]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(rows).select("doc_id", secrets.listed("base").alias("b"), secrets.listed("spans").alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i].b == brute_spans(t or "")
    hits = sum("random:4:44" in got[i].s for i in range(len(texts) - 60, len(texts)))
    assert hits >= 50 and "random" not in got[5].s
    assert secrets.scan(rows.limit(0)).count() == 0


def test_packing_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [*TEXTS, "İΣς x² <|endoftext|> it's 'll", "À l'ÉTÉ!"]
    rows = spark.createDataFrame([*enumerate(texts), (1, "")], "doc_id long, text string")
    found = packing.pack(packing.pieces(rows, path)).collect()
    want = []
    for i, t in [*enumerate(texts), (1, "")]:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.asarray(ids[at : at + 4096], "<u4").tobytes()
            want.append((i, piece, at, len(part) // 4, zlib.crc32(part)))
    assert sorted(want) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) == -(-sum(r.length for r in found) // 4096)
    assert packing.pack(packing.pieces(rows.limit(0), path)).count() == 0


def test_mixing_counts(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") % 3 == 0, "a").otherwise(F.lit(None)).alias("source"))
    mixed = mixing.mix(rows, {"a": 0.75, "*": 0.25}, seed=1)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["a"] - 15_000) < 500 and abs(n[None] - 5_000) < 300
    clash = mixing.mix(docs(spark), {"*": 1.0}, seed=1)
    assert {"copy_no", "copy_no_", "place"} <= set(clash.columns)
    assert mixing.mix(docs(spark, []), {"*": 1.0}).count() == 0
    assert abs(sum(1 - c for c in mixing.poisson_table(5.0)) - 5.0) < 1e-9  # the mean


def test_languages_held_out(spark):
    rows = contract.queries()["op2_language_mixtures"](spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = rows.join(truth.where("lang is not null"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_languages_edges(spark):
    given = docs(spark)
    found = {r.doc_id: r for r in languages.identify(given, languages.learn(given), ["doc_id"]).collect()}
    assert found[0].lang_pred == found[1].lang_pred == found[2].lang_pred == "und" and found[5].lang_pred == "en"
    assert languages.learn(given.limit(0)).names == ()
    two = languages.Model(("a", "b"), languages.learn(given).likelihood.repeat(2, axis=1))
    assert two.mixture("tie of both") == {"a": 1.0}


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.1"
    given, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    test = F.crc32(F.col("doc_id").cast("string")) % 4 == 1
    model = quality_model.train(given, labels.where(~test))
    rows = quality_model.score(given.join(labels.where(test), "doc_id"), model).select("quality", (F.col("score") >= 0.5).alias("kept")).collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.15


def test_quality_edges(spark):
    given = docs(spark).withColumn("score", F.lit(7))
    labels = spark.createDataFrame([(5, 1), (5, 1), (6, 0), (None, 0), (8, None)], "doc_id long, quality int")
    rows = quality_model.score(given, quality_model.train(given, labels)).collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.score == 7 and 0 <= r.score_ <= 1 for r in rows)
    assert quality_model.train(given, labels.where("quality = 1")) is None


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    near = [(b + rng.normal(scale=0.01, size=16)).tolist() for b in base[:10] for _ in range(20)]
    rows = [*base.tolist(), *near, base[0].tolist(), None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None]]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_groups.near_duplicates(frame).collect()}
    assert len(got) == len(rows)
    good = np.array(rows[: len(rows) - 5])
    good /= np.linalg.norm(good, axis=1, keepdims=True)
    links = good @ good.T >= 0.95
    for i in range(len(good)):
        assert got[i].n_links == links[i].sum() - 1
        assert got[i].component_id == np.flatnonzero(links[i])[0]
    assert all(got[i].n_links == 0 and got[i].kept for i in range(len(good), len(rows)))
    assert embedding_groups.near_duplicates(frame.limit(0)).count() == 0


def test_pipeline_stages(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, given, FOLDER)
        assert out.columns == given.columns, name
    assert contract.queries()["pipeline"](spark, FOLDER).count() > 0
    assert json.dumps(sorted(contract.queries()))
