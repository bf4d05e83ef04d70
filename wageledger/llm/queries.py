"""The registered queries of this subpackage: thin readers around the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.llm import divergence, embedding_groups, exact_dedup, languages, line_dedup, manifest, mixing, packing, quality_model, quality_rules, secrets, simhash, warc
from wageledger.sinks.scratch import new_path, stored

TOKENIZER = "word_bpe_49k.json"
# Target shares of characters: the crawl's largest source is cut back, two smaller ones are raised.
WEIGHTS = {"src0": 0.25, "src1": 0.10, "src2": 0.10, mixing.REST: 0.55}
MIX_SEED = 2024

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    groups = simhash.near_duplicates(simhash.fingerprints(docs, ["doc_id"], shingle=3), distance=2)
    return groups.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op2_language_mixtures(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = languages.learn(docs.where(~held_out))
    found = languages.identify(docs, model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.to_json("mixture").alias("mixture"))


def op3_warc_captures(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write(warc.captures_of(table(spark, folder, "pages")), path)
    captures = warc.transactions(stored(warc.read(spark, path, payloads=False), "records"))
    response, about = F.col("response"), F.col("metadata")[0]["fields"]
    captures = captures.select(
        "capture",
        about["page_id"].cast("long").alias("page_id"),
        response["record_type"].alias("record_type"),
        response["refers_to"].alias("refers_to_record"),
        response["fields"]["content-length"].cast("long").alias("payload_bytes"),
        F.when(response["record_type"] == "revisit", F.substring_index(response["declared_digest"], ":", -1))
        .otherwise(response["payload_digest"])
        .alias("payload_digest"),
        response["target_uri"].alias("target_uri"),
    )
    captures = stored(captures, "captures")
    first = captures.select(F.col("capture").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    return captures.join(first, "refers_to_record", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"
    )


def op4_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, folder, "documents"))
    base = quality_rules.passes(quality_rules.BASE)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~base).alias("base_failed"),
        (base & quality_rules.passes(quality_rules.STANDARD)).alias("kept"),
        "failures",
    )


def op5_removed_lines(spark: SparkSession, folder: str) -> DataFrame:
    gone = line_dedup.removed_lines(table(spark, folder, "documents"))
    return gone.select(
        F.col("occ.key").alias("doc_id"),
        F.col("occ.line_no").alias("line_no"),
        F.col("kept.key").alias("kept_doc_id"),
        F.col("kept.line_no").alias("kept_line_no"),
        "edits",
    )


def op6_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(secrets.count("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.listed("base"), 256).alias("base_sha256"),
        secrets.listed("spans").alias("spans"),
    )


def op7_packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    parts = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), limit=4096)
    return packing.pack(parts, limit=4096)


def op8_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model.train(docs, table(spark, folder, "labels"))
    scored = quality_model.score(docs.select("doc_id", "text", "source", "lang"), model)
    return scored.select("doc_id", "score", (F.col("score") >= quality_model.THRESHOLD).alias("kept"))


def op9_embedding_groups(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_groups.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), WEIGHTS, seed=MIX_SEED)


def op11_exact_groups(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(table(spark, folder, "documents")).drop("carried")


# Fixed values of the contract: the columns of a leaf, and the one that tampering changes.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*LEAF)
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in LEAF]
    leaves = docs.select("source", "doc_id", manifest.digest(*map(F.col, LEAF)).alias("leaf"), F.when(changed, manifest.digest(*tampered)).alias("tampered"))
    tree = manifest.build(leaves, "source", "doc_id", "leaf", F.struct("doc_id", "tampered"))
    root = F.lit(tree.root).cast("string")
    rows = tree.proofs().withColumn("folded_root", manifest.fold(F.coalesce("item.tampered", "digest"), "path"))
    return rows.select(
        "item.doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        F.sha2(manifest.siblings("path"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_simhash_groups": op1_simhash_groups,
    "op2_language_mixtures": op2_language_mixtures,
    "op3_warc_captures": op3_warc_captures,
    "op4_rule_ledger": op4_rule_ledger,
    "op5_removed_lines": op5_removed_lines,
    "op6_secret_spans": op6_secret_spans,
    "op7_packed_sequences": op7_packed_sequences,
    "op8_quality_scores": op8_quality_scores,
    "op9_embedding_groups": op9_embedding_groups,
    "op10_source_mix": op10_source_mix,
    "op11_exact_groups": op11_exact_groups,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence": op13_source_divergence,
}
