"""The operators applied to their tables, one query each.

SQL covers the conversation trie and the web archive. It has no counterpart for the others
(learned models, tokenizers, seeded hashes, greedy plans, exact components over 64-bit
hashes); ``tests/llm`` checks them by brute force, round trips and held-out accuracy instead.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import (
    conversation_trie, jaccard_join, language_id, mixing, oracle, packing, quality_rules, scaled_sketch,
    secret_scan, token_alignment, token_files, toxicity, virtual_slots, warc_archive,
)
from ticketlake.llm.text import held_out, materialize
from ticketlake.session import scratch_path

SHARDS = 8
#: Date of the archive's records: the tables carry none.
ARCHIVE_DATE = "2024-01-01T00:00:00Z"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return jaccard_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.train(docs).findings(docs).drop("text_hash")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rules = quality_rules.train(docs, labels)
    return quality_rules.apply_rules(quality_rules.statistics(docs), rules)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = lambda doc_id: held_out(doc_id, 4, 2)
    model = language_id.train(docs, lambda doc_id: ~held(doc_id))
    return language_id.predict(docs, model).withColumn("held_out", held(F.col("doc_id")))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    target = scratch_path(spark, "token-files")
    token_files.write_files(docs, target, public_tokenizers.path("word_bpe_49k.json"), end=2)
    rows = token_files.read_files(spark, target)
    n_tokens = F.expr("length(ids) div 4").cast("long").alias("n_tokens")
    return rows.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = materialize(virtual_slots.record_rows(_table(spark, sf_dir, "documents")), "records")
    path = scratch_path(spark, "slot-maps")
    first = virtual_slots.first_map(SHARDS)
    virtual_slots.store_map(spark, path, first)
    virtual_slots.store_map(spark, path, virtual_slots.rebalanced(first, virtual_slots.slot_sizes(records), SHARDS))
    placed = virtual_slots.place(records, virtual_slots.load_map(spark, path))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held = lambda doc_id: held_out(doc_id, 5, 0)
    model = toxicity.train(docs, labels, lambda doc_id: ~held(doc_id))
    return toxicity.score(docs, model).withColumns({
        "held_out": held(F.col("doc_id")), "predicted": (F.col("score") >= 0.5).cast("int"),
    })


def op8_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.fingerprints(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(_table(spark, sf_dir, "documents"), vocabulary, end=0))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken, "copies")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_nodes(_table(spark, sf_dir, "conversations"))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "archive")
    warc_archive.write_archive(_table(spark, sf_dir, "pages"), target, ARCHIVE_DATE)
    return warc_archive.read_archive(spark, target).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digests(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_jaccard_join, op2_secret_scan, op3_quality_rules, op4_language_id, op5_token_files,
            op6_virtual_slots, op7_toxicity, op8_scaled_sketch, op9_packing, op10_mixing,
            op11_conversation_trie, op12_warc_archive, op13_token_alignment,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_conversation_trie": oracle.CONVERSATION_TRIE, "op12_warc_archive": oracle.WARC_ARCHIVE,
    }
