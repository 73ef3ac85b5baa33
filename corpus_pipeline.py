"""A training corpus from ``documents``: stages over what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and
read again as the next stage's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import jaccard_join, mixing, packing, secret_scan, toxicity
from ticketlake.llm.text import held_out, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; null and empty texts have nothing toxic and stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, lambda doc_id: ~held_out(doc_id, 5, 0))
    return toxicity.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest doc_id.

    Documents without words are no copies of each other and stay. Rows of one doc_id stay
    together.
    """
    rows = jaccard_join.jaccard_components(docs)
    kept = rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with accepted secrets replaced by a mask.

    Null and empty texts have none; repeated rows stay, each masked alike.
    """
    return secret_scan.redact(docs, secret_scan.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Rows without words take part with size 0, a null source is a source of its own; rows
    alike in id, source and text share their copies and keep their other columns.
    """
    return mixing.take(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their places in windows of 1024.

    A null or empty text is one piece with the end id; repeated rows are packed each.
    """
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(packing.pieces(docs, vocabulary, end=0))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Models, seeded hashes and greedy plans have no SQL; tests/llm/test_llm.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
