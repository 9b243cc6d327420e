"""From raw documents to packed training sequences.

Each stage works on all documents its predecessor kept. Null texts fail the quality
rules; an empty table passes through every stage as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import jaccard, packing, quality, substrings
from tidewater.llm.scratch import on_workers, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality.kept(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return jaccard.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; a text that loses words is
    its kept words, and ``n_chars`` follows it."""
    rows = substrings.deduplicated(docs, layout=True)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents with the training sequence each is placed in."""
    rows = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Several stages can't be said in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again."""
    docs = on_workers(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
