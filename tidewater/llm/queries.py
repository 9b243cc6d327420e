"""One query for each operator, over whole tables, and the DuckDB statements for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, collocations, jaccard, licenses, minhash, packing, pages, quality, search, substrings, unigram
from .scratch import on_workers

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return on_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = search.integer_vectors(table(spark, sf_dir, "embeddings"))
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.linked(chat.derived(table(spark, sf_dir, "conversations")), chat.TOOLS)


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(table(spark, sf_dir, "documents"))


@query
def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.grouped(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
