"""The registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.llm import conversations, decontaminate, host_trust, licenses, line_dedup, near_dedup, periodic, pieces, private_data, quality, token_counts, token_store, topk


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def pieces_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3's Viterbi by summed scores: the same pieces read as a unigram model, as the library would."""
    return pieces.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), kind=pieces.UNIGRAM)


def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.private_spans(read(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(read(spark, sf_dir, "documents"))


def line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7's maximal copied runs."""
    return line_dedup.copied_runs(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(read(spark, sf_dir, "conversations"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_trust.judge(read(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest_runs(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_licenses": op2_licenses,
    "op3_pieces": op3_pieces,
    "op4_private_data": op4_private_data,
    "op5_decontaminate": op5_decontaminate,
    "op6_near_dedup": op6_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_token_counts": op10_token_counts,
    "op11_conversations": op11_conversations,
    "op12_url_filter": op12_url_filter,
    "op13_periodic_runs": op13_periodic_runs,
    "pieces_unigram": pieces_unigram,
    "line_runs": line_runs,
    "pipeline": pipeline,
}
