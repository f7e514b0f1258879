"""The corpus pipeline: five stages, each over everything that the one before kept.

quality          documents that the classifier rejects go (score below quality.THRESHOLD); it learns from the
                 labels of the documents given
line_dedup       later copies of repeated line runs are cut out of the texts; a document that loses all of
                 its lines goes; n_chars follows the text
near_dedup       one document of each group of near duplicates stays, the one with the smallest doc_id; documents are
                 linked by their texts as they come and by those they had before lines were cut, as cut copies
                 of one text may have little in common left; whose text was whose is told by doc_ids, and for rows that
                 share one or have none by digests that line_dedup leaves in the shared folder
decontaminate    documents that the contract's rule calls contaminated by benchmark items go
sentencepiece    the columns of documents, with n_ids, ids and round_trip

Null or empty texts are documents like others: scored as empty, with nothing to cut, linked with nothing, not
contaminated, without ids. Empty tables give empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.llm import decontaminate, line_dedup, near_dedup, pieces, quality
from seatloom.llm.common import cut, scratch_path, shared_root, step, text_digest


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


#: By application and tables: where line_dedup has left which text was whose, for rows that a doc_id doesn't tell.
_pairs: dict[tuple[str, str], str] = {}


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    before = f"_source_{uuid.uuid4().hex[:8]}"
    named = docs.withColumns({f"{before}_id": near_dedup.row_number_of(), f"{before}_s": text_digest()})
    rows = line_dedup.dedup_lines(named).where("not emptied")
    shared = docs.groupBy(F.col("doc_id").cast("long").alias("shared")).agg(F.count("*").alias("n")).where("n > 1 or shared is null").select("shared")
    shared, known = cut(shared), (spark.sparkContext.applicationId, sf_dir)
    _pairs.pop(known, None)
    if not shared.isEmpty():
        told = rows.where("n_deleted > 0").join(shared, F.col("doc_id").cast("long").eqNullSafe(F.col("shared")), "left_semi")
        told = told.select(near_dedup.row_number_of().alias("a_id"), text_digest().alias("t"), F.col(f"{before}_id").alias("b_id"), F.col(f"{before}_s").alias("s"))
        path = scratch_path(spark, "pipeline-pairs")
        told.write.parquet(path)
        _pairs[known] = path
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = _pairs.get((spark.sparkContext.applicationId, sf_dir))
    return near_dedup.keep_one(docs, also=spark.read.parquet(f"{sf_dir}/documents.parquet"), pairs=spark.read.parquet(path) if path else None)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = tuple(c for c in docs.columns if c not in ("n_ids", "ids", "round_trip"))
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=kept)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The classifier's scores and the model file's pieces are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents of sf_dir, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        with step(spark):  # what a stage has put into the shared folder goes when its result is written
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
