"""Corpus pipeline: documents -> quality -> near-dedup -> decontamination -> secrets -> token ids.

Each stage works on all that its predecessor kept; its result is written as
Parquet into the shared folder and reread as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontam, near_dup, pieces, quality, secrets
from orderlens.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality scorer accepts."""
    return quality.keep_good(docs, quality.fit(docs))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (similarity from 0.8): the smallest doc_id."""
    return near_dup.keep_first(docs, link=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every credential replaced by a mark; n_chars follows the text."""
    return secrets.redact(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids): the token ids of every document that is left."""
    ids = pieces.encode(docs)
    return ids.select("doc_id", F.greatest(F.size("ids"), F.lit(0)).alias("n_ids"), "ids")


STAGES = [("quality classifier", quality_stage), ("MinHash near-dedup", near_dup_stage),
          ("benchmark decontamination", decontamination_stage), ("secret scans", secret_stage),
          ("SentencePiece encoding", encode_stage)]

#: no SQL form: the stages hold trained models, hashed similarity search and a tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
