"""Queries of the training-data operators; each derives its digest from the operator's result."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.llm import (decontam, embed_dedup, filter_audit, html_text, near_dup, oracles, pieces, quality,
                           secrets, suffix_dedup, token_files, toxicity, url_filter, variants)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    """Base and grammar-scored secret spans of every document."""
    return secrets.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op2_quality_classifier(spark, sf_dir):
    """Weak-label posterior and linear score of every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


def op3_decontamination(spark, sf_dir):
    """Words of every document inside benchmark windows."""
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("tkey")


def op4_toxicity(spark, sf_dir):
    """Noisy-or toxicity score of every document, trained without the held-out quarter."""
    docs = _table(spark, sf_dir, "documents")
    got = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return got.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                      "worst_start", "worst_end")


def op5_embedding_near_dup(spark, sf_dir):
    """Cosine links and components of all vectors."""
    return embed_dedup.report(_table(spark, sf_dir, "embeddings"))


def op6_sentencepiece(spark, sf_dir):
    """Token ids of every document (count, digest) and whether decoding gives the text back."""
    return pieces.digest(_table(spark, sf_dir, "documents"))


def op7_minhash_near_dup(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_dup.report(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark, sf_dir):
    """Rule and verdict of every page url."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op9_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat an earlier 100-byte string."""
    return suffix_dedup.report(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    """Forms and roots of all words one edit apart."""
    return variants.report(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark, sf_dir):
    """Totals of five filters in all 120 orders, per language."""
    return filter_audit.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_token_files(spark, sf_dir):
    """Places and digests of all documents, read back from their token-id files."""
    return token_files.report(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    """The corpus pipeline over all documents: the token ids of what every stage keeps."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quality_classifier, op3_decontamination, op4_toxicity, op5_embedding_near_dup,
    op6_sentencepiece, op7_minhash_near_dup, op8_url_filter, op9_html_extraction, op10_suffix_dedup,
    op11_spelling_variants, op12_filter_audit, op13_token_files, pipeline)}

ORACLE: dict[str, str] = {
    "op3_decontamination": oracles.DECONTAMINATION, "op5_embedding_near_dup": oracles.EMBEDDINGS,
    "op7_minhash_near_dup": oracles.NEAR_DUP, "op11_spelling_variants": oracles.VARIANTS,
    "op12_filter_audit": filter_audit.ORACLE}
