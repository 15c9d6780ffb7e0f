"""One query per operator, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlake.llm import oracles, pii
from playerlake.llm.decontamination import find_contamination
from playerlake.llm.divergence_audit import divergence_audit
from playerlake.llm.filter_audit import audit_filters
from playerlake.llm.lm_scoring import score_documents
from playerlake.llm.pii import find_pii, span_list
from playerlake.llm.piece_codec import encode
from playerlake.llm.quality_classifier import score_quality
from playerlake.llm.quality_rules import BASE, apply_rules
from playerlake.llm.repeated_substrings import repeated_spans, text_keys
from playerlake.llm.sequence_packing import pack_documents
from playerlake.llm.simhash import near_duplicates
from playerlake.llm.token_counts import count_tokens
from playerlake.llm.warc import read_archives, write_archives
from playerlake.session import configure, scratch_dir


PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in each document by FM-indexes of training shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of each document and the verdict of its group's thresholds."""
    judged = apply_rules(table(spark, sf_dir, "documents"), columns=["doc_id", "lang", "source"])
    return judged.select("doc_id", *BASE, "base_failed", "kept")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear log-probabilities of each document."""
    scored = score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated probability that each document is of good quality."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of each document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document under the 32k piece model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(PIECE_MODEL), keep_text=False)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document under the 32k piece model, and the text they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, public_tokenizers.path(PIECE_MODEL), decoded=True, keep_text=False)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.get("piece_ends", F.size("piece_ends") - 1), F.lit(0)).cast("long").alias("n_bytes_covered"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives (when the query is built) and read back."""
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = read_archives(spark, path, keep_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in each document."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"] < len(pii.BASE))
    counts = [F.size(F.expr(f"filter(pii, s -> s.kind = {k})")).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.BASE)]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("pii")).alias("spans"))


def op10_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that a string of 400 bytes found elsewhere covers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    cut = repeated_spans(docs).select("k1", "k2", "n_removed", (F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("cut_sha256"))
    rows = docs.select("doc_id", *text_keys(text), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole_sha256"))
    return rows.join(cut, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
    )


def op11_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 2048 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, public_tokenizers.path(WORD_MODEL), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each source in every order."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and the terms that set each apart."""
    return divergence_audit(table(spark, sf_dir, "documents"))


def _configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {q.__name__: _configured(q) for q in (op1_decontamination, op2_quality_rules, op3_lm_scoring, op4_quality_classifier, op5_simhash_neardup, op6_token_counts, op7_sentencepiece, op8_warc, op9_pii, op10_repeated_substrings, op11_sequence_packing, op12_filter_audit, op13_source_divergence)}
ORACLES = oracles.SQL
