"""The corpus pipeline: documents through quality rules to encoded token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of documents; n_chars follows the text. Nulls,
empty texts, repeated rows, empty tables and extra columns have the results that
the operators' docstrings define; extra columns pass through.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlake.llm.decontamination import remove_contamination
from playerlake.llm.piece_codec import encode
from playerlake.llm.pii import redact
from playerlake.llm.quality_rules import apply_rules
from playerlake.llm.simhash import one_per_group
from playerlake.llm.storage import remove_scratch, saved, scratch_folders
from playerlake.session import configure

PIECE_MODEL = "piece_bpe_32k.model"

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(build: Stage) -> Stage:
    """Settings applied, and extra columns under names that no operator uses meanwhile."""

    @functools.wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark)
        aside = {c: f"__extra_column_{k}" for k, c in enumerate(docs.columns) if c not in DOCUMENT}
        out = build(spark, docs.withColumnsRenamed(aside), sf_dir)
        return out.withColumnsRenamed({name: c for c, name in aside.items() if name in out.columns})

    return run


def _as_documents(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars of the text as it is now."""
    now = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return found.withColumns(now).select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = apply_rules(docs)
    return judged.where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return one_per_group(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows."""
    return _as_documents(remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return _as_documents(redact(docs), docs)


@_stage
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and piece offsets of every document, and whether they decode to its text."""
    coded = encode(docs, public_tokenizers.path(PIECE_MODEL), decoded=True)
    shown = F.coalesce(F.replace("text", F.lit("▁"), F.lit(" ")), F.lit(""))  # the visible space decodes to a space
    whole = (F.col("decoded") == shown).alias("round_trip")
    rest = [F.col(f"`{c}`") for c in docs.columns if c in ("doc_id", "lang", "source")]
    return coded.select(*rest, F.size("ids").cast("long").alias("n_tokens"), "ids", "piece_ends", whole)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece),
]

#: SQL has no SentencePiece encoding; the tests hold run() against a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared scratch folder and read again.

    What a stage has left in the scratch folder goes once the next one is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done: list[str] = []
    for name, stage in STAGES[:-1]:
        with scratch_folders() as folders:
            docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove_scratch(spark, [*done, *folders[:-1]])
        done = folders[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
