"""A training corpus from raw documents: reject toxic ones, keep one of each near-copy, redact secrets, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last return
the columns of ``documents``. ``run`` writes each stage's rows to the shared folder and rereads them. Stages that pass texts to
Python do so in small batches, because what a worker once took it keeps for the stages after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import packing, secrets, simhash, toxicity
from tidelog.llm.queries import TOXICITY_CATEGORIES, tokenizer_file, toxicity_labels
from tidelog.llm.shared import Workspace, small_batches, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    small_batches(spark)
    return toxicity.acceptable(docs.select(*COLUMNS), toxicity_labels(spark, sf_dir), TOXICITY_CATEGORIES)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, 0.8 of the fingerprints' bits."""
    small_batches(spark)
    return simhash.one_of_each(docs.select(*COLUMNS), simhash.COPIES)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redact(docs.select(*COLUMNS))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=1024, end=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_windows),
]

#: No SQL has the classifier chain or the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
