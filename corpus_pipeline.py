"""The corpus pipeline: five stages, each one training-data operator on all its predecessor kept.

Language ID drops documents without a recognised language, the quality classifier
drops what it predicts to be of low quality, SimHash near-dedup keeps one document
of each group, secret scans blank out the secrets they find, best-fit packing turns
what is left into sequences.  Every stage but the last returns the columns of
``documents`` and never their scores.  Nulls, empty tables and repeated rows are
handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, quality, secrets
from tidemark.llm.common import fold, stored, table
from tidemark.llm.packing import pack_documents
from tidemark.llm.simhash import one_of_each

#: A document stays if its language is known and this likely.
MIN_LANGUAGE = 0.4
#: A document stays if label 1 is at least this likely.
MIN_QUALITY = 0.3


def _free(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is unknown (null texts, texts without a letter) or unsure."""
    model = langid.fit(docs, fold("doc_id", 4) != 2)
    lang, score = _free(docs, "lang_pred"), _free(docs, "lang_score")
    found = langid.identify(docs, model, lang_col=lang, score_col=score)
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE)).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are unlikely to have quality 1."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    score = _free(docs, "quality_score")
    return quality.score(docs, model, score_col=score).where(F.col(score) >= MIN_QUALITY).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group: the one with the smallest id."""
    return one_of_each(docs, max_bits=2, shingle=3, seed=42)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars follows."""
    spans = _free(docs, "spans")
    clean = secrets.redact(secrets.scan(docs, spans_col=spans), spans_col=spans)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("quality", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

#: Trained models, tokenizers and components are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
