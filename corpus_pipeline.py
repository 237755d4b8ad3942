"""Documents to packed training sequences, stage by stage.

Each stage is a function of (session, documents, folder of the tables); its result is
written as Parquet and read again as the documents of the next one. Stages work on every
row and whole text that the stage before kept, and all but the last return the columns of
documents. Null texts, empty tables, repeated rows and further columns are handled as
the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import stored, table
from tideline.llm.exact_dedup import exact_dedup
from tideline.llm.near_dedup import near_dedup
from tideline.llm.packing import pack_documents
from tideline.llm.quality_classifier import keep_good
from tideline.llm.secrets import redact

SEQUENCE_TOKENS, END_ID = 4096, 1


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of this folder."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest identifier stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates the text with the smallest identifier stays."""
    return near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are replaced by a mark."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their sequence and offset."""
    return pack_documents(
        docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, SEQUENCE_TOKENS
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

#: SQL can't express the classifier, the alignment, the forest or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; the pieces of the packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
