"""A corpus pipeline: language ID, exact dedup, near-dedup, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and all that its predecessor kept; between stages the documents are written
as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixmill.llm import op5_packing, op6_language, op7_exact, op8_secrets, op9_minhash
from helixmill.llm.common import documents, materialize
from helixmill.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network knows; those whose text is null or has no letter go.

    Whole texts are read, however long; repeated rows and rows without doc_id are judged like others; other columns
    pass through, whatever their names; an empty table stays empty, and without labels no text with a letter goes.
    """
    return op6_language.keep(docs, op6_language.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside: the longest, then the smallest doc_id (null last).

    A row is known by its id and text, so rows that share an id, or have none, lose no text of their own; null and
    empty texts are one text; an empty table stays empty.
    """
    return op7_exact.keep(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the smallest doc_id (null last).

    Rows without doc_id, or that share one, are compared as rows of their own; null and empty texts are alone in
    their class; texts under five words are near copies of equal ones alone; an empty table stays empty.
    """
    return op9_minhash.keep(docs, plain=True, share=None)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars set to the new length.

    Null texts stay null, empty ones empty; rows that repeat, or have no doc_id, stay; an empty table stays empty.
    """
    return op8_secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets.

    Null and empty texts are one piece, the end id; longer texts than a sequence are cut; rows that repeat are packed
    as documents of their own, a null doc_id stays null; an empty table gives no rows.
    """
    return op5_packing.best_fit(docs, tokenizer_path(), end_id=0, capacity=2048)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("secret_redaction", secrets), ("packing", packing)]

#: No SQL for the network, the samples and the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of sf_dir to packed pieces."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
