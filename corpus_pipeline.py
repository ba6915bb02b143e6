"""A training-corpus pipeline: five stages of the llm operators, each written as Parquet and read again as the next one's input.

All stages but the last return the columns of `documents`. ORACLE_SQL is None: hashing, tokenizing and trained models
are beyond SQL; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import cut_lineage, quoted, read_table
from tallyweave.llm.langid import fit_language_model, identify_language
from tallyweave.llm.mixing import mixed_texts
from tallyweave.llm.packing import pack_documents
from tallyweave.llm.queries import tokenizer_path
from tallyweave.llm.secrets_scan import redact
from tallyweave.llm.simhash import keep_representatives

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that the calibrated model rejects go. A null lang is filled in."""
    whole = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("document"), "text")
    found = identify_language(whole, fit_language_model(docs)).where(~F.col("lang_rejected"))
    filled = {"lang": F.coalesce("document.lang", "lang_pred")}
    return found.select(*[filled.get(c, F.col("document").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: copies, and texts whose sets of five-word shingles are similar to 0.8 or more."""
    return keep_representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: for each slot of its output shards, a row for each document in the block, in the mix's order."""
    return mixed_texts(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens; row_key tells the mix's rows of one document apart."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
