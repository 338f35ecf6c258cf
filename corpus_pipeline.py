"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` applies them in order to the documents table,
writing each stage's rows as Parquet under the shared scratch folder and
reading them back as the next stage's documents. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystar.llm import near_dedup, packing, quality_classifier, secret_scan, source_mixing
from tallystar.llm.common import stored, table
from tallystar.llm.queries import tokenizer
from tallystar.llm.shipping import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_dedup.keep_one(docs).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets masked."""
    return secret_scan.redact(docs.select(COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's target rate, in global random order."""
    return source_mixing.mix(docs).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their token ids and their places in the packed
    sequences (``packing.sequences`` puts them together)."""
    return packing.pack(docs, tokenizer(), with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixing),
    ("best-fit packing", best_fit_packing),
]

# a learned classifier, MinHash and BPE have no SQL form; tests check the stages one by one
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
