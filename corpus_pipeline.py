"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; what it returns is written and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.

Nulls, empty and very long texts, ties, repeated rows and empty tables are handled as the operators'
docstrings say: a document without words goes in the first stage, of equal texts the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import exact_dedup, mixing, packing, quality, simhash
from skyledger.sources.shared import read_table, scratch, shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within their language's fertility bands."""
    return quality.keep_good(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each set of equal texts."""
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources ask for."""
    return mixing.emit(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences, with their token ids."""
    pieces = packing.pack(docs.select("doc_id", "text"))
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: The first, third and fifth stage have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"pipeline-{name}")
        with scratch(spark):  # a stage's work tables go once its result is written
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
