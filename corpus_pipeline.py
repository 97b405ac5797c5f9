"""A training corpus from raw documents: stages that each apply one operator to all that the one before it kept.

All stages but the last return the columns of documents; every stage is written to the shared folder and read again by
the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import jaccard, mixing, packing, pii, quality
from wattloom.llm.common import table
from wattloom.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one it is named after; of rows with one id, one. Documents
    without an id or without words have no copies and stay."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes them; n_chars follows the text."""
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in the training sequences."""
    return packing.pack(docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

# Components, spans and tokens are beyond SQL. The tests compare near_duplicates with a brute-force version and hold the
# operators of the other stages against theirs one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
