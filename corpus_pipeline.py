"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before it kept. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelspark.llm import jaccard, mixing, packing, pii, quality
from reelspark.llm.common import table, written

#: Learned rules, dependent rounding and a byte-pair vocabulary have no SQL form.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Stages return plans that run later, so their batches of texts for Python are
    bounded for the rest of the session: by bytes, and by rows where bytes don't count."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list rejects go."""
    _small_batches(spark)
    return quality.reject(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to its kind in brackets."""
    return pii.redact(docs, pii.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go as the mix of their source asks."""
    return mixing.repeat_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence."""
    return packing.pack(packing.pieces_of(docs, packing.rank_file()))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
