"""A corpus from raw documents to token ids, in five stages of the package's own operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import bpe, crf, cuckoo, mixing, simhash
from parcelflow.llm.common import ship, table, write_and_read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model does not reject; it learns from the labelled rows that are not held out."""
    ship(spark)
    model = crf.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return crf.keep_good(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest id."""
    ship(spark)
    return cuckoo.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints, the one with the smallest id."""
    ship(spark)
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as their source's share asks for."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian 32-bit), with digests of the ids and of what they decode to."""
    ship(spark)
    return bpe.encoded(docs, bpe.default_ranks(), with_ids=True)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: The line model, fingerprints and tokens are beyond SQL; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
