"""From documents to packed training sequences, in five stages.

Quality classifier, toxicity, near duplicates, mixing to target weights,
packing. Each stage gets what the one before it has kept, written as Parquet and
read again; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import minhash, mixing, packing, quality, toxicity
from tidemart.llm.common import small_batches, stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, packing.default_vocabulary())


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packed),
]

# Fitted classifiers and a tokenizer are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
