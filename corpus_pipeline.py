"""A training corpus from raw documents: language, quality, near copies, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next.
All but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm.jaccard_join import keep_one
from recordloom.llm.language import keep_identified
from recordloom.llm.mixing import keep_mixed
from recordloom.llm.packing import packed_documents
from recordloom.llm.quality import keep_good
from recordloom.llm.queries import ready, table
from recordloom.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return keep_identified(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return keep_mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packed_documents(docs)


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("mixing", mixing),
    ("packing", packing),
]

# Learned models, robust estimates and hashed permutations have no SQL form. The operators of the stages are tested one by
# one; the chain as a whole only for its columns, counts and sequence lengths.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        docs = result if at == len(STAGES) - 1 else stored(result)
    return docs
