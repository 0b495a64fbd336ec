"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm.ann import neighbours
from recordloom.llm.divergence import divergence
from recordloom.llm.jaccard_join import near_copies
from recordloom.llm.language import identified
from recordloom.llm.licenses import scanned
from recordloom.llm.mixing import mixture
from recordloom.llm.packing import packed_documents
from recordloom.llm.quality import quality
from recordloom.llm.secrets import secrets
from recordloom.llm.shards import SHARDS, placed
from recordloom.llm.token_files import counted_documents
from recordloom.llm.url_filter import judge_urls
from recordloom.llm.variants import variants
from recordloom.session import pin

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Settings of these queries: the library's, small Arrow batches, and workers of a local session that find the package."""
    pin(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, paths]))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str):
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, folder: function(ready(spark), folder)
        return function

    return register


@query("op3_ngram_jaccard_join")
def ngram_jaccard_join(spark, folder):
    return near_copies(table(spark, folder, "documents"))


@query("op7_language_id")
def language_id(spark, folder):
    return identified(table(spark, folder, "documents"))


@query("op10_best_fit_packing")
def best_fit_packing(spark, folder):
    return packed_documents(table(spark, folder, "documents"))


@query("op4_quality_rules")
def quality_rules(spark, folder):
    return quality(table(spark, folder, "documents"))


# The rules that op5 judges by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query("op5_url_filters")
def url_filters(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages"), rules)


@query("op8_license_scans")
def license_scans(spark, folder):
    return scanned(table(spark, folder, "documents"))


@query("op9_sharding")
def sharding(spark, folder):
    names = [f"shard-{n:03d}" for n in range(SHARDS)]
    return placed(table(spark, folder, "documents").select("doc_id", "source"), names)


@query("op1_nearest_neighbours")
def nearest_neighbours(spark, folder):
    return neighbours(table(spark, folder, "embeddings"))


@query("op2_token_counts")
def token_counts(spark, folder):
    return counted_documents(table(spark, folder, "documents"))


@query("op6_mixing_weights")
def mixing_weights(spark, folder):
    return mixture(table(spark, folder, "documents"))


@query("op11_secret_scans")
def secret_scans(spark, folder):
    return secrets(table(spark, folder, "documents"))


@query("op12_source_divergence")
def source_divergence(spark, folder):
    return divergence(table(spark, folder, "documents"))


@query("op13_spelling_variants")
def spelling_variants(spark, folder):
    return variants(table(spark, folder, "documents"))
