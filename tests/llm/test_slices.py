"""Tokens of one partition in several slices: the same components as in one."""

import pytest
from pyspark.sql import functions as F

from recordloom.llm import jaccard_join
from recordloom.llm.jaccard_join import candidate_classes, near_copies


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_slices_give_the_same_components(spark, documents, monkeypatch):
    whole = sorted(map(tuple, near_copies(documents, buckets=3).collect()))
    monkeypatch.setattr(jaccard_join, "SLICE_TOKENS", 700)
    assert sorted(map(tuple, near_copies(documents, buckets=3).collect())) == whole
    assert len({c for d, _, c in whole if c != d}) > 1


def test_candidates_of_slices(spark, documents):
    columns = ["set_id", "n", "tokens", "first", "order1", "order2"]
    one, many = (candidate_classes(documents, buckets=2, shingles=n).select(columns) for n in (0, 40 << 20))
    assert one.count() > 0 and one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_no_candidates(spark, documents):
    for some in (documents.limit(0), documents.limit(1), documents.withColumn("text", F.lit(None).cast("string"))):
        assert candidate_classes(some, buckets=2, shingles=9 << 20).count() == 0
