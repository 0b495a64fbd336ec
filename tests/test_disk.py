"""What a query of several jobs holds on disk at once."""

import time

import pytest
from pyspark.sql import functions as F
from rows import RUN, delivered

from recordloom.checks.queries import QUERIES
from recordloom.operators import history as h
from recordloom.session import DROP_SHUFFLES, side_by_side, stored, written_once
from recordloom.specs import ENCOUNTER

VERSIONS = [
    ("1", "1", "2020-01-01", "a"),
    ("1", "2", "2020-01-02", "b"),
    ("2", "1", "2020-01-01", "a"),
    ("2", "1", "2020-01-01", "c", "2023-01-01 00:00:00"),
]


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = stored(spark.range(1000).repartition(5, "id"))
    until = time.time() + 20  # they are removed in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert table.count() == 1000


def test_jobs_outside_keep_what_the_session_has(spark):
    outside = spark.conf.get(DROP_SHUFFLES)
    steps = [lambda n=n: stored(spark.range(n).repartition(3, "id")).count() for n in range(1, 5)]
    assert side_by_side(spark, steps) == [1, 2, 3, 4]
    with pytest.raises(ValueError), written_once(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        raise ValueError
    assert spark.conf.get(DROP_SHUFFLES) == outside


@pytest.fixture
def whole_plans(spark):
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    yield lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set(key, before)


def test_hashes_are_made_after_the_shuffle(spark, whole_plans):
    rows = delivered(spark, VERSIONS)
    plain, slim = h.rebuild(rows, RUN[0]), h.rebuild(rows, RUN[0], hashed=ENCOUNTER.hash_columns)
    assert plain.columns == slim.columns and sorted(map(str, plain.collect())) == sorted(map(str, slim.collect()))
    after, before = whole_plans(slim).split("RepartitionByExpression")
    assert "md5(" in after and "md5(" not in before


def test_stored_rows_keep_their_hash(spark):
    first, later = delivered(spark, VERSIONS), delivered(spark, [("1", "3", "2020-01-03", "d"), ("3", "1", "2020-01-01", "a")])
    current = stored(h.current_rows(h.rebuild(first, RUN[0])).withColumn("record_hash", F.lit("of other columns")))
    plain, _ = h.delta(current, later, first, RUN[1])
    slim, _ = h.delta(current, later, first, RUN[1], hashed=ENCOUNTER.hash_columns)
    rows = sorted(map(str, slim.collect()))
    assert rows == sorted(map(str, plain.collect())) and sum("of other columns" in r for r in rows) == 1


def test_the_summary_shuffles_one_history_at_a_time(spark, folder, whole_plans):
    """What is left in the plan of the result is the history of the patients."""
    assert whole_plans(QUERIES["patient_summary"](spark, folder)).count("RepartitionByExpression") == 1


def test_the_counted_views_read_stored_histories(spark, folder, whole_plans):
    assert whole_plans(QUERIES["gold_view_counts"](spark, folder)).count("RepartitionByExpression") == 0
