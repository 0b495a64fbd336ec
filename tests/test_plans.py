"""Shapes of physical plans that keep the operators usable on large tables."""

import re

from pyspark.sql import functions as F
from rows import RUN

from recordloom.checks.queries import QUERIES
from recordloom.operators import history as h
from recordloom.operators.cleaning import deliveries, first_deliveries
from recordloom.plans import marts
from recordloom.session import new_folder, stored
from recordloom.sources import star_tables as star
from recordloom.specs import ENCOUNTER, OBSERVATION


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def bronze_table(spark, folder, records, spec):
    """Bronze rows in a table, as in daily work."""
    root = new_folder(spark, "bronze")
    star.bronze_rows(records, spec).write.parquet(root)
    return spark.read.parquet(root)


def versions(spark, folder):
    records = star.patients_by_order(star.table(spark, folder, "orders"))
    return deliveries(bronze_table(spark, folder, records, ENCOUNTER), ENCOUNTER)


def test_ordinary_history_shuffles_its_rows_once(spark, folder):
    text = final_plan(h.rebuild(versions(spark, folder), RUN[0]))
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(resource_id" in text
    assert "Join" not in text


def test_deduplication_keeps_one_row_per_version_before_the_shuffle(spark, folder):
    text = plan(first_deliveries(versions(spark, folder)))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "Partial" in below


def test_hot_ids_are_spread_by_range(spark, folder):
    text = plan(h.rebuild(versions(spark, folder), RUN[0], hot_rows=5))
    assert "rangepartitioning(resource_id" in text


def test_current_rows_filter_reaches_the_scan(spark, folder):
    root = new_folder(spark, "history")
    h.rebuild(versions(spark, folder), RUN[0]).write.parquet(root)
    text = plan(marts.encounters(spark.read.parquet(root)))
    assert re.search(r"PushedFilters: \[[^\]]*is_current", text)
    kpis = plan(marts.encounter_kpis(marts.encounters(spark.read.parquet(root))))
    read = kpis.split("ReadSchema: ")[1].split("\n")[0]
    assert "class_code" not in read and "patient_reference" in read


def test_window_filter_reaches_the_scan(spark, folder):
    text = plan(QUERIES["current_window_filter"](spark, folder))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in text.split("ReadSchema: ")[1]


def test_small_batch_does_not_shuffle_the_current_set(spark, folder):
    history = stored(h.rebuild(versions(spark, folder), RUN[0]))
    rows, late = h.step(h.current_rows(history), versions(spark, folder), versions(spark, folder), RUN[1])
    untouched = plan(rows).split("LeftAnti")[0]
    assert late is None and "BroadcastHashJoin [resource_id" in untouched and "Exchange" not in untouched


def test_fact_join_splits_a_patient_with_very_many_facts(spark):
    """A third of the facts belong to one patient and a third to none."""
    key = F.expr("case id % 3 when 0 then 'p0' when 1 then 'p' || id end")
    facts = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("fact"), key.alias("patient_id"))
    patients = spark.range(60_000).selectExpr(
        "'p' || id as patient_id", "'n' || id as full_name", "'x' as gender", "1 as age"
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        joined = marts.with_patient(facts, patients)
        assert joined.filter("patient_name is not null").count() == 40_000 and joined.count() == 60_000
        assert "skew=true" in final_plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_newest_version_is_picked_before_the_shuffle(spark, folder):
    text = plan(h.first_load(versions(spark, folder), RUN[0]))
    assert "Partial" in text.split("Exchange hashpartitioning", 1)[1]


def test_summary_joins_after_aggregating(spark, folder):
    records = star.observations(star.table(spark, folder, "lineitem"), star.table(spark, folder, "orders"))
    root = new_folder(spark, "history")
    h.rebuild(deliveries(bronze_table(spark, folder, records, OBSERVATION), OBSERVATION), RUN[0]).write.parquet(root)
    text = plan(marts.observation_kpis(marts.observations(spark.read.parquet(root))))
    assert "Join" not in text and "Expand" not in text
    assert "partial_count" in text
