"""Entries that landed against rows that bronze and the history hold."""

import pytest
from pyspark.sql import functions as F
from rows import RUN, bronze

from recordloom.operators.balance import day_balance, losses
from recordloom.operators.cleaning import deliveries
from recordloom.operators.history import rebuild
from recordloom.operators.landing import land_pages
from recordloom.plans import daily
from recordloom.sources import star_tables as star
from recordloom.sources import tables as store
from recordloom.specs import ENCOUNTER, PATIENT

ROWS = [
    ("a", "1", "2024-01-01", "x"),
    ("a", "1", "2024-01-01", "x", "2024-01-02 00:00:00", "u"),
    (" a ", "1", "2024-01-01", "x", "2024-01-03 00:00:00", "u"),
    ("a", "2", "2024-01-02", "y"),
    ("b", None, "2024-01-01", "x"),
    ("", "1", "2024-01-01", "x"),
    ("  ", "1", "2024-01-01", "x"),
    (None, "1", "2024-01-01", "x"),
]
LOG = "resource_type string, ingestion_date string, records_fetched int, status string"


def log_of(spark, *rows):
    return spark.createDataFrame(rows, LOG).withColumn("ingestion_date", F.col("ingestion_date").cast("date"))


def only(df):
    (row,) = df.collect()
    return row.asDict()


def test_every_row_has_a_class(spark):
    rows = bronze(spark, ROWS)
    without = bronze(spark, [(None, None, None, None)]).withColumn("raw_resource_json", F.lit(None).cast("string"))
    log = log_of(spark, ("Encounter", "2024-01-01", 5, "SUCCESS"), ("Encounter", "2024-01-01", 4, "ERROR"))
    history = rebuild(deliveries(rows, ENCOUNTER), RUN[0])
    found = only(day_balance(log, rows.unionByName(without), ENCOUNTER, history))
    assert {k: found[k] for k in ("entries", "without_resource", "blank_ids", "repeats", "kept", "unaccounted", "ids_missing")} == {
        "entries": 9, "without_resource": 1, "blank_ids": 3, "repeats": 2, "kept": 3, "unaccounted": 0, "ids_missing": 0
    }
    assert found["pages_in_error"] == 1 and found["written"] is None


@pytest.mark.parametrize("landed,written,expected", [(8, 8, None), (10, 8, (2, 0)), (10, 10, (0, 2)), (7, 8, (-1, 0))])
def test_losses_say_where(spark, landed, written, expected):
    rows, log = bronze(spark, ROWS), log_of(spark, ("Encounter", "2024-01-01", landed, "SUCCESS"))
    counts = log.select("resource_type", "ingestion_date", F.lit(written).cast("long").alias("rows"))
    found = [tuple(r)[2:4] for r in losses(day_balance(log, rows, ENCOUNTER, counts=counts)).collect()]
    assert found == ([] if expected is None else [expected])


def test_ids_that_the_history_lost(spark):
    rows, log = bronze(spark, ROWS), log_of(spark, ("Encounter", "2024-01-01", 8, "SUCCESS"))
    history = rebuild(deliveries(rows, ENCOUNTER), RUN[0]).filter("resource_id <> 'b'")
    assert only(losses(day_balance(log, rows, ENCOUNTER, history)))["ids_missing"] == 1


def test_nothing_landed(spark):
    assert day_balance(log_of(spark).limit(0), bronze(spark, ROWS).limit(0), ENCOUNTER).count() == 0


def test_lost_files_of_stored_tables_show(spark, folder, tmp_path):
    landing, tables, silver, log = (str(tmp_path / n) for n in ("landing", "bronze", "silver", "log"))
    records = star.patients(star.table(spark, folder, "customer"))
    for day in ("2024-01-02", "2024-01-03"):
        land_pages(records, landing, PATIENT, day)
        daily.ingest_day(spark, landing, tables, log, PATIENT, day)
    daily.update_history(spark, tables, silver, PATIENT, RUN[0])
    whole = daily.balance_of(spark, tables, log, silver, PATIENT)
    assert losses(whole).count() == 0
    kept = [(r["repeats"], r["kept"], r["written"]) for r in whole.sort("ingestion_date").collect()]
    assert kept == [(0, 150, 150), (150, 0, 150)]
    # Part of a day is overwritten behind the library's back.
    table = f"{tables}/bronze_patient"
    part = store.read_bronze(spark, table, PATIENT).filter("ingestion_date = '2024-01-03'").drop("ingestion_date").limit(100)
    spark.createDataFrame(part.collect(), part.schema).write.mode("overwrite").parquet(f"{table}/ingestion_date=2024-01-03")
    lost = only(losses(daily.balance_of(spark, tables, log, silver, PATIENT)))
    assert (str(lost["ingestion_date"]), lost["lost_on_write"], lost["lost_since"], lost["ids_missing"]) == ("2024-01-03", 0, 50, 0)
    daily.ingest_day(spark, landing, tables, log, PATIENT, "2024-01-03")
    assert losses(daily.balance_of(spark, tables, log, silver, PATIENT)).count() == 0
