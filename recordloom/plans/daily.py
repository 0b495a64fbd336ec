"""The daily run per resource type: landed pages to bronze and log, bronze to history, histories to views.

Each step reads tables and writes tables, so any step can be repeated after a failure.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.audit import audit_pages
from recordloom.operators.balance import day_balance
from recordloom.operators.bundles import flatten_bundles, rejected_pages
from recordloom.operators.cleaning import deliveries
from recordloom.operators.history import delta, first_load, merge, rebuild
from recordloom.operators.metrics import observed
from recordloom.plans import marts
from recordloom.session import settled_keys, stored
from recordloom.sources.pages import read_pages
from recordloom.sources.tables import (
    bronze_states,
    compact_history,
    history_runs,
    ids_of_states,
    next_run,
    read_bronze,
    read_counts,
    read_current,
    read_history,
    read_ingestion_log,
    taken_states,
    write_bronze,
    write_counts,
    write_history_run,
    write_ingestion_log,
)
from recordloom.specs import ID, ResourceSpec


COMPACT_AFTER = 32  # runs; a longer list would make reading slower


def ingest_day(
    spark: SparkSession,
    landing: str,
    bronze: str,
    log: str,
    spec: ResourceSpec,
    day: str,
    one_per_line: bool = True,
    rejects: str | None = None,
) -> int:
    """Pages of one day to bronze rows and log rows; returns the number of bronze rows.

    Running a day again replaces it. A day for which nothing landed writes nothing and gives 0. With `rejects`, pages
    that lose something are kept there, by resource type and day.
    """
    try:
        pages = read_pages(spark, landing, spec, [day], one_per_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    pages = stored(pages)  # parsed once: rows, log and rejects come from the same reading
    rows, counted = observed(flatten_bundles(pages, spec), f"{spec.bronze_table} {day}")
    write_bronze(rows, f"{bronze}/{spec.bronze_table}", day)
    written = counted.get["total_rows"]
    write_counts(spark, f"{bronze}/{spec.bronze_table}", spec.name, day, written)
    write_ingestion_log(audit_pages(pages), log)
    if rejects is not None:
        lost = rejected_pages(pages).drop("resource_type", "ingestion_date")
        lost.write.mode("overwrite").parquet(f"{rejects}/resource_type={spec.name}/ingestion_date={day}")
    return written


def advance_history(
    batch: DataFrame,
    earlier: DataFrame,
    root: str,
    spec: ResourceSpec,
    taken: Mapping[str, str],
    run_at: datetime,
    replaced: DataFrame | None = None,
) -> None:
    """Add a batch of bronze rows to the stored history, unless it holds what `taken` names already.

    `earlier` are all other bronze rows. They are read when there is no history yet, for ids whose batch rows are older
    than what the history has seen, and for the ids in `replaced`: those of days that the history took before and that
    hold other rows now. What is gone from bronze can only be taken back by deriving these ids anew; ids that bronze does
    not hold any more leave the history.
    """
    spark = batch.sparkSession
    known = taken_states(spark, root)
    if taken and all(known.get(source) == state for source, state in taken.items()):
        return
    runs = history_runs(spark, root)
    run, seen = next_run(spark, root)
    arriving, before = deliveries(batch, spec), deliveries(earlier, spec)
    if not runs:
        whole = rebuild(before.unionByName(arriving), run_at, hashed=spec.hash_columns)
        write_history_run(whole, root, run, taken=dict(taken), seen=seen)
        return
    if run - runs[-1]["base"] >= COMPACT_AFTER:
        compact_history(spark, root)
        run, seen = next_run(spark, root)
    derived, fresh = None, arriving.select(ID)
    if replaced is not None:
        derived, _ = settled_keys(replaced.select(ID))
        fresh = fresh.join(derived, ID, "left_anti")
    touched, count = settled_keys(fresh)
    if count or derived is not None:
        current = read_current(spark, root)
        rows, late = delta(current, arriving, before, run_at, derived=derived, touched=touched, hashed=spec.hash_columns)
    else:
        rows, late = read_current(spark, root).limit(0), None
    if derived is not None:
        touched = touched.unionByName(derived)
        late = derived if late is None else late.select(ID).unionByName(derived)
    write_history_run(rows, root, run, touched, late, dict(taken), seen)


def update_history(spark: SparkSession, bronze: str, root: str, spec: ResourceSpec, run_at: datetime) -> None:
    """Bring the history of a resource type up to its bronze table, whatever days were added, backfilled or run again.

    Each day has a state; days whose state the history has not taken are the batch. For a day that it has taken in another
    state, the ids of both states are derived anew from bronze, and only those are written.
    """
    table, target = f"{bronze}/{spec.bronze_table}", f"{root}/{spec.silver_table}"
    states, known = bronze_states(spark, table), taken_states(spark, target)
    pending = {day: state for day, state in states.items() if known.get(day) != state}
    if not pending:
        return
    rows = read_bronze(spark, table, spec)
    is_pending = F.col("ingestion_date").isin([date.fromisoformat(day) for day in pending])
    replaced = {known[day]: state for day, state in pending.items() if day in known}
    ids = ids_of_states(spark, table, [*replaced.keys(), *replaced.values()]) if replaced else None
    if replaced and ids is None:  # bronze keeps no ids: all are derived anew
        ids = read_history(spark, target).select(ID).unionByName(deliveries(rows, spec).select(ID))
    advance_history(rows.filter(is_pending), rows.filter(~is_pending), target, spec, pending, run_at, ids)


def update_history_in_run_time(spark: SparkSession, bronze: str, root: str, spec: ResourceSpec, run_at: datetime) -> None:
    """Like update_history, for a history in run time: it starts and ends versions at `run_at`."""
    table, target = f"{bronze}/{spec.bronze_table}", f"{root}/{spec.silver_table}_by_run"
    states, known = bronze_states(spark, table), taken_states(spark, target)
    pending = {day: state for day, state in states.items() if known.get(day) != state}
    if not pending:
        return
    days = F.col("ingestion_date").isin([date.fromisoformat(day) for day in pending])
    arriving = deliveries(read_bronze(spark, table, spec).filter(days), spec)
    run, seen = next_run(spark, target)
    if not seen:
        write_history_run(first_load(arriving, run_at), target, run, taken=pending, seen=seen)
        return
    touched, _ = settled_keys(arriving.select(ID))
    mine = read_current(spark, target).join(touched, ID, "left_semi")
    write_history_run(merge(mine, arriving, run_at), target, run, touched, taken=pending, seen=seen)


def balance_of(spark: SparkSession, bronze: str, log: str, root: str, spec: ResourceSpec) -> DataFrame:
    """Balance of all days of a resource type, from the stored log, counts, bronze and history."""
    table = f"{bronze}/{spec.bronze_table}"
    landed = read_ingestion_log(spark, log).filter(F.col("resource_type") == spec.name)
    held = read_history(spark, f"{root}/{spec.silver_table}")
    return day_balance(landed, read_bronze(spark, table, spec), spec, held, read_counts(spark, table))


def read_histories(spark: SparkSession, root: str, specs: Iterable[ResourceSpec]) -> dict[str, DataFrame]:
    return {spec.name: read_history(spark, f"{root}/{spec.silver_table}") for spec in specs}


def mart_tables(histories: Mapping[str, DataFrame], as_of: date) -> dict[str, DataFrame]:
    """The five analytical tables from the histories by resource type."""
    patients = marts.dim_patient(histories["Patient"], as_of)
    return {
        "dim_patient": patients,
        "dim_condition": marts.dim_condition(histories["Condition"]),
        "fact_encounter": marts.fact_encounter(histories["Encounter"], patients),
        "fact_observation": marts.fact_observation(histories["Observation"], patients),
        "patient_summary": marts.patient_summary(
            patients, histories["Encounter"], histories["Condition"], histories["Observation"]
        ),
    }


def create_views(histories: Mapping[str, DataFrame], as_of: date) -> None:
    """Register the five tables as temporary views for SQL."""
    for name, table in mart_tables(histories, as_of).items():
        table.createOrReplaceTempView(name)
