"""The patient summary kept by run: each run aggregates anew only what the touched records belong to.

Per source of the summary (encounters, conditions, observations) there is a table of cells. A cell holds the partial
aggregates of one patient and one month of start (encounters) or code (the others), so the records of a patient with very
many of them are spread over cells. First and last times and sets of names cannot be taken back from an aggregate; a run
therefore replaces whole cells: those that the touched records were in, and those that they are in now. Where a record was
is kept as its owner, (id, patient, cell). A summary adds up the cells of each patient.

Layout per source: <root>/<source>/cells/write=<id>, <root>/<source>/owners/write=<id>, <root>/<source>/runs. The newest
run that wrote a cell or an owner wins. A cell without records, and an id without a record, keep a row of nulls.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions.columns import reference_key
from recordloom.operators.history import current_rows
from recordloom.plans import marts
from recordloom.session import settled_keys, side_by_side, stored, written_once
from recordloom.sources import tables as store
from recordloom.specs import ID, RESOURCES

COMPACT_AFTER = 32  # runs; then all cells and owners are written as a new base
CELL = ("patient_id", "cell")
MOMENT = "struct<readable: boolean, at: timestamp, text: string>"
OWNERS_DDL = f"{ID} string, patient_id string, cell string"


def _cell(value: Column | str) -> Column:
    """Never null, so that cells can be joined: `=` and the value, or empty for none."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias("cell")


def _visits(current: DataFrame) -> DataFrame:
    month = _cell(F.substring("period_start", 1, 7))
    return marts.encounters(current).select(F.col("encounter_id").alias(ID), "patient_id", month, "period_start", "duration_hours")


def _visit_cells(rows: DataFrame) -> DataFrame:
    hours = F.col("duration_hours").cast("decimal(18,2)")
    return rows.groupBy(*CELL).agg(
        F.count(ID).alias("n"),
        marts.earliest("period_start").alias("first"),
        marts.latest("period_start").alias("last"),
        F.sum(hours).alias("hours"),
        F.count(hours).alias("timed"),
    )


def _visit_kpis(cells: DataFrame) -> DataFrame:
    mean = F.sum("hours").cast("decimal(28,2)") / F.nullif(F.sum("timed"), F.lit(0))
    return cells.groupBy("patient_id").agg(
        F.sum("n").alias("total_encounters"),
        F.min("first")["text"].alias("first_encounter"),
        F.max("last")["text"].alias("last_encounter"),
        mean.cast("decimal(22,6)").alias("avg_duration_hours"),
    )


def _diagnoses(current: DataFrame) -> DataFrame:
    key = reference_key("patient_reference", "Patient").alias("patient_id")
    return current_rows(current).select(ID, key, _cell("condition_code"), "condition_display")


def _diagnosis_cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL).agg(F.count(ID).alias("n"), F.collect_set("condition_display").alias("names"))


def _diagnosis_kpis(cells: DataFrame) -> DataFrame:
    """A wording may occur under several codes; the second step sees each once a code."""
    return cells.groupBy("patient_id").agg(
        F.count_if(F.col("cell") != "").alias("distinct_conditions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("condition_list"),
    )


def _measures(current: DataFrame) -> DataFrame:
    measured = marts.observations(current)
    return measured.select(F.col("observation_id").alias(ID), "patient_id", _cell("observation_code"), "effective_datetime")


def _measure_cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL).agg(F.count(ID).alias("n"), marts.latest("effective_datetime").alias("last"))


def _measure_kpis(cells: DataFrame) -> DataFrame:
    return cells.groupBy("patient_id").agg(
        F.sum("n").alias("total_observations"),
        F.count_if(F.col("cell") != "").alias("distinct_obs_types"),
        F.max("last")["text"].alias("latest_observation"),
    )


@dataclass(frozen=True)
class Part:
    """How a source enters the summary: its rows with id, patient and cell; their cells; the sums of a patient's cells."""

    rows: Callable[[DataFrame], DataFrame]
    cells: Callable[[DataFrame], DataFrame]
    kpis: Callable[[DataFrame], DataFrame]
    measures_ddl: str

    @property
    def cells_ddl(self) -> str:
        return f"patient_id string, cell string, {self.measures_ddl}"


PARTS = {
    "Encounter": Part(
        _visits, _visit_cells, _visit_kpis, f"n long, first {MOMENT}, last {MOMENT}, hours decimal(28,2), timed long"
    ),
    "Condition": Part(_diagnoses, _diagnosis_cells, _diagnosis_kpis, "n long, names array<string>"),
    "Observation": Part(_measures, _measure_cells, _measure_kpis, f"n long, last {MOMENT}"),
}


def _newest(spark: SparkSession, path: str, marks: list, keys: Sequence[str], ddl: str) -> DataFrame:
    """The newest row of each key: the base without the keys that later runs wrote, and those runs' rows."""
    base, *later = [m["write"] for m in store.counting(marks)]
    rows = spark.read.schema(f"{ddl}, run long, write string").parquet(path)
    kept = rows.filter(F.col("write") == base).drop("run", "write")
    if not later:
        return kept
    values = [c for c in kept.columns if c not in keys]
    written = rows.filter(F.col("write").isin(later)).groupBy(*keys).agg(F.max_by(F.struct(*values), "run").alias("values"))
    written = written.select(*keys, "values.*")
    return kept.join(written.select(*keys), list(keys), "left_anti").unionByName(written)


def _cells(spark: SparkSession, own: str, marks: list, part: Part) -> DataFrame:
    return _newest(spark, f"{own}/cells", marks, CELL, part.cells_ddl).filter("n > 0")


def _owners(spark: SparkSession, own: str, marks: list) -> DataFrame:
    return _newest(spark, f"{own}/owners", marks, [ID], OWNERS_DDL).filter("patient_id is not null")


def _touched_since(spark: SparkSession, history: str, runs: list, upto: int) -> DataFrame | None:
    """Ids that runs of a history after `upto` touched; None if they may be any.

    A compaction holds everything and takes nothing new, so it touches nothing. The lists of older runs may have been
    removed after it.
    """
    listed = []
    for mark in runs:
        if mark["run"] <= upto or (mark["base"] == mark["run"] and not mark["taken"]):
            continue
        files, folder = store.files_of(spark, f"{history}/touched/write={mark['write']}")
        if mark["base"] == mark["run"] or not files.exists(folder):
            return None
        listed.append(mark["write"])
    ids = spark.read.schema(f"{ID} string, write string").parquet(f"{history}/touched") if listed else None
    if ids is None:
        return spark.createDataFrame([], f"{ID} string")
    return ids.filter(F.col("write").isin(listed)).select(ID)


def _write(cells: DataFrame, owners: DataFrame, own: str, run: int, seen: int, base: int | None, upto: int) -> None:
    """Store a run. Nothing counts before its mark; RunTaken is raised when another writer was faster."""
    spark, write = cells.sparkSession, uuid.uuid4().hex
    for name, rows in (("cells", cells), ("owners", owners)):
        with written_once(spark):
            rows.withColumn("run", F.lit(run).cast("long")).write.parquet(f"{own}/{name}/write={write}", compression="zstd")
    store.claim_run(spark, own, run, seen)
    mark = spark.createDataFrame([(run, write, base or run, upto)], "run long, write string, base long, upto long")
    mark.coalesce(1).write.mode("append").parquet(f"{own}/runs")


def refresh_source(spark: SparkSession, history: str, root: str, source: str) -> bool:
    """Bring the cells of one source up to its stored history; False if they were.

    The cost is the touched ids, a scan of the current rows' few columns for the cells they concern, and no shuffle of
    the others. Everything is aggregated at the first call, when the lists of what was touched since are gone, and when
    more ids were touched than had a place: reading where each of them was then costs more than it spares.
    A history without a run leaves nothing behind.
    """
    part, own = PARTS[source], f"{root}/{source}"
    runs, marks = store.history_runs(spark, history), store.history_runs(spark, own)
    if not runs or (marks and marks[-1]["upto"] == runs[-1]["run"]):
        return False
    upto = runs[-1]["run"]
    rows = part.rows(store.read_current(spark, history)).filter("patient_id is not null")
    if marks and len(store.counting(marks)) > COMPACT_AFTER:
        run, seen = store.next_run(spark, own)
        _write(_cells(spark, own, marks, part), _owners(spark, own, marks), own, run, seen, None, marks[-1]["upto"])
        marks = store.history_runs(spark, own)
    run, seen = store.next_run(spark, own)
    ids = _touched_since(spark, history, runs, marks[-1]["upto"]) if marks else None
    touched, count = settled_keys(ids) if ids is not None else (None, 0)
    if touched is None or count > _owners(spark, own, marks).count():
        _write(part.cells(rows), rows.select(ID, *CELL), own, run, seen, None, upto)
        return True
    now = stored(rows.join(touched, ID, "left_semi").select(ID, *CELL))
    before = _owners(spark, own, marks).join(touched, ID, "left_semi")
    concerned, _ = settled_keys(before.select(*CELL).unionByName(now.select(*CELL)))
    anew = part.cells(rows.join(concerned, list(CELL), "left_semi"))
    cells = concerned.join(anew, list(CELL), "left")
    _write(cells, touched.join(now, ID, "left"), own, run, seen, marks[-1]["base"], upto)
    return True


def refresh_summary(spark: SparkSession, silver: str, root: str) -> None:
    """Bring the cells of all sources up to the stored histories. Each source is finished by itself and may be repeated."""
    side_by_side(spark, (partial(refresh_source, spark, f"{silver}/{RESOURCES[n].silver_table}", root, n) for n in PARTS))


def kept_summary(spark: SparkSession, root: str, patients: DataFrame) -> DataFrame:
    """`marts.patient_summary` of the histories as last refreshed, for the rows of dim_patient.

    Reads cells only. A source that was never refreshed counts as empty.
    """
    sides = []
    for source, part in PARTS.items():
        marks = store.history_runs(spark, f"{root}/{source}")
        cells = _cells(spark, f"{root}/{source}", marks, part) if marks else spark.createDataFrame([], part.cells_ddl)
        sides.append(part.kpis(cells))
    return marts.with_kpis(patients, *sides)
