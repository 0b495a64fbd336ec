"""Parquet tables: bronze by day, the ingestion log, and version histories written run by run.

History layout: <root>/rows/is_current=<bool>/write=<id>, <root>/touched/write=<id>, <root>/runs. A run writes only
rows of the ids it touched, and lists them: on reading, the current row of an id is that of the newest run that touched
it, and for ids whose past a run had to correct, what earlier runs stored is skipped. A run counts once <root>/runs
holds its row. Every attempt writes under an id of its own, so a crash before that leaves nothing that could count.
Compaction writes the whole history as a new base; vacuum removes the folders that no longer count.
"""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import written_once
from recordloom.specs import ID, ResourceSpec

# Columns of the ingestion log.
INGESTION_LOG_DDL = (
    "log_id string, resource_type string, api_url string, page_number int, records_fetched int, "
    "extraction_timestamp timestamp, save_timestamp timestamp, status string, "
    "error_message string, ingestion_date date"
)


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Write `df`, replacing exactly the partitions it holds rows for; other partitions stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    with written_once(df.sparkSession):
        writer.parquet(path, compression="zstd")


def write_bronze(bronze: DataFrame, root: str, day: str | None = None) -> None:
    """Add days to the table of its resource type; a repeated day replaces itself instead of doubling.

    With `day` all rows are of that day, and it is replaced also when there are none any more. Without, the days are
    those that `bronze` has rows for. Each day written gets a new state, which histories compare with what they took,
    and the ids of that state are kept beside the table, so that a history can tell later what a replaced day had held.
    """
    spark = bronze.sparkSession
    if day is None:
        days = [str(r[0]) for r in bronze.select("ingestion_date").distinct().collect()]  # one value per day
        write_partitions(bronze, root, "ingestion_date")
    else:
        days = [day]
        with written_once(spark):
            bronze.drop("ingestion_date").write.mode("overwrite").parquet(f"{root}/ingestion_date={day}", compression="zstd")
    if days:
        at = max((m["at"] for m in _marks(spark, f"{root}-states")), default=0) + 1
        states = spark.createDataFrame([(d, uuid.uuid4().hex, at) for d in days], "source string, state string, at long")
        states = states.coalesce(1)
        if ID in bronze.columns:
            written = spark.read.parquet(root).select(F.col("ingestion_date").cast("string").alias("source"), F.trim(ID).alias(ID))
            ids = written.filter(F.col("source").isin(days) & (F.col(ID) != "")).distinct()
            # The states of the days are few; they are fixed in the query, as they are written below.
            named = F.create_map(*[F.lit(x) for row in states.collect() for x in (row["source"], row["state"])])
            write_partitions(ids.select(ID, named[F.col("source")].alias("state")), f"{root}-ids", "state")
        states.write.mode("append").parquet(f"{root}-states")


def ids_of_states(spark: SparkSession, root: str, states: Sequence[str]) -> DataFrame | None:
    """Ids that the days of a bronze table held in the given states of theirs; None if the table keeps none for them."""
    try:
        kept = spark.read.schema(f"{ID} string, state string").parquet(f"{root}-ids")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return kept.filter(F.col("state").isin(list(states))).select(ID).distinct()


def bronze_states(spark: SparkSession, root: str) -> dict[str, str]:
    """Newest state of each day; one small row per day and write."""
    marks = _marks(spark, f"{root}-states")
    return {m["source"]: m["state"] for m in sorted(marks, key=lambda m: m["at"])}


def read_bronze(spark: SparkSession, root: str, spec: ResourceSpec | None = None) -> DataFrame:
    """All days; a column that came later is NULL in the days before.

    With `spec` the schema is known and no file is opened to find it; without, the schemas of all
    files are merged.
    """
    if spec is None:
        return spark.read.option("mergeSchema", "true").parquet(root)
    return spark.read.schema(spec.bronze_ddl).parquet(root)


def write_counts(spark: SparkSession, root: str, resource: str, day: str, rows: int) -> None:
    """Keep how many rows were written of a day, in place of what was kept for it before."""
    kept = spark.createDataFrame([(resource, day, rows)], "resource_type string, ingestion_date string, rows long")
    write_partitions(kept.coalesce(1), f"{root}-counts", "resource_type", "ingestion_date")


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("rows long, resource_type string, ingestion_date date").parquet(f"{root}-counts")


def empty_ingestion_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INGESTION_LOG_DDL)


def write_ingestion_log(log: DataFrame, root: str) -> None:
    write_partitions(log, root, "resource_type", "ingestion_date")


def read_ingestion_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INGESTION_LOG_DDL).parquet(root)


def write_history_run(
    rows: DataFrame,
    root: str,
    run: int,
    touched: DataFrame | None = None,
    late: DataFrame | None = None,
    taken: dict[str, str] | None = None,
    seen: int | None = None,
) -> None:
    """Store what a run made.

    `touched` are the ids in `rows`; `late` are those of them for which `rows` holds the complete history. Without
    `touched`, `rows` is the complete history of all ids, and nothing written by earlier runs counts any more. `taken`
    maps sources to the states of theirs that the history now holds. `seen` is the newest run that `rows` were made from.
    When another writer has finished a run since, or has taken this one's number, nothing is marked and RunTaken is
    raised: reading again and repeating the step is safe.
    """
    spark = rows.sparkSession
    write, marks = uuid.uuid4().hex, history_runs(spark, root)
    if touched is not None:
        listed = touched.select(ID).withColumns({"run": F.lit(run).cast("long"), "corrected": F.lit(False)})
        if late is not None:
            listed = listed.join(late.select(ID, F.lit(True).alias("_late")), ID, "left")
            listed = listed.withColumn("corrected", F.coalesce("_late", F.lit(False))).drop("_late")
        with written_once(spark):
            listed.write.parquet(f"{root}/touched/write={write}", compression="zstd")
    write_partitions(
        rows.withColumns({"run": F.lit(run).cast("long"), "write": F.lit(write)}), f"{root}/rows", "is_current", "write"
    )
    base = run if touched is None or not marks else marks[-1]["base"]
    claim_run(spark, root, run, seen)
    row = (run, write, base, taken or {})
    mark = spark.createDataFrame([row], "run long, write string, base long, taken map<string,string>")
    mark.coalesce(1).write.mode("append").parquet(f"{root}/runs")


class RunTaken(RuntimeError):
    """Another writer finished or began the run in the meantime."""


def files_of(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


_files = files_of


def claim_run(spark: SparkSession, root: str, run: int, seen: int | None) -> None:
    """Take the run's number by a file that only one writer can create."""
    newest = max((m["run"] for m in history_runs(spark, root)), default=0)
    if newest >= run or (seen is not None and newest != seen):
        raise RunTaken(f"run {newest} of {root} was finished while run {run} was made")
    files, claim = files_of(spark, f"{root}/claims/run={run}")
    if not files.createNewFile(claim):
        raise RunTaken(f"run {run} of {root} was begun by another writer")


def next_run(spark: SparkSession, root: str) -> tuple[int, int]:
    """The number for a new run, and the newest finished one (0 before the first).

    A number whose writer crashed before its run was marked stays unused.
    """
    seen = max((m["run"] for m in history_runs(spark, root)), default=0)
    files, folder = files_of(spark, f"{root}/claims")
    claimed = [int(f.getPath().getName().removeprefix("run=")) for f in files.listStatus(folder)] if files.exists(folder) else []
    return max([seen, *claimed]) + 1, seen


def _marks(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def history_runs(spark: SparkSession, root: str) -> list:
    """Finished runs in order: run, write, base and what it took; one small row per run."""
    return sorted(_marks(spark, f"{root}/runs"), key=lambda m: m["run"])


def taken_states(spark: SparkSession, root: str) -> dict[str, str]:
    """Sources and the states of theirs that the history holds."""
    states: dict[str, str] = {}
    for mark in history_runs(spark, root):
        states.update(mark["taken"])
    return states


def counting(marks: list) -> list:
    """The newest base and the runs after it."""
    return [m for m in marks if m["run"] >= marks[-1]["base"]]


def _history_rows(spark: SparkSession, root: str, marks: list, wanted: Column | None = None) -> DataFrame:
    """Rows that count, of the wanted partitions; is_current is text in folder names."""
    writes = [m["write"] for m in marks]
    rows = spark.read.parquet(f"{root}/rows").filter(F.col("write").isin(writes))
    if wanted is not None:
        rows = rows.filter(wanted)
    rows = rows.withColumn("is_current", F.col("is_current").cast("boolean")).drop("write")
    later = [m["write"] for m in marks if m["run"] > m["base"]]
    if later:
        touched = spark.read.parquet(f"{root}/touched").filter(F.col("write").isin(later))
        newest = touched.groupBy(ID).agg(
            F.max("run").alias("_current_from"), F.max(F.when(F.col("corrected"), F.col("run"))).alias("_closed_from")
        )
        since = F.when(F.col("is_current"), F.col("_current_from")).otherwise(F.col("_closed_from"))
        rows = rows.join(newest, ID, "left").filter(F.col("run") >= F.coalesce(since, F.col("run")))
        rows = rows.drop("_current_from", "_closed_from")
    return rows.drop("run")


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    """The history as of the newest finished run, None before the first one.

    The filter names partition columns only, so no superseded or unfinished file is opened. Right after a compaction
    nothing is joined.
    """
    marks = history_runs(spark, root)
    return _history_rows(spark, root, counting(marks)) if marks else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The current rows as of the newest finished run; reads current partitions only."""
    marks = history_runs(spark, root)
    return _history_rows(spark, root, counting(marks), F.col("is_current") == "true") if marks else None


def compact_history(spark: SparkSession, root: str) -> None:
    """Write the whole history as a new base, so that reading joins nothing."""
    marks = history_runs(spark, root)
    if len(counting(marks)) > 1:
        run, seen = next_run(spark, root)
        write_history_run(read_history(spark, root), root, run, seen=seen)


def vacuum_history(spark: SparkSession, root: str) -> int:
    """Remove folders of writes that do not count any more; returns how many. Nobody may be reading or writing."""
    kept = {m["write"] for m in counting(history_runs(spark, root))}
    removed = 0
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in ("rows/is_current=true", "rows/is_current=false", "touched"):
        top = hadoop(f"{root}/{folder}")
        system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.listStatus(top) if system.exists(top) else []:
            name = status.getPath().getName()
            if name.startswith("write=") and name.removeprefix("write=") not in kept:
                removed += system.delete(status.getPath(), True)
    return removed
