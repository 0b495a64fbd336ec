"""Landed pages as a stream whose repeated deliveries are dropped before bronze, within a window of time.

A feed that asks for the last days again and again delivers most versions several times. The state store keeps the keys of
the window only, so its size follows the window, not the age of the feed. What comes after the window is not passed on
by Spark; `passed_over` finds such versions among the landed ones.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.bundles import flatten_bundles
from recordloom.sources.pages import stream_pages
from recordloom.specs import ID, VERSION, WINDOW_DAYS, ResourceSpec
from recordloom.streaming.pages import batch_place, take_batch

KEY = ("_id", "_of_version")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows that have an id, with id and version as the history compares them."""
    return rows.withColumns({"_id": F.trim(ID), "_of_version": F.trim(VERSION)}).filter("_id <> ''")


def unique_rows(rows: DataFrame, window: str) -> DataFrame:
    """Bronze rows of a stream, one per (id, version) within `window` of the time they landed."""
    timed = keyed(rows).withWatermark("extraction_timestamp", window)
    return timed.dropDuplicatesWithinWatermark(list(KEY)).drop(*KEY)


def ingest_unique(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    spec: ResourceSpec,
    window: str = f"{WINDOW_DAYS} days",
    history: str | None = None,
    run_at: datetime | None = None,
    one_per_line: bool = True,
    files_per_batch: int | None = None,
) -> list[dict[str, int]]:
    """Take all pages that landed since the last call, then stop; returns per batch the keys kept and the rows too late.

    A version that was delivered within `window` before reaches bronze once. Rows with a blank id are left out, as they
    are no records. Of deliveries in one micro-batch any may stay: two deliveries of a version are taken to be
    equal. Batches are written as `ingest_available` writes them and may run twice after a failure.
    """

    def store(rows: DataFrame, batch: int) -> None:
        place = batch_place(rows.sparkSession, checkpoint, batch)
        rows.write.mode("overwrite").parquet(f"{bronze}/{place.path}")
        if history is not None:
            take_batch(rows.sparkSession, bronze, history, spec, place, run_at)

    rows = flatten_bundles(stream_pages(spark, landing, spec, one_per_line, files_per_batch), spec)
    query = (
        unique_rows(rows, window)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    states = [progress.stateOperators[0] for progress in query.recentProgress if progress.stateOperators]
    return [{"keys": s.numRowsTotal, "too_late": s.numRowsDroppedByWatermark} for s in states]


def passed_over(landed: DataFrame, bronze: DataFrame) -> DataFrame:
    """Deliveries of versions that landed and that bronze does not hold: those that came after the window.

    `landed` are bronze rows of the landed pages (`flatten_bundles`), of the days in question. A late repeat of a version
    that bronze has is no loss and gives no row. The rows can be taken by `advance_history` with an empty `taken`.
    """
    held = keyed(bronze).select(*KEY).distinct().withColumnsRenamed({c: f"{c}_held" for c in KEY})
    same = F.expr("_id = _id_held and _of_version <=> _of_version_held")
    return keyed(landed).join(held, same, "left_anti").drop(*KEY)
