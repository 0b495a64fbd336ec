"""Landed pages as a stream: each file is taken once, however often the job is started."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.audit import audit_pages
from recordloom.operators.bundles import flatten_bundles, rejected_pages
from recordloom.plans.daily import advance_history
from recordloom.session import stored
from recordloom.sources.pages import stream_pages
from recordloom.sources.tables import read_bronze
from recordloom.specs import ResourceSpec


class Place(NamedTuple):
    """Where a micro-batch is written: a partition named by its stream and its number."""

    stream: str
    batch: int

    @property
    def path(self) -> str:
        return f"stream={self.stream}/batch={self.batch}"


def batch_place(spark: SparkSession, checkpoint: str, batch: int) -> Place:
    kept = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
    return Place(kept, batch)


def take_batch(
    spark: SparkSession, bronze: str, history: str, spec: ResourceSpec, place: Place, run_at: datetime | None
) -> None:
    """Add the bronze rows of a micro-batch to the history, once."""
    rows = read_bronze(spark, bronze, spec)
    mine = (F.col("stream") == place.stream) & (F.col("batch") == place.batch)
    arrived, before = (rows.filter(c).drop("stream", "batch") for c in (mine, ~mine))
    advance_history(arrived, before, history, spec, {f"{place.stream}/{place.batch}": "done"}, run_at)


def ingest_available(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    spec: ResourceSpec,
    history: str | None = None,
    run_at: datetime | None = None,
    one_per_line: bool = True,
    files_per_batch: int | None = None,
    log: str | None = None,
    rejects: str | None = None,
) -> None:
    """Take all pages that landed since the last call, then stop.

    `bronze`, `history`, `checkpoint`, `log` and `rejects` are folders of this resource type. The last two get the
    ingestion log and the pages that lose something, if they are named.

    A micro-batch may run twice after a failure. What it writes goes to a partition of its own, named by the stream (an
    id that Spark keeps at the checkpoint) and the batch, which the second try replaces; its history run is skipped if
    it had finished. A new checkpoint is a new stream, whose batches stand beside those of earlier ones.
    """

    def store(pages: DataFrame, batch: int) -> None:
        session = pages.sparkSession
        pages = stored(pages)  # parsed once: rows, log and rejects come from the same reading
        place = batch_place(session, checkpoint, batch)
        flatten_bundles(pages, spec).write.mode("overwrite").parquet(f"{bronze}/{place.path}")
        if log is not None:
            audit_pages(pages).write.mode("overwrite").parquet(f"{log}/{place.path}")
        if rejects is not None:
            rejected_pages(pages).write.mode("overwrite").parquet(f"{rejects}/{place.path}")
        if history is not None:
            take_batch(session, bronze, history, spec, place, run_at)

    pages = stream_pages(spark, landing, spec, one_per_line, files_per_batch)
    query = (
        pages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
