"""Landed pages: one JSON bundle per file, or one per line, under <root>/<resource type>/<day>/."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.specs import CORRUPT, WINDOW_DAYS, ResourceSpec, page_ddl

DAY_IN_PATH = r"/(\d{4}-\d{2}-\d{2})/[^/]+$"


def landing_path(root: str, resource: str, day: str) -> str:
    return f"{root}/{resource}/{day}"


def _with_lineage(pages: DataFrame, spec: ResourceSpec) -> DataFrame:
    path = F.col("_metadata.file_path")
    return pages.select(
        "*",
        path.alias("page_path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.regexp_extract(path, DAY_IN_PATH, 1).cast("date").alias("ingestion_date"),
        F.lit(spec.name).alias("resource_type"),
    )


def read_pages(
    spark: SparkSession,
    root: str,
    spec: ResourceSpec,
    days: Sequence[str],
    one_per_line: bool = False,
    headers_only: bool = False,
) -> DataFrame:
    """Pages of the given days with the declared schema; broken pages keep their text in _corrupt.

    `headers_only` leaves the resources unparsed, which is enough for the audit.

    Only the folders of `days` are listed. A multi-line file is one task, so pages must stay small;
    with `one_per_line` files hold many pages and can be split.
    """
    reader = (
        spark.read.schema(page_ddl("fullUrl:string") if headers_only else spec.bundle_ddl)
        .option("multiLine", not one_per_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    return _with_lineage(reader.json([landing_path(root, spec.name, d) for d in days]), spec)


def read_page_texts(
    spark: SparkSession, root: str, spec: ResourceSpec, days: Sequence[str], one_per_line: bool = False
) -> DataFrame:
    """The same pages as text in `value`, unparsed."""
    reader = spark.read.option("wholetext", not one_per_line)
    return _with_lineage(reader.text([landing_path(root, spec.name, d) for d in days]), spec)


def stream_pages(
    spark: SparkSession,
    root: str,
    spec: ResourceSpec,
    one_per_line: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same pages as a stream over all days; each landed file is seen once per checkpoint."""
    reader = (
        spark.readStream.schema(spec.bundle_ddl)
        .option("multiLine", not one_per_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_lineage(reader.json(landing_path(root, spec.name, "*")), spec)


def parse_pages(texts: DataFrame, spec: ResourceSpec, text: str = "value") -> DataFrame:
    """Pages held as text in a column, parsed with the same schema; other columns stay."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = texts.withColumn("_page", F.from_json(text, spec.bundle_ddl, options))
    return parsed.select("_page.*", *[c for c in texts.columns if c != text])


def in_window(at: Column | str, end: str, days: int = WINDOW_DAYS) -> Column:
    """Condition for the incremental window: `days` before `end` up to `end`, both days included.

    Takes dates and timestamps. It compares the column itself, so it prunes the folders of a partition
    column and is pushed to the scan of any other.
    """
    at = F.col(at) if isinstance(at, str) else at
    last = F.lit(end).cast("date")
    return (at >= F.date_sub(last, days)) & (at < F.date_add(last, 1))
