"""Bronze rows to clean, hashed, unique versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.functions.columns import instant, record_hash, trimmed
from recordloom.specs import ID, UPDATED, VERSION, ResourceSpec

# Columns that put the versions of one record in order: time, then number, then text of the version
# ("10" is after "9"). They exist only between deliveries() and the history.
ORDER = ("_at", "_number", "_version")

# Decides between deliveries of one version; the first column is the rule, the others break ties.
DELIVERY_ORDER = (
    "extraction_timestamp",
    UPDATED,
    "record_hash",
    "full_url",
    "meta_source",
    "api_url_or_params",
    "ingestion_date",
)


def with_record_hash(df: DataFrame, spec: ResourceSpec) -> DataFrame:
    return df.withColumn("record_hash", record_hash(spec.hash_columns))


def with_order(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"_at": instant(UPDATED), "_number": F.expr(f"try_cast({VERSION} as bigint)"), "_version": F.col(VERSION)}
    )


def deliveries(bronze: DataFrame, spec: ResourceSpec) -> DataFrame:
    """Bronze rows trimmed, with an id, hashed and in version order; narrow, nothing is shuffled.

    Trimming comes first, so that " 1" and "1" are one id and "  " is none.
    """
    rows = trimmed(bronze.drop("raw_resource_json")).filter(F.col(ID) != "")
    return with_order(with_record_hash(rows, spec))


def first_deliveries(rows: DataFrame) -> DataFrame:
    """One row per (id, version): the earliest extraction.

    Spark keeps one row per version and task before it shuffles, so a version that was delivered
    very often does not meet in one task.
    """
    ranked = Window.partitionBy(ID, VERSION).orderBy(*DELIVERY_ORDER)
    return rows.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def newest_versions(rows: DataFrame) -> DataFrame:
    """One row per id: the newest version, and of that the earliest extraction."""
    latest = [F.col(c).desc() for c in ORDER]
    ranked = Window.partitionBy(ID).orderBy(*latest, *DELIVERY_ORDER)
    return rows.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
