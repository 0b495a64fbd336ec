"""Balance of layers: every entry that landed is kept, repeated, without an id or without a resource; nothing vanishes.

The left side is what the pages said when they landed (the ingestion log), the right side what bronze and the history
hold now, so rows that are lost on a write or after it show on their day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions.columns import trimmed
from recordloom.operators.audit import ERROR
from recordloom.operators.cleaning import deliveries, first_deliveries
from recordloom.specs import ID, ResourceSpec

DAY = ("resource_type", "ingestion_date")
SUMS = ("pages_in_error", "entries", "written", "without_resource", "blank_ids", "valid", "kept", "ids_missing")


def day_balance(
    log: DataFrame, bronze: DataFrame, spec: ResourceSpec, history: DataFrame | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """One row per type and day of the log or of bronze.

    entries            entries of the pages, by the log
    written            bronze rows counted while the day was written (NULL without `counts`)
    without_resource   bronze rows of entries that held no resource
    blank_ids          rows whose id is null or blank; they can be no record
    repeats            deliveries of a version that is kept from another row, of whatever day
    kept               versions whose first delivery is of this day
    unaccounted        entries less these four; not zero when rows were lost or doubled
    ids_missing        ids of kept versions that `history` does not hold (NULL without `history`)

    Two shuffles of keys, (id, version) and id; all other sums are per day. `log` and `bronze` are of the one type of `spec`.
    """
    rows = deliveries(bronze, spec)
    kept = first_deliveries(rows).select(*DAY, ID)
    without = F.col("raw_resource_json").isNull()
    usable = trimmed(bronze.select(*DAY, ID, "raw_resource_json")).withColumn("blank", F.coalesce(ID, F.lit("")) == "")
    sums = [
        log.groupBy(*DAY).agg(
            F.sum("records_fetched").cast("long").alias("entries"), F.count_if(F.col("status") == ERROR).alias("pages_in_error")
        ),
        usable.groupBy(*DAY).agg(
            F.count_if(without).alias("without_resource"),
            F.count_if(~without & F.col("blank")).alias("blank_ids"),
            F.count_if(~F.col("blank")).alias("valid"),
        ),
        kept.groupBy(*DAY).agg(F.count(F.lit(1)).alias("kept")),
    ]
    if counts is not None:
        sums.append(counts.groupBy(*DAY).agg(F.sum("rows").alias("written")))
    if history is not None:
        missing = kept.distinct().join(history.select(ID).distinct(), ID, "left_anti")
        sums.append(missing.groupBy(*DAY).agg(F.count(F.lit(1)).alias("ids_missing")))
    none = F.lit(None).cast("long")
    given = [part.select(*DAY, *[F.col(c) if c in part.columns else none.alias(c) for c in SUMS]) for part in sums]
    totals = reduce(DataFrame.unionByName, given).groupBy(*DAY).agg(*[F.sum(c).alias(c) for c in SUMS])
    zeros = [c for c in SUMS if c != "written" and (c != "ids_missing" or history is not None)]
    totals = totals.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in zeros})
    return totals.select(
        *DAY,
        "pages_in_error",
        "entries",
        "written",
        "without_resource",
        "blank_ids",
        (F.col("valid") - F.col("kept")).alias("repeats"),
        "kept",
        (F.col("entries") - F.col("without_resource") - F.col("blank_ids") - F.col("valid")).alias("unaccounted"),
        "ids_missing",
    )


def losses(balance: DataFrame) -> DataFrame:
    """Days that do not balance, with where the rows went: on the write of bronze, in bronze since, or on the way to the history."""
    present = F.col("without_resource") + F.col("blank_ids") + F.col("repeats") + F.col("kept")
    found = balance.select(
        *DAY,
        (F.col("entries") - F.coalesce("written", present)).alias("lost_on_write"),
        (F.coalesce("written", present) - present).alias("lost_since"),
        F.coalesce("ids_missing", F.lit(0).cast("long")).alias("ids_missing"),
    )
    return found.filter("lost_on_write <> 0 or lost_since <> 0 or ids_missing <> 0")
