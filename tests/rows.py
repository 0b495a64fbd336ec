"""Bronze-like encounter rows for hand-made histories, and the history by brute force."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from recordloom.operators.cleaning import deliveries
from recordloom.specs import ENCOUNTER

RUN = [datetime(2030, 1, day, tzinfo=timezone.utc) for day in range(1, 10)]
DDL = (
    "resource_id string, meta_version_id string, meta_last_updated string, status string, "
    "extraction_timestamp string, full_url string"
)


def bronze(spark, rows):
    """Rows are (id, version, updated, status) and may add extraction time and full URL."""
    filled = [tuple(r) + ("2024-01-01 00:00:00", "u")[len(r) - 4 :] for r in rows]
    df = spark.createDataFrame(filled, DDL)
    absent = [c for c in ENCOUNTER.columns if c != "status"]
    return df.withColumns(
        {
            "extraction_timestamp": F.col("extraction_timestamp").cast("timestamp"),
            **{c: F.lit(None).cast("string") for c in [*absent, "meta_source", "api_url_or_params"]},
            "ingestion_date": F.lit("2024-01-01").cast("date"),
            "resource_type": F.lit("Encounter"),
            "raw_resource_json": F.lit("{}"),
        }
    )


def delivered(spark, rows):
    return deliveries(bronze(spark, rows), ENCOUNTER)


def view(history):
    """(id, version, status, from, to, current) of each row, sorted."""
    form = lambda c: F.date_format(c, "yyyy-MM-dd")
    rows = history.select(
        "resource_id", "meta_version_id", "status", form("valid_from"), form("valid_to"), "is_current"
    ).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(str(x) for x in r))


def brute_force(rows):
    """The same for rows whose `updated` is a day and whose versions are numbers."""
    first = {}
    for r in sorted(rows, key=lambda r: r[4] if len(r) > 4 else ""):
        first.setdefault((r[0], r[1]), r)
    result = []
    for key in {k[0] for k in first}:
        mine = sorted((r for r in first.values() if r[0] == key), key=lambda r: (r[2], int(r[1])))
        kept = [r for i, r in enumerate(mine) if i == 0 or r[3] != mine[i - 1][3]]
        for i, r in enumerate(kept):
            after = kept[i + 1][2] if i + 1 < len(kept) else None
            result.append((r[0], r[1], r[3], r[2], after, after is None))
    return sorted(result, key=lambda r: tuple(str(x) for x in r))
