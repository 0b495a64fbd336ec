"""Pages to flat rows, one per bundle entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.specs import CORRUPT, ResourceSpec

LINEAGE = ("extraction_timestamp", "api_url_or_params", "ingestion_date", "resource_type")


def link_url(relation: str) -> Column:
    """URL of a page's link with that relation, NULL when there is none."""
    return F.get(F.filter("link", lambda x: x["relation"] == relation), 0)["url"]


def with_lineage(pages: DataFrame) -> DataFrame:
    """Lineage of each page, taken from the page: when it landed and the URL it came from."""
    return pages.withColumns(
        {
            "extraction_timestamp": F.col("landed_at"),
            "api_url_or_params": F.coalesce(link_url("self"), F.col("page_path")),
        }
    )


def flatten_records(records: DataFrame, spec: ResourceSpec, *keep: str) -> DataFrame:
    """Flat columns of the resource struct `r`, with the struct itself as JSON."""
    flat = [f"{expression} as {column}" for column, expression in spec.flat_columns.items()]
    return records.selectExpr("full_url", *flat, "to_json(r) as raw_resource_json", *keep)


def flatten_bundles(pages: DataFrame, spec: ResourceSpec) -> DataFrame:
    """Bronze rows: one per entry; pages with an empty or missing entry list give none."""
    entries = with_lineage(pages).select(F.explode("entry").alias("entry"), *LINEAGE)
    records = entries.select(F.col("entry.fullUrl").alias("full_url"), F.col("entry.resource").alias("r"), *LINEAGE)
    return flatten_records(records, spec, *LINEAGE)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that lose something on the way to bronze, with the reason."""
    without_resource = F.filter("entry", lambda e: e["resource"].isNull())
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed page")
        .when(~F.col("resourceType").eqNullSafe("Bundle"), "not a bundle")
        .when(F.size(without_resource) > 0, "entry without resource")
    )
    # Of a page that cannot be read nobody knows how many entries it had.
    lost = F.when(F.col(CORRUPT).isNull(), F.when(F.size(without_resource) > 0, F.size(without_resource)).otherwise(0))
    return pages.select(
        "resource_type", "ingestion_date", "page_path", reason.alias("reason"), lost.alias("entries_lost"), CORRUPT
    ).filter("reason is not null")
