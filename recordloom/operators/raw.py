"""Bronze of whole records as VARIANT: every field a source sent is kept, and columns are taken from it when they are wanted.

The declared shape of a type drops what it does not name. These rows hold the record itself in Spark's binary form, so a
column that is added to a spec later is read from the stored table, and the landing files are not needed any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.bundles import LINEAGE, flatten_records, with_lineage
from recordloom.specs import LINK, ResourceSpec


def raw_records(texts: DataFrame) -> DataFrame:
    """One row per entry of pages held as text in `value`: full_url, resource (VARIANT) and lineage.

    Narrow. An entry without a resource has NULL. Pages that are not JSON, name a key twice, or are beyond the size of a
    VARIANT give no rows; `unread_pages` lists them.
    """
    pages = texts.withColumn("page", F.try_parse_json("value"))
    pages = with_lineage(pages.withColumn("link", F.try_variant_get("page", "$.link", LINK)))
    # Taken apart in one step and exploded as an expression: of a bare column Spark would test first that it has entries,
    # and for that parse and take apart each page once more.
    listed = F.try_variant_get("page", "$.entry", "array<struct<fullUrl:string,resource:variant>>")
    entries = pages.select(F.explode(listed).alias("entry"), *LINEAGE)
    return entries.select(F.col("entry.fullUrl").alias("full_url"), F.col("entry.resource").alias("resource"), *LINEAGE)


def unread_pages(texts: DataFrame) -> DataFrame:
    """Pages whose text gives no VARIANT."""
    lost = texts.filter(F.try_parse_json("value").isNull())
    return lost.select("resource_type", "ingestion_date", "page_path", F.length("value").cast("long").alias("characters"))


def flatten_raw(records: DataFrame, spec: ResourceSpec) -> DataFrame:
    """Bronze rows with the flat columns of `spec`, from whole records.

    A value that does not fit its declared type is NULL by itself; text that reads as the type, such as "1.5" for a
    number, is taken.
    """
    typed = records.withColumn("r", F.try_variant_get("resource", "$", spec.body))
    return flatten_records(typed, spec, *LINEAGE)
