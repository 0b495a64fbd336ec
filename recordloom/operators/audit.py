"""What was landed: one log row per page, and one per page that should be there but is not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.bundles import link_url
from recordloom.specs import CORRUPT

# File name pattern and status words of the ingestion log.
PAGE_NUMBER = r"page_(\d+)"
ID_IN_TEXT = r'"id"\s*:\s*"page_\d+"'
SUCCESS, ERROR = "SUCCESS", "ERROR"

LOG_COLUMNS = (
    "log_id",
    "resource_type",
    "api_url",
    "page_number",
    "records_fetched",
    "extraction_timestamp",
    "save_timestamp",
    "status",
    "error_message",
    "ingestion_date",
)


def _digits(text):
    return F.nullif(F.regexp_extract(text, PAGE_NUMBER, 1), F.lit(""))


def audit_pages(pages: DataFrame) -> DataFrame:
    """Ingestion log rows.

    The page number comes from the file name, or from the bundle id where a file holds many pages (of
    a malformed page, from the id in its text). A
    page whose next link leads to a page that did not land gives an ERROR row for that page, so a
    feed that stopped early shows. Row ids depend on the page only: a second audit gives the same.
    """
    file_name = F.substring_index("page_path", "/", -1)
    own_id = F.regexp_extract(CORRUPT, ID_IN_TEXT, 0)
    digits = F.coalesce(_digits(file_name), _digits(F.col("id")), _digits(own_id))
    number = digits.try_cast("int")
    error = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed page")
        .when(~F.col("resourceType").eqNullSafe("Bundle"), "not a bundle")
        .when(digits.isNotNull() & number.isNull(), "page number does not fit")
    )
    seen = pages.select(
        "resource_type",
        "ingestion_date",
        "page_path",
        "landed_at",
        number.alias("page_number"),
        F.md5(F.col(CORRUPT).cast("binary")).alias("broken_text"),
        F.when(F.col("entry").isNull(), 0).otherwise(F.size("entry")).alias("records_fetched"),
        error.alias("error_message"),
        link_url("self").alias("own_url"),
        link_url("next").alias("next_url"),
    )
    landed = seen.select(
        "*", F.coalesce("own_url", "page_path").alias("api_url"), F.col("landed_at").alias("save_timestamp")
    )
    place = ["resource_type", "ingestion_date", "page_number"]
    expected = seen.filter("next_url is not null and page_number is not null").withColumn(
        "page_number", F.col("page_number") + 1
    )
    missing = expected.join(seen.select(*place), place, "left_anti").select(
        *place,
        "page_path",
        "landed_at",
        F.lit(0).alias("records_fetched"),
        F.lit("next page not landed").alias("error_message"),
        F.col("next_url").alias("api_url"),
        F.lit(None).cast("timestamp").alias("save_timestamp"),
    )
    rows = landed.unionByName(missing, allowMissingColumns=True)
    return rows.withColumns(
        {
            "log_id": F.md5(F.concat_ws("|", "resource_type", "page_path", F.col("page_number").cast("string"), "error_message", "broken_text")),
            "extraction_timestamp": F.col("landed_at"),
            "status": F.when(F.col("error_message").isNull(), SUCCESS).otherwise(ERROR),
        }
    ).select(*LOG_COLUMNS)


def day_totals(log: DataFrame) -> DataFrame:
    """Pages, records and errors per resource type and day."""
    return log.groupBy("resource_type", "ingestion_date").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("records_fetched").alias("records"),
        F.count_if(F.col("status") == ERROR).alias("errors"),
    )
