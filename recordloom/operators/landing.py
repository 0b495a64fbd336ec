"""Records to numbered pages, and pages to the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import stored
from recordloom.sources.pages import landing_path
from recordloom.specs import PAGE_SIZE, ResourceSpec

BASE_URL = "https://records.example/api"
ROW_BITS = 33  # monotonically_increasing_id holds the row of its partition in the low 33 bits


def with_row_index(df: DataFrame) -> DataFrame:
    """Add `index`, 0-based and without gaps, and `total`.

    Counts rows per partition and adds the counts of the partitions before, so no row is shuffled
    and nothing is sorted. The broadcast side has one row per partition. `df` is read twice and must
    give the same rows in the same order: a scan with narrow steps, or a stored table.
    """
    placed = df.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", ROW_BITS))
    in_part = F.col("_at") - F.shiftleft("_part", ROW_BITS)
    sizes = placed.groupBy("_part").agg((F.max(in_part) + 1).alias("rows"))
    whole, before = Window.partitionBy(), Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"),
        F.sum("rows").over(whole).alias("total"),
    )
    joined = placed.join(F.broadcast(starts), "_part")
    return joined.withColumn("index", F.col("_start") + in_part).drop("_at", "_part", "_start")


def entry_texts(records: DataFrame) -> DataFrame:
    """Records (`full_url`, `r`) as the JSON text of their bundle entries, in `entry`; narrow."""
    entry = F.struct(F.col("full_url").alias("fullUrl"), F.col("r").alias("resource"))
    return records.select(F.to_json(entry).alias("entry"))


def to_pages(
    records: DataFrame, spec: ResourceSpec, page_size: int = PAGE_SIZE, base_url: str = BASE_URL
) -> DataFrame:
    """Bundles of `page_size` records (`full_url`, `r`) as JSON text: columns page_number, value.

    All pages but the last are full, and each but the last links to the next. See with_row_index for
    what `records` must hold to.
    """
    return paged(entry_texts(records), spec, page_size, base_url)


def paged(entries: DataFrame, spec: ResourceSpec, page_size: int = PAGE_SIZE, base_url: str = BASE_URL) -> DataFrame:
    """The same from `entry_texts`: records are stored, sorted and shuffled as text, and written as it."""
    url = f"{base_url}/{spec.name}?_count={page_size}&page="
    numbered = with_row_index(entries).withColumn("page_number", F.floor(F.col("index") / page_size) + 1)
    pages = numbered.groupBy("page_number").agg(
        F.collect_list(F.struct("index", "entry")).alias("entries"), F.ceil(F.max("total") / page_size).alias("pages")
    )

    def link(relation, number):
        return F.struct(F.lit(relation).alias("relation"), F.concat(F.lit(url), number.cast("string")).alias("url"))

    number = F.col("page_number")
    here, onward = link("self", number), link("next", number + 1)
    in_order = F.array_sort("entries")  # by index, the first field
    head = F.to_json(
        F.struct(
            F.lit("Bundle").alias("resourceType"),
            F.format_string("page_%04d", number).alias("id"),
            F.when(number < F.col("pages"), F.array(here, onward)).otherwise(F.array(here)).alias("link"),
        )
    )
    texts = F.array_join(F.transform(in_order, lambda e: e["entry"]), ",")
    value = F.concat(F.rtrim(head, F.lit("}")), F.lit(',"entry":['), texts, F.lit("]}"))
    return pages.select("page_number", value.alias("value"))


def land_pages(
    records: DataFrame,
    root: str,
    spec: ResourceSpec,
    day: str,
    page_size: int = PAGE_SIZE,
    one_per_file: bool = False,
) -> str:
    """Write the pages of one resource type and day, replacing that day; returns the folder.

    Default is one page per line, many per file. The records are stored first, so that a lost executor
    cannot number them differently on the second try. Files are compressed, each is read by one task.
    """
    path = landing_path(root, spec.name, day)
    pages = paged(stored(entry_texts(records)), spec, page_size).select("value")
    pages.write.mode("overwrite").option("maxRecordsPerFile", 1 if one_per_file else 0).text(path, compression="lz4")
    return path
