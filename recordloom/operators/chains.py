"""Feeds as chains of pages: where each page's next links lead, found by list ranking with doubled pointers.

Each round every page that has not reached an end looks up where the page it points to points, so pointers double their
reach: a feed of n pages takes log2(n) joins on the URL, however the pages were named, numbered or landed. Rounds follow the
longest feed, also where feeds go round, and not the number of pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.bundles import link_url
from recordloom.session import stored
from recordloom.specs import CORRUPT

DAY = ("resource_type", "ingestion_date")
COMPLETE, BROKEN, CYCLE = "complete", "broken", "cycle"


def page_links(pages: DataFrame) -> DataFrame:
    """URL and next URL of every readable page; a page without a link of its own has its path as URL."""
    readable = pages.filter(F.col(CORRUPT).isNull())
    return readable.select(*DAY, F.coalesce(link_url("self"), "page_path").alias("url"), link_url("next").alias("next_url"))


def ranked_pages(links: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """One row per URL: the end its links lead to, and how many steps away that is.

    `links` has url, next_url and the columns of `by`, within which links count. `ending` is `complete` when the last
    page has no next link, `broken` when its next page (`missing`) did not land, and `cycle` when there is no last page;
    then `end` is the least URL of the cycle and `steps` null. `head` tells that no other page leads here. Of a URL that
    landed several times the least next link counts; `landed` is the number of times, `ways` that of different links.
    Rows without a URL, or with a null in `by`, are left out.
    """
    by = list(by)
    usable = links.filter(F.forall(F.array(*[F.col(c).isNotNull() for c in [*by, "url"]]), lambda given: given))
    nodes = usable.groupBy(*by, "url").agg(
        F.min("next_url").alias("next_url"), F.count(F.lit(1)).alias("landed"), F.count_distinct("next_url").alias("ways")
    )
    nodes = stored(nodes)
    known = nodes.select(*by, F.col("url").alias("next_url"), F.lit(True).alias("found"))
    found = F.coalesce("found", F.lit(False))
    pointers = nodes.join(known, [*by, "next_url"], "left").select(
        *by,
        "url",
        F.when(found, F.col("next_url")).otherwise(F.col("url")).alias("at"),
        found.cast("long").alias("steps"),
        F.col("url").alias("least"),
        found.alias("going"),
        F.lit(True).alias("lowered"),
    )
    frames = [stored(pointers)]
    while not frames[-1].filter("going").isEmpty() and not _all_round(frames, by):
        going, ended = frames[-1].filter("going"), [f.filter("not going") for f in frames]
        ahead = reduce(DataFrame.unionByName, [*ended, going]).select(
            *by, F.col("url").alias("at"), *[F.col(c).alias(f"{c}_ahead") for c in ("at", "steps", "least", "going")]
        )
        moved = going.join(ahead, [*by, "at"]).select(
            *by,
            "url",
            F.col("at_ahead").alias("at"),
            (F.col("steps") + F.col("steps_ahead")).alias("steps"),
            F.least("least", "least_ahead").alias("least"),
            F.col("going_ahead").alias("going"),
            (F.col("least_ahead") < F.col("least")).alias("lowered"),
        )
        frames.append(stored(moved))
    # What still goes on points into a cycle, and has seen all of it; the page pointed to has seen nothing else.
    endless = frames[-1].filter("going")
    around = endless.select(*by, F.col("url").alias("at"), F.col("least").alias("end"))
    none = F.lit(None).cast("string")
    cycles = endless.join(around, [*by, "at"]).select(
        *by, "url", "end", F.lit(None).cast("long").alias("steps"), F.lit(CYCLE).alias("ending"), none.alias("missing")
    )
    ended = reduce(DataFrame.unionByName, [f.filter("not going") for f in frames])
    tails = nodes.select(*by, F.col("url").alias("at"), F.col("next_url").alias("missing"))
    ending = F.when(F.col("missing").isNull(), COMPLETE).otherwise(BROKEN)
    ended = ended.join(tails, [*by, "at"]).select(*by, "url", F.col("at").alias("end"), "steps", ending.alias("ending"), "missing")
    led_to = nodes.filter("next_url <> url").select(*by, F.col("next_url").alias("url"), F.lit(False).alias("head")).distinct()
    ranked = nodes.join(ended.unionByName(cycles), [*by, "url"]).join(led_to, [*by, "url"], "left")
    return ranked.withColumn("head", F.coalesce("head", F.lit(True)))


def _all_round(frames: Sequence[DataFrame], by: Sequence[str]) -> bool:
    """Whether all that still goes on goes round, and has seen the least URL of its cycle.

    The pages pointed to get fewer each round until only those of cycles are left. Once none of them has found a lesser URL
    in a round, no cycle is longer than what each has seen.
    """
    if len(frames) == 1 or not frames[-1].filter("going and lowered").isEmpty():
        return False
    before, now = (f.filter("going").select(*by, "at").distinct().count() for f in frames[-2:])
    return before == now


def feeds(ranked: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """One row per feed: its end, pages, steps of its longest way, beginnings, and URLs that landed with different links.

    More than one beginning means that feeds run together.
    """
    return ranked.groupBy(*by, "end", "ending", "missing").agg(
        F.count(F.lit(1)).alias("pages"),
        F.max("steps").alias("longest"),
        F.count_if("head").alias("heads"),
        F.count_if(F.col("ways") > 1).alias("forks"),
    )


def day_feeds(found: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Per group of `by` the number of feeds, and of those that break off, go round, or run together."""
    return found.groupBy(*by).agg(
        F.count(F.lit(1)).alias("feeds"),
        F.count_if(F.col("ending") == BROKEN).alias("broken"),
        F.count_if(F.col("ending") == CYCLE).alias("cycles"),
        F.count_if(F.col("heads") > 1).alias("merged"),
    )
