"""Connected components of a link table, as joins that carry the smallest label along."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import stored


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(id, label) for every id in `links` (a, b): the smallest id its links lead to. Empty links give no rows.

    Every round hangs each neighbourhood on its smallest member: first larger neighbours of each id, then each id's
    smaller neighbours. Stars remain, after a number of rounds that grows with the logarithm of the longest path. Each
    round is written to the shared folder.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (
            both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(
            F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")
        )
        edges = stored(small.filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
            )
        before = now
