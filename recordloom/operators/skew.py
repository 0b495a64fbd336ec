"""Finding the few keys that hold very many rows.

The keys only choose a plan: both ways of treating a key give the same rows, so a key that is missed
or listed needlessly costs time, never rows. They are looked up once and then fixed, so that the two
sides of a split cannot disagree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import stored

HOT_ROWS = 1_000_000
HITS = 1_000  # rows of a key with HOT_ROWS rows that the look-up is expected to meet


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """Keys with about `rows` rows or more; there are at most as many as `rows` goes into the number of rows.

    Reads the key column only and counts a sample sized by `rows`: a key with `rows` rows is met about
    HITS times, half of that makes it hot. Counts are added up before they are shuffled.
    """
    fraction = min(1.0, HITS / rows)
    found = df.select(key) if fraction == 1.0 else df.select(key).sample(fraction, seed=1)
    least = rows if fraction == 1.0 else HITS / 2
    counts = found.groupBy(key).agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") >= least)
    return counts.select(key)


def split_hot(
    df: DataFrame, key: str, rows: int = HOT_ROWS, among: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """`df` as (rows of ordinary keys, rows of hot keys or None where no key is hot).

    The keys are looked up in `among` instead, if given: it has about as many rows of each key of `df`, or more.
    """
    hot = stored(hot_keys(df if among is None else among, key, rows))
    if hot.isEmpty():
        return df, None
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")
