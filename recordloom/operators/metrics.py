"""Row counts of tables and of writes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recordloom.specs import ID


def layer_metrics(tables: Mapping[str, DataFrame], key: str = ID) -> DataFrame:
    """One row per table: rows, current, historical and distinct keys, each table in one pass.

    Tables without is_current have NULL for current and historical; without `key`, for the keys.
    """

    def measure(name: str, df: DataFrame) -> DataFrame:
        versioned, keyed = "is_current" in df.columns, key in df.columns
        none = F.lit(None).cast("long")
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("total_rows"),
            (F.count_if("is_current") if versioned else none).alias("current_rows"),
            (F.count_if(~F.col("is_current")) if versioned else none).alias("historical_rows"),
            (F.count_distinct(key) if keyed else none).alias("distinct_keys"),
        )

    return reduce(DataFrame.unionByName, [measure(n, df) for n, df in tables.items()])


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """`df` counting itself while it is written: observation.get after the write, no second pass."""
    observation = Observation(name)
    measures = [F.count(F.lit(1)).alias("total_rows")]
    if "is_current" in df.columns:
        measures.append(F.count_if("is_current").alias("current_rows"))
    return df.observe(observation, *measures), observation
