"""Compare a registered query with its SQL, value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql) -> str | None:
    """None when both give the same columns and the same bag of rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    wanted = bag(names, result.fetchall())
    got = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if not wanted:
        return "the SQL gives no rows"
    if got != wanted:
        extra, lacking = got - wanted, wanted - got
        return f"{sum(extra.values())} rows too many {list(extra)[:2]}, {sum(lacking.values())} missing {list(lacking)[:2]}"
    return None
