"""Placement of documents on shards by a lookup table that the shards fill in turns.

Each shard prefers the slots of a prime-sized table in an order of its own: a start and a step, both from its name; as
the size is prime, every step visits every slot. In turns each shard claims the first slot it prefers that is still
free, until none is. A document's hash picks a slot. Shards hold equal numbers of slots, give or take one per turn and
weight, and when a shard comes or goes few slots change hands.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = 64


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Start and step of a shard's order of slots."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """Number of the shard that owns each slot. The table has `slots` entries, however many documents there are."""
    if not is_prime(slots) or not names or len(set(names)) != len(names) or len(names) > slots:
        raise ValueError("slots must be a prime no smaller than the number of shards, and shard names distinct")
    owner = [-1] * slots
    turns = [preference(name, slots) for name in names]
    at = [start for start, _ in turns]
    free = slots
    while free:
        for shard, (_, step) in enumerate(turns):
            if not free:
                break
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step) % slots
            owner[at[shard]] = shard
            free -= 1
    return owner


def slot(key: str | Column, slots: int = SLOTS) -> Column:
    """The slot of a key's text: 60 bits of its MD5 modulo the table's size. Null counts as the empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(slots))


def placed(documents: DataFrame, names: list[str], slots: int = SLOTS, key: str = "doc_id") -> DataFrame:
    """`documents` with `slot` and `shard`, by one look-up per row and no shuffle.

    Rows with the same key go to the same shard; columns named slot or shard are replaced.
    """
    spark = documents.sparkSession
    owner = fill_table(names, slots)
    rows = [(at, shard, names[shard]) for at, shard in enumerate(owner)]
    # `slots` rows, a parameter: the broadcast does not grow with the documents.
    table = F.broadcast(spark.createDataFrame(rows, "slot long, shard_no int, shard string").drop("shard_no"))
    return documents.drop("slot", "shard").withColumn("slot", slot(key, slots)).join(table, "slot")


def write_shards(documents: DataFrame, names: list[str], path: str, slots: int = SLOTS, key: str = "doc_id", files: int = 8) -> None:
    """Write one folder per shard. A shard's rows are dealt to `files` tasks, so no task gets a whole shard."""
    rows = placed(documents, names, slots, key)
    dealt = rows.repartition(len(names) * files, "shard", F.pmod(F.xxhash64(key), F.lit(files)))
    dealt.write.partitionBy("shard").parquet(path)


def moved(before: list[int], after: list[int]) -> int:
    """Slots whose owner differs between two tables of one size."""
    return sum(a != b for a, b in zip(before, after, strict=True))
