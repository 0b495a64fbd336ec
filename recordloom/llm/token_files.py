"""Token counts from flat, unindexed token files.

A token file is nothing but ids, two bytes each, with an end id after every document. It is read in blocks of one size,
which cut documents anywhere. Each block is searched for the end id at once; it yields the lengths between its own ends,
the ids before its first and those after its last. A prefix sum over blocks, in two levels, tells how many ids of the
document that a block begins with lie in earlier blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm.tokens import default_path, tokens
from recordloom.session import new_folder, stored

END_ID = 0  # of the files; a tokenizer's id i is stored as i + 1
PAD_ID = 65_535
BLOCK_IDS = 1 << 16
RUN_BLOCKS = 1024
WIDTH = 2


def _documents_as_ids(path: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = tokens(path), 0
        for batch in batches:
            out = []
            for text in batch.column(0):
                ids = np.frombuffer(words.ids(text.as_py()), dtype="<u4") + 1
                if ids.size and ids.max() >= PAD_ID:
                    raise ValueError("the vocabulary does not fit two bytes")
                out.append(ids.astype("<u2").tobytes())
                total += len(ids) + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])
        if lacking := -total % block_ids:
            lacking += block_ids * (lacking == 1)  # padding needs an id before its end id
            yield pa.RecordBatch.from_arrays([pa.array([np.full(lacking - 1, PAD_ID, dtype="<u2").tobytes()], pa.binary())], ["ids"])

    return run


def write_token_files(documents: DataFrame, folder: str, path: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Token files of `documents`, one per task, filled up with PAD_ID to whole blocks.

    A null or empty text is its end id alone.
    """
    texts = documents.select(F.col("text").cast("string"))
    ids = texts.mapInArrow(_documents_as_ids(path or default_path(), block_ids), "ids binary")
    # The end id is two zero bytes, which is what the text writer puts after every row.
    ids.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\0\0").text(folder)


def read_blocks(spark: SparkSession, folder: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """split, at (of the block within its split) and ids (bytes) of all files, which Spark splits at whole blocks."""
    records = spark.sparkContext.binaryRecords(folder, block_ids * WIDTH)
    rows = records.mapPartitionsWithIndex(lambda split, it: ((split, at, ids) for at, ids in enumerate(it)))
    return spark.createDataFrame(rows, "split int, at long, ids binary")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, heads, tails, inner = [], [], [], []
        for raw in batch.column(2):
            ids = np.frombuffer(raw.as_buffer(), dtype="<u2")
            at = np.flatnonzero(ids == END_ID)
            lengths = np.diff(at) - 1
            if len(at) > 1 and ids[at[-1] - 1] == PAD_ID:
                lengths[-1] = -1  # padding, not a document
            ends.append(len(at))
            heads.append(-1 if ids[0] == PAD_ID else int(at[0]) if len(at) else len(ids))
            tails.append(len(ids) - 1 - int(at[-1]) if len(at) else len(ids))
            inner.append(lengths)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ends, pa.int64()), pa.array(heads, pa.int64()), pa.array(tails, pa.int64()), pa.array(inner, pa.list_(pa.int64()))],
            ["split", "at", "ends", "head", "tail", "inner"],
        )


def count_tokens(blocks: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """split, block, document (its number among those that end in the block) and n_tokens of every document.

    Documents of no tokens count, with 0; padding is no document. Without blocks there are no rows.
    """
    scanned = stored(blocks.mapInArrow(_scan, "split int, at long, ends long, head long, tail long, inner array<long>"))
    scanned = scanned.withColumn("run", F.expr(f"at div {RUN_BLOCKS}"))
    # A run of blocks carries on what is open after its last end, and, if it has no end, all of itself.
    runs = scanned.groupBy("split", "run").agg(
        F.max(F.when(F.col("ends") > 0, F.struct("at", "tail"))).alias("last"), F.max("at").alias("final"), F.count("*").alias("n")
    )
    open_ids = F.when(
        F.col("last").isNotNull(), F.col("last.tail") + (F.col("final") - F.col("last.at")) * block_ids
    ).otherwise(F.col("n") * block_ids)
    runs = runs.select("split", "run", F.col("last").isNotNull().alias("closes"), open_ids.alias("open"))
    order = Window.orderBy("split", "run")
    carried = _carry(stored(runs), ["split", "run"], [], order)
    own = scanned.select("split", "run", "at", "ends", "head", "inner", (F.col("ends") > 0).alias("closes"), F.col("tail").alias("open"))
    within = _carry(own, ["at"], ["split", "run"], Window.partitionBy("split", "run").orderBy("at"))
    joined = within.join(carried.select("split", "run", F.col("before").alias("run_before")), ["split", "run"])
    first = F.when(F.col("head") < 0, F.lit(-1)).otherwise(
        F.col("head") + F.col("before") + F.when(F.col("none_closed"), F.col("run_before")).otherwise(0)
    )
    lengths = F.concat(F.array(first), "inner")
    done = joined.filter("ends > 0").select("split", F.col("at").alias("block"), F.posexplode(lengths).alias("document", "n_tokens"))
    return done.filter("n_tokens >= 0")


def _carry(df: DataFrame, order_columns: list[str], keys: list[str], window) -> DataFrame:
    """`before`: ids left open by the rows before; `none_closed`: whether none of them closes a document."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    closed = F.coalesce(F.count_if("closes").over(earlier), F.lit(0))
    df = df.withColumn("part", closed)
    # Ids open since the last row that closes: that row's own, and all of those after it.
    part = Window.partitionBy(*keys, "part") if keys else Window.partitionBy("part")
    through = F.sum("open").over(part.orderBy(*order_columns).rowsBetween(Window.unboundedPreceding, -1))
    last_close = F.last(F.when(F.col("closes"), F.col("open")), ignorenulls=True).over(earlier)
    return df.withColumns(
        {"before": F.coalesce(last_close, F.lit(0)) + F.coalesce(through, F.lit(0)), "none_closed": F.col("part") == 0}
    ).drop("part")


def counted_documents(documents: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write token files of `documents` to the shared folder and count every document's tokens from the files alone."""
    spark = documents.sparkSession
    folder = new_folder(spark, "tokens")
    write_token_files(documents, folder, block_ids=block_ids)
    return count_tokens(read_blocks(spark, folder, block_ids), block_ids)
