"""Best-fit packing with certified bin counts.

Documents become runs of ids and an end id; runs longer than a sequence are cut, and a full piece is a sequence by
itself. The other pieces are dealt to groups of bounded size and packed by best-fit decreasing. For each group, bounds
from dual feasible functions say how few sequences any packing needs. A group that meets its bound is done. The groups
that do not give up the pieces of all sequences that are not full; these are dealt out anew, across groups, and packed
again, for as long as that saves sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.tokens import default_path, forget, release, tokens
from recordloom.session import stored

CAPACITY = 2048
GROUP_PIECES = 50_000
MOST_ROUNDS = 8  # of exchange; each must save sequences
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "group long, row long, bin int, offset int, fill int, bins int, bound int"


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        words = tokens(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        names = [f.split()[0] for f in PIECES.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = words.ids(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((row, doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    row += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def pieces(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of all documents; `row` tells repeated documents apart. Written once, so later readers see the same rows."""
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(texts.mapInArrow(_cut(path or default_path(), capacity, end_id), PIECES))


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing can undercut: the best of the volume bound and two families of dual feasible functions.

    u_k rounds x (k+1) / C down to k-ths when it is no whole number; f_l counts pieces above C - l as whole bins and
    drops those below l. Sums of either over all pieces, rounded up, bound the bins from below.
    """
    counts = np.bincount(lengths.astype(np.int64), minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    total = int((counts * sizes).sum())
    best = -(-total // capacity)
    for k in range(1, 33):
        scaled = sizes * (k + 1)
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)  # times k * capacity
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    below = np.concatenate([[0], np.cumsum(counts)])  # pieces shorter than l
    volume = np.concatenate([[0], np.cumsum(counts * sizes)])
    for low in range(1, capacity // 2 + 1):
        whole = int(below[-1] - below[capacity - low + 1])
        middle = int(volume[capacity - low + 1] - volume[low])
        best = max(best, whole - (-middle // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins; ties go to the first piece and the last opened bin."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), dtype=np.int32)
    offsets = np.empty(len(lengths), dtype=np.int32)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when a bin with room r is open
    opened = 0
    for at, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, number = capacity, opened
            opened += 1
        bins[at], offsets[at] = number, capacity - room
        if left := room - length:
            by_room[left].append(number)
            rooms |= 1 << left
    return bins, offsets, opened


def _pack(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        forget()
        rows = rows.sort_values("row")
        lengths = rows["length"].to_numpy()
        bins, offsets, opened = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=opened).astype(np.int32)
        return pd.DataFrame(
            {"group": rows["group"].to_numpy(), "row": rows["row"].to_numpy(), "bin": bins, "offset": offsets,
             "fill": fill[bins], "bins": opened, "bound": least_bins(lengths, capacity)}
        ).astype({"bins": np.int32, "bound": np.int32})

    return run


def _dealt(rows: DataFrame, count: int, first: int, turn: int, group_pieces: int) -> DataFrame:
    """Every row in one of the groups numbered from `first`, of about `group_pieces` rows."""
    groups = max(1, round(count / group_pieces))
    return rows.withColumn("group", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)) + F.lit(first))


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """`cut` (row, length, ...) with sequence_id and offset.

    A full piece is a sequence of its own. No piece makes no sequence. Equal pieces are told apart by `row` alone.
    """
    small = cut.filter(F.col("length") < capacity).select("row", "length")
    count = small.count()
    packed = stored(_dealt(small, count, 0, 0, group_pieces).groupBy("group").applyInPandas(_pack(capacity), PLACED))
    done = []
    first = 1 << 20
    for turn in range(1, MOST_ROUNDS + 1):
        open_rows = packed.filter((F.col("bins") > F.col("bound")) & (F.col("fill") < capacity))
        bins = open_rows.select("group", "bin").distinct()
        before, count = bins.count(), open_rows.count()
        if before < 2:
            break
        loose = open_rows.join(small, "row").select("row", "length")
        again = stored(_dealt(loose, count, first, turn, group_pieces).groupBy("group").applyInPandas(_pack(capacity), PLACED))
        if again.select("group", "bin").distinct().count() >= before:
            break
        done.append(packed.filter((F.col("bins") <= F.col("bound")) | (F.col("fill") == capacity)))
        packed, first = again, first + (1 << 20)
    for part in done:
        packed = packed.unionByName(part)
    placed = packed.select("row", (F.col("group") * (1 << 22) + F.col("bin")).alias("sequence_id"), F.col("offset").cast("long"))
    full = cut.filter(F.col("length") == capacity).select("*", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return cut.filter(F.col("length") < capacity).join(placed, "row").select(full.columns).unionByName(full)


def packed_documents(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone. Repeated rows are packed as often as they come; a null doc_id stays null.
    Other columns of `documents` play no part.
    """
    return pack(pieces(documents, path, capacity, end_id), capacity).drop("row")
