"""Approximate nearest neighbours by low-dimensional stable projections under a kd-tree.

Unit vectors are multiplied by a few Gaussian directions. As the normal distribution is stable, a squared projected
distance divided by the true one follows chi-square with as many degrees of freedom as there are directions. A kd-tree
over the projections deals the vectors to cells; inside a cell another one orders them by projected distance from a
query. Neighbours are verified in that order, and the search stops when a vector nearer than the fifth found so far
would have so large a projected distance with a probability below 1 - SURE. A query's own cell is searched first; the
distance it gives tells which other cells are worth a visit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.quality import chi_square_quantile
from recordloom.session import stored

NEIGHBOURS = 5
DIRECTIONS = 16
SURE = 0.985
SAMPLE_ROWS = 50_000  # the upper tree's splits are fitted on about so many vectors; all are indexed
CELL_ROWS = 4096
MOST_CELLS = 4096  # of the upper tree; fuller cells are dealt to several blocks
BLOCK_QUERIES = 20_000
LEAF_ROWS = 256
SEED = 23
FOUND = "query_id long, vec_id long, score double"


def directions(width: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, DIRECTIONS))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def split_tree(points: np.ndarray, leaves: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Boxes (lower, upper corners) of a kd-tree with up to `leaves` leaves, cut at medians of the widest dimension.

    They cover all space and do not overlap: a point belongs to the box with lower < point <= upper.
    """
    width = points.shape[1]
    whole = (np.full(width, -np.inf), np.full(width, np.inf))
    open_nodes, done = [(np.arange(len(points)), whole)], []
    while open_nodes and len(open_nodes) + len(done) < leaves:
        rows, (low, high) = open_nodes.pop(0)
        cut = None
        if len(rows) > 1:
            spread = np.ptp(points[rows], axis=0)
            at = int(spread.argmax())
            middle = float(np.median(points[rows, at]))
            left = points[rows, at] <= middle
            if spread[at] > 0 and left.any() and not left.all():
                cut = at, middle, left
        if cut is None:
            done.append((low, high))
            continue
        at, middle, left = cut
        below, above = high.copy(), low.copy()
        below[at] = above[at] = middle
        open_nodes += [(rows[left], (low, below)), (rows[~left], (above, high))]
    return done + [box for _, box in open_nodes]


def _cell_of(projected: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = np.zeros(len(projected), dtype=np.int64)
    for cell in range(len(low)):
        out[((projected > low[cell]) & (projected <= high[cell])).all(axis=1)] = cell
    return out


def _box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    away = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (away * away).sum(axis=-1)


class Block:
    """Vectors of one block under a kd-tree of their projections."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.units = _unit(rows)
        self.projected = self.units @ directions(rows.shape[1])
        groups = [np.arange(len(rows))]
        while any(len(g) > LEAF_ROWS for g in groups):
            split = []
            for g in groups:
                if len(g) <= LEAF_ROWS:
                    split.append(g)
                    continue
                at = int(np.ptp(self.projected[g], axis=0).argmax())
                order = np.argpartition(self.projected[g, at], len(g) // 2)
                split += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
            groups = split
        self.leaves = groups
        self.low = np.array([self.projected[g].min(axis=0) for g in groups])
        self.high = np.array([self.projected[g].max(axis=0) for g in groups])

    def nearest(self, query_id: int, query: np.ndarray, known: float, count: int, factor: float):
        """ids and cosines of up to `count` nearest; `known` is the squared distance that others must beat."""
        unit = query / np.sqrt((query * query).sum())
        point = unit @ directions(len(query))
        reach = _box_distance(point, self.low, self.high)
        at, near = np.zeros(0, dtype=np.int64), np.zeros(0)
        bound = known
        for leaf in np.argsort(reach).tolist():
            if reach[leaf] > bound * factor:
                break
            rows = self.leaves[leaf]
            away = self.projected[rows] - point
            rows = rows[((away * away).sum(axis=1) <= bound * factor) & (self.ids[rows] != query_id)]
            at = np.concatenate([at, rows])
            near = np.concatenate([near, self.units[rows] @ unit])
            if len(near) >= count:
                worst = np.partition(near, len(near) - count)[len(near) - count]
                bound = min(bound, max(2 - 2 * worst, 0.0) + 1e-12)
                stay = near >= worst - 1e-9
                at, near = at[stay], near[stay]
        rows = self.rows[at]
        scores = (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))
        best = np.lexsort((self.ids[at], -scores))[:count]
        return self.ids[at][best], scores[best]


def _search(count: int, factor: float):
    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if block.num_rows and queries.num_rows:
            index = Block(block.column("vec_id").to_numpy(), _matrix(block.column("embedding")))
            rows = _matrix(queries.column("query"))
            for query_id, row, known in zip(queries.column("query_id").to_numpy(), rows, queries.column("known").to_numpy(), strict=True):
                ids, scores = index.nearest(int(query_id), row, float(known), count, factor)
                found.append((np.full(len(ids), query_id), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return run


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and embedding (doubles) of rows that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter("vec_id is not null and embedding is not null").filter(F.coalesce(finite, F.lit(False)))
    return rows.filter(F.exists("embedding", lambda x: x != 0))


def neighbours(
    vectors: DataFrame, query_every: int = 50, count: int = NEIGHBOURS, vec_id: str = "vec_id", embedding: str = "embedding",
    cell_rows: int = CELL_ROWS, sure: float = SURE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine): the `count` nearest found of each query.

    Queries are the rows whose vec_id is divisible by `query_every`, against every other row; equal scores go to the
    smaller vec_id. Vectors that are null, zero or hold null or non-finite components take no part, nor do those of
    another length than most have, or without a vec_id. Rows that repeat a vec_id are candidates each for itself, but one
    query. Extra columns play no part.
    """
    rows = usable(vectors, vec_id, embedding)
    sizes = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if sizes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = sizes["width"], sizes["count"]
    rows = rows.filter(F.size("embedding") == width)
    factor = chi_square_quantile(sure, DIRECTIONS)

    share = min(1.0, SAMPLE_ROWS / total)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 30)) < share * (1 << 30)).select("embedding").toArrow()
    points = _unit(_matrix(sample.column(0))) @ directions(width) if sample.num_rows else np.zeros((1, DIRECTIONS))
    boxes = split_tree(points, max(1, min(MOST_CELLS, -(-total // cell_rows))))
    low, high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])

    def to_cells(batches):
        for batch in batches:
            projected = _unit(_matrix(batch.column(1))) @ directions(width)
            yield pa.RecordBatch.from_arrays([pa.array(_cell_of(projected, low, high)), *batch.columns], ["cell", "vec_id", "embedding"])

    celled = stored(rows.mapInArrow(to_cells, "cell long, vec_id long, embedding array<double>"))
    # At most MOST_CELLS rows.
    full = {r["cell"]: -(-r["count"] // cell_rows) for r in celled.groupBy("cell").count().collect()}
    blocks = np.array([full.get(cell, 1) for cell in range(len(low))])
    several = F.array(*[F.lit(int(b)) for b in blocks])
    queries = celled.filter(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(
        F.min(F.struct("embedding", "cell")).alias("q")
    ).select(F.col("vec_id").alias("query_id"), F.col("q.embedding").alias("query"), F.col("q.cell").alias("cell"))
    queries = stored(queries)
    chunks = max(1, -(-queries.count() // BLOCK_QUERIES))
    chunk = F.pmod(F.xxhash64("query_id"), F.lit(chunks))
    index = celled.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit("part")), F.get(several, F.col("cell").cast("int"))))
    index = index.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.get(several, F.col("cell").cast("int")).cast("long") - 1))
    keys = ["cell", "part", "chunk"]

    def searched(visits: DataFrame) -> DataFrame:
        visits = visits.withColumn("part", parts).withColumn("chunk", chunk)
        return index.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(_search(count, factor), FOUND)

    home = stored(searched(queries.withColumn("known", F.lit(float("inf")))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = home.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == count)
    known = ranked.select("query_id", F.greatest(2 - 2 * F.col("score"), F.lit(0.0)).alias("known"))
    asked = queries.join(known, "query_id", "left").withColumn("known", F.coalesce("known", F.lit(float("inf"))))

    def to_visits(batches):
        for batch in batches:
            points = _unit(_matrix(batch.column(1))) @ directions(width)
            at, cells = [], []
            for row, (point, own, bound) in enumerate(zip(points, batch.column(2).to_numpy(), batch.column(3).to_numpy(), strict=True)):
                worth = np.flatnonzero(_box_distance(point, low, high) <= bound * factor)
                worth = worth[worth != own]
                at += [row] * len(worth)
                cells += worth.tolist()
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(cells, pa.int64()), taken.column(3)], ["query_id", "query", "cell", "known"])

    visits = asked.select("query_id", "query", "cell", "known").mapInArrow(to_visits, "query_id long, query array<double>, cell long, known double")
    every = home.unionByName(searched(visits))
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
