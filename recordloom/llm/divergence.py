"""How far the sources of a language differ, from hash-consed segment trees over term ids.

A term's probability in a group, in billionths and smoothed by one, depends on its count there and on the group's size;
the price of a term between two groups on the two probabilities. Terms get ids by falling frequency. Over each block of
ids every group has a segment tree whose leaves are its counts; subtrees with equal counts are one node, within a group
and across groups. Two trees are walked down together, level by level; a pair of nodes that is met again is only counted,
so its leaves are priced once. Where both groups lack a run of terms, as most do for most terms, one price stands for all.
All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import stored

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
BLOCK_BITS = 13  # a block has 2**BLOCK_BITS term ids; a task holds as many counts per group of a language
COUNTED = 200_000  # terms a task counts before it hands them on
PIECE = 1 << 20  # bytes of a long text that are split at once

# Terms are runs of ASCII letters and of all bytes of other characters; only A-Z are lower-cased.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes) -> Counter[bytes]:
    clean = text.translate(TERM_BYTES)
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        counts.update(clean[at:end].split())
        at = end
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uses: dict[tuple[str, str], Counter] = defaultdict(Counter)
    texts: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in uses.items():
            terms = pa.array(list(counts), pa.binary()).cast(pa.string())
            n, docs = list(counts.values()), [texts[lang, source][t] for t in counts]
            columns = [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        uses.clear()
        texts.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found, mine = terms_of(text), uses[lang, source]
            held -= len(mine)
            mine.update(found)
            texts[lang, source].update(found.keys())
            held += len(mine)
            if held > COUNTED:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows with it), stored; rows of `documents` hold no nulls."""
    counted = documents.select("lang", "source", F.col("text").cast("binary")).mapInArrow(
        _count, "lang string, source string, term string, n long, docs long"
    )
    return stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def with_ids(kept: DataFrame) -> DataFrame:
    """`kept` (lang, term, total) with `id`, stored: terms of a language that are about as frequent get neighbouring ids.

    Ids have gaps between the ranges that tasks sort. Within a block, those of one language have none.
    """
    order = ["lang", F.col("total").desc(), "term"]
    ranges = kept.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranges.withColumn("id", F.monotonically_increasing_id()))


# --- trees ------------------------------------------------------------------------------------


class Trees:
    """Segment trees over the rows of a matrix of counts, with equal subtrees shared; a negative count is no leaf."""

    def __init__(self, counts: np.ndarray):
        height = max(int(counts.shape[1] - 1).bit_length(), 0)
        padded = np.full((counts.shape[0], 1 << height), -1, dtype=np.int64)
        padded[:, : counts.shape[1]] = counts
        self.leaves, at = np.unique(padded, return_inverse=True)
        at = at.reshape(padded.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        nodes = len(self.leaves)
        for _ in range(height):
            both, where = np.unique(at[:, 0::2] * nodes + at[:, 1::2], return_inverse=True)
            self.children.append((both // nodes, both % nodes))
            at = where.reshape(at.shape[0], -1)
            nodes = len(both)
        self.roots = at[:, 0]

    def pairs(self, first: int, second: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of counts at the same leaf of two trees, and how often each occurs."""
        a, b, times = self.roots[[first]], self.roots[[second]], np.ones(1, dtype=np.int64)
        for at in range(len(self.children) - 1, -1, -1):
            left, right = self.children[at]
            below = len(self.children[at - 1][0]) if at else len(self.leaves)
            keys = np.concatenate([left[a] * below + left[b], right[a] * below + right[b]])
            both, where = np.unique(keys, return_inverse=True)
            total = np.zeros(len(both), dtype=np.int64)
            np.add.at(total, where, np.concatenate([times, times]))
            a, b, times = both // below, both % below, total
        leaf = self.leaves[a] >= 0
        return self.leaves[a[leaf]], self.leaves[b[leaf]], times[leaf]


def scaled(counts: np.ndarray, size: int) -> np.ndarray:
    """Smoothed probabilities in billionths; `size` is the group's occurrences plus the number of terms."""
    counts = counts + 1
    if len(counts) and counts.max() > (1 << 62) // SCALE:
        return np.array([1 + SCALE * c // size for c in counts.tolist()], dtype=np.int64)
    return 1 + SCALE * counts // size


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _walk(cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Prices between all groups of a language over one block of terms."""
    groups = groups.sort_values("source")
    names, sizes = groups["source"].to_numpy(), groups["size"].to_numpy()
    counts = np.zeros((len(names), int(groups["width"].iloc[0])), dtype=np.int64)
    row = pd.Index(names).get_indexer(cells["source"])
    counts[row, cells["leaf"].to_numpy() - int(groups["first"].iloc[0])] = cells["n"].to_numpy()
    trees = Trees(counts)
    a, b, values = [], [], []
    for i in range(len(names)):
        for j in range(i):
            here, there, times = trees.pairs(i, j)
            p, q = scaled(here, int(sizes[i])), scaled(there, int(sizes[j]))
            a += [names[i], names[j]]
            b += [names[j], names[i]]
            values += [int((times * price(p, q)).sum()), int((times * price(q, p)).sum())]
    lang = [groups["lang"].iloc[0]] * len(a)
    return pd.DataFrame({"lang": lang, "source": a, "item": b, "value": np.array(values, dtype=np.int64)})


# --- the audit --------------------------------------------------------------------------------


def _share(count: str, size: str) -> Column:
    return F.expr(f"1 + (cast({count} + 1 as decimal(28,0)) * {SCALE}) div cast({size} as decimal(20,0))")


def _ranked(rows: DataFrame) -> DataFrame:
    along = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(along))


def divergence(documents: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank for the groups (lang, source) of `documents`.

    Part `pair` has each other source of the language with the sum of its terms' prices, part `term` up to TOP_TERMS of
    the terms that are more probable in the group than in the language. Null text, lang and source are empty texts.
    Repeated rows count as often as they occur. A language without kept terms has pairs of value 0, one with a single
    source no pairs. Equal values stand in the order of their items' bytes. Extra columns play no part; an empty table
    gives no rows. The result has one row per two sources of a language; a task holds one block of terms of a language.
    """
    filled = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = term_counts(filled)
    per_term = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    terms = with_ids(per_term.filter(F.col("docs") >= LEAST_DOCUMENTS).drop("docs"))
    cells = stored(counts.drop("docs").join(terms, ["lang", "term"]))

    of_lang = terms.groupBy("lang").agg(F.count("*").alias("terms"), (F.sum("total") + F.count("*")).alias("lang_size"))
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("uses"))
    groups = filled.select("lang", "source").distinct().join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
    size = F.coalesce("uses", F.lit(0)) + F.coalesce("terms", F.lit(0))
    groups = stored(groups.select("lang", "source", size.alias("size"), "lang_size"))

    block, leaf = F.shiftright("id", BLOCK_BITS).alias("block"), F.col("id").bitwiseAND((1 << BLOCK_BITS) - 1)
    blocks = terms.groupBy("lang", block).agg(F.min(leaf).alias("first"), F.count("*").alias("width"))
    sides = groups.join(blocks, "lang").select("lang", "block", "source", "size", "first", "width")
    walked = (
        cells.select("lang", block, "source", leaf.alias("leaf"), "n")
        .groupBy("lang", "block")
        .cogroup(sides.groupBy("lang", "block"))
        .applyInPandas(_walk, "lang string, source string, item string, value long")
    )
    summed = walked.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("item"))
    couples = groups.select("lang", "source").join(others, "lang").filter("source <> item")
    pairs = couples.join(summed, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))

    likely = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _share("n", "size").alias("p"), _share("total", "lang_size").alias("q")
    )
    prices = likely.filter("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))
    top = _ranked(prices).filter(F.col("rank") <= TOP_TERMS)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    of_pairs = _ranked(pairs).withColumn("part", F.lit("pair")).select(*columns)
    return of_pairs.unionByName(top.withColumn("part", F.lit("term")).select(*columns))
