"""Near copies by word shingles: an exact similarity join that filters by prefixes of several global token orders.

A token is the 64-bit hash of a shingle. Two sets of sizes n and m with Jaccard similarity 0.8 or more share at least
need(n, m) tokens, so under *every* order of all tokens the first token they share stands early in both: at most
n - need tokens come before it in the one, m - need in the other. Orders put rare tokens first, so a token that no other
text has never joins anything, and a text whose early tokens are all its own is settled without being compared.

1. Texts with equal sets form a class, named by the hash of the set. All that follows is about classes.
2. Tokens are dealt out by value in packed rows, counted, and those in two or more classes go back to their class.
3. Candidates share a token in their prefixes under the first order. The other orders' prefixes must meet as well before
   a pair's sets are compared. In each token's list the most central class is compared with all others first; components
   of these links are labelled, and then every remaining pair of *different* components is compared. A large group of
   near copies is one component by then, so its pairs are never listed, and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from recordloom.llm.components import smallest_reachable
from recordloom.llm.scan import LOWER, blocks, mixed, span_hashes, word_spans
from recordloom.llm.tokens import forget
from recordloom.session import stored

WORDS = 5
FACTORS = np.array([3, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)
ORDERS = 3
FLUSH_TOKENS = 1 << 20  # packed per task before rows are written
SLICE_TOKENS = 1 << 20  # about what a task holds at once of the tokens dealt to it
BROADCAST_IDS = 1_000_000
KNOWN_SETS = 1 << 20  # sets a task remembers, so that it sends copies once

SETS = "doc_id long, n_shingles long, set_id long"
PACKED = "bucket int, owners array<long>, sizes array<int>, counts array<int>, tokens array<long>"
SHARED = "bucket int, owners array<long>, sizes array<int>, counts array<int>, tokens array<long>, df array<int>"
CANDIDATES = (
    "set_id long, n int, central float, tokens array<long>, "
    + "first array<struct<token:long,pos:int>>, "
    + ", ".join(f"order{k} array<long>" for k in range(1, ORDERS))
)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of every text of a column of bytes."""
    for first, last, raw, bounds in blocks(column):
        buffer = LOWER[raw]
        starts, ends, before = word_spans(buffer, bounds)
        words = span_hashes(buffer, starts, ends)
        windows = np.zeros(max(len(words) - WORDS + 1, 0), dtype=np.uint64)
        for at in range(WORDS):
            windows += words[at : at + len(windows)] * FACTORS[at]
        windows = mixed(windows)
        for row in range(first, last):
            low, high = before[row - first], before[row - first + 1]
            if high - low >= WORDS:
                yield row, np.unique(windows[low : high - WORDS + 1])
            elif high > low:
                whole = (words[low:high] * FACTORS[: high - low]).sum(keepdims=True) + np.uint64(high - low)
                yield row, mixed(whole)
            else:
                yield row, windows[:0]


def set_name(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _summaries(batches):
    for batch in batches:
        rows = [(len(s), set_name(s) if len(s) else None) for _, s in shingle_sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
            ["doc_id", "n_shingles", "set_id"],
        )


def summaries(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and set_id (null for a text without words) per row."""
    return documents.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(_summaries, SETS)


def _lists(values: np.ndarray, lengths, kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _packed(bucket: np.ndarray, owner: np.ndarray, size: np.ndarray, columns: list[tuple[np.ndarray, pa.DataType]]):
    """One row per bucket: its owners in runs, and the columns' values run by run. `owner` is sorted within each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, owner, size = bucket[order], owner[order], size[order]
    new_bucket = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    runs = np.flatnonzero(new_bucket | np.concatenate([[True], owner[1:] != owner[:-1]]))
    counts = np.diff(np.append(runs, len(bucket)))
    tops = np.flatnonzero(new_bucket)
    per_bucket = np.diff(np.append(tops, len(bucket)))
    runs_per_bucket = np.diff(np.append(np.searchsorted(runs, tops), len(runs)))
    return [
        pa.array(bucket[tops], pa.int32()),
        _lists(owner[runs], runs_per_bucket, pa.int64()),
        _lists(size[runs], runs_per_bucket, pa.int32()),
        _lists(counts, runs_per_bucket, pa.int32()),
    ] + [_lists(values[order], per_bucket, kind) for values, kind in columns]


def _token_rows(buckets: int):
    def run(batches):
        forget()
        names = [f.split()[0] for f in PACKED.split(", ")]
        known: set[int] = set()
        held, total = [], 0

        def flush():
            tokens = np.concatenate([s for _, s in held])
            lengths = [len(s) for _, s in held]
            owner = np.repeat(np.array([o for o, _ in held], dtype=np.int64), lengths)
            size = np.repeat(np.array(lengths, dtype=np.int32), lengths)
            bucket = (tokens % np.uint64(buckets)).astype(np.int32)
            return pa.RecordBatch.from_arrays(_packed(bucket, owner, size, [(tokens.view(np.int64), pa.int64())]), names)

        for batch in batches:
            for _, tokens in shingle_sets(batch.column(0)):
                if not len(tokens) or (name := set_name(tokens)) in known:
                    continue
                if len(known) >= KNOWN_SETS:
                    known.clear()
                known.add(name)
                held.append((name, tokens))
                total += len(tokens)
                if total >= FLUSH_TOKENS:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def _unpacked(table: pa.Table):
    """Owner, size and every list column, one entry per token."""
    flat = {c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in table.column_names[1:]}
    return {
        "owner": np.repeat(flat["owners"], flat["counts"]),
        "size": np.repeat(flat["sizes"], flat["counts"]),
        **{c: flat[c] for c in flat if c not in ("owners", "sizes", "counts")},
    }


def _by_bucket(function):
    """Run `function` on all rows of one bucket at a time. A partition's rows are sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(bucket)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if held and high > low and held[0].column(0)[0].as_py() != bucket[low]:
                    yield from function(pa.Table.from_batches(held)).to_batches()
                    held = []
                if high > low:
                    held.append(batch.slice(low, high - low))
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches()

    return run


def _dealt(packed: DataFrame, partitions: int, slices: int) -> DataFrame:
    """Rows of a bucket in one partition, and bucket by bucket there."""
    spread = packed.repartitionById(partitions, F.col("bucket") % partitions)
    return spread.sortWithinPartitions("bucket") if slices > 1 else spread


def _count(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        flat = _unpacked(table)
        tokens, owner, size = flat["tokens"], flat["owner"], flat["size"]
        order = np.argsort(tokens)
        same = tokens[order][1:] == tokens[order][:-1]
        order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        tokens, owner, size = tokens[order], owner[order], size[order]
        order = np.lexsort((owner, tokens))
        tokens, owner, size = tokens[order], owner[order], size[order]
        first = np.ones(len(tokens), dtype=bool)
        first[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        tokens, owner, size = tokens[first], owner[first], size[first]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, int)
        lengths = np.diff(np.append(starts, len(tokens)))
        df = np.repeat(lengths, lengths)
        shared = df > 1
        tokens, owner, size, df = tokens[shared], owner[shared], size[shared], df[shared]
        order = np.argsort(owner, kind="stable")
        tokens, owner, size, df = tokens[order], owner[order], size[order], df[order]
        bucket = (owner.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        columns = _packed(bucket, owner, size, [(tokens, pa.int64()), (df, pa.int32())]) if len(tokens) else None
        names = [f.split()[0] for f in SHARED.split(", ")]
        if columns is None:
            return pa.table({n: pa.array([], t) for n, t in zip(names, _SHARED_TYPES)})
        return pa.Table.from_arrays(columns, names)

    return run


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_SHARED_TYPES = [pa.int32(), _LONGS, _INTS, _INTS, _LONGS, _INTS]
_STRUCTS = pa.list_(pa.struct([("token", pa.int64()), ("pos", pa.int32())]))
_CANDIDATE_TYPES = [pa.int64(), pa.int32(), pa.float32(), _LONGS, _STRUCTS] + [_LONGS] * (ORDERS - 1)


def _order_key(k: int, tokens: np.ndarray, df: np.ndarray):
    """Sort keys of order k: rare first; later orders tell frequencies apart by powers of two only."""
    spread = mixed(tokens.view(np.uint64) + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (spread, df if k == 0 else np.floor(np.log2(df)))


def _prefixes(table: pa.Table) -> pa.Table:
    flat = _unpacked(table)
    order = np.argsort(flat["owner"], kind="stable")
    owner, size, tokens, df = (flat[c][order] for c in ("owner", "size", "tokens", "df"))
    names = ["set_id", "n", "central", "tokens", "first"] + [f"order{k}" for k in range(1, ORDERS)]
    own_values, lists, places = [], [[] for _ in range(ORDERS + 1)], []
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
    for low, high in zip(starts, np.append(starts, len(owner))[1:], strict=True):
        n, own = int(size[low]), int(size[low]) - int(high - low)
        length = n - (4 * n + 4) // 5 + 1
        if own >= length:  # the whole prefix is this text's own
            continue
        t, f = tokens[low:high], df[low:high]
        for k in range(ORDERS):
            lists[k].append(t[np.lexsort(_order_key(k, t, f))[: length - own]])
        lists[ORDERS].append(np.sort(t))
        places.append(np.arange(own, own + len(lists[0][-1]), dtype=np.int32))
        own_values.append((int(owner[low]), n, float(np.log2(f).sum() / n)))
    if not own_values:
        return pa.table({n: pa.array([], t) for n, t in zip(names, _CANDIDATE_TYPES, strict=True)})
    first, *others, whole = [_lists(np.concatenate(parts), [len(x) for x in parts], pa.int64()) for parts in lists]
    entries = pa.StructArray.from_arrays([first.values, pa.array(np.concatenate(places))], fields=list(_STRUCTS.value_type))
    scalars = [pa.array(list(c), t) for c, t in zip(zip(*own_values, strict=True), _CANDIDATE_TYPES[:3], strict=True)]
    return pa.Table.from_arrays([*scalars, whole, pa.ListArray.from_arrays(first.offsets, entries), *others], names)


def candidate_classes(
    documents: DataFrame, text: str = "text", buckets: int | None = None, shingles: int = 0
) -> DataFrame:
    """Classes that may have a near copy, with the tokens they share with any other and their prefixes.

    `shingles` is about how many tokens all sets have. Tokens are dealt to `buckets` partitions, and within each to as many
    slices as keep one near SLICE_TOKENS, so that what a task holds does not grow with the input.
    """
    spark = documents.sparkSession
    partitions = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-shingles // (partitions * SLICE_TOKENS)))
    buckets = partitions * slices
    packed = documents.select(F.col(text).cast("binary").alias("text")).mapInArrow(_token_rows(buckets), PACKED)
    shared = _dealt(packed, partitions, slices).mapInArrow(_by_bucket(_count(buckets)), SHARED)
    return stored(_dealt(shared, partitions, slices).mapInArrow(_by_bucket(_prefixes), CANDIDATES))


def need(n: Column | str, m: Column | str) -> Column:
    """The least overlap of sets of sizes n and m whose similarity is 0.8: 4/9 of both sizes, rounded up."""
    return ((F.lit(4) * (F.col(n) + F.col(m)) + 8) / 9).cast("int")


def _linked(batches):
    for batch in batches:
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        lists = {}
        for name in ("tokens", *[f"order{k}" for k in range(1, ORDERS)]):
            for side in "ab":
                c = columns[f"{side}_{name}"]
                lists[side, name] = (c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False))

        def cut(side, name, row):
            offsets, values = lists[side, name]
            return values[offsets[row] : offsets[row + 1]]

        def meets(row, name):
            return np.isin(cut("a", name, row), cut("b", name, row)).any()

        n, m = columns["a_n"].to_numpy(), columns["b_n"].to_numpy()
        found = []
        for row in range(batch.num_rows):
            if all(meets(row, f"order{k}") for k in range(1, ORDERS)):
                common = np.intersect1d(cut("a", "tokens", row), cut("b", "tokens", row), assume_unique=True).size
                if 100 * common >= 80 * (int(n[row]) + int(m[row]) - common):
                    found.append(row)
        yield pa.RecordBatch.from_arrays([columns["a"].take(pa.array(found, pa.int64())), columns["b"].take(pa.array(found, pa.int64()))], ["a", "b"])


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose prefixes meet under the other orders and whose sets are similar enough."""
    names = ["n", "tokens"] + [f"order{k}" for k in range(1, ORDERS)]
    sides = [classes.select(F.col("set_id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in names]) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_linked, "a long, b long")


def _pair(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _early(x: str, y: str) -> Column:
    """The shared token stands early enough in both."""
    overlap = need(f"{x}.n", f"{y}.n")
    return (F.col(f"{x}.pos") <= F.col(f"{x}.n") - overlap) & (F.col(f"{y}.pos") <= F.col(f"{y}.n") - overlap)


def class_components(classes: DataFrame) -> DataFrame:
    """(id, label) of classes that a chain of links joins."""
    entries = stored(
        classes.select("set_id", "n", "central", F.explode("first").alias("e")).select(
            "set_id", "n", "central", F.col("e.token").alias("token"), F.col("e.pos").alias("pos")
        )
    )
    best = F.max(F.struct("central", "set_id", "n", "pos")).alias("hub")
    hubs = entries.groupBy("token").agg(best, F.count("*").alias("members")).filter("members > 1")
    hubs = hubs.select("token", "hub.set_id", "hub.n", "hub.pos")
    near = entries.alias("x").join(hubs.alias("y"), "token").filter("x.set_id <> y.set_id").filter(_early("x", "y"))
    links = stored(_verified(stored(near.select(*_pair("x.set_id", "y.set_id")).distinct()), classes))
    labels = stored(smallest_reachable(links)).withColumnsRenamed({"id": "set_id"})

    marked = entries.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id")).drop("central")
    marked = stored(marked)
    main = (
        marked.groupBy("token", "label").count().groupBy("token")
        .agg(F.count("*").alias("labels"), F.max(F.struct("count", "label"))["label"].alias("main")).filter("labels > 1").drop("labels")
    )
    marked = stored(marked.join(main, "token"))
    rest = (
        marked.filter("label <> main").alias("x").join(marked.alias("y"), "token")
        .filter("x.label <> y.label").filter(_early("x", "y")).select(*_pair("x.set_id", "y.set_id")).distinct()
    )
    more = stored(_verified(stored(rest), classes))
    if more.isEmpty():
        return labels.withColumnsRenamed({"set_id": "id"})
    # Only the components themselves are joined now.
    for side in "ab":
        named = labels.select(F.col("set_id").alias(side), F.col("label").alias(f"{side}_label"))
        more = more.join(named, side, "left").withColumn(side, F.coalesce(f"{side}_label", side)).drop(f"{side}_label")
    merged = stored(smallest_reachable(more))
    known = labels.join(merged.select(F.col("id").alias("label"), F.col("label").alias("to")), "label", "left")
    known = known.select(F.col("set_id").alias("id"), F.coalesce("to", "label").alias("label"))
    return known.unionByName(merged.join(known.select("id"), "id", "left_anti"))


def near_copies(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) per row.

    Words are split at ASCII white space after A-Z are lower-cased; a text with fewer than five words is one shingle. A
    null, empty or blank text has no shingles and links with nothing. Rows with the same doc_id are rows of their own; a
    null doc_id is never a component's name unless the component has no other. Other columns play no part.
    """
    known = stored(summaries(documents, doc_id, text))
    names = _components(known, documents, text, buckets)
    least = names.groupBy("label").agg(F.min("least.doc_id").alias("component_id"))
    named = stored(names.join(least, "label").select("set_id", "component_id"))
    return known.join(named, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _components(known: DataFrame, documents: DataFrame, text: str, buckets: int | None) -> DataFrame:
    """set_id, label and the least row (no_id, doc_id, set_id) per class of a component of two rows or more."""
    shingles = known.agg(F.sum("n_shingles")).first()[0] or 0
    joined = class_components(candidate_classes(documents, text, buckets, shingles))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "set_id")
    names = known.filter("set_id is not null").groupBy("set_id").agg(F.min(row).alias("least"), F.count("*").alias("copies"))
    names = stored(names.join(joined.withColumnsRenamed({"id": "set_id"}), "set_id", "left").filter("copies > 1 or label is not null"))
    return names.withColumn("label", F.coalesce("label", "set_id"))


def _set_names(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    forget()
    for column in batches:
        yield pa.array([set_name(s) if len(s) else None for _, s in shingle_sets(column)], pa.int64())


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of `documents` per component, and all rows without shingles.

    The row with the least doc_id stays; one without a doc_id only where none has any. A row is told by its doc_id and its
    set of shingles, so another text under a removed doc_id is not touched. Of rows equal in both, one stays.
    """
    known = stored(summaries(documents))
    names = _components(known, documents, "text", None)
    best = names.groupBy("label").agg(F.min("least").alias("best"))
    named = stored(names.join(best, "label").select("set_id", "best"))
    rows = known.filter("set_id is not null").groupBy("doc_id", "set_id").agg(F.count("*").alias("copies")).join(named, "set_id")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("set_id") == F.col("best.set_id"))
    rows = stored(rows.select(F.col("doc_id").alias("_id"), F.col("set_id").alias("_name"), "copies", stays.alias("stays")).filter("not stays or copies > 1"))

    # Not called deterministic, or else Spark copies it into the filter of the semi join: a second scan, by a second worker.
    out = documents.withColumn("_set", arrow_udf(_set_names, "long").asNondeterministic()(F.col("text").cast("binary")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_set") == F.col("_name"))
    gone, repeated = rows.select("_id", "_name"), rows.filter("stays").select("_id", "_name")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)  # at most 16 MB of ids and names; more are joined by a shuffle
    kept = out.join(gone, same, "left_anti").select(documents.columns)
    if repeated.isEmpty():
        return kept
    # Tasks reduce equal rows before the shuffle.
    one = out.join(repeated, same, "left_semi").groupBy(F.col("doc_id").cast("long"), "_set")
    one = one.agg(F.first(F.struct(*documents.columns)).alias("row"))
    return kept.unionByName(one.select("row.*"))
