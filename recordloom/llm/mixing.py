"""Mixing sources to target weights by temperature, realised as budgeted permutations of blocks.

A source's weight is its share of all tokens raised to an exponent, normalised. The exponent is bisected: towards 0 the
mix becomes even, which raises its entropy and repeats small sources more often; at 1 it is the corpus itself. Given a
target entropy the exponent meets it; given a repetition limit it is the smallest that keeps every source within it.

Each source then fills its part of the token budget: as many whole passes as fit, and a last pass cut short. For it,
documents are hashed to blocks of about a thousand, the blocks stand in a permuted order, documents within a block too;
blocks are taken until the budget is met, and the last one in part. What a source takes is thus told by one row: passes,
the last block's place, and where in that block the cut is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from recordloom.llm.tokens import default_path, release, tokens
from recordloom.session import stored

REPEAT_LIMIT = 1.25
BLOCK_DOCUMENTS = 1000
SEED = 17
SLICE_BITS = 18  # of a block's place: a source has at most 2^18 slices
LEVELS = 5  # of bisection per job
JOBS = 8


def _token_counter(path: str):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()  # what tasks of other kinds left free in this worker
        words = tokens(path)
        for column in batches:
            yield pa.array([len(words.ids(text.as_py())) // 4 for text in column], pa.int64())

    return run


def token_counts(text: str | Column = "text", path: str | None = None) -> Column:
    """Tokens of a text, without an end id; 0 for null."""
    return arrow_udf(_token_counter(path or default_path()), "bigint")(text)


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def _key(salt: str) -> Column:
    """A hash of a document that repeated rows share."""
    return F.xxhash64(F.lit(SEED), F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def exponent(sources: DataFrame, entropy: float | None = None, repeats: float | None = REPEAT_LIMIT, budget: float = 1.0) -> float:
    """The exponent in [0, 1] for `sources` (share). `budget` is a multiple of all tokens.

    With `entropy` (natural units), the exponent whose mix has it, or the nearest end. Otherwise the smallest exponent
    under which no source is passed over more than `repeats` times; 1 when even that is too often. Without sources 1.
    """
    low, high = 0.0, 1.0
    if sources.isEmpty():
        return high
    for _ in range(JOBS):
        steps = (1 << LEVELS) - 1
        points = [low + (high - low) * (i + 1) / (steps + 1) for i in range(steps)]
        powers = [F.pow("share", F.lit(p)) for p in points]
        sums = [F.sum(p).alias(f"z{i}") for i, p in enumerate(powers)]
        logs = [F.sum(p * F.log(p)).alias(f"l{i}") for i, p in enumerate(powers)]
        most = [F.max(p / F.col("share")).alias(f"m{i}") for i, p in enumerate(powers)]
        row = sources.agg(*sums, *(logs if entropy is not None else most)).first()
        if entropy is not None:  # entropy falls as the exponent grows
            too_low = [(row[f"z{i}"] and _entropy(row[f"z{i}"], row[f"l{i}"])) > entropy for i in range(steps)]
        else:
            too_low = [row[f"m{i}"] * budget / row[f"z{i}"] > repeats for i in range(steps)]
        at = sum(too_low)  # both conditions hold up to one point and not after it
        edges = [low, *points, high]
        low, high = edges[at], edges[at + 1]
    return high


def _entropy(z: float, l: float) -> float:
    """Of weights p / z, with l the sum of p log p."""
    import math

    return math.log(z) - l / z


def mix_plan(counted: DataFrame, budget_tokens: int | None = None, entropy: float | None = None, repeats: float | None = REPEAT_LIMIT) -> DataFrame:
    """One row per source of `counted` (doc_id, source, n_tokens): what it gives to the mix.

    source, n_tokens, weight, quota, passes (whole ones), blocks, last_place (of the block that is cut) and last_key
    (documents of that block with a smaller key are taken). The budget is all tokens unless given.
    """
    sized = counted.select(_source().alias("source"), F.col("n_tokens"), F.col("doc_id")).filter("n_tokens > 0")
    sources = stored(sized.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_documents")))
    total = sources.agg(F.sum("n_tokens")).first()[0] or 0
    budget = total if budget_tokens is None else budget_tokens
    shares = sources.withColumn("share", F.col("n_tokens") / F.lit(max(total, 1)))
    power = exponent(shares, entropy, repeats, budget / max(total, 1))
    norm = shares.agg(F.sum(F.pow("share", F.lit(power)))).first()[0] or 1.0
    weights = shares.withColumn("weight", F.pow("share", F.lit(power)) / norm)
    weights = weights.withColumn("quota", F.round(F.col("weight") * budget).cast("long"))
    weights = weights.withColumn("passes", F.expr("quota div n_tokens"))
    weights = weights.withColumn("rest", F.col("quota") - F.col("passes") * F.col("n_tokens"))
    weights = stored(weights.withColumn("blocks", F.ceil(F.col("n_documents") / BLOCK_DOCUMENTS).cast("long")))

    keyed = sized.join(weights.select("source", "blocks"), "source").withColumn("block", _block())
    totals = keyed.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    totals = stored(totals.withColumn("place", _place()))
    # Sums in two levels, so that no task holds all blocks of a source: over slices of the places, then in the cut slice.
    totals = totals.withColumn("slice", F.shiftright("place", 64 - SLICE_BITS))
    slices = totals.groupBy("source", "slice").agg(F.sum("block_tokens").alias("slice_tokens"))
    over_slices = F.sum("slice_tokens").over(Window.partitionBy("source").orderBy("slice")) - F.col("slice_tokens")
    slices = slices.withColumn("start", over_slices).join(weights.select("source", "rest"), "source")
    slices = slices.filter("start <= rest and rest < start + slice_tokens").select("source", "slice", "start", "rest")
    along = Window.partitionBy("source").orderBy("place", "block")
    before = F.col("start") + F.sum("block_tokens").over(along) - F.col("block_tokens")
    cut = totals.join(stored(slices), ["source", "slice"]).withColumn("before", before)
    cut = stored(cut.filter("before <= rest and rest < before + block_tokens"))
    inside = keyed.join(cut.select("source", "block", "before", "rest"), ["source", "block"])
    by_key = inside.groupBy("source", "block", "before", "rest", _key("order").alias("key")).agg(F.sum("n_tokens").alias("n_tokens"))
    within = Window.partitionBy("source", "block").orderBy("key")
    stays = by_key.withColumn("upto", F.col("before") + F.sum("n_tokens").over(within)).filter("upto > rest")
    last = stays.groupBy("source").agg(F.min("key").alias("last_key"))
    out = weights.join(cut.select("source", F.col("place").alias("last_place"), F.col("block").alias("last_block")), "source", "left")
    out = out.join(last, "source", "left")
    return stored(out.select("source", "n_tokens", "weight", "quota", "passes", "blocks", "last_place", "last_block", "last_key"))


def _block() -> Column:
    return F.pmod(_key("block"), F.col("blocks"))


def _place() -> Column:
    """Sorting by it permutes a source's blocks."""
    return F.xxhash64(F.lit(SEED), F.lit("place"), "source", "block")


def mixed(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """`documents` as often as the plan takes each, with `mix_pass` (from 0), `mix_block`, `mix_place` and `mix_order`.

    A pass goes through a source's blocks by (mix_place, mix_block) and through a block's documents by mix_order, so
    sorting by these follows the permutation. Equal doc_ids share a mix_order. Documents without tokens take no part and are left out. A null source is a source of its own. Rows that repeat a
    doc_id are taken or left together in the last pass.
    """
    side = plan.select(F.col("source").alias("_source"), "passes", "blocks", "last_place", "last_block", "last_key")
    joined = documents.withColumn("_source", _source()).join(side, "_source")
    block = F.pmod(_key("block"), F.col("blocks"))
    place = F.xxhash64(F.lit(SEED), F.lit("place"), "_source", block)
    earlier = (place < F.col("last_place")) | ((place == F.col("last_place")) & (block < F.col("last_block")))
    partly = (block == F.col("last_block")) & (_key("order") < F.coalesce("last_key", F.lit((1 << 63) - 1)))
    times = F.col("passes") + F.coalesce(earlier | partly, F.lit(False)).cast("long")
    rows = joined.withColumns({"mix_block": block, "mix_place": place, "mix_order": _key("order"), "times": times})
    rows = rows.filter("times > 0")
    rows = rows.withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return rows.drop("_source", "passes", "blocks", "last_place", "last_block", "last_key", "times")


def mixture(documents: DataFrame, **target) -> DataFrame:
    """One row for each time a document is taken: doc_id, source, n_tokens, the columns of `mixed`, the source's weight."""
    counted = stored(documents.select("doc_id", "source", token_counts("text").alias("n_tokens")))
    plan = mix_plan(counted, **target)
    taken = mixed(counted.filter("n_tokens > 0"), plan)
    weights = plan.select(F.col("source").alias("_source"), "weight")
    return taken.withColumn("_source", _source()).join(weights, "_source").drop("_source")


def keep_mixed(documents: DataFrame, **target) -> DataFrame:
    """`documents`, each as often as the mix takes it. All columns come back as they were, whatever their names."""
    counted = stored(documents.select("doc_id", "source", token_counts("text").alias("n_tokens")))
    rows = documents.select("doc_id", "source", F.struct("*").alias("document")).filter("document.text <> ''")
    return mixed(rows, mix_plan(counted, **target)).select("document.*")
