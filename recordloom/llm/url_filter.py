"""URL rules through a blocked Bloom filter and an exact hash join. Built-in functions only.

A listed canonical URL is a host and a path's beginning, `host/path`. A page's URL is cut into its canonical candidates:
each of its host's last labels with each beginning of its path, for the numbers of labels and the lengths that occur in
the list. Candidates that miss the Bloom filter are certainly not listed; the others are joined with the list by their
text, which removes false positives. The filter has at most MOST_BLOCKS blocks of 256 bits, whatever the length of the
list: a longer list lets more false positives through to the join, never a wrong verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 4  # 64-bit words in a block
BITS = 8  # set per entry, two in each word
ENTRIES_PER_BLOCK = 16
MOST_BLOCKS = 1 << 16  # 2 MiB in all


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or no `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and its bits in each of the block's words."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit("bits"))
    masks = []
    for word in range(WORDS):
        at = [F.shiftrightunsigned(second, 12 * word + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS // WORDS)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), a) for a in at]
        masks.append(bits[0].bitwiseOR(bits[1]))
    return F.pmod(first, F.lit(blocks)), masks


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> bytes:
    """The bits of all blocks in order, 32 bytes each.

    Each block is made by itself, and the bytes of at most MOST_BLOCKS blocks are strung together.
    """
    block, masks = _places(F.col(key), blocks)
    bits = keys.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    filled = bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    every = keys.sparkSession.range(blocks).select(F.col("id").alias("block")).join(filled, "block", "left")
    digits = F.concat(*[F.lpad(F.hex(F.coalesce(f"w{i}", F.lit(0).cast("long"))), 16, "0") for i in range(WORDS)])
    in_order = F.array_sort(F.collect_list(F.struct("block", digits.alias("digits"))))
    return bytes(every.agg(F.unhex(F.array_join(F.transform(in_order, lambda b: b["digits"]), ""))).first()[0])


def may_hold(words: Column, key: Column, blocks: int) -> Column:
    """False only if no such key went into the filter; later words are looked at only where the earlier ones fit."""
    block, masks = _places(key, blocks)
    at = (block * (8 * WORDS) + 1).cast("int")
    word = [F.conv(F.hex(F.substring(words, at + 8 * i, F.lit(8))), 16, -10).cast("long") for i in range(WORDS)]
    hits = [w.bitwiseAND(m) == m for w, m in zip(word, masks, strict=True)]
    return hits[0] & hits[1] & hits[2] & hits[3]


def _candidates(labels: list[int], lengths: list[int]) -> Column:
    """Each of the host's last labels with each beginning of the path, as far as the URL reaches."""
    listed = lambda numbers: f"cast(array({', '.join(map(str, numbers))}) as array<int>)"
    return F.expr(
        f"flatten(transform(filter({listed(labels)}, k -> k <= size(split(host, '[.]'))), "
        f"k -> transform(filter({listed(lengths)}, n -> n <= length(path)), "
        "n -> concat(substring_index(host, '.', -k), substring(path, 1, n)))))"
    )


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", unlisted: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict for every row of `pages`.

    `rules` has host, path (beginning with `/`) and verdict, each host and path once. A rule fits its host and all
    subdomains when the URL's path starts with the rule's. The longest fitting rule wins, of equally long ones the one
    with the longer host. Without one, rule is null and the verdict `unlisted`: the URL is in no list. A null or
    malformed URL has an empty host and path and fits no rule. Repeated rows come back as often; other columns play no
    part. Only URLs that pass the filter are shuffled; the others are judged where they are read.
    """
    listed = stored(rules.select(F.concat("host", "path").alias("rule"), "host", "path", "verdict"))
    shape = listed.agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_set(F.size(F.split("host", "[.]")))).alias("labels"),
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()
    host, path = host_and_path(url)
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    blocks = max(1, min(MOST_BLOCKS, -(-shape["n"] // ENTRIES_PER_BLOCK)))
    # At most 2 MiB, a constant of the plan: rows do not carry it.
    words = F.lit(bloom_filter(listed, "rule", blocks))
    candidates = _candidates(shape["labels"], shape["lengths"])
    probed = parsed.withColumn("hits", F.filter(candidates, lambda key: may_hold(words, key, blocks)))
    none = F.lit(None).cast("string")
    passed = probed.filter(F.size("hits") == 0).select("page_id", "host", "path", none.alias("rule"), F.lit(unlisted).alias("verdict"))
    hit = probed.filter(F.size("hits") > 0).select("page_id", "host", "path", F.posexplode("hits").alias("at", "key"))
    joined = hit.join(listed.select(F.col("rule").alias("key"), "verdict"), "key", "left")
    found = F.when(F.col("verdict").isNotNull(), F.struct(F.length("key").alias("n"), F.col("host_part"), F.col("key"), F.col("verdict")))
    joined = joined.withColumn("host_part", F.length(F.substring_index("key", "/", 1)))
    best = joined.groupBy("page_id", "host", "path").agg(F.max(found).alias("best"), F.count_if(F.col("at") == 0).alias("times"))
    each = best.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    judged = each.select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(unlisted)).alias("verdict")
    )
    return judged.unionByName(passed)
