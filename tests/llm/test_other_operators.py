"""Neighbours, URL rules and shards, the pipeline, and every query with SQL."""

import numpy as np
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import ann, shards, url_filter
from recordloom.llm.oracles import ORACLES
from recordloom.llm.queries import QUERIES, URL_RULES, ready


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_the_sql_gives(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def exact(rows, query, count=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    q = x[ids == query][0]
    scores = (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum())
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:count]
    return [(int(ids[i]), scores[i]) for i in order]


def test_neighbours_recall_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op1_nearest_neighbours"](spark, folder).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == {i for i, _ in rows if i % 50 == 0}
    hits = 0
    for query, found in got.items():
        assert sorted(found) == [1, 2, 3, 4, 5]
        want = exact(rows, query)
        hits += len({v for v, _ in want} & {v for v, _ in found.values()})
        for (v, s), (w, t) in zip([found[k] for k in range(1, 6)], want):
            assert v != w or abs(s - t) < 1e-12
    assert hits >= 0.9 * 5 * len(got)


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 400)]
    odd = [(500, None), (550, [0.0] * 8), (600, [float("nan")] + [1.0] * 7), (650, [None] + [1.0] * 7), (700, [float("inf")] * 8), (750, [1.0, 2.0]), (None, [1.0] * 8)]
    df = ready(spark).createDataFrame([(i, v, 0, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rank int, cell string")
    got = {}
    for r in ann.neighbours(df, cell_rows=40).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i, _ in rows if i % 50 == 0}
    for query in (300, 350):  # ties go to the smaller id
        assert [v for _, v, _ in sorted(got[query])] == [i for i in range(300, 306) if i != query][:5]
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in exact(rows, q)}) for q in got)
    assert hits >= 0.9 * 5 * len(got)
    assert ann.neighbours(df.filter("vec_id = 0")).count() == 0
    assert ann.neighbours(df.limit(0)).count() == 0
    assert ann.neighbours(df.filter("vec_id in (0, 1, 2)")).count() == 2


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "http://a.com?x=/en/", "HTTPS://WWW.Example.COM/en/1#a", "http://www.example.com/EN/1",
    "http://b.example.com/en/", "http://example.com/en", "http://notexample.com/en/x", "http://x.net/es/1", "http://net/fr/", "http://x.org/en/", "a://b://c.com/en/",
    "http://é.example.com/en/ü?q", "http://example.com./en/", "http://.com/", "x://" + "a." * 500 + "net/es/" + "b" * 3000, "http://x.net\n/fr/a",
]


def test_url_rules(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate(URLS + URLS[5:9])] + [(3, "http://"), (3, "http://"), (None, None)][:0]
    df = ready(spark).createDataFrame(rows + [(4, "http://com", "h", "p"), (None, "http://a.net/es/", "h", "p")], "page_id long, url string, host string, verdict string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, url_filter.judge_urls(df.select("page_id", "url", F.lit(1).alias("hits")), rules).collect()), key=str)
    want = sorted(((r["page_id"], *brute_verdict(r["url"], URL_RULES)) for r in df.collect()), key=str)
    assert got == want
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(df, rules.limit(0)).collect()} == {"allow"}


def test_long_list_of_url_rules(spark):
    """Hosts of one to six labels, beginnings of many lengths: over a hundred shapes and several blocks."""
    names = ["a", "b", "net", "org", "x-y", "news"]
    host = lambda n: ".".join(names[(n // 6**i) % 6] for i in range(1 + n % 6))
    path = lambda n: "/" + "d" * (n % 23) + "/" * (n % 2)
    rules = sorted({(host(n * 7919), path(n), "block" if n % 3 else "allow") for n in range(4000)})
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    urls = [(n, f"http://{host(n * 31)}.{host(n * 7919)}{path(n * 5)}rest/{n % 4}?q") for n in range(600)]
    got = url_filter.judge_urls(
        ready(spark).createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")
    )
    assert sorted(map(tuple, got.collect())) == sorted((n, *brute_verdict(u, rules)) for n, u in urls)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bloom_filter_never_misses_and_removes_most(spark):
    keys = ready(spark).range(5000).select(F.concat(F.lit("h"), "id").alias("key"))
    blocks = 5000 // url_filter.ENTRIES_PER_BLOCK
    bits = url_filter.bloom_filter(keys, "key", blocks)
    assert len(bits) == 32 * blocks
    probe = spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("key"), "id")
    hits = probe.filter(url_filter.may_hold(F.lit(bits), F.col("key"), blocks)).select("id").collect()
    assert sum(r["id"] < 5000 for r in hits) == 5000 and len(hits) < 5000 + 0.05 * 15_000


def test_url_rules_make_no_python(spark, folder):
    for name in ("op5_url_filters", "op8_license_scans"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_shards(spark):
    names = [f"s{i}" for i in range(7)]
    table = shards.fill_table(names, 211)
    sizes = np.bincount(table, minlength=7)
    assert sizes.max() - sizes.min() <= 1
    # One shard fewer: its slots go to others, and few of the others' change.
    after = shards.fill_table(names[:-1], 211)
    assert shards.moved(table, after) <= 211 // 7 + 211 // 4
    with pytest.raises(ValueError):
        shards.fill_table(names, 210)
    df = ready(spark).createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "doc_id long, slot string")
    rows = shards.placed(df, names, 211).collect()
    assert len(rows) == 4 and len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    assert all(names[table[r["slot"]]] == r["shard"] for r in rows)
    assert shards.placed(df.limit(0), names, 211).count() == 0


def brute_table(names, slots):
    """Turn by turn, with whole preference lists."""
    order = [[(start + k * step) % slots for k in range(slots)] for start, step in (shards.preference(n, slots) for n in names)]
    owner, at = [None] * slots, [0] * len(names)
    while None in owner:
        for i in range(len(names)):
            if None in owner:
                while owner[order[i][at[i]]] is not None:
                    at[i] += 1
                owner[order[i][at[i]]] = i
    return owner


def test_shard_query_against_brute_force(spark, folder):
    import hashlib

    assert shards.fill_table(["a", "b", "c"], 13) == brute_table(["a", "b", "c"], 13)
    owner = shards.fill_table([f"shard-{n:03d}" for n in range(shards.SHARDS)])
    for r in QUERIES["op9_sharding"](spark, folder).collect():
        slot = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % shards.SLOTS
        assert (r["slot"], r["shard"]) == (slot, f"shard-{owner[slot]:03d}")


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if at < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            assert 0 < out.count() <= 1.3 * docs.count()
        docs = out
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()
    assert corpus_pipeline.run(spark, folder).count() == docs.count()
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
