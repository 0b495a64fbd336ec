"""Text operators against plain Python on small tables with odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import jaccard_join, language, licenses, mixing, packing, quality, token_files
from recordloom.llm.queries import QUERIES, ready
from recordloom.llm.tokens import default_path, tokens

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, component_id string, counts string, block int"


def word(i):
    return "".join("abcdefghij"[int(c)] for c in str(i))


def prose(seed, n=120):
    rng = np.random.default_rng(seed)
    return " ".join(word(i) for i in rng.integers(0, 500, n))


def edited(text, at, new):
    words = text.split(" ")
    words[at] = new
    return " ".join(words)


BASE = prose(1)
TEXTS = [
    BASE,
    edited(BASE, 50, "x"),
    edited(BASE, 60, "y"),
    edited(edited(BASE, 10, "q"), 80, "r"),
    BASE.upper(),
    BASE,
    prose(2),
    prose(3) + "\n" + prose(3),
    "one two three four",
    "One  two\tthree\nfour",
    "one two three",
    "",
    None,
    "   \n\t ",
    "a",
    "ß é " * 40,
    "Released under the MIT License.\nfoo. Licensed under the Apache License, Version 2.0 it is. All rights reserved.",
    " ".join(["To"] * 60 + ["be"] * 60),
    prose(4, 30_000),
    "x" * 5000,
    "<|endoftext|> ### %% $5 <b> don't 'll. İΣΣ. \x1c é ",
]


@pytest.fixture(scope="module")
def documents(spark):
    ready(spark)
    rows = [(i, t, "en" if i % 2 else None, "s1" if i % 3 else None, 1, "c", "k", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[7], rows[7], (None, BASE, "en", None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return ready(spark).createDataFrame([], DOCUMENTS)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    """doc_id -> (set size, smallest id in its component) for distinct ids."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for at, (i, s) in enumerate(sets):
        for j, t in sets[:at]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets}


def test_near_copies_equal_brute_force(documents):
    wanted = brute_components(list(enumerate(TEXTS)))
    got = jaccard_join.near_copies(documents).collect()
    assert len(got) == len(TEXTS) + 3
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == (wanted[r["doc_id"]] if r["doc_id"] is not None else wanted[0])


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_of_edited_groups(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for group in range(6):
        centre = prose(100 * seed + group, int(rng.integers(20, 90)))
        for _ in range(25):
            text = centre
            for _ in range(int(rng.integers(0, 5))):
                text = edited(text, int(rng.integers(0, len(centre.split()))), word(int(rng.integers(500, 900))))
            rows.append(text)
    rng.shuffle(rows)
    df = ready(spark).createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    wanted = brute_components(list(enumerate(rows)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_copies(df, buckets=3).collect()}
    assert got == wanted
    kept = {r["doc_id"] for r in jaccard_join.keep_one(df).collect()}
    assert kept == {c for _, c in wanted.values()}


def test_keep_one_keeps_one_row_of_repeated_and_missing_ids(spark):
    other, third = prose(8), prose(9)
    rows = [(5, BASE, 1), (5, BASE, 2), (7, edited(BASE, 50, "x"), 3), (7, other, 4), (None, BASE, 5)]
    rows += [(None, third, n) for n in range(6, 12)] + [(9, prose(10), 12), (None, "", 13), (None, "", 14), (9, prose(11), 15)]
    df = ready(spark).createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    kept = sorted(r["n"] for r in kept.collect())
    assert [n for n in kept if n > 11] == [12, 13, 14, 15]
    assert [(rows[n - 1][0], rows[n - 1][1]) for n in kept if n < 12] == [(5, BASE), (7, other), (None, third)]


def test_near_copies_over_whole_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op3_ngram_jaccard_join"](spark, folder).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows)


def counts_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_quality_counts_equal_brute_force(documents, spark, folder):
    by_id = dict(enumerate(TEXTS))
    for r in quality.quality(documents).collect():
        want = counts_of(by_id[r["doc_id"]] if r["doc_id"] is not None else BASE)
        assert tuple(r[1:6]) == want, r
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op4_quality_rules"](spark, folder).collect():
        assert tuple(r[1:6]) == counts_of(texts[r["doc_id"]])


def test_quality_rejects_far_vectors_only(spark):
    rows = [(i, prose(i, 80 + i % 40), "en", "a") for i in range(300)]
    rows += [(1000 + i, re.sub(" ", " ### ", prose(i, 80)), "en", "a") for i in range(20)]
    df = ready(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(df).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(20))
    assert {r["doc_id"] for r in quality.keep_good(df).collect()} == set(range(300))


def test_quality_rejects_repeated_lines_and_repeated_words(spark):
    rows = [(i, "\n".join(prose(50 * i + k, 12) for k in range(8)), "en", "a") for i in range(300)]
    lines = ["%s %s" % (word(500 + i), word(600 + i)) for i in range(60)]
    for i in range(10):
        rows.append((1000 + i, "\n".join(prose(90_000 + 50 * i + k, 12) for k in range(8)) + ("\n" + lines[i]) * 6, "en", "a"))
        again = prose(70_000 + i, 20)
        rows.append((2000 + i, f"{again} {prose(80_000 + i, 60)} {again}", "en", "a"))
    df = ready(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.quality(df).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if r["kept"]} == set(range(300))


def concentrated(x):
    """Centre and scatter of least determinant by the same steps in numpy."""
    floors, best = np.diag(np.square(quality.FLOORS)), []
    q = np.percentile(x, [25, 50, 75], axis=0, method="inverted_cdf")
    for centre, scatter in ((q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2)), (x.mean(axis=0), np.cov(x.T, bias=True).reshape(4, 4))):
        det = np.inf
        while True:
            d2 = np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(scatter + floors), x - centre)
            core = x[d2 <= np.percentile(d2, 75, method="inverted_cdf")]
            moved = core.mean(axis=0), np.cov(core.T, bias=True).reshape(4, 4) * quality.CONSISTENT
            now = np.linalg.slogdet(moved[1] + floors)[1]
            if not now < det - quality.FALL:
                break
            (centre, scatter), det = moved, now
        best.append((det, centre, scatter))
    return min(best, key=lambda b: b[0])[1:]


def drawn(own, n, wider):
    return tuple((n * a + quality.PRIOR * b) / (n + quality.PRIOR) for a, b in zip(own, wider, strict=True))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_quality_verdicts_equal_numpy_in_every_group(spark, sf):
    docs = ready(spark).read.parquet(f"/root/testdata/{sf}/documents.parquet")
    columns = ["doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")]
    rows = quality.with_counts(docs).filter(~quality.base_failed()).select(*columns, *quality.vector()).collect()
    x = np.array([list(r)[3:] for r in rows])
    langs, groups = np.array([r["lang"] for r in rows]), np.array([r["lang"] + "|" + r["source"] for r in rows])
    whole, want, close = concentrated(x), {}, set()
    for lang in set(langs):
        of_lang = drawn(concentrated(x[langs == lang]), (langs == lang).sum(), whole)
        for group in set(groups[langs == lang]):
            at = np.flatnonzero(groups == group)
            centre, scatter = drawn(concentrated(x[at]), len(at), of_lang)
            away = x[at] - centre
            d2 = np.einsum("ni,ij,nj->n", away, np.linalg.inv(scatter + np.diag(np.square(quality.FLOORS))), away)
            want |= {rows[i]["doc_id"]: d <= quality.LIMIT for i, d in zip(at, d2, strict=True)}
            close |= {rows[i]["doc_id"] for i, d in zip(at, d2, strict=True) if abs(d - quality.LIMIT) < 1e-6}
    got = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect() if not r["base_failed"]}
    assert got.keys() == want.keys() and not close
    assert got == want and 0 < sum(got.values()) < len(got)


def pieces_of(text):
    ids = tokens(default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    return [ids[a : a + 2048] for a in range(0, len(ids), 2048)]


def check_packing(result, by_id, times):
    places = defaultdict(list)
    seen = Counter()
    for r in result:
        piece = pieces_of(by_id[r["doc_id"]])[r["piece"]]
        assert (r["start"], r["length"]) == (2048 * r["piece"], len(piece))
        assert r["ids_crc32"] == zlib.crc32(np.array(piece, dtype="<u4").tobytes())
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"], r["piece"]] += 1
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert sum(n for _, n in spans) <= 2048
    assert seen == {(i, p): times[i] for i in by_id for p in range(len(pieces_of(by_id[i])))}
    return len(places)


def test_packing_keeps_every_id(documents):
    by_id = dict(enumerate(TEXTS)) | {None: BASE}
    result = packing.packed_documents(documents).collect()
    check_packing(result, by_id, Counter({i: 3 if i == 7 else 1 for i in by_id}))


def test_packing_exchanges_between_groups(spark):
    rows = [(i, int(n)) for i, n in enumerate(np.random.default_rng(3).integers(400, 1300, 900))]
    df = ready(spark).createDataFrame(rows, "row long, length long")
    together = packing.pack(df, group_pieces=10_000).select("sequence_id").distinct().count()
    apart = packing.pack(df, group_pieces=60)
    assert apart.count() == 900
    assert apart.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()
    lengths = np.array([n for _, n in rows])
    assert packing.least_bins(lengths, 2048) <= together <= apart.select("sequence_id").distinct().count() <= 1.1 * together


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold_and_best_fit_matches_a_plain_one(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 40, 12 if seed < 3 else 200)
    bins, offsets, opened = packing.best_fit_decreasing(lengths, 40)
    rooms = []
    for n in sorted(lengths.tolist(), reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(40 - n)
    assert opened == len(rooms)
    assert packing.least_bins(lengths, 40) <= opened
    assert packing.least_bins(np.array([21, 21, 21, 25]), 40) == 4
    assert all(lengths[bins == b].sum() <= 40 for b in range(opened))
    assert {(b, o) for b, o in zip(bins, offsets)} == set(zip(bins.tolist(), offsets.tolist()))


def test_cached_tokens_equal_the_tokenizer():
    words = tokens(default_path())
    for text in [t for t in TEXTS if t]:
        assert words.ids(text) == words.direct(text), text[:60]


@pytest.mark.parametrize("block_ids", [16, 1 << 12])
def test_token_files_round_trip(documents, block_ids):
    got = token_files.counted_documents(documents, block_ids=block_ids).collect()
    want = [len(tokens(default_path()).ids(r["text"])) // 4 for r in documents.select("text").collect()]
    assert sorted(r["n_tokens"] for r in got) == sorted(want)


def test_token_files_stitch_across_runs(spark, monkeypatch):
    monkeypatch.setattr(token_files, "RUN_BLOCKS", 3)
    ready(spark)
    lengths = [0, 1, 200, 15, 16, 17, 0, 47, 48, 49, 500, 3]
    df = spark.createDataFrame([(" ".join(["dog"] * n),) for n in lengths], "text string").coalesce(1)
    got = token_files.counted_documents(df, block_ids=8).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(lengths)


def test_language_of_held_out_documents(spark, folder):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_language_id"](spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(langs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([langs[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.9


def test_language_of_odd_texts(documents, empty):
    rows = {r["doc_id"]: r for r in language.identified(documents).collect()}
    assert rows[12]["lang_pred"] == rows[11]["lang_pred"] == rows[13]["lang_pred"] == "und" and rows[12]["score"] == 0
    assert rows[0]["lang_pred"] == "en" and rows[None]["held_out"] is False
    kept = language.keep_identified(documents)
    assert kept.columns == documents.columns and kept.filter("doc_id in (11, 12, 13)").isEmpty()
    assert {r["lang_pred"] for r in language.identified(documents.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_not_learned_is_rejected(spark):
    rng = np.random.default_rng(0)

    def text(parts, n):
        return " ".join("".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(n))

    english, french = ["the", "ing", "and", "er", "st", "on"], ["eau", "que", "oui", "ment", "le", "re"]
    rows = [(i, text((english, french)[i % 2], 20 + i % 200), ("en", "fr")[i % 2]) for i in range(400)]
    rows += [(1000 + i, text(list("abcdefghijklmnopqrstuvwxyz"), 150), None) for i in range(5)]
    rows += [(2000 + i, text(["zgw", "przy", "szcz", "kno", "wsk"], 150), None) for i in range(5)] + [(3000, "привет мир " * 50, None)]
    df = ready(spark).createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert {r["doc_id"] for r in language.keep_identified(df).collect()} == set(range(400))


def test_units_are_letters_only():
    assert language.units("½ ² 12 _") == [] and language.units("Ab x² é½a\n") == ["ab", "x", "éa"]
    assert language.units("y" * 100) == ["y" * 100]
    parts = language.short_units("y" * 100)
    assert "".join(parts) == "y" * 100 and max(map(len, parts)) == language.LEARNED


def test_forward_pass_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "bab"]
    rng = np.random.default_rng(0)
    table = rng.random((len(pieces), 2))
    table /= table.sum(axis=0)
    segmenter = language.Segmenter(pieces)

    def ways(text):
        if not text:
            return [[]]
        return [[p, *rest] for p in pieces if text.startswith(p) for rest in ways(text[len(p) :])]

    words = ["ab", "abab", "a", "bbab"]
    logs = language.log_probabilities(segmenter, table, words)
    for w, got in zip(words, logs):
        totals = [sum(np.prod([table[pieces.index(p), k] for p in way]) for way in ways("▁" + w)) for k in (0, 1)]
        assert np.allclose(got, np.log(totals))
    long = "ab" * 40_000 + "b"
    far = language.log_probabilities(segmenter, table * 1e-3, [long, "ab"])[0]
    chain = np.zeros((len(long) + 2, 2))
    text = "▁" + long
    for end in range(1, len(text) + 1):
        logs = [chain[end - len(p)] + np.log(table[i] * 1e-3) for i, p in enumerate(pieces) if text.startswith(p, end - len(p)) and len(p) <= end]
        chain[end] = np.logaddexp.reduce(logs, axis=0)
    assert np.allclose(far, chain[-1])
    uses = language.expected_counts(segmenter, table[:, 0], words, np.array([2.0, 1, 3, 1]))
    want = np.zeros(len(pieces))
    for w, n in zip(words, [2, 1, 3, 1]):
        weights = [(way, np.prod([table[pieces.index(p), 0] for p in way])) for way in ways("▁" + w)]
        for way, weight in weights:
            for p in way:
                want[pieces.index(p)] += n * weight / sum(x for _, x in weights)
    assert np.allclose(uses, want)


def test_licences(documents):
    rows = {r["doc_id"]: r for r in licenses.scanned(documents).collect()}
    assert rows[16]["licences"] == "MIT,proprietary" and rows[16]["n_known"] == 2
    assert rows[12]["n_known"] == rows[11]["n_known"] == 0 and rows[12]["licences"] == ""
    assert licenses.scanned(documents).count() == len(TEXTS) + 3


def test_ordered_licence_rules_use_up_sentences(spark):
    text = "\n".join([
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice.",
        "Redistributions in binary form must reproduce the above copyright notice.",
        "Licensed under CC BY 4.0.", "Either version 3 of the License, or (at your option) any later version.",
    ])
    r = licenses.scanned(ready(spark).createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["licences"] == "BSD-2-Clause,CC-BY-4.0" and r["unmatched"] == 1


MIT_NOTICE = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
"""
BSD_NOTICE = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3) Neither the name of Some Company Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL3_NOTICE = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
"""
GPL2_NOTICE = """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
"""
APACHE_NOTICE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with
# the License. You may obtain a copy of the
# License at
#     http://www.apache.org/licenses/LICENSE-2.0
"""


@pytest.mark.parametrize("text, licences", [
    (MIT_NOTICE, "MIT"), (MIT_NOTICE.replace("\n", "\r\n"), "MIT"), (BSD_NOTICE, "BSD-2-Clause"), (BSD_NOTICE + ENDORSE, "BSD-3-Clause"),
    (GPL3_NOTICE, "GPL-3.0-or-later"), (GPL2_NOTICE, "GPL-2.0-or-later"), (APACHE_NOTICE, "Apache-2.0"),
    ("This project is licensed under the MIT License - see the\n[LICENSE](LICENSE) file for details", ""),
    ("This project is licensed under the MIT License - see the LICENSE file\nfor details.", "MIT"), ("This project is licensed\nunder the MIT License.", "MIT"),
    ("not licensed under the MIT License", ""), ("licensed. Under the MIT License", ""),
])
def test_licences_of_wrapped_notices(spark, text, licences):
    r = licenses.scanned(ready(spark).createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["licences"] == licences and r["unmatched"] == 0


def test_mixing_meets_limit_and_budget(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "s%d" % min(int(rng.exponential(1.2)), 4), int(rng.integers(5, 90))) for i in range(4000)]
    df = ready(spark).createDataFrame(rows, "doc_id long, source string, n_tokens long")
    total = sum(n for _, _, n in rows)
    for target in ({"repeats": 2.0}, {"repeats": 1.1}, {"entropy": 1.5, "repeats": None}):
        plan = mixing.mix_plan(df, **target).collect()
        weights = {r["source"]: r["weight"] for r in plan}
        assert abs(sum(weights.values()) - 1) < 1e-9
        if "entropy" in target:
            assert abs(-sum(w * np.log(w) for w in weights.values()) - 1.5) < 1e-6
        else:
            assert max(r["quota"] / r["n_tokens"] for r in plan) <= target["repeats"] + 1e-3
        taken = mixing.mixed(df, mixing.mix_plan(df, **target)).collect()
        by_source = Counter()
        for r in taken:
            by_source[r["source"]] += r["n_tokens"]
        for r in plan:
            assert 0 <= r["quota"] - by_source[r["source"]] < 90
        times = Counter(r["doc_id"] for r in taken)
        passes = {r["source"]: r["passes"] for r in plan}
        assert all(times[i] - passes[s] in (0, 1) for i, s, _ in rows)
    assert abs(sum(by_source.values()) - total) < 90 * len(plan)


@pytest.mark.parametrize("slice_bits", [1, 18])
def test_mixing_follows_its_permutation(spark, monkeypatch, slice_bits):
    """Who is taken, and how often, against running sums along the returned places; many blocks in a slice and few."""
    monkeypatch.setattr(mixing, "BLOCK_DOCUMENTS", 20)
    monkeypatch.setattr(mixing, "SLICE_BITS", slice_bits)
    rng = np.random.default_rng(7)
    rows = [(i // 2 if i < 40 else i, [None, "a", "b", "b", "b"][i % 5], int(rng.integers(0, 60))) for i in range(1500)]
    df = ready(spark).createDataFrame(rows, "doc_id long, source string, n_tokens long").filter("n_tokens > 0")
    plan = mixing.mix_plan(df, repeats=1.6)
    none = F.lit(None).cast("long")
    whole = plan.withColumns({"passes": F.lit(1).cast("long"), "last_place": none, "last_block": none, "last_key": none})
    steps = {}
    for r in mixing.mixed(df, whole).collect():
        place = (r["mix_place"], r["mix_block"], r["mix_order"])
        steps.setdefault(r["source"] or "", {}).setdefault(place, []).append((r["doc_id"], r["n_tokens"]))
    want = Counter()
    for p in plan.collect():
        upto, rest = 0, p["quota"] - p["passes"] * p["n_tokens"]
        for _, together in sorted(steps[p["source"]].items()):
            upto += sum(n for _, n in together)
            for doc, n in together:
                want[(p["source"], doc, n)] += p["passes"] + (upto <= rest)
    got = Counter((r["source"] or "", r["doc_id"], r["n_tokens"]) for r in mixing.mixed(df, plan).collect())
    assert got == +want


def test_mixing_odd_rows(documents, empty):
    kept = mixing.keep_mixed(documents)
    assert kept.columns == documents.columns and kept.filter("text is null or text = ''").isEmpty()
    assert mixing.keep_mixed(empty).count() == 0 and mixing.mixture(documents).count() > 0


HELPERS = (
    "counts kept base_failed distance2 v0 v1 v2 v3 m0 p00 d2 key group_lang language lang_pred score per_letter letters document "
    "passes times mix_block mix_pass mix_place mix_order blocks last_place last_block last_key _source rest weight quota n_tokens "
    "set_id component_id label owner row hash n_shingles"
).split()


@pytest.mark.parametrize("stage", [language.keep_identified, quality.keep_good, jaccard_join.keep_one, mixing.keep_mixed])
def test_stages_return_columns_named_like_their_helpers(spark, folder, stage):
    plain = ready(spark).read.parquet(f"{folder}/documents.parquet")
    docs = plain.withColumns({name: F.concat(F.lit(f"{name} "), "doc_id") for name in HELPERS})
    kept = stage(docs)
    assert kept.dtypes == docs.dtypes
    rows = kept.select("doc_id", *HELPERS).collect()
    assert rows and all(r[name] == f"{name} {r['doc_id']}" for r in rows for name in HELPERS)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in stage(plain).select("doc_id").collect())


@pytest.mark.parametrize("run", [
    jaccard_join.near_copies, jaccard_join.keep_one, quality.quality, quality.keep_good, packing.packed_documents,
    language.identified, language.keep_identified, licenses.scanned, mixing.mixture, token_files.counted_documents,
])
def test_empty_table(empty, run):
    assert run(empty).count() == 0
