"""Rounds of pointer doubling follow the longest feed, not the number of pages."""

import pytest

from recordloom.operators import chains


@pytest.mark.parametrize(("around", "most"), [(2, 5), (7, 7)])
def test_rounds_of_cycles_follow_their_length(spark, monkeypatch, around, most):
    """Many short cycles; each round stores a table, as the nodes and the first pointers do."""
    links = [("Patient", f"u{n:04d}", f"u{n + 1 if (n + 1) % around else n + 1 - around:04d}") for n in range(around * 100)]
    seen, stored = [], chains.stored
    monkeypatch.setattr(chains, "stored", lambda df: seen.append(df) or stored(df))
    found = chains.ranked_pages(spark.createDataFrame(links, "feed string, url string, next_url string"), ["feed"])
    rows = found.collect()
    assert len(seen) <= most + 1
    assert {(r["url"], r["end"], r["ending"]) for r in rows} == {
        (f"u{n:04d}", f"u{n - n % around:04d}", "cycle") for n in range(around * 100)
    }
