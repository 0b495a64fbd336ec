"""Chains of links against walking them one by one."""

import random
from datetime import date

import pytest

from recordloom.operators import chains
from recordloom.specs import CORRUPT

DDL = "resource_type string, ingestion_date date, url string, next_url string"


def walked(links):
    """url -> (end, steps, ending, missing, head) by following links, for one day."""
    ways = {}
    for url, after in links:
        ways.setdefault(url, set()).add(after)
    after = {u: min((x for x in w if x is not None), default=None) for u, w in ways.items()}
    result = {}
    for url in after:
        path = [url]
        while after[path[-1]] in after and after[path[-1]] not in path:
            path.append(after[path[-1]])
        last = after[path[-1]]
        head = not any(n == url and u != url for u, n in after.items())
        if last in after:
            result[url] = (min(path[path.index(last) :]), None, "cycle", None, head)
        else:
            result[url] = (path[-1], len(path) - 1, "broken" if last else "complete", last, head)
    return result


def ranks(spark, links, kind="Patient", day=date(2024, 1, 1)):
    rows = chains.ranked_pages(spark.createDataFrame([(kind, day, *x) for x in links], DDL)).collect()
    return {r["url"]: (r["end"], r["steps"], r["ending"], r["missing"], r["head"]) for r in rows}


LINE = [(f"u{n}", f"u{n + 1}") for n in range(37)] + [("u37", None)]
ODD = [
    ("a", "b"), ("b", "gone"), ("self", "self"), ("into", "x"), ("x", "y"), ("y", "x"), ("z", "b"),
    ("twice", "b"), ("twice", None), ("twice", "c"), ("b", "gone"), ("alone", None), ("far", "into"), ("", "a"),
]


@pytest.mark.parametrize("seed", [None, 1])
def test_ranks_equal_walks(spark, seed):
    links = LINE + ODD
    if seed is not None:
        rng = random.Random(seed)
        links = [(str(n), rng.choice([None, *map(str, range(130))])) for n in range(120)]
    assert ranks(spark, links) == walked(links)


def test_days_stay_apart_and_odd_rows(spark):
    days = [date(2024, 1, 1), date(2024, 1, 2)]
    rows = [("Patient", days[0], "a", "b"), ("Patient", days[1], "b", None), (None, days[0], "b", None), ("Patient", days[0], None, "a")]
    links = spark.createDataFrame(rows, DDL)
    found = chains.feeds(chains.ranked_pages(links))
    assert {(r["ingestion_date"], r["end"], r["ending"], r["missing"]) for r in found.collect()} == {
        (days[0], "a", "broken", "b"),
        (days[1], "b", "complete", None),
    }
    assert {tuple(r)[2:] for r in chains.day_feeds(found).collect()} == {(1, 1, 0, 0), (1, 0, 0, 0)}
    assert chains.ranked_pages(links.limit(0)).count() == 0


def test_links_of_pages(spark):
    link = "array<struct<relation: string, url: string>>"
    ddl = f"resource_type string, ingestion_date date, page_path string, link {link}, {CORRUPT} string"
    day = date(2024, 1, 1)
    rows = [
        ("Patient", day, "f/1", [("self", "s1"), ("next", "s2")], None),
        ("Patient", day, "f/2", [("next", "s1")], None),
        ("Patient", day, "f/3", None, None),
        ("Patient", day, "f/4", [("self", "s2")], "{broken"),
    ]
    got = chains.page_links(spark.createDataFrame(rows, ddl)).collect()
    assert {tuple(r)[2:] for r in got} == {("s1", "s2"), ("f/2", "s1"), ("f/3", None)}
