"""Repeated deliveries dropped in the stream, and what comes after the window."""

import json
import os
from datetime import datetime, timezone

import pytest
from rows import RUN

from recordloom.operators.bundles import flatten_bundles
from recordloom.plans.daily import advance_history
from recordloom.sources.pages import read_pages
from recordloom.sources.tables import read_bronze, read_history
from recordloom.specs import ENCOUNTER
from recordloom.streaming.unique import ingest_unique, passed_over

DAY = "2024-01-02"


def land(root, name, day, *records):
    """One page of (id, version) records that landed on a day of January."""
    folder = f"{root}/Encounter/{DAY}"
    os.makedirs(folder, exist_ok=True)
    entries = [{"fullUrl": f"u{i}", "resource": {"id": i, "meta": {"versionId": v, "lastUpdated": "2024-01-01"}}} for i, v in records]
    path = f"{folder}/{name}.json"
    with open(path, "w") as file:
        file.write(json.dumps({"resourceType": "Bundle", "id": name, "entry": entries}) + "\n")
    at = datetime(2024, 1, day, tzinfo=timezone.utc).timestamp()
    os.utime(path, (at, at))


@pytest.fixture
def feed(spark, tmp_path):
    root, bronze, progress = (str(tmp_path / n) for n in ("landing", "bronze", "progress"))

    def take(**options):
        return ingest_unique(spark, root, bronze, progress, ENCOUNTER, "3 days", **options)

    def held():
        rows = read_bronze(spark, bronze, ENCOUNTER).select("resource_id", "meta_version_id").collect()
        return sorted((r[0], r[1] or "") for r in rows)

    return root, bronze, take, held


def test_repeats_in_the_window_never_reach_bronze(feed):
    root, _, take, held = feed
    land(root, "one", 1, ("a", "1"), ("a", "1"), (" a", "1 "), ("n", None), ("n", None))
    take()
    land(root, "two", 2, ("a", "1"), ("a", "2"), ("", "1"), ("  ", "1"), (None, "1"), ("n", None))
    take()
    assert [(i.strip(), v.strip()) for i, v in held()] == [("a", "1"), ("a", "2"), ("n", "")]
    assert take() == [] or take()[-1]["too_late"] == 0
    assert len(held()) == 3


def test_state_is_bounded_and_late_versions_are_found(spark, feed, tmp_path):
    root, bronze, take, held = feed
    for day in (1, 2, 20):
        land(root, f"p{day}", day, *[(f"{day}-{n}", "1") for n in range(50)])
        reports = take()
    assert reports[-1]["keys"] <= 50  # those of day 20 only
    land(root, "late", 15, ("e", "1"), ("1-0", "1"))
    assert sum(r["too_late"] for r in take()) == 2
    assert ("e", "1") not in held()
    land(root, "after", 21, ("1-0", "1"))
    take()
    assert held().count(("1-0", "1")) == 2  # a repeat after the window is the history's to drop
    landed = flatten_bundles(read_pages(spark, root, ENCOUNTER, [DAY], one_per_line=True), ENCOUNTER)
    lost = passed_over(landed, read_bronze(spark, bronze, ENCOUNTER))
    assert [r["resource_id"] for r in lost.collect()] == ["e"]
    history, rows = str(tmp_path / "history"), read_bronze(spark, bronze, ENCOUNTER).drop("stream", "batch")
    advance_history(lost, rows, history, ENCOUNTER, {}, RUN[0])
    assert read_history(spark, history).count() == 151


def test_history_takes_each_batch_once(spark, feed, tmp_path):
    root, _, take, _ = feed
    history = str(tmp_path / "history")
    land(root, "one", 1, ("a", "1"), ("b", "1"))
    take(history=history, run_at=RUN[0])
    land(root, "two", 2, ("a", "1"), ("c", "1"))
    take(history=history, run_at=RUN[1])
    assert sorted(r["resource_id"] for r in read_history(spark, history).collect()) == ["a", "b", "c"]
