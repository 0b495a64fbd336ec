import random

import pytest
from pyspark.sql import functions as F
from rows import RUN, bronze, brute_force, delivered, view

from recordloom.operators import history as h
from recordloom.operators.changes import change_counts, detect_changes, rows_to_write
from recordloom.operators.cleaning import first_deliveries
from recordloom.operators.skew import hot_keys, split_hot
from recordloom.session import stored
from recordloom.specs import ENCOUNTER

A = [("1", "1", "2020-01-01", "a"), ("1", "2", "2020-01-02", "b"), ("1", "3", "2020-01-03", "a")]


def random_versions(seed, ids=12, versions=40, days=60):
    rng = random.Random(seed)
    rows = []
    for i in range(ids):
        count = versions * 10 if i == 0 else rng.randint(1, 8)  # one id holds most rows
        for v in range(count):
            day = f"2020-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
            rows.append((str(i), str(v), day, rng.choice("abc")))
    return rows


def check_invariants(history):
    per_id = history.groupBy("resource_id").agg(F.count_if("is_current").alias("current")).filter("current <> 1")
    assert per_id.count() == 0
    number = F.col("meta_version_id").cast("int").alias("number")
    rows = sorted(history.select("resource_id", "valid_from", number, "valid_to", "record_hash").collect(), key=lambda r: r[:3])
    for one, two in zip(rows, rows[1:]):
        if one["resource_id"] == two["resource_id"]:
            assert one["valid_to"] == two["valid_from"] and one["record_hash"] != two["record_hash"]


def test_there_and_back_keeps_three_rows(spark):
    assert view(h.rebuild(delivered(spark, A), RUN[0])) == [
        ("1", "1", "a", "2020-01-01", "2020-01-02", False),
        ("1", "2", "b", "2020-01-02", "2020-01-03", False),
        ("1", "3", "a", "2020-01-03", None, True),
    ]


def test_version_without_change_adds_no_row_but_is_seen(spark):
    history = h.rebuild(delivered(spark, [*A, ("1", "4", "2020-01-04", "a")]), RUN[0])
    assert view(history) == view(h.rebuild(delivered(spark, A), RUN[0]))
    assert history.filter("is_current").first()["last_seen"]["version"] == "4"


def test_ten_is_after_nine(spark):
    rows = [("1", "10", "2020-01-01", "b"), ("1", "9", "2020-01-01", "a")]
    assert [r[1] for r in view(h.rebuild(delivered(spark, rows), RUN[0])) if r[5]] == ["10"]


def test_unreadable_time_comes_first_and_is_not_current(spark):
    rows = [("1", "5", "no time", "a"), ("1", "1", "2020-01-01", "b"), ("2", "1", None, "a")]
    assert view(h.rebuild(delivered(spark, rows), RUN[0])) == [
        ("1", "1", "b", "2020-01-01", None, True),
        ("1", "5", "a", None, "2020-01-01", False),
        ("2", "1", "a", None, None, True),
    ]


def test_keys_are_trimmed_before_they_are_compared(spark):
    rows = [(" 1", "1", "2020-01-01", "a"), ("1 ", "1", "2020-01-01", "a"), ("  ", "1", "2020-01-01", "a"), (None, "1", "x", "a")]
    assert [r[0] for r in view(h.rebuild(delivered(spark, rows), RUN[0]))] == ["1"]


def test_earliest_delivery_of_a_version_stays(spark):
    rows = [
        ("1", "1", "2020-01-01", "late", "2024-01-03 00:00:00"),
        ("1", "1", "2020-01-01", "early", "2024-01-02 00:00:00"),
        ("2", None, "2020-01-01", "x", "2024-01-02 00:00:00"),
        ("2", None, "2020-01-01", "y", "2024-01-03 00:00:00"),
    ]
    assert sorted(r["status"] for r in first_deliveries(delivered(spark, rows)).collect()) == ["early", "x"]


def test_tie_between_deliveries_does_not_depend_on_row_order(spark):
    rows = [("1", "1", "2020-01-01", s) for s in "dacb"]
    picks = {
        first_deliveries(delivered(spark, order).repartition(n)).first()["status"]
        for n, order in ((1, rows), (3, rows[::-1]), (4, rows[2:] + rows[:2]))
    }
    assert len(picks) == 1


def test_hash_tells_null_from_text(spark):
    hashes = delivered(
        spark, [("1", "1", "d", None), ("2", "1", "d", ""), ("3", "1", "d", "NULL"), ("4", "1", "d", " "), ("5", "1", "d", "x ")]
    )
    found = {r["resource_id"]: r["record_hash"] for r in hashes.collect()}
    assert len({found[k] for k in "1235"}) == 4 and found["2"] == found["4"]


def test_change_outside_the_hash_columns_is_none(spark):
    rows = [("1", "1", "2020-01-01", "a", "2024-01-01 00:00:00", "u1"), ("1", "2", "2020-01-02", "a", "2024-01-01 00:00:00", "u2")]
    assert len(view(h.rebuild(delivered(spark, rows), RUN[0]))) == 1


@pytest.mark.parametrize("hot_rows", [10**9, 20, 1])
def test_rebuild_equals_brute_force(spark, hot_rows):
    rows = random_versions(1)
    history = h.rebuild(delivered(spark, rows).repartition(7), RUN[0], hot_rows)
    assert view(history) == brute_force(rows)
    check_invariants(history)


def test_hot_and_ordinary_plans_agree_in_all_columns(spark):
    versions = delivered(spark, random_versions(2))
    one, two = h.rebuild(versions, RUN[0], 10**9), h.rebuild(versions, RUN[0], 1)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_all_hot_keys_are_found(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") / 2).cast("long").cast("string"))
    rows = spark.range(60_000).select(key.alias("k"))
    assert [r["k"] for r in hot_keys(rows, "k", 10_000).collect()] == ["hot"]
    assert hot_keys(rows, "k", 1).count() == rows.select("k").distinct().count() > 1000
    assert hot_keys(rows, "k").count() == 0
    ordinary, hot = split_hot(rows, "k", 10_000)
    assert (ordinary.count(), hot.count()) == (40_000, 20_000)
    assert split_hot(rows, "k")[1] is None


@pytest.mark.parametrize("seed,hot_rows", [(3, 10**9), (4, 10**9), (5, 1), (6, 20)])
def test_batches_in_any_order_equal_one_rebuild(spark, seed, hot_rows):
    rows = random_versions(seed)
    random.Random(seed).shuffle(rows)
    third = len(rows) // 3
    batches = [rows[:third], rows[third : 2 * third], rows[2 * third :], rows[:third]]
    history, seen = None, []
    for at, batch in zip(RUN, batches):
        arriving = delivered(spark, batch)
        if history is None:
            history = h.rebuild(arriving, at, hot_rows)
        else:
            history = h.apply_in_order(history, arriving, delivered(spark, seen), at, hot_rows)
        history, seen = stored(history), seen + batch
    assert view(history) == brute_force(rows)
    check_invariants(history)


@pytest.mark.parametrize("hot_rows", [10**9, 1])
def test_batches_in_order_need_no_earlier_rows(spark, hot_rows):
    rows = sorted(random_versions(7), key=lambda r: (r[2], int(r[1])))
    half = len(rows) // 2
    history = stored(h.rebuild(delivered(spark, rows[:half]), RUN[0], hot_rows))
    # A day may be cut in two; such rows are ordered by version and are still newer.
    current, closed = h.current_rows(history), history.filter("not is_current")
    assert h.late_ids(current, delivered(spark, rows[half:]), delivered(spark, rows[:half])) is None
    extended = h.extend(current, delivered(spark, rows[half:]), RUN[1], hot_rows)
    assert view(closed.unionByName(extended)) == brute_force(rows)


def test_late_version_next_to_one_that_changed_nothing(spark):
    """Version 2 repeats 1 and is not kept; 1.5 arrives later, lies after the current row, and is late."""
    first = [("1", "1", "2020-01-01", "a"), ("1", "3", "2020-01-03", "a")]
    late = [("1", "2", "2020-01-02", "b")]
    history = h.rebuild(delivered(spark, first), RUN[0])
    assert h.late_ids(history, delivered(spark, late), delivered(spark, first)).count() == 1
    result = h.apply_in_order(history, delivered(spark, late), delivered(spark, first), RUN[1])
    assert view(result) == brute_force(first + late)


def test_apply_is_exact_and_repeatable(spark):
    rows = random_versions(8)
    history = h.rebuild(delivered(spark, rows[::2]), RUN[0])
    once = stored(h.apply(history, delivered(spark, rows[1::2]), delivered(spark, rows), RUN[1]))
    again = h.apply(once, delivered(spark, rows[1::2]), delivered(spark, rows), RUN[2])
    assert view(once) == view(again) == brute_force(rows)


def test_replay_and_empty_batch_change_nothing(spark):
    rows = delivered(spark, A)
    history = stored(h.rebuild(rows, RUN[0]))
    for batch in (rows, rows.limit(0)):
        after = h.apply_in_order(history, batch, rows, RUN[1])
        assert after.exceptAll(history).count() == 0 and history.exceptAll(after).count() == 0


def test_as_of(spark):
    history = h.rebuild(delivered(spark, A), RUN[0])
    at = lambda day: [r["meta_version_id"] for r in h.as_of(history, F.lit(day).cast("timestamp")).collect()]
    assert (at("2019-12-31"), at("2020-01-01"), at("2020-01-02 12:00:00"), at("2021-01-01")) == ([], ["1"], ["2"], ["3"])


def test_first_load_and_merge_in_run_time(spark):
    first = h.first_load(delivered(spark, [*A[:2], ("2", "1", "2020-01-01", "x"), ("3", "1", "2020-01-01", "k")]), RUN[0])
    assert view(first) == [
        ("1", "2", "b", "2030-01-01", None, True),
        ("2", "1", "x", "2030-01-01", None, True),
        ("3", "1", "k", "2030-01-01", None, True),
    ]
    batch = [A[2], ("2", "2", "2020-01-02", "x"), ("4", "1", "2020-01-01", "n"), ("4", "2", "2020-01-05", "m")]
    merged = stored(h.merge(first, delivered(spark, batch), RUN[1]))
    assert view(merged) == [
        ("1", "2", "b", "2030-01-01", "2030-01-02", False),
        ("1", "3", "a", "2030-01-02", None, True),
        ("2", "1", "x", "2030-01-01", None, True),
        ("3", "1", "k", "2030-01-01", None, True),
        ("4", "2", "m", "2030-01-02", None, True),
    ]
    again = h.merge(h.current_rows(merged), delivered(spark, [*batch, *A]), RUN[2])
    assert view(again) == view(h.current_rows(merged))


def test_changes(spark):
    history = h.rebuild(delivered(spark, [*A, ("2", "1", "2020-01-01", "x")]), RUN[0])
    batch = delivered(
        spark,
        [("1", "4", "2020-02-01", "a"), ("1", "5", "2020-02-02", "c"), ("2", "2", "2020-02-01", "x"), ("3", "1", "2020-01-01", "n")],
    )
    changes = detect_changes(h.current_rows(history), batch)
    assert {r["resource_id"]: r["change"] for r in changes.collect()} == {"1": "changed", "2": "unchanged", "3": "new"}
    assert {r["change"]: r["ids"] for r in change_counts(changes).collect()} == {"changed": 1, "unchanged": 1, "new": 1}
    written = rows_to_write(h.current_rows(history), batch)
    assert sorted((r["resource_id"], r["meta_version_id"]) for r in written.collect()) == [("1", "4"), ("1", "5"), ("3", "1")]


def test_state_columns(spark):
    history = h.rebuild(delivered(spark, A), RUN[0])
    assert "raw_resource_json" in bronze(spark, A).columns and "raw_resource_json" not in history.columns
    assert set(h.HISTORY_COLUMNS) | {"record_hash"} <= set(history.columns)
    assert not [c for c in history.columns if c.startswith("_")]


def test_replay_never_moves_last_seen_back(spark):
    first = [("1", "1", "2020-01-01", "a"), ("1", "3", "2020-01-03", "a")]
    late = [("1", "2", "2020-01-02", "b")]
    history = h.rebuild(delivered(spark, first), RUN[0])
    for rows, earlier, at in ((first[1:], first, 1), (late, first, 2)):
        history = stored(h.apply_in_order(history, delivered(spark, rows), delivered(spark, earlier), RUN[at]))
    whole = h.rebuild(delivered(spark, first + late), RUN[0])
    columns = ["meta_version_id", "is_current", "valid_from", "valid_to", "last_seen"]
    assert sorted(map(str, history.select(columns).collect())) == sorted(map(str, whole.select(columns).collect()))


def test_values_that_share_a_hash_are_still_a_change(spark):
    rows = bronze(spark, [("1", "1", "2020-01-01", "a||b"), ("1", "2", "2020-01-02", "a")])
    other = [c for c in ENCOUNTER.columns if c != "status"][0]
    rows = rows.withColumn(other, F.when(F.col("status") == "a", F.lit("b||c")).otherwise(F.lit("c")))
    from recordloom.operators.cleaning import deliveries

    assert h.rebuild(deliveries(rows, ENCOUNTER), RUN[0]).count() == 2


def test_old_versions_are_no_change(spark):
    current = h.current_rows(h.rebuild(delivered(spark, [("1", "2", "2020-01-02", "b")]), RUN[0]))
    changes = detect_changes(current, delivered(spark, [("1", "1", "2020-01-01", "a")])).collect()
    assert [r["change"] for r in changes] == ["seen"]
    assert rows_to_write(current, delivered(spark, [("1", "1", "2020-01-01", "a")])).isEmpty()
