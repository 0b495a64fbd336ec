import json

import pytest
from pyspark.sql import functions as F

from recordloom.operators.bundles import flatten_bundles
from recordloom.operators.landing import land_pages, to_pages, with_row_index
from recordloom.session import new_folder, shared_dir, shuffle_partitions_for
from recordloom.sources import star_tables as star
from recordloom.sources.pages import in_window, landing_path, parse_pages, read_pages
from recordloom.specs import PATIENT


def patients(spark, folder):
    return star.patients(star.table(spark, folder, "customer"))


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_index_has_no_gaps(spark, parts):
    rows = with_row_index(spark.range(0, 1003, 1, parts)).collect()
    assert sorted(r["index"] for r in rows) == list(range(1003))
    assert {r["total"] for r in rows} == {1003}


def test_row_index_of_nothing(spark):
    assert with_row_index(spark.range(0)).count() == 0


@pytest.mark.parametrize("size,pages", [(100, 2), (150, 1), (7, 22)])
def test_pages_are_full_and_linked(spark, folder, size, pages):
    texts = {r["page_number"]: json.loads(r["value"]) for r in to_pages(patients(spark, folder), PATIENT, size).collect()}
    assert sorted(texts) == list(range(1, pages + 1))
    assert [len(texts[n]["entry"]) for n in sorted(texts)] == [size] * (pages - 1) + [150 - size * (pages - 1)]
    for number, page in texts.items():
        assert page["id"] == f"page_{number:04d}"
        onward = [link["url"] for link in page["link"] if link["relation"] == "next"]
        assert onward == ([f"https://records.example/api/Patient?_count={size}&page={number + 1}"] if number < pages else [])
    ids = [e["resource"]["id"] for n in sorted(texts) for e in texts[n]["entry"]]
    assert len(set(ids)) == 150


def test_parsed_pages_equal_the_records(spark, folder):
    records = patients(spark, folder)
    again = parse_pages(to_pages(records, PATIENT), PATIENT).select(F.explode("entry").alias("e")).select("e.resource")
    assert again.select(F.to_json("resource")).exceptAll(records.select(F.to_json("r"))).count() == 0
    assert again.count() == records.count()


@pytest.mark.parametrize("one_per_file", [False, True])
def test_landing_replaces_the_day(spark, folder, one_per_file):
    root = new_folder(spark, "landing")
    customers = star.table(spark, folder, "customer")
    land_pages(star.patients(customers), root, PATIENT, "2024-01-02", 10, one_per_file)
    path = land_pages(star.patients(customers.filter("c_custkey < 25")), root, PATIENT, "2024-01-02", 10, one_per_file)
    assert path == landing_path(root, "Patient", "2024-01-02")
    pages = read_pages(spark, root, PATIENT, ["2024-01-02"], one_per_line=not one_per_file)
    assert pages.count() == 3 and flatten_bundles(pages, PATIENT).count() == 25


def test_window_includes_both_ends(spark):
    days = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 32)], "d string").select(F.to_date("d").alias("d"))
    kept = [str(r["d"]) for r in days.filter(in_window("d", "2024-01-10")).collect()]
    assert kept == ["2024-01-07", "2024-01-08", "2024-01-09", "2024-01-10"]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert new_folder(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partition_count_follows_the_input():
    assert shuffle_partitions_for(0) == 200
    assert shuffle_partitions_for(100 << 40) == 819_200
