"""Whole records are taken from a page that is parsed once."""

from test_plans import plan

from recordloom.operators.landing import land_pages
from recordloom.operators.raw import raw_records
from recordloom.session import new_folder
from recordloom.sources import star_tables as star
from recordloom.sources.pages import read_page_texts
from recordloom.specs import ENCOUNTER


def test_pages_are_parsed_once(spark, folder):
    landing = new_folder(spark, "landing")
    land_pages(star.encounters(star.table(spark, folder, "orders")), landing, ENCOUNTER, star.DAY)
    texts = read_page_texts(spark, landing, ENCOUNTER, [star.DAY], one_per_line=True)
    assert plan(raw_records(texts)).count("parseJson") == 1


def test_entries_of_odd_kinds(spark):
    page = '{"entry": [1, null, {"fullUrl": 5, "resource": null}, {"resource": {"id": "a"}}, {"fullUrl": "u"}]}'
    lineage = "value string, page_path string, landed_at timestamp, ingestion_date date, resource_type string"
    texts = spark.createDataFrame([(page, "p", None, None, "X"), ("{}", "p", None, None, "X"), ("{", "p", None, None, "X")], lineage)
    rows = raw_records(texts).selectExpr("full_url", "to_json(resource) as resource").collect()
    assert [tuple(r) for r in rows] == [(None, None), (None, None), ("5", "null"), (None, '{"id":"a"}'), ("u", None)]
