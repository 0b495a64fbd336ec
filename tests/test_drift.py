"""Whole records as VARIANT, and how their structure departs from the spec."""

import json
from dataclasses import replace

import pytest
from oracle import bag
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from recordloom.operators.bundles import flatten_bundles
from recordloom.operators.drift import declared_kinds, departures, schema_drift
from recordloom.operators.landing import land_pages
from recordloom.operators.raw import flatten_raw, raw_records, unread_pages
from recordloom.sources import star_tables as star
from recordloom.sources.pages import read_page_texts, read_pages
from recordloom.specs import PATIENT, RESOURCES

DAY = "2024-01-02"


def texts(spark, *pages):
    rows = [(p if isinstance(p, (str, type(None))) else json.dumps(p),) for p in pages]
    return spark.createDataFrame(rows, "value string").withColumns(
        {
            "page_path": F.lit("p"),
            "landed_at": F.lit("2024-01-02").cast("timestamp"),
            "ingestion_date": F.lit(DAY).cast("date"),
            "resource_type": F.lit("Patient"),
        }
    )


def page(*resources):
    return {"resourceType": "Bundle", "entry": [{"fullUrl": "u", "resource": r} for r in resources]}


def drift(spark, *pages):
    found = schema_drift(raw_records(texts(spark, *pages)), PATIENT).collect()
    return {(r["path"], r["declared"], r["found"], r["drift"]): r["records"] for r in found}


def records(spark, folder, name):
    t = lambda n: star.table(spark, folder, n)
    return {
        "Patient": lambda: star.patients(t("customer")),
        "Encounter": lambda: star.encounters(t("orders"), t("lineitem")),
        "Observation": lambda: star.observations(t("lineitem"), t("orders")),
        "Condition": lambda: star.conditions(t("lineitem"), t("orders"), t("part")),
    }[name]()


@pytest.mark.parametrize("name", sorted(RESOURCES))
def test_flat_columns_equal_those_of_the_declared_scan(spark, folder, tmp_path, name):
    spec = RESOURCES[name]
    land_pages(records(spark, folder, name), str(tmp_path), spec, DAY)
    declared = flatten_bundles(read_pages(spark, str(tmp_path), spec, [DAY], one_per_line=True), spec)
    raw = flatten_raw(raw_records(read_page_texts(spark, str(tmp_path), spec, [DAY], one_per_line=True)), spec)
    assert raw.dtypes == declared.dtypes
    rows = [bag(df.columns, [tuple(r) for r in df.collect()]) for df in (raw, declared)]
    assert rows[0] == rows[1] and rows[0]


def test_one_page_per_file(spark, folder, tmp_path):
    land_pages(records(spark, folder, "Patient"), str(tmp_path), PATIENT, DAY, 50, one_per_file=True)
    assert raw_records(read_page_texts(spark, str(tmp_path), PATIENT, [DAY])).count() == 150


def test_a_new_column_needs_no_landing_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    raw_records(texts(spark, page({"id": "1", "telecom": [{"value": "5"}]}, {"id": "2"}))).write.parquet(root)
    wider = replace(
        PATIENT,
        body=PATIENT.body[:-1] + ",telecom:array<struct<value:string>>>",
        columns={**PATIENT.columns, "phone": "get(r.telecom, 0).value"},
    )
    rows = flatten_raw(spark.read.parquet(root), wider).select("resource_id", "phone").collect()
    assert sorted(map(tuple, rows)) == [("1", "5"), ("2", None)]


def test_values_that_do_not_fit_are_null_by_themselves(spark):
    (row,) = flatten_raw(raw_records(texts(spark, page({"id": 7, "active": [1], "gender": "m", "name": "n"}))), PATIENT).collect()
    assert (row["resource_id"], row["active"], row["gender"], row["name_text"]) == ("7", None, "m", None)


def test_pages_that_give_no_records(spark):
    odd = texts(spark, "{bad", None, "", '{"a":1,"a":2}', "[]", "5", page(), {"entry": None}, {"entry": [None, {}]})
    assert [tuple(r)[:2] for r in raw_records(odd).collect()] == [(None, None), (None, None)]
    assert unread_pages(odd).count() == 4  # broken, null, empty, and a key named twice


def test_declared_records_do_not_drift(spark, folder, tmp_path):
    for name, spec in RESOURCES.items():
        land_pages(records(spark, folder, name), str(tmp_path), spec, DAY)
        raw = raw_records(read_page_texts(spark, str(tmp_path), spec, [DAY], one_per_line=True))
        assert schema_drift(raw, spec).count() == 0


def test_unknown_and_retyped_paths_are_counted(spark):
    found = drift(
        spark,
        page({"id": "1", "x": {"deep": 1}}, {"id": "2", "x": {"other": True}}, {"id": "3", "x": None}),
        page({"id": "4", "active": "yes", "name": [{"text": "t", "use": 1}, {"use": "u"}]}, {"id": "5", "name": {"text": 1}}),
        page({"id": "6", "meta": {"versionId": 5}, "address": [], "gender": None, "a b.c": 1}, "text", None),
    )
    assert found == {
        ("x", None, "object", "unknown"): 2,
        ("x", None, "null", "unknown"): 1,
        ("active", "boolean", "string", "retyped"): 1,
        ("name[].use", None, "mixed", "unknown"): 1,
        ("name", "array", "object", "retyped"): 1,
        ("meta.versionId", "string", "number", "retyped"): 1,
        ("`a b.c`", None, "number", "unknown"): 1,
        ("$", "object", "string", "retyped"): 1,
    }


def test_nothing_drifts_in_an_empty_table(spark):
    assert schema_drift(raw_records(texts(spark, None)), PATIENT).count() == 0


def test_structures_are_read_part_by_part(spark):
    declared = declared_kinds(DataType.fromDDL(PATIENT.body))
    read = lambda s: departures(s, declared)
    assert read("OBJECT<>") == [] and read("VOID") == []
    assert read("OBJECT<id: STRING, name: ARRAY<OBJECT<given: ARRAY<VOID>>>, active: BOOLEAN>") == []
    assert read("OBJECT<`x``<y>: z`: OBJECT<id: BIGINT>, id: STRING>") == [("`x``<y>: z`", None, "object")]
    assert read("OBJECT<active: DECIMAL(2, 1), d: DECIMAL(2,1)>") == [("active", "boolean", "number"), ("d", None, "number")]
    assert read("OBJECT<meta: OBJECT<a: ARRAY<OBJECT<b: STRING>>>, meta2: DATE>") == [("meta.a", None, "array"), ("meta2", None, "date")]
    deep = "OBJECT<a: " * 3000 + "STRING" + ">" * 3000
    assert read(deep) == [("a", None, "object")]
