"""Hand-made page files: broken, empty, odd and incomplete ones."""

import json

import pytest

from recordloom.operators.audit import audit_pages
from recordloom.operators.bundles import flatten_bundles, rejected_pages
from recordloom.sources.pages import read_pages
from recordloom.sources.tables import INGESTION_LOG_DDL, empty_ingestion_log
from recordloom.specs import ENCOUNTER, OBSERVATION, PATIENT, RESOURCES, spec_for

DAY = "2024-03-01"


def land(tmp_path, pages, resource="Patient"):
    folder = tmp_path / resource / DAY
    folder.mkdir(parents=True)
    for name, page in pages.items():
        (folder / name).write_text(page if isinstance(page, str) else json.dumps(page))
    return str(tmp_path)


def bundle(*resources, **more):
    return {"resourceType": "Bundle", "entry": [{"fullUrl": f"u{i}", "resource": r} for i, r in enumerate(resources)], **more}


def bronze(spark, tmp_path, pages, spec=PATIENT):
    return flatten_bundles(read_pages(spark, land(tmp_path, pages, spec.name), spec, [DAY]), spec)


def test_first_elements_and_missing_arrays(spark, tmp_path):
    full = {
        "id": "1",
        "name": [{"text": "A B", "family": "B", "given": ["A", "C"]}, {"text": "other"}],
        "maritalStatus": {"coding": [{"code": "M"}, {"code": "S"}]},
    }
    empty = {"id": "2", "name": [], "maritalStatus": {"coding": []}, "address": None}
    bare = {"id": "3", "name": [{"given": []}]}
    rows = {r["resource_id"]: r for r in bronze(spark, tmp_path, {"page_0001.json": bundle(full, empty, bare)}).collect()}
    assert (rows["1"]["name_text"], rows["1"]["name_given"], rows["1"]["marital_status_code"]) == ("A B", "A", "M")
    assert rows["2"]["name_text"] is None and rows["2"]["marital_status_code"] is None
    assert rows["3"]["name_given"] is None


def test_two_levels_of_first_elements(spark, tmp_path):
    visit = {
        "id": "e",
        "class": {"code": "AMB", "display": "ambulatory"},
        "type": [{"coding": [{"code": "t1", "display": "T1"}, {"code": "t2"}]}, {"coding": [{"code": "t3"}]}],
        "reasonCode": [{"coding": []}],
        "period": {"start": "2020-01-01T00:00:00Z"},
    }
    row = bronze(spark, tmp_path, {"page_0001.json": bundle(visit)}, ENCOUNTER).first()
    assert (row["class_code"], row["type_code"], row["type_display"]) == ("AMB", "t1", "T1")
    assert row["reason_display"] is None and row["period_end"] is None


def test_wrong_type_loses_the_field_only(spark, tmp_path):
    odd = {"id": "1", "active": "maybe", "gender": "female", "extra": 5}
    row = bronze(spark, tmp_path, {"page_0001.json": bundle(odd)}).first()
    assert row["active"] is None and row["gender"] == "female"
    assert json.loads(row["raw_resource_json"]) == {"id": "1", "gender": "female"}


def test_pages_without_entries_give_no_rows(spark, tmp_path):
    pages = {
        "page_0001.json": bundle(),
        "page_0002.json": {"resourceType": "Bundle"},
        "page_0003.json": '{"resourceType": "Bundle", "entry": [{"reso',
        "page_0004.json": [bundle({"id": "in array"})],
    }
    assert [r["resource_id"] for r in bronze(spark, tmp_path, pages).collect()] == ["in array"]


def test_lineage_comes_from_the_page(spark, tmp_path):
    page = bundle({"id": "1"}, link=[{"relation": "self", "url": "https://x/Patient?page=1"}])
    rows = bronze(spark, tmp_path, {"page_0001.json": page, "page_0002.json": bundle({"id": "2"})}).collect()
    rows = {r["resource_id"]: r for r in rows}
    assert rows["1"]["api_url_or_params"] == "https://x/Patient?page=1"
    assert rows["2"]["api_url_or_params"].endswith("Patient/2024-03-01/page_0002.json")
    assert str(rows["1"]["ingestion_date"]) == DAY and rows["1"]["resource_type"] == "Patient"
    assert rows["1"]["extraction_timestamp"] is not None


def test_rejects_name_the_reason(spark, tmp_path):
    pages = {
        "page_0001.json": bundle({"id": "1"}),
        "page_0002.json": '{"resourceType": "Bundle", "entry": [',
        "page_0003.json": {"resourceType": "OperationOutcome"},
        "page_0004.json": {"resourceType": "Bundle", "entry": [{"fullUrl": "u"}, {"fullUrl": "v", "resource": {"id": "2"}}]},
    }
    lost = rejected_pages(read_pages(spark, land(tmp_path, pages), PATIENT, [DAY])).collect()
    found = {r["page_path"][-9:-5]: (r["reason"], r["entries_lost"]) for r in lost}
    assert found == {"0002": ("malformed page", None), "0003": ("not a bundle", 0), "0004": ("entry without resource", 1)}


def test_audit_reports_errors_and_missing_pages(spark, tmp_path):
    def linked(*resources, number):
        return bundle(*resources, link=[{"relation": "next", "url": f"https://x?page={number}"}])

    pages = {
        "page_0001.json": linked({"id": "1"}, {"id": "2"}, number=2),
        "page_0002.json": linked({"id": "3"}, number=3),
        "page_0004.json": "not json",
        "page_0005.json": bundle(),
        "notes.json": linked({"id": "9"}, number=7),
    }
    root = land(tmp_path, pages)
    log = audit_pages(read_pages(spark, root, PATIENT, [DAY], headers_only=True))
    assert log.exceptAll(audit_pages(read_pages(spark, root, PATIENT, [DAY]))).count() == 0
    rows = {r["page_number"]: r for r in log.collect()}
    assert {n: (r["records_fetched"], r["status"], r["error_message"]) for n, r in rows.items()} == {
        1: (2, "SUCCESS", None),
        2: (1, "SUCCESS", None),
        3: (0, "ERROR", "next page not landed"),
        4: (0, "ERROR", "malformed page"),
        5: (0, "SUCCESS", None),
        None: (1, "SUCCESS", None),
    }
    assert rows[3]["api_url"] == "https://x?page=3" and rows[3]["save_timestamp"] is None
    assert len({r["log_id"] for r in rows.values()}) == len(rows)
    assert {r["log_id"] for r in log.collect()} == {r["log_id"] for r in rows.values()}


def test_log_schema(spark, tmp_path):
    log = audit_pages(read_pages(spark, land(tmp_path, {"page_0001.json": bundle()}), PATIENT, [DAY]))
    assert dict(log.dtypes) == dict(empty_ingestion_log(spark).dtypes)
    assert log.columns == [c.split()[0] for c in INGESTION_LOG_DDL.split(", ")]


def test_bronze_columns_are_those_of_the_spec(spark, tmp_path):
    for name, spec in RESOURCES.items():
        rows = flatten_bundles(read_pages(spark, land(tmp_path / name, {"p.json": bundle()}, name), spec, [DAY]), spec)
        assert rows.dtypes == spark.createDataFrame([], spec.bronze_ddl).dtypes


def test_days_select_folders(spark, tmp_path):
    root = land(tmp_path, {"page_0001.json": bundle({"id": "1"})})
    other = tmp_path / "Patient" / "2024-03-02"
    other.mkdir()
    (other / "page_0001.json").write_text(json.dumps(bundle({"id": "2"})))
    pages = read_pages(spark, root, PATIENT, ["2024-03-02"])
    assert [r["resource_id"] for r in flatten_bundles(pages, PATIENT).collect()] == ["2"]


def test_unknown_resource_type():
    with pytest.raises(ValueError, match="unknown resource type 'Claim'"):
        spec_for("Claim")


def test_column_counts_and_hash_columns():
    assert {n: len(s.flat_columns) for n, s in RESOURCES.items()} == {
        "Patient": 17,
        "Encounter": 13,
        "Observation": 18,
        "Condition": 18,
    }
    assert {n: len(s.hash_columns) for n, s in RESOURCES.items()} == {
        "Patient": 13,
        "Encounter": 9,
        "Observation": 14,
        "Condition": 14,
    }
    for spec in RESOURCES.values():
        assert set(spec.hash_columns) <= set(spec.columns)
    assert OBSERVATION.bronze_table == "bronze_observation"
