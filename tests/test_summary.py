"""The summary kept by run, against the full one after every run."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import RUN

from recordloom.plans import daily, marts, summary
from recordloom.session import new_folder
from recordloom.sources import tables as store
from recordloom.specs import ID, RESOURCES

SOURCES = ("Encounter", "Observation", "Condition")


def land(spark, bronze, name, day, rows):
    """Bronze rows of a day, given as dicts of flat columns."""
    spec = RESOURCES[name]
    empty = spark.createDataFrame([], spec.bronze_ddl)
    filled = [
        {"meta_version_id": "1", "meta_last_updated": "2020-01-01", "ingestion_date": date.fromisoformat(day), "resource_type": name, **r}
        for r in rows
    ]
    df = spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in filled], empty.schema)
    store.write_bronze(df, f"{bronze}/{spec.bronze_table}", day)


def visit(key, patient, start, end=None, **more):
    return {"resource_id": key, "patient_reference": patient and f"Patient/{patient}", "period_start": start, "period_end": end, **more}


def code(key, patient, value, shown=None, at=None, **more):
    named = {"condition_code": value, "condition_display": shown, "observation_code": value, "effective_datetime": at}
    return {"resource_id": key, "patient_reference": patient and f"Patient/{patient}", **named, **more}


LATER = {"meta_version_id": "2", "meta_last_updated": "2020-02-01"}
OLDER = {"meta_version_id": "0", "meta_last_updated": "2019-01-01"}
CODES = [code("a", "p1", "x", "Ex", "2020-01-01"), code("b", "p1", "y", "Why", "2021-01-01"), code("c", "p2", None, "No code", "bad"), code("d", None, "x")]
# Each step lands days by source; the summary must equal the full one after each.
STEPS = [
    {
        "Encounter": ("2024-01-01", [
            visit("e1", "p1", "2020-01-01T00:00:00Z", "2020-01-01T02:00:00Z"), visit("e2", "p1", "2019-05-01", "2019-05-02"),
            visit("e3", "p2", "bad", "2020-01-01"), visit("e4", None, "2020-01-01"), visit("e5", "p1", None),
        ]),
        "Observation": ("2024-01-01", CODES),
        "Condition": ("2024-01-01", CODES),
    },
    # The earliest visit moves to another patient, a record is closed by one without a patient, a code's only record changes.
    {
        "Encounter": ("2024-01-02", [visit("e2", "p3", "2019-05-01", "2019-05-03", **LATER), visit("e3", None, "bad", **LATER), visit("e6", "p2", "2020-03-01", "2020-03-01T00:00:01Z")]),
        "Observation": ("2024-01-02", [code("b", "p1", "x", "Ex", "2018-01-01", **LATER), code("d", "p3", "z", "Zed", **LATER)]),
        "Condition": ("2024-01-02", [code("b", "p1", "x", "Ex again", **LATER), code("a", "p1", "x", "Ex", "2020-01-01")]),
    },
    # Late: older than what is current, so nothing shown may change; and one source only.
    {"Observation": ("2024-01-03", [code("a", "p2", "late", "Late", "2030-01-01", **OLDER)])},
    # Days run again: with fewer records, and with none.
    {"Encounter": ("2024-01-01", [visit("e1", "p2", "2020-01-01T00:00:00Z")]), "Condition": ("2024-01-01", [])},
    {"Condition": ("2024-01-02", [])},
]


def advance(spark, step, at, bronze, silver):
    for name, (day, rows) in step.items():
        land(spark, bronze, name, day, rows)
        daily.update_history(spark, bronze, silver, RESOURCES[name], at)


def patients(spark):
    known = spark.createDataFrame([("p1",), ("p2",), ("p3",), ("p4",)], "patient_id string")
    others = [c for c in marts.PATIENT_SUMMARY[1:9]]
    return known.withColumns({c: F.lit(None).cast("string") for c in others})


def view(df):
    return sorted(map(tuple, df.collect()))


def full(spark, silver):
    histories = daily.read_histories(spark, silver, [RESOURCES[n] for n in SOURCES])
    return view(marts.patient_summary(patients(spark), histories["Encounter"], histories["Condition"], histories["Observation"]))


@pytest.fixture
def folders(spark):
    return [new_folder(spark, n) for n in ("bronze", "silver", "summary")]


def test_every_run_equals_the_full_summary(spark, folders):
    bronze, silver, root = folders
    for step, at in zip(STEPS, RUN, strict=False):
        advance(spark, step, at, bronze, silver)
        summary.refresh_summary(spark, silver, root)
        assert view(summary.kept_summary(spark, root, patients(spark))) == full(spark, silver)
    assert [len(store.history_runs(spark, f"{root}/{n}")) for n in SOURCES] == [3, 3, 4]
    assert not any(summary.refresh_source(spark, f"{silver}/{RESOURCES[n].silver_table}", root, n) for n in SOURCES)
    # Only concerned cells were written.
    cells = spark.read.parquet(f"{root}/Encounter/cells").filter("run = 2")
    left = {("p1", "=2019-05"), ("p2", "=bad")}
    assert {tuple(r) for r in cells.select("patient_id", "cell").collect()} == left | {("p3", "=2019-05"), ("p2", "=2020-03")}
    assert {tuple(r) for r in cells.filter("n is null").select("patient_id", "cell").collect()} == left
    assert spark.read.parquet(f"{root}/Encounter/owners").filter("run = 2").count() == 3


def test_compacted_histories_and_cells(spark, folders, monkeypatch):
    bronze, silver, root = folders
    monkeypatch.setattr(summary, "COMPACT_AFTER", 1)
    for n, (step, at) in enumerate(zip(STEPS[:3], RUN, strict=False)):
        advance(spark, step, at, bronze, silver)
        if n == 1:  # compacted before the summary saw the run, with its list of ids still there
            store.compact_history(spark, f"{silver}/{RESOURCES['Encounter'].silver_table}")
        if n == 2:  # compacted, and the list removed: everything is aggregated anew
            table = f"{silver}/{RESOURCES['Observation'].silver_table}"
            store.compact_history(spark, table)
            store.vacuum_history(spark, table)
        summary.refresh_summary(spark, silver, root)
        assert view(summary.kept_summary(spark, root, patients(spark))) == full(spark, silver)
    assert all(len(store.counting(store.history_runs(spark, f"{root}/{n}"))) <= 2 for n in SOURCES)


def test_sources_without_history_and_a_second_writer(spark, folders, monkeypatch):
    bronze, silver, root = folders
    summary.refresh_summary(spark, silver, root)
    assert {r["total_encounters"] for r in summary.kept_summary(spark, root, patients(spark)).collect()} == {0}
    advance(spark, {"Encounter": STEPS[0]["Encounter"]}, RUN[0], bronze, silver)
    history = f"{silver}/{RESOURCES['Encounter'].silver_table}"
    write = summary._write

    def late(cells, owners, own, run, seen, base, upto):
        write(cells, owners, own, run, seen, base, upto)
        write(cells, owners, own, run, seen, base, upto)

    monkeypatch.setattr(summary, "_write", late)
    with pytest.raises(store.RunTaken):
        summary.refresh_source(spark, history, root, "Encounter")
    kept = {r["patient_id"]: r["total_encounters"] for r in summary.kept_summary(spark, root, patients(spark)).collect()}
    assert kept == {"p1": 3, "p2": 1, "p3": 0, "p4": 0}
    assert spark.read.parquet(f"{root}/Encounter/owners").select(ID).distinct().count() == 4
