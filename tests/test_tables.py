"""Stored tables: runs of a history, repeated days, the daily steps and the stream."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import RUN, bronze, brute_force, view

from recordloom.operators.landing import land_pages
from recordloom.plans import daily
from recordloom.session import new_folder
from recordloom.sources import star_tables as star
from recordloom.sources import tables as store
from recordloom.sources.pages import landing_path
from recordloom.specs import ENCOUNTER, PATIENT, RESOURCES
from recordloom.streaming.pages import ingest_available

DAYS = [
    [("1", "1", "2020-01-01", "a"), ("2", "1", "2020-01-01", "x")],
    [("1", "2", "2020-01-02", "b"), ("3", "1", "2020-01-02", "n")],
    [("1", "4", "2020-01-04", "a"), ("2", "3", "2020-01-03", "y")],
    [("2", "2", "2020-01-02", "late"), ("3", "2", "2020-01-05", "m")],
]


def run_days(spark, root, count):
    for run in range(count):
        earlier = bronze(spark, [r for d in DAYS[:run] for r in d])
        daily.advance_history(bronze(spark, DAYS[run]), earlier, root, ENCOUNTER, {str(run): "once"}, RUN[run])


def abandon(rows, root, run):
    """What a crashed attempt leaves: rows that no finished run names."""
    rows = rows.withColumns({"run": F.lit(run).cast("long"), "write": F.lit("crashed")})
    store.write_partitions(rows, f"{root}/rows", "is_current", "write")


def all_rows(count):
    return [r for d in DAYS[:count] for r in d]


@pytest.mark.parametrize("count", [1, 2, 4])
def test_stored_runs_equal_one_rebuild(spark, count):
    root = new_folder(spark, "history")
    run_days(spark, root, count)
    assert view(store.read_history(spark, root)) == brute_force(all_rows(count))
    assert view(store.read_current(spark, root)) == [r for r in brute_force(all_rows(count)) if r[5]]


def test_finished_run_is_not_repeated(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 2)
    daily.advance_history(bronze(spark, DAYS[2]), bronze(spark, all_rows(2)), root, ENCOUNTER, {"1": "once"}, RUN[5])
    assert view(store.read_history(spark, root)) == brute_force(all_rows(2))


def test_unfinished_run_does_not_count_and_can_be_repeated(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 1)
    wrong = store.read_current(spark, root).withColumns({"status": F.lit("half"), "is_current": F.lit(False)})
    abandon(wrong, root, 2)
    assert view(store.read_history(spark, root)) == brute_force(all_rows(1))
    run_days(spark, root, 2)
    assert view(store.read_history(spark, root)) == brute_force(all_rows(2))


def test_rows_of_an_abandoned_run_stay_out(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 2)
    wrong = store.read_current(spark, root).withColumn("is_current", F.lit(False))
    abandon(wrong, root, 3)
    daily.advance_history(bronze(spark, DAYS[2]), bronze(spark, all_rows(2)), root, ENCOUNTER, {"2": "once"}, RUN[3])
    assert view(store.read_history(spark, root)) == brute_force(all_rows(3))


def test_whole_history_starts_a_new_base(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 2)
    again = store.read_history(spark, root)
    store.write_history_run(again, root, 7)
    assert store.history_runs(spark, root)[-1]["base"] == 7
    assert view(store.read_history(spark, root)) == brute_force(all_rows(2))


def test_reading_current_rows_prunes_partitions(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 2)
    plan = store.read_current(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "write" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_no_history_yet(spark):
    root = new_folder(spark, "history")
    assert store.read_history(spark, root) is None and store.read_current(spark, root) is None


def test_daily_steps(spark, folder):
    landing, bronze_root, log, histories = (new_folder(spark, n) for n in ("landing", "bronze", "log", "silver"))
    tables = {n: star.table(spark, folder, n) for n in ("customer", "orders", "lineitem", "part")}
    records = {
        "Patient": star.patients(tables["customer"]),
        "Encounter": star.encounters(tables["orders"], tables["lineitem"]),
        "Observation": star.observations(tables["lineitem"], tables["orders"]),
        "Condition": star.conditions(tables["lineitem"], tables["orders"], tables["part"]),
    }
    counts = {}
    for name, rows in records.items():
        spec = RESOURCES[name]
        land_pages(rows, landing, spec, "2024-01-02")
        for _ in range(2):  # a repeated day replaces itself
            counts[name] = daily.ingest_day(spark, landing, bronze_root, log, spec, "2024-01-02")
        daily.update_history(spark, bronze_root, histories, spec, RUN[0])
    assert counts == {"Patient": 150, "Encounter": 1500, "Observation": 6000, "Condition": 6000}
    logged = store.read_ingestion_log(spark, log).groupBy("resource_type").agg(F.sum("records_fetched").alias("n"))
    assert {r["resource_type"]: r["n"] for r in logged.collect()} == counts
    stored = daily.read_histories(spark, histories, RESOURCES.values())
    summary = daily.mart_tables(stored, date(2024, 1, 1))["patient_summary"]
    assert summary.count() == 150
    assert summary.agg(F.sum("total_encounters")).first()[0] == 1500


def test_stream_takes_each_file_once_and_keeps_the_history(spark, folder):
    landing, bronze_root, progress, history = (new_folder(spark, n) for n in ("landing", "bronze", "progress", "silver"))
    customers = star.table(spark, folder, "customer")
    renamed = customers.withColumn("c_mktsegment", F.lit("RENAMED"))

    def versions(rows, version):
        changed = star.patients(rows)
        meta = F.struct(F.lit(version).alias("versionId"), F.lit(f"2024-01-0{version}T00:00:00Z").alias("lastUpdated"), F.lit("t").alias("source"))
        return changed.withColumn("r", F.col("r").withField("meta", meta))

    land_pages(versions(customers, "1"), landing, PATIENT, "2024-01-02")
    ingest_available(spark, landing, bronze_root, progress, PATIENT, history, RUN[0])
    ingest_available(spark, landing, bronze_root, progress, PATIENT, history, RUN[1])
    land_pages(versions(renamed, "2"), landing, PATIENT, "2024-01-03")
    ingest_available(spark, landing, bronze_root, progress, PATIENT, history, RUN[2])
    assert store.read_bronze(spark, bronze_root).count() == 300
    rows = store.read_history(spark, history)
    assert (rows.count(), rows.filter("is_current").count()) == (300, 150)
    assert rows.filter("is_current and marital_status_code = 'RENAMED'").count() == 150
    assert landing_path(landing, "Patient", "2024-01-02").endswith("/Patient/2024-01-02")


def versions_of(spark, rows, day):
    return bronze(spark, rows).withColumn("ingestion_date", F.lit(day).cast("date"))


def test_history_follows_bronze_over_first_load_rerun_and_backfill(spark):
    bronze_root, root = new_folder(spark, "bronze"), new_folder(spark, "silver")
    days = {"2024-01-02": DAYS[0], "2024-01-03": DAYS[1]}

    def ingest(day, rows):
        days[day] = rows
        store.write_bronze(versions_of(spark, rows, day), f"{bronze_root}/bronze_encounter", day)

    def check(at):
        daily.update_history(spark, bronze_root, root, ENCOUNTER, RUN[at])
        everything = [r for rows in days.values() for r in rows]
        assert view(store.read_history(spark, f"{root}/silver_encounter")) == brute_force(everything)

    for day, rows in list(days.items()):
        ingest(day, rows)
    check(0)  # several days before the first call
    ingest("2024-01-03", DAYS[1] + [("9", "1", "2020-01-09", "z")])
    check(1)  # a day again, with more
    ingest("2024-01-01", DAYS[2])
    check(2)  # an earlier day afterwards
    ingest("2024-01-03", [])
    check(3)  # a day that lost all its rows
    ingest("2024-01-05", DAYS[3])
    check(4)
    check(5)  # nothing new


def test_run_writes_touched_ids_only_and_compaction_keeps_the_history(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 1)
    batch = bronze(spark, [("1", "2", "2020-01-02", "b")])
    daily.advance_history(batch, bronze(spark, DAYS[0]), root, ENCOUNTER, {"b": "once"}, RUN[1])
    newest = store.history_runs(spark, root)[-1]["write"]
    written = spark.read.parquet(f"{root}/rows").filter(F.col("write") == newest)
    assert {r["resource_id"] for r in written.collect()} == {"1"}
    before = view(store.read_history(spark, root))
    assert store.vacuum_history(spark, root) == 0
    store.compact_history(spark, root)
    assert view(store.read_history(spark, root)) == before
    assert store.vacuum_history(spark, root) > 0
    assert view(store.read_history(spark, root)) == before
    daily.advance_history(bronze(spark, DAYS[1]), batch.unionByName(bronze(spark, DAYS[0])), root, ENCOUNTER, {"c": "once"}, RUN[2])
    assert view(store.read_history(spark, root)) == brute_force(DAYS[0] + [("1", "2", "2020-01-02", "b")] + DAYS[1])


def test_day_without_pages_ends_quietly(spark):
    roots = [new_folder(spark, n) for n in ("landing", "bronze", "log")]
    assert daily.ingest_day(spark, *roots, PATIENT, "2024-01-02") == 0


def test_second_stream_adds_to_bronze(spark, folder):
    landing, bronze_root, log = (new_folder(spark, n) for n in ("landing", "bronze", "log"))
    customers = star.table(spark, folder, "customer")
    for day, part in (("2024-01-02", "c_custkey % 2 = 0"), ("2024-01-03", "c_custkey % 2 = 1")):
        one = new_folder(spark, "landing")
        land_pages(star.patients(customers.filter(part)), one, PATIENT, day)
        ingest_available(spark, one, bronze_root, new_folder(spark, "progress"), PATIENT, log=log)
    assert store.read_bronze(spark, bronze_root).count() == 150
    assert spark.read.parquet(log).agg(F.sum("records_fetched")).first()[0] == 150


def test_history_in_run_time_is_stored(spark):
    bronze_root, root = new_folder(spark, "bronze"), new_folder(spark, "silver")
    for at, (day, rows) in enumerate((("2024-01-02", DAYS[0]), ("2024-01-03", DAYS[1]))):
        store.write_bronze(versions_of(spark, rows, day), f"{bronze_root}/bronze_encounter", day)
        daily.update_history_in_run_time(spark, bronze_root, root, ENCOUNTER, RUN[at])
    rows = store.read_history(spark, f"{root}/silver_encounter_by_run")
    assert (rows.count(), rows.filter("is_current").count()) == (4, 3)


def test_repeated_day_writes_the_ids_of_its_old_and_new_rows_only(spark):
    bronze_root, root = new_folder(spark, "bronze"), new_folder(spark, "silver")
    table, target = f"{bronze_root}/bronze_encounter", f"{root}/silver_encounter"
    many = [(f"o{i}", "1", "2020-01-01", "q") for i in range(50)]
    days = {"2024-01-02": DAYS[0] + many, "2024-01-03": [(" 1", "2", "2020-01-02", "b"), ("3", "1", "2020-01-02", "n"), ("  ", "1", "2020-01-02", "n")]}
    for day, rows in days.items():
        store.write_bronze(versions_of(spark, rows, day), table, day)
    daily.update_history(spark, bronze_root, root, ENCOUNTER, RUN[0])
    days["2024-01-03"] = [("3", "2", "2020-01-05", "m"), ("4", "1", "2020-01-05", "new")]
    days["2024-01-04"] = [("o7", "2", "2020-01-09", "later"), ("4", "2", "2020-01-03", "late")]
    for day in ("2024-01-03", "2024-01-04"):
        store.write_bronze(versions_of(spark, days[day], day), table, day)
    daily.update_history(spark, bronze_root, root, ENCOUNTER, RUN[1])
    clean = [r for rows in days.values() for r in rows]
    assert view(store.read_history(spark, target)) == brute_force(clean)
    marks = store.history_runs(spark, target)
    assert [m["run"] for m in marks] == [1, 2] and marks[1]["base"] == 1
    last = F.col("write") == marks[1]["write"]
    written = spark.read.parquet(f"{target}/rows").filter(last)
    assert {r[0] for r in written.select("resource_id").collect()} == {"1", "3", "4", "o7"}
    touched = spark.read.parquet(f"{target}/touched").filter(last)
    assert {tuple(r) for r in touched.select("resource_id", "corrected").collect()} == {("1", True), ("3", True), ("4", True), ("o7", False)}
    days["2024-01-03"] = []
    store.write_bronze(versions_of(spark, [], "2024-01-03"), table, "2024-01-03")
    daily.update_history(spark, bronze_root, root, ENCOUNTER, RUN[2])
    assert view(store.read_history(spark, target)) == brute_force([r for rows in days.values() for r in rows])


def test_second_writer_of_a_run_is_refused(spark):
    root = new_folder(spark, "history")
    run_days(spark, root, 2)
    run, seen = store.next_run(spark, root)
    rows = store.read_current(spark, root)
    run_days_again = bronze(spark, DAYS[2])
    daily.advance_history(run_days_again, bronze(spark, all_rows(2)), root, ENCOUNTER, {"2": "once"}, RUN[2])
    touched = rows.select("resource_id")
    with pytest.raises(store.RunTaken):
        store.write_history_run(rows, root, run, touched, seen=seen)
    with pytest.raises(store.RunTaken):  # a later number does not help: the rows were made from an older history
        store.write_history_run(rows, root, run + 1, touched, seen=seen)
    assert view(store.read_history(spark, root)) == brute_force(all_rows(3))
    files, claim = store._files(spark, f"{root}/claims/run=4")
    files.createNewFile(claim)  # a writer that crashed after it had taken its number
    with pytest.raises(store.RunTaken):
        store.write_history_run(rows, root, 4, touched)
    daily.advance_history(bronze(spark, DAYS[3]), bronze(spark, all_rows(3)), root, ENCOUNTER, {"3": "once"}, RUN[3])
    assert [m["run"] for m in store.history_runs(spark, root)] == [1, 2, 3, 5]
    assert view(store.read_history(spark, root)) == brute_force(all_rows(4))


def test_states_of_a_day_are_ordered_without_a_clock(spark):
    root = new_folder(spark, "bronze")
    for rows in (DAYS[0], DAYS[1], DAYS[2]):
        store.write_bronze(versions_of(spark, rows, "2024-01-02"), root, "2024-01-02")
    marks = sorted(spark.read.parquet(f"{root}-states").collect(), key=lambda m: m["at"])
    assert [m["at"] for m in marks] == [1, 2, 3] and store.bronze_states(spark, root) == {"2024-01-02": marks[-1]["state"]}
    old = store.ids_of_states(spark, root, [marks[0]["state"]])
    assert {r[0] for r in old.collect()} == {"1", "2"}
    assert store.ids_of_states(spark, new_folder(spark, "none"), ["x"]) is None


PAGES = {
    "page_0001.json": '{"resourceType":"Bundle","id":"page_0001","link":[{"relation":"next","url":"u2"}],"entry":[{"fullUrl":"a","resource":{"resourceType":"Patient","id":"1"}}]}',
    "page_0002.json": '{"resourceType":"Bundle","id":"page_0002","entry":[{"fullUrl":"b","resource":"not a record"}]}',
    "page_0003.json": '{"resourceType":"Bundle","id":"page_0003","entry":[{"fullUrl":"c"}]}',
    "page_0004.json": '{"resourceType":"Bundle", broken',
    "page_0005.json": '{"resourceType":"Other","id":"page_0005"}',
}


def test_daily_and_streamed_logs_agree_and_pages_are_parsed_once(spark, tmp_path, monkeypatch):
    day = tmp_path / "landing" / "Patient" / "2024-01-02"
    day.mkdir(parents=True)
    for name, text in PAGES.items():
        (day / name).write_text(text)
    reads = []
    read_pages = daily.read_pages
    monkeypatch.setattr(daily, "read_pages", lambda *a, **k: reads.append(a) or read_pages(*a, **k))
    paths = {n: str(tmp_path / n) for n in ("bronze", "log", "rejects", "s-bronze", "s-log", "s-rejects", "progress")}
    landing = str(tmp_path / "landing")
    rows = daily.ingest_day(spark, landing, paths["bronze"], paths["log"], PATIENT, "2024-01-02", False, paths["rejects"])
    assert len(reads) == 1 and rows == store.read_bronze(spark, f"{paths['bronze']}/{PATIENT.bronze_table}").count()
    ingest_available(
        spark, landing, paths["s-bronze"], paths["progress"], PATIENT, one_per_line=False, log=paths["s-log"], rejects=paths["s-rejects"]
    )
    columns = ["log_id", "page_number", "records_fetched", "status", "error_message", "ingestion_date"]
    logs = [{tuple(r) for r in store.read_ingestion_log(spark, paths[n]).select(columns).collect()} for n in ("log", "s-log")]
    assert logs[0] == logs[1] and len(logs[0]) == 5
    lost = [{tuple(r) for r in spark.read.parquet(paths[n]).select("page_path", "reason", "entries_lost").collect()} for n in ("rejects", "s-rejects")]
    assert lost[0] == lost[1] and len(lost[0]) >= 3
    assert {tuple(r)[1:] for r in store.read_bronze(spark, paths["s-bronze"]).select("stream", "resource_id").collect()} == {
        tuple(r) for r in store.read_bronze(spark, f"{paths['bronze']}/{PATIENT.bronze_table}").select("resource_id").collect()
    }
