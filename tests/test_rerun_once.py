"""A day run again with another one beside it: one pass over what was delivered, and all cells anew when every id is touched."""

from rows import RUN
from test_summary import advance, land, visit

from recordloom.plans import daily, summary
from recordloom.session import new_folder
from recordloom.sources import tables as store
from recordloom.specs import RESOURCES


def test_derived_and_continued_ids_share_their_windows(spark, monkeypatch):
    bronze, silver, root = [new_folder(spark, n) for n in ("bronze", "silver", "summary")]
    spec, start = RESOURCES["Encounter"], "2020-01-01"
    history = f"{silver}/{spec.silver_table}"
    advance(spark, {"Encounter": ("2024-01-01", [visit("a", "p1", start), visit("b", "p2", start)])}, RUN[0], bronze, silver)
    assert summary.refresh_source(spark, history, root, "Encounter")
    land(spark, bronze, "Encounter", "2024-01-01", [visit("a", "p2", start)])
    land(spark, bronze, "Encounter", "2024-01-02", [visit(k, "p3", start) for k in "bcd"])
    written, write = [], daily.write_history_run
    monkeypatch.setattr(daily, "write_history_run", lambda rows, *more: (written.append(rows), write(rows, *more)))
    daily.update_history(spark, bronze, silver, spec, RUN[1])
    assert written[0]._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 3
    held = store.read_history(spark, history).select("resource_id", "patient_reference", "is_current").collect()
    assert sorted(map(tuple, held)) == [(k, f"Patient/{p}", True) for k, p in zip("abcd", ("p2", "p3", "p3", "p3"), strict=True)]
    # Four ids were touched and two had a place: the run is a new base.
    assert summary.refresh_source(spark, history, root, "Encounter")
    assert [m["base"] for m in store.history_runs(spark, f"{root}/Encounter")] == [1, 2]
