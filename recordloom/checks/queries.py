"""One query per operator, over the whole star-schema tables. Each takes (spark, folder of tables).

checks/oracles.py states the same results in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.functions.columns import age_years, reference_key, span_hours, trimmed
from recordloom.operators import chains
from recordloom.operators import history as h
from recordloom.operators.audit import audit_pages, day_totals
from recordloom.operators.bundles import LINEAGE, rejected_pages
from recordloom.operators.changes import detect_changes, rows_to_write
from recordloom.operators.cleaning import deliveries, first_deliveries
from recordloom.operators.drift import schema_drift
from recordloom.operators.landing import land_pages, to_pages
from recordloom.operators.metrics import layer_metrics
from recordloom.operators.raw import flatten_raw, raw_records
from recordloom.plans import daily, marts, summary
from recordloom.session import new_folder, pin, side_by_side, stored
from recordloom.sources import star_tables as star
from recordloom.sources import tables as store
from recordloom.sources.pages import in_window, read_page_texts, read_pages
from recordloom.specs import CONDITION, ENCOUNTER, OBSERVATION, PATIENT, RESOURCES, spec_for
from recordloom.streaming.pages import ingest_available
from recordloom.streaming.unique import ingest_unique

FIRST_RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 2, 2, tzinfo=timezone.utc)
THIRD_RUN = datetime(2024, 2, 3, tzinfo=timezone.utc)
AGE_DAY = date(2024, 1, 1)
CUT = "1998-01-01"
VERSION_COLUMNS = ["resource_id", "meta_version_id", "record_hash", "is_current", "valid_from", "valid_to"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name, with the session pinned and zone-free timestamps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = function(pin(spark), folder)
        zoned = [f.name for f in result.schema.fields if f.dataType.typeName() == "timestamp"]
        return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[function.__name__] = run
    return function


# --- inputs -----------------------------------------------------------------------------------


def _table(spark, folder, name) -> DataFrame:
    return star.table(spark, folder, name)


def _order_versions(spark, folder, keep=None) -> DataFrame:
    orders = _table(spark, folder, "orders")
    return star.delivered(star.patients_by_order(orders if keep is None else orders.filter(keep)), ENCOUNTER)


def _before_and_after(spark, folder) -> tuple[DataFrame, DataFrame]:
    return _order_versions(spark, folder, F.col("o_orderdate") < CUT), _order_versions(
        spark, folder, F.col("o_orderdate") >= CUT
    )


def _bronze(spark, folder, name) -> DataFrame:
    t = lambda n: _table(spark, folder, n)
    records = {
        "Patient": lambda: star.patients(t("customer")),
        "Encounter": lambda: star.encounters(t("orders"), t("lineitem")),
        "Observation": lambda: star.observations(t("lineitem"), t("orders")),
        "Condition": lambda: star.conditions(t("lineitem"), t("orders"), t("part")),
    }
    return star.bronze_rows(records[name](), spec_for(name))


def _history(spark, folder, name) -> DataFrame:
    spec = spec_for(name)
    return h.rebuild(deliveries(_bronze(spark, folder, name), spec), FIRST_RUN, hashed=spec.hash_columns)


def _dim_patient(spark, folder) -> DataFrame:
    return marts.dim_patient(_history(spark, folder, "Patient"), AGE_DAY)


def _flat(bronze: DataFrame) -> DataFrame:
    return bronze.drop("raw_resource_json", *LINEAGE)


# --- pages ------------------------------------------------------------------------------------


@query
def bundle_flatten_customer(spark, folder):
    return _flat(star.bronze_through_pages(star.patients(star.table(spark, folder, "customer")), PATIENT, True))


@query
def bundle_flatten_orders(spark, folder):
    return _flat(star.bronze_through_pages(star.encounters(star.table(spark, folder, "orders")), ENCOUNTER, True))


@query
def bundle_flatten_lineitem(spark, folder):
    records = star.observations(_table(spark, folder, "lineitem"), _table(spark, folder, "orders"))
    return _flat(star.bronze_through_pages(records, OBSERVATION))


@query
def bundle_flatten_part(spark, folder):
    records = star.conditions(*[_table(spark, folder, n) for n in ("lineitem", "orders", "part")])
    return _flat(star.bronze_through_pages(records, CONDITION))


@query
def bundle_entry_counts(spark, folder):
    pages = star.pages_of(star.patients(star.table(spark, folder, "customer")), PATIENT, True)
    return pages.select(F.col("id").alias("page_id"), F.size("entry").cast("long").alias("records"))


@query
def raw_json_round_trip(spark, folder):
    """The stored JSON of each record, read back."""
    bronze = star.bronze_through_pages(star.patients(star.table(spark, folder, "customer")), PATIENT, True)
    again = F.from_json("raw_resource_json", PATIENT.body)
    return bronze.select("resource_id", again["birthDate"].alias("birth_date"), F.size(again["name"]).alias("names"))


@query
def lineage_columns(spark, folder):
    bronze = star.bronze_through_pages(star.patients(star.table(spark, folder, "customer")), PATIENT, True)
    page = F.regexp_extract("api_url_or_params", r"page=(\d+)$", 1).cast("long")
    return bronze.groupBy("resource_type", "ingestion_date", "extraction_timestamp", page.alias("page")).agg(
        F.count(F.lit(1)).alias("records")
    )


@query
def registry_dispatch_rows(spark, folder):
    """Rows and columns that each registered resource type gives."""
    counts = [
        _flat(_bronze(spark, folder, name)).agg(
            F.lit(name).alias("resource_type"),
            F.count("resource_id").alias("records"),
            F.lit(len(spec_for(name).flat_columns)).alias("columns"),
        )
        for name in RESOURCES
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query
def current_window_filter(spark, folder):
    events = _table(spark, folder, "events")
    return events.filter(in_window("ts", "2024-01-15")).select("event_id", "user_id", "event_type")


@query
def event_props_parse(spark, folder):
    parsed = F.from_json("props", "k bigint")
    return _table(spark, folder, "events").select("event_id", parsed["k"].alias("k"))


def _land(spark, folder, landing, name="Patient", day=star.DAY, keep=None) -> str:
    source, adapter = {"Patient": ("customer", star.patients), "Encounter": ("orders", star.encounters)}[name]
    rows = _table(spark, folder, source)
    return land_pages(adapter(rows if keep is None else rows.filter(keep)), landing, spec_for(name), day)


LOG_VIEW = ["resource_type", "page_number", "records_fetched", "status", "error_message", "ingestion_date"]


@query
def audit_pages_ok(spark, folder):
    """Pages landed as files, read back and logged; the log is stored and read again."""
    landing, log = new_folder(spark, "landing"), new_folder(spark, "log")
    _land(spark, folder, landing)
    store.write_ingestion_log(audit_pages(read_pages(spark, landing, PATIENT, [star.DAY], True, headers_only=True)), log)
    return store.read_ingestion_log(spark, log).select(*LOG_VIEW)


def _damaged_pages(spark, folder) -> DataFrame:
    """Order pages on file with every fifth page missing and every seventh cut off half-way."""
    landing = new_folder(spark, "damaged")
    pages = to_pages(star.encounters(star.table(spark, folder, "orders")), ENCOUNTER)
    number = F.col("page_number")
    half = F.left("value", (F.length("value") / 2).cast("int"))
    damaged = pages.filter(number % 5 != 0).select(F.when(number % 7 == 0, half).otherwise(F.col("value")))
    damaged.write.text(f"{landing}/Encounter/{star.DAY}")
    return read_pages(spark, landing, ENCOUNTER, [star.DAY], True)


@query
def audit_pages_corrupt(spark, folder):
    return audit_pages(_damaged_pages(spark, folder)).select(*LOG_VIEW)


@query
def audit_day_totals(spark, folder):
    return day_totals(audit_pages(_damaged_pages(spark, folder)))


@query
def feed_link_chains(spark, folder):
    """Orders as pages that link to the next one of their customer, with breaks, cycles and shortcuts."""
    orders = _table(spark, folder, "orders")
    mine = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    whole = mine.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = (
        F.when(F.col("o_orderkey") % 10 == 3, F.nullif(F.last("o_orderkey").over(whole), "o_orderkey"))
        .when((F.col("o_custkey") % 4 == 0) & F.lead("o_orderkey").over(mine).isNull(), F.first("o_orderkey").over(whole))
        .otherwise(F.lead("o_orderkey").over(mine))
    )
    linked = orders.select(
        (F.col("o_custkey") % 3).alias("feed_group"),
        F.col("o_orderkey").cast("string").alias("url"),
        following.cast("string").alias("next_url"),
    )
    landed = linked.filter("cast(url as long) % 17 <> 0")
    return chains.feeds(chains.ranked_pages(landed, ["feed_group"]), ["feed_group"])


@query
def rejected_pages_report(spark, folder):
    lost = rejected_pages(_damaged_pages(spark, folder))
    return lost.groupBy("resource_type", "reason").agg(F.count(F.lit(1)).alias("pages"))


@query
def pages_stream_available_now(spark, folder):
    """Two days land one after the other; a third start finds nothing new."""
    landing, bronze, checkpoint = (new_folder(spark, n) for n in ("landing", "bronze", "progress"))
    even = F.col("c_custkey") % 2 == 0
    for day, part in (("2024-01-02", even), ("2024-01-03", ~even), (None, None)):
        if day:
            _land(spark, folder, landing, day=day, keep=part)
        ingest_available(spark, landing, bronze, checkpoint, PATIENT)
    rows = store.read_bronze(spark, bronze)
    return rows.select("resource_id", "ingestion_date", "name_text", "batch")


@query
def stream_unique_versions(spark, folder):
    """Orders land, then all of them again on the next day with those of one status changed; each version reaches bronze once."""
    landing, bronze, checkpoint = (new_folder(spark, n) for n in ("landing", "bronze", "progress"))
    records = star.encounters(_table(spark, folder, "orders"))
    status, meta = F.col("r.status"), F.col("r.meta")
    changed = records.withColumn(
        "r", F.when(status == "F", F.col("r").withField("meta", meta.withField("versionId", F.lit("2")))).otherwise(F.col("r"))
    )
    for day, delivered in (("2024-01-02", records), ("2024-01-03", changed)):
        land_pages(delivered, landing, ENCOUNTER, day)
        ingest_unique(spark, landing, bronze, checkpoint, ENCOUNTER)
    return store.read_bronze(spark, bronze).select("resource_id", "meta_version_id", "ingestion_date", "status")


@query
def variant_flatten_lineitem(spark, folder):
    """Whole records stored as VARIANT, then flat columns taken from the stored table."""
    landing, root = new_folder(spark, "landing"), new_folder(spark, "raw")
    records = star.observations(_table(spark, folder, "lineitem"), _table(spark, folder, "orders"))
    land_pages(records, landing, OBSERVATION, star.DAY)
    raw_records(read_page_texts(spark, landing, OBSERVATION, [star.DAY], one_per_line=True)).write.parquet(root)
    return _flat(flatten_raw(spark.read.parquet(root), OBSERVATION))


@query
def schema_drift_orders(spark, folder):
    """Orders with fields nobody declared, at the top, in an object and in an array, and with values of another kind."""
    landing = new_folder(spark, "landing")
    orders = _table(spark, folder, "orders")
    number = F.expr("cast(split(full_url, ':')[2] as bigint)")
    r = F.col("r")
    some = lambda n, value: F.when(number % n == 0, value)
    added = r.withField("priority", some(3, F.struct(number.alias("rank")))).withField(
        "subject", r["subject"].withField("display", some(5, F.lit("name")))
    )
    shaped = added.withField("type", F.transform(r["type"], lambda t: t.withField("userSelected", F.lit(True))))
    retyped = r.withField("status", F.array(r["status"])).withField("period", number)
    for day, body in (("2024-01-02", shaped), ("2024-01-03", retyped)):
        land_pages(star.encounters(orders).withColumn("r", body), landing, ENCOUNTER, day)
    texts = read_page_texts(spark, landing, ENCOUNTER, ["2024-01-02", "2024-01-03"], one_per_line=True)
    return schema_drift(raw_records(texts), ENCOUNTER)


@query
def layer_balance_orders(spark, folder):
    """Two days of orders, the second with those of the first again, blank ids, and entries without a resource."""
    landing, bronze, silver, log = (new_folder(spark, n) for n in ("landing", "bronze", "silver", "log"))
    orders = _table(spark, folder, "orders")
    records = star.encounters(orders)
    number = F.expr("cast(split(full_url, ':')[2] as bigint)")
    blank = F.col("r").withField("id", F.lit("  "))
    second = F.when(number % 11 == 0, F.lit(None)).when(number % 7 == 0, blank).otherwise(F.col("r"))
    for day, sent in (("2024-01-02", records.filter(number % 2 == 0)), ("2024-01-03", records.withColumn("r", second))):
        land_pages(sent, landing, ENCOUNTER, day)
        daily.ingest_day(spark, landing, bronze, log, ENCOUNTER, day)
    daily.update_history(spark, bronze, silver, ENCOUNTER, FIRST_RUN)
    return daily.balance_of(spark, bronze, log, silver, ENCOUNTER)


@query
def bronze_merge_schema_append(spark, folder):
    """A column that exists from the second day on, and a repeated second day."""
    root = new_folder(spark, "bronze")
    orders = _table(spark, folder, "orders")
    first = star.bronze_rows(star.encounters(orders.filter(F.col("o_orderdate") < CUT)), ENCOUNTER, "2024-01-02")
    second = star.bronze_rows(star.encounters(orders.filter(F.col("o_orderdate") >= CUT)), ENCOUNTER, "2024-01-03")
    store.write_bronze(first.drop("type_code"), root)
    store.write_bronze(second, root)
    store.write_bronze(second, root)
    return store.read_bronze(spark, root).select("resource_id", "type_code", "ingestion_date")


# --- cleaning ---------------------------------------------------------------------------------


@query
def string_trim_all(spark, folder):
    customer = _table(spark, folder, "customer")
    padded = customer.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat(F.lit("\t"), "c_mktsegment", F.lit("  ")).alias("c_mktsegment"),
    )
    return trimmed(padded)


@query
def record_hash_orders(spark, folder):
    records = star.encounters(_table(spark, folder, "orders"))
    return star.delivered(records, ENCOUNTER).select("resource_id", "record_hash")


@query
def dedup_first_extraction(spark, folder):
    """All orders delivered on two days, on the second with another status: the first delivery stays."""
    orders = _table(spark, folder, "orders")
    closed = orders.withColumn("o_orderstatus", F.lit("closed"))
    again = star.bronze_rows(star.encounters(closed), ENCOUNTER, "2024-01-03", "2024-01-03 00:00:00")
    both = star.bronze_rows(star.encounters(orders), ENCOUNTER).unionByName(again)
    return first_deliveries(deliveries(both, ENCOUNTER)).select(
        "resource_id", "meta_version_id", "status", "ingestion_date"
    )


# --- change detection and history -------------------------------------------------------------


@query
def changes_new_or_changed(spark, folder):
    before, after = _before_and_after(spark, folder)
    return detect_changes(h.current_rows(h.rebuild(before, FIRST_RUN)), after)


@query
def changed_rows_to_write(spark, folder):
    before, after = _before_and_after(spark, folder)
    return rows_to_write(h.current_rows(h.rebuild(before, FIRST_RUN)), after).select("resource_id", "meta_version_id")


@query
def scd2_first_load(spark, folder):
    return h.first_load(_order_versions(spark, folder), FIRST_RUN).select(*VERSION_COLUMNS)


@query
def scd2_merge_run(spark, folder):
    """Two runs in run time: changed rows end when the second run starts their successor."""
    before, after = _before_and_after(spark, folder)
    return h.merge(h.first_load(before, FIRST_RUN), after, SECOND_RUN).select(*VERSION_COLUMNS, "scd_updated_at")


@query
def scd2_rebuild_orders(spark, folder):
    return h.rebuild(_order_versions(spark, folder), FIRST_RUN).select(*VERSION_COLUMNS)


@query
def scd2_rebuild_events(spark, folder):
    events = star.delivered(star.users_by_event(_table(spark, folder, "events")), ENCOUNTER)
    return h.rebuild(events, FIRST_RUN).select("resource_id", "meta_version_id", "status", *VERSION_COLUMNS[2:])


@query
def scd2_rebuild_hot_ids(spark, folder):
    """The same history with every customer of ten orders or more treated as a hot id."""
    return h.rebuild(_order_versions(spark, folder), FIRST_RUN, hot_rows=10).select(*VERSION_COLUMNS)


@query
def scd2_apply_two_batches(spark, folder):
    """Ids of the second batch rebuilt from everything delivered."""
    before, after = _before_and_after(spark, folder)
    history = h.rebuild(before, FIRST_RUN)
    return h.apply(history, after, _order_versions(spark, folder), SECOND_RUN).select(*VERSION_COLUMNS)


@query
def scd2_apply_in_order(spark, folder):
    """The second batch appended behind the current rows, then delivered once more."""
    before, after = _before_and_after(spark, folder)
    history = stored(h.rebuild(before, FIRST_RUN))
    history = stored(h.apply_in_order(history, after, before, SECOND_RUN))
    again = h.apply_in_order(history, after, before.unionByName(after), THIRD_RUN)
    return again.select(*VERSION_COLUMNS, "scd_updated_at")


@query
def scd2_apply_late_versions(spark, folder):
    """Orders in two batches by key, so that the second is full of versions older than those seen."""
    odd = F.col("o_orderkey") % 2 == 1
    first, second = _order_versions(spark, folder, odd), _order_versions(spark, folder, ~odd)
    history = stored(h.rebuild(first, FIRST_RUN))
    history = h.apply_in_order(history, second, first, SECOND_RUN)
    return history.select(*VERSION_COLUMNS)


@query
def history_store_runs(spark, folder):
    """Three stored runs, the third with late versions, read back."""
    root = new_folder(spark, "history")
    orders = _table(spark, folder, "orders")
    late = F.col("o_orderkey") % 10 == 0
    recent = F.col("o_orderdate") >= CUT
    parts = [orders.filter(~late & ~recent), orders.filter(~late & recent), orders.filter(late)]
    bronze = [star.bronze_rows(star.patients_by_order(p), ENCOUNTER) for p in parts]
    earlier = bronze[0].filter(F.lit(False))
    for run, (batch, at) in enumerate(zip(bronze, (FIRST_RUN, SECOND_RUN, THIRD_RUN))):
        daily.advance_history(batch, earlier, root, ENCOUNTER, {str(run): "once"}, at)
        earlier = earlier.unionByName(batch)
    return store.read_history(spark, root).select(*VERSION_COLUMNS)


def _stored_by_days(spark, folder, writes) -> DataFrame:
    """The stored history after each (day, condition on orders) is written to bronze; None brings the history up to date."""
    bronze, root = new_folder(spark, "bronze"), new_folder(spark, "silver")
    for day, keep in writes:
        if day is None:
            daily.update_history(spark, bronze, root, ENCOUNTER, FIRST_RUN)
            continue
        rows = star.bronze_rows(star.patients_by_order(_table(spark, folder, "orders").filter(keep)), ENCOUNTER)
        rows = rows.withColumn("ingestion_date", F.lit(day).cast("date"))
        store.write_bronze(rows, f"{bronze}/{ENCOUNTER.bronze_table}", day)
    return store.read_history(spark, f"{root}/{ENCOUNTER.silver_table}")


THIRDS = [f"o_orderkey % 3 = {n}" for n in range(3)]
OTHERS = "o_orderkey % 3 <> 0"


@query
def history_first_load_many_days(spark, folder):
    """Three days are in bronze before the history is first asked for."""
    days = [(f"2024-01-0{n + 2}", part) for n, part in enumerate(THIRDS)]
    return _stored_by_days(spark, folder, [*days, (None, None)]).select(*VERSION_COLUMNS)


@query
def history_rerun_day(spark, folder):
    """The second day is run again with the rest of the orders."""
    writes = [("2024-01-02", THIRDS[0]), (None, None), ("2024-01-03", THIRDS[1]), (None, None), ("2024-01-03", OTHERS), (None, None)]
    return _stored_by_days(spark, folder, writes).select(*VERSION_COLUMNS)


@query
def history_backfill_day(spark, folder):
    """The earlier days arrive last."""
    writes = [("2024-01-04", THIRDS[2]), (None, None), ("2024-01-03", THIRDS[1]), (None, None), ("2024-01-02", THIRDS[0]), (None, None)]
    return _stored_by_days(spark, folder, writes).select(*VERSION_COLUMNS)


@query
def history_store_compacted(spark, folder):
    """Two stored runs, compacted, and the folders of the first ones removed."""
    root = new_folder(spark, "history")
    parts = [star.bronze_rows(star.patients_by_order(_table(spark, folder, "orders").filter(p)), ENCOUNTER) for p in (THIRDS[0], OTHERS)]
    daily.advance_history(parts[0], parts[0].limit(0), root, ENCOUNTER, {"0": "once"}, FIRST_RUN)
    daily.advance_history(parts[1], parts[0], root, ENCOUNTER, {"1": "once"}, SECOND_RUN)
    store.compact_history(spark, root)
    store.vacuum_history(spark, root)
    return store.read_history(spark, root).select(*VERSION_COLUMNS)


@query
def scd2_replay_then_late(spark, folder):
    """Odd orders, the same again, then the even ones: last_seen of the current row stays with the newest order.

    Rows that were closed earlier are not rewritten, so theirs may be older.
    """
    odd = F.col("o_orderkey") % 2 == 1
    first, second = _order_versions(spark, folder, odd), _order_versions(spark, folder, ~odd)
    history = stored(h.rebuild(first, FIRST_RUN))
    history = stored(h.apply_in_order(history, first, first, SECOND_RUN))
    history = h.apply_in_order(history, second, first, THIRD_RUN)
    last = F.when(F.col("is_current"), F.col("last_seen.version"))
    return history.select(*VERSION_COLUMNS, last.alias("last_version"))


@query
def changes_replayed_versions(spark, folder):
    """Orders before the cut, against a history that has seen all: nothing changes."""
    before, _ = _before_and_after(spark, folder)
    changes = detect_changes(h.current_rows(h.rebuild(_order_versions(spark, folder), FIRST_RUN)), before)
    return changes.select("resource_id", F.col("change").isin("new", "changed").alias("changes"))


@query
def pages_stream_new_checkpoint(spark, folder):
    """Two streams with checkpoints of their own write to one bronze table."""
    bronze, even = new_folder(spark, "bronze"), F.col("c_custkey") % 2 == 0
    for day, part in (("2024-01-02", even), ("2024-01-03", ~even)):
        landing = new_folder(spark, "landing")
        _land(spark, folder, landing, day=day, keep=part)
        ingest_available(spark, landing, bronze, new_folder(spark, "progress"), PATIENT)
    return store.read_bronze(spark, bronze).select("resource_id", "ingestion_date")


@query
def scd2_current_only(spark, folder):
    return h.current_rows(h.rebuild(_order_versions(spark, folder), FIRST_RUN)).select(
        "resource_id", "meta_version_id", "valid_from"
    )


@query
def scd2_as_of(spark, folder):
    history = h.rebuild(_order_versions(spark, folder), FIRST_RUN)
    moment = datetime(1998, 6, 1, tzinfo=timezone.utc)
    return h.as_of(history, moment).select("resource_id", "meta_version_id", "valid_from", "valid_to")


@query
def scd2_layer_counts(spark, folder):
    history = h.rebuild(_order_versions(spark, folder), FIRST_RUN)
    bronze = star.bronze_rows(star.patients_by_order(_table(spark, folder, "orders")), ENCOUNTER)
    return layer_metrics({"bronze_encounter": bronze, "silver_encounter": history})


# --- keys, dates, durations -------------------------------------------------------------------


@query
def reference_key_extract(spark, folder):
    """References of four forms, with the key and the whole rest of each."""
    forms = F.expr(
        "case o_orderkey % 4 when 0 then 'Patient/' || o_custkey when 1 then 'https://host/Patient/' || o_custkey "
        "when 2 then 'Patient/' || o_custkey || '/_history/2' else 'urn:uuid:' || o_custkey end"
    )
    orders = _table(spark, folder, "orders").withColumn("reference", forms)
    return orders.select(
        "o_orderkey",
        reference_key("reference", "Patient").alias("patient_id"),
        reference_key("reference", "Patient", whole_tail=True).alias("patient_tail"),
        reference_key("reference", "Encounter").alias("encounter_id"),
    )


@query
def age_years_customer(spark, folder):
    """Birth dates as full date, month, year and unreadable text."""
    birth = F.expr(
        "case c_custkey % 4 when 0 then cast(date_sub(date'2000-01-01', cast(c_custkey % 20000 as int)) as string) "
        "when 1 then '1980-05' when 2 then '1980' else 'unknown' end"
    )
    customer = _table(spark, folder, "customer").withColumn("birth", birth)
    return customer.select(
        "c_custkey",
        age_years("birth", F.lit(AGE_DAY)).alias("age"),
        age_years("birth", F.lit(AGE_DAY), calendar=True).alias("birthdays"),
    )


@query
def order_span_hours(spark, folder):
    records = star.encounters(_table(spark, folder, "orders"), _table(spark, folder, "lineitem"))
    return records.select(
        F.col("r.id").alias("resource_id"), span_hours("r.period.start", "r.period.end").alias("duration_hours")
    )


@query
def event_gap_hours(spark, folder):
    """Hours from an event to the start of 2024-02, with fractions of an hour to round."""
    events = _table(spark, folder, "events")
    return events.select("event_id", span_hours(star.iso("ts"), F.lit("2024-02-01T00:00:00Z")).alias("hours"))


# --- dimensions, facts, summary ---------------------------------------------------------------


@query
def dim_patient(spark, folder):
    return _dim_patient(spark, folder)


@query
def dim_condition(spark, folder):
    return marts.dim_condition(_history(spark, folder, "Condition"))


@query
def dim_condition_repeated_codes(spark, folder):
    return marts.repeated_codes(marts.dim_condition(_history(spark, folder, "Condition")))


@query
def fact_encounter(spark, folder):
    return marts.fact_encounter(_history(spark, folder, "Encounter"), _dim_patient(spark, folder))


@query
def fact_observation(spark, folder):
    return marts.fact_observation(_history(spark, folder, "Observation"), _dim_patient(spark, folder))


@query
def fact_observation_with_encounter(spark, folder):
    facts = marts.observations(_history(spark, folder, "Observation"))
    visits = marts.encounters(_history(spark, folder, "Encounter"))
    return marts.observations_with_encounter(facts, visits).select(
        "observation_id", "encounter_id", "encounter_status", "encounter_class", "period_start"
    )


@query
def customer_order_kpis(spark, folder):
    kpis = marts.encounter_kpis(marts.encounters(_history(spark, folder, "Encounter")))
    return kpis.withColumn("avg_duration_hours", F.round("avg_duration_hours", 2).cast("double"))


@query
def customer_code_set(spark, folder):
    kpis = marts.condition_kpis(_history(spark, folder, "Condition"))
    return kpis.withColumn("condition_list", F.array_join("condition_list", "|"))


@query
def customer_item_kpis(spark, folder):
    return marts.observation_kpis(marts.observations(_history(spark, folder, "Observation")))


@query
def patient_summary(spark, folder):
    histories = [_history(spark, folder, n) for n in ("Encounter", "Condition", "Observation")]
    summary = marts.patient_summary(_dim_patient(spark, folder), *histories, keep=stored)
    return summary.withColumn("condition_list", F.array_join("condition_list", "|"))


@query
def patient_summary_by_runs(spark, folder):
    """The summary kept by run: a day with records at wrong patients, then that day run again and another one added."""
    bronze, silver, root = (new_folder(spark, n) for n in ("bronze", "silver", "summary"))
    t = lambda n: _table(spark, folder, n)
    orders, lines = t("orders"), t("lineitem")
    wrong = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    records = {
        "Encounter": lambda o, keep: star.encounters(o.filter(f"o_orderkey {keep}"), lines),
        "Observation": lambda o, keep: star.observations(lines.filter(f"l_orderkey {keep}"), o),
        "Condition": lambda o, keep: star.conditions(lines.filter(f"l_orderkey {keep}"), o, t("part")),
    }

    def advance(name, days, at):
        spec = spec_for(name)
        for day, source, keep in days:
            rows = star.bronze_rows(records[name](source, keep), spec, f"2024-01-{day}")
            store.write_bronze(rows, f"{bronze}/{spec.bronze_table}", f"2024-01-{day}")
        daily.update_history(spark, bronze, silver, spec, at)

    for days, at in (([("02", wrong, "% 3 <> 2")], FIRST_RUN), ([("02", orders, "% 3 = 1"), ("03", orders, "% 3 <> 1")], SECOND_RUN)):
        side_by_side(spark, (partial(advance, name, days, at) for name in records))
        summary.refresh_summary(spark, silver, root)
    kept = summary.kept_summary(spark, root, _dim_patient(spark, folder))
    return kept.withColumn("condition_list", F.array_join("condition_list", "|"))


@query
def gold_view_counts(spark, folder):
    """Rows of the five views, through SQL. Histories are stored one by one, as the views read them several times."""
    daily.create_views({n: stored(_history(spark, folder, n)) for n in reversed(RESOURCES)}, AGE_DAY)
    names = ["dim_patient", "dim_condition", "fact_encounter", "fact_observation", "patient_summary"]
    return spark.sql(" union all ".join(f"select '{n}' as table_name, count(*) as total_rows from {n}" for n in names))
