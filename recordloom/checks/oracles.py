"""The results of checks/queries.py in plain SQL, written without the library's code."""

from __future__ import annotations

from collections.abc import Sequence

# The columns of each type whose change makes a new version, in the order that enters the hash.
PATIENT_HASHED = (
    "active", "gender", "birth_date", "name_text", "name_family", "name_given", "identifier_system",
    "identifier_value", "address_city", "address_state", "address_country", "address_postal_code", "marital_status_code",
)
OBSERVATION_HASHED = (
    "status", "category_code", "category_display", "code_system", "observation_code", "observation_display",
    "observation_text", "patient_reference", "encounter_reference", "effective_datetime", "value_quantity",
    "value_unit", "value_string", "value_codeable_text",
)
CONDITION_HASHED = (
    "clinical_status", "verification_status", "verification_display", "category_code", "category_display",
    "code_system", "condition_code", "condition_display", "condition_text", "patient_reference",
    "encounter_reference", "onset_datetime", "abatement_datetime", "recorded_date",
)
ENCOUNTER_HASHED = (
    "status", "class_code", "class_display", "patient_reference", "period_start", "period_end", "type_code",
    "type_display", "reason_display",
)

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
FIRST_RUN, SECOND_RUN = "timestamp '2024-02-01'", "timestamp '2024-02-02'"
CUT = "timestamp '1998-01-01'"

# Each source: flat columns as bronze has them, after trimming, and `moment`, the time of the version.
PATIENT_ROWS = """
select 'urn:Patient:' || c_custkey as full_url, cast(c_custkey as varchar) as resource_id,
       '1' as meta_version_id, '2024-01-01T00:00:00Z' as meta_last_updated, 'customer' as meta_source,
       c_acctbal >= 0 as active,
       case c_custkey % 3 when 0 then 'female' when 1 then 'male' end as gender,
       cast(date '2000-01-01' - cast(c_custkey % 20000 as int) as varchar) as birth_date,
       case when c_custkey % 10 <> 9 then c_name end as name_text,
       case when c_custkey % 10 <> 9 then 'Customer' end as name_family,
       case when c_custkey % 10 <> 9 then split_part(c_name, '#', 2) end as name_given,
       'urn:customer' as identifier_system, c_name as identifier_value,
       'City ' || c_nationkey as address_city, cast(c_nationkey as varchar) as address_state,
       cast(null as varchar) as address_country, '' as address_postal_code,
       c_mktsegment as marital_status_code, timestamp '2024-01-01' as moment
from customer
"""


def encounter_rows(key: str, version: str, period: bool, shipped: bool, orders: str = "orders") -> str:
    start = f"strftime(o_orderdate, {ISO})" if period else "cast(null as varchar)"
    end = f"strftime(s.shipped, {ISO})" if shipped else "cast(null as varchar)"
    join = (
        "left join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by l_orderkey) s"
        " on s.l_orderkey = o_orderkey"
        if shipped
        else ""
    )
    return f"""
select 'urn:Encounter:' || {key} as full_url, cast({key} as varchar) as resource_id,
       cast({version} as varchar) as meta_version_id, strftime(o_orderdate, {ISO}) as meta_last_updated,
       'orders' as meta_source, o_orderstatus as status, substr(o_orderpriority, 1, 1) as class_code,
       o_orderpriority as class_display, 'Patient/' || o_custkey as patient_reference,
       {start} as period_start, {end} as period_end,
       o_orderpriority as type_code, o_orderpriority as type_display, cast(null as varchar) as reason_display,
       o_orderdate as moment
from {orders} {join}
"""


ENCOUNTER_ROWS = encounter_rows("o_orderkey", "1", True, True)
LINE_KEYS = """
       l_orderkey || '-' || l_linenumber as resource_id,
       cast(l_partkey * 1000000 + l_suppkey as varchar) as meta_version_id"""

OBSERVATION_ROWS = f"""
select 'urn:Observation:' || l_orderkey || '-' || l_linenumber as full_url, {LINE_KEYS},
       strftime(l_shipdate, {ISO}) as meta_last_updated, 'lineitem' as meta_source,
       l_linestatus as status, l_returnflag as category_code, l_returnflag as category_display,
       'urn:part' as code_system, cast(l_partkey as varchar) as observation_code,
       cast(null as varchar) as observation_display, cast(null as varchar) as observation_text,
       'Patient/' || o_custkey as patient_reference, 'Encounter/' || l_orderkey as encounter_reference,
       strftime(l_shipdate, {ISO}) as effective_datetime,
       case when l_linenumber % 3 <> 0 then l_quantity end as value_quantity,
       case when l_linenumber % 3 <> 0 then 'each' end as value_unit,
       case when l_linenumber % 3 = 0 then l_returnflag end as value_string,
       cast(null as varchar) as value_codeable_text, l_shipdate as moment
from lineitem left join orders on l_orderkey = o_orderkey
"""

CONDITION_ROWS = f"""
select 'urn:Condition:' || l_orderkey || '-' || l_linenumber as full_url, {LINE_KEYS},
       strftime(l_shipdate, {ISO}) as meta_last_updated, 'lineitem' as meta_source,
       l_returnflag as clinical_status, l_linestatus as verification_status,
       l_linestatus as verification_display, l_linestatus as category_code, l_linestatus as category_display,
       'urn:brand' as code_system, p_brand as condition_code, p_type as condition_display,
       cast(null as varchar) as condition_text, 'Patient/' || o_custkey as patient_reference,
       'Encounter/' || l_orderkey as encounter_reference, strftime(l_shipdate, {ISO}) as onset_datetime,
       cast(null as varchar) as abatement_datetime, strftime(l_shipdate, '%Y-%m-%d') as recorded_date,
       l_shipdate as moment
from lineitem left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey
"""

ORDER_VERSIONS = encounter_rows("o_custkey", "o_orderkey", False, False)
EVENT_VERSIONS = """
select cast(user_id as varchar) as resource_id, cast(event_id as varchar) as meta_version_id,
       event_type as status, cast(null as varchar) as class_code, cast(null as varchar) as class_display,
       cast(null as varchar) as patient_reference, cast(null as varchar) as period_start,
       cast(null as varchar) as period_end, cast(null as varchar) as type_code,
       cast(null as varchar) as type_display, cast(null as varchar) as reason_display,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as meta_last_updated, ts as moment
from events
"""


def md5_of(columns: Sequence[str]) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"coalesce(cast({c} as varchar), '__NULL__')" for c in columns) + "))"


def history(name: str, rows: str, hashed: Sequence[str]) -> str:
    """CTEs ending in <name>: all kept versions with validity."""
    order = "moment nulls first, try_cast(meta_version_id as bigint) nulls first, meta_version_id nulls first"
    return f"""
{name}_hashed as (select *, {md5_of(hashed)} as record_hash from ({rows})),
{name}_once as (select * from {name}_hashed qualify row_number() over (
    partition by resource_id, meta_version_id order by meta_last_updated, record_hash) = 1),
{name}_pairs as (select *, lag(record_hash) over (partition by resource_id order by {order}) as before from {name}_once),
{name} as (
  select *, moment as valid_from, lead(moment) over w as valid_to, lead(1) over w is null as is_current
  from {name}_pairs where before is null or before <> record_hash
  window w as (partition by resource_id order by {order}))"""


def newest(name: str, rows: str) -> str:
    """CTEs ending in <name>: the newest version per id."""
    return f"""
{name} as (select *, {md5_of(ENCOUNTER_HASHED)} as record_hash from ({rows}) qualify row_number() over (
    partition by resource_id order by moment desc nulls last, try_cast(meta_version_id as bigint) desc nulls last,
    meta_version_id desc nulls last) = 1)"""


VERSION_COLUMNS = "resource_id, meta_version_id, record_hash, is_current, valid_from, valid_to"
ORDERS = history("orders_h", ORDER_VERSIONS, ENCOUNTER_HASHED)
EARLY = encounter_rows("o_custkey", "o_orderkey", False, False, f"(select * from orders where o_orderdate < {CUT})")
LATE = encounter_rows("o_custkey", "o_orderkey", False, False, f"(select * from orders where o_orderdate >= {CUT})")
EARLY_HISTORY = history("early_h", EARLY, ENCOUNTER_HASHED)
ORDER_HISTORY = f"with {ORDERS} select {VERSION_COLUMNS} from orders_h"

P = history("patients", PATIENT_ROWS, PATIENT_HASHED)
E = history("visits_h", ENCOUNTER_ROWS, ENCOUNTER_HASHED)
O = history("measures_h", OBSERVATION_ROWS, OBSERVATION_HASHED)
C = history("diagnoses_h", CONDITION_ROWS, CONDITION_HASHED)

AGE = "cast(floor(date_diff('day', cast(birth_date as date), date '2024-01-01') / 365.25) as int)"
KEY = "nullif(regexp_extract(patient_reference, 'Patient/([^/]+)', 1), '')"
VISIT_KEY = "nullif(regexp_extract(encounter_reference, 'Encounter/([^/]+)', 1), '')"


def hundredths(seconds: str) -> str:
    """Seconds as hours with two decimals, halves away from zero, in whole-number arithmetic."""
    return f"(sign({seconds}) * ((abs({seconds}) * 100 + 1800) // 3600) / 100.0)"


SPAN = hundredths("cast(epoch(cast(period_end as timestamp)) - epoch(cast(period_start as timestamp)) as bigint)")

DIM = f"""{P},
dim as (
  select resource_id as patient_id, name_given as first_name, name_family as last_name, name_text as full_name,
         gender, birth_date, {AGE} as age, active as is_active, identifier_system, identifier_value, address_city,
         address_state, address_country, address_postal_code, marital_status_code, meta_version_id,
         meta_last_updated, valid_from, valid_to, is_current
  from patients where is_current)"""

VISITS = f"""{E},
visits as (
  select resource_id as encounter_id, {KEY} as patient_id, status as encounter_status, class_code as encounter_class,
         class_display as encounter_class_display, type_code as encounter_type_code,
         type_display as encounter_type_display, reason_display as encounter_reason, period_start, period_end,
         {SPAN} as duration_hours, meta_last_updated, date '2024-01-02' as ingestion_date
  from visits_h where is_current)"""

MEASURES = f"""{O},
measures as (
  select resource_id as observation_id, {KEY} as patient_id, {VISIT_KEY} as encounter_id,
         status as observation_status, category_code, category_display, code_system, observation_code,
         observation_display, observation_text, effective_datetime, value_quantity, value_unit, value_string,
         value_codeable_text,
         coalesce(cast(value_quantity as varchar), value_string, value_codeable_text) as display_value,
         meta_last_updated, date '2024-01-02' as ingestion_date
  from measures_h where is_current)"""

DIAGNOSES = f"{C}, diagnoses as (select *, {KEY} as patient_id from diagnoses_h where is_current)"

DIM_CONDITION = """
select distinct condition_code, code_system, condition_display, condition_text,
       category_code as condition_category, category_display as condition_category_display
from diagnoses where condition_code is not null"""

# Averages have six decimals before the last rounding, as those of two-decimal numbers have.
VISIT_KPIS = """
select patient_id, count(distinct encounter_id) as total_encounters, min(period_start) as first_encounter,
       max(period_start) as last_encounter,
       round(round(sum(cast(round(duration_hours * 100) as bigint)) / (count(duration_hours) * 100.0), 6), 2)
         as avg_duration_hours
from visits group by patient_id"""

CODE_KPIS = """
select patient_id, count(distinct condition_code) as distinct_conditions,
       array_to_string(list_sort(list(distinct condition_display) filter (condition_display is not null)), '|')
         as condition_list
from diagnoses group by patient_id"""

MEASURE_KPIS = """
select patient_id, count(distinct observation_id) as total_observations,
       count(distinct observation_code) as distinct_obs_types, max(effective_datetime) as latest_observation
from measures group by patient_id"""

SUMMARY = f"""
select d.patient_id, full_name, gender, age, birth_date, is_active, address_city, address_state, address_country,
       coalesce(total_encounters, 0) as total_encounters, first_encounter, last_encounter, avg_duration_hours,
       coalesce(distinct_conditions, 0) as distinct_conditions, condition_list,
       coalesce(total_observations, 0) as total_observations,
       coalesce(distinct_obs_types, 0) as distinct_obs_types, latest_observation
from dim d left join ({VISIT_KPIS}) e on d.patient_id = e.patient_id
left join ({CODE_KPIS}) c on d.patient_id = c.patient_id
left join ({MEASURE_KPIS}) o on d.patient_id = o.patient_id"""

CONTEXT = "d.full_name as patient_name, d.gender as patient_gender, d.age as patient_age"


def paged(table: str, size: int = 100) -> str:
    """Page numbers with the records on each."""
    return f"""
select cast(page as int) as page_number,
       cast(least({size}, (select count(*) from {table}) - (page - 1) * {size}) as int) as records_fetched
from range(1, cast(ceil((select count(*) from {table}) / {size}.0) as bigint) + 1) t(page)"""


DAMAGED_LOG = f"""
        with p as ({paged('orders')}),
        landed as (select *, page_number % 7 = 0 as cut from p where page_number % 5 <> 0)
        select 'Encounter' as resource_type, page_number, case when cut then 0 else records_fetched end as records_fetched,
               case when cut then 'ERROR' else 'SUCCESS' end as status,
               case when cut then 'malformed page' end as error_message, date '2024-01-02' as ingestion_date
        from landed
        union all
        select 'Encounter', page_number + 1, 0, 'ERROR', 'next page not landed', date '2024-01-02'
        from landed where not cut and (page_number + 1) % 5 = 0 and page_number < (select max(page_number) from p)"""

ORACLES: dict[str, str] = {
    "bundle_flatten_customer": f"""
        select * exclude (moment) replace (' ' || address_city as address_city) from ({PATIENT_ROWS})""",
    "bundle_flatten_orders": f"select * exclude (moment) from ({encounter_rows('o_orderkey', '1', True, False)})",
    "bundle_flatten_lineitem": f"select * exclude (moment) from ({OBSERVATION_ROWS})",
    "bundle_flatten_part": f"select * exclude (moment) from ({CONDITION_ROWS})",
    "bundle_entry_counts": f"""
        select 'page_' || lpad(cast(page_number as varchar), cast(greatest(4, length(cast(page_number as varchar))) as int), '0')
               as page_id, cast(records_fetched as bigint) as records from ({paged('customer')})""",
    "raw_json_round_trip": f"""
        select resource_id, birth_date, cast(case when name_text is null then 0 else 1 end as int) as names
        from ({PATIENT_ROWS})""",
    "lineage_columns": f"""
        select 'Patient' as resource_type, date '2024-01-02' as ingestion_date,
               timestamp '2024-01-02' as extraction_timestamp, cast(page_number as bigint) as page,
               cast(records_fetched as bigint) as records from ({paged('customer')})""",
    "registry_dispatch_rows": """
        select 'Patient' as resource_type, count(*) as records, cast(17 as int) as columns from customer union all
        select 'Encounter', count(*), 13 from orders union all
        select 'Observation', count(*), 18 from lineitem union all
        select 'Condition', count(*), 18 from lineitem""",
    "current_window_filter": """
        select event_id, user_id, event_type from events
        where cast(ts as date) between date '2024-01-12' and date '2024-01-15'""",
    "event_props_parse": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "audit_pages_ok": f"""
        select 'Patient' as resource_type, page_number, records_fetched, 'SUCCESS' as status,
               cast(null as varchar) as error_message, date '2024-01-02' as ingestion_date
        from ({paged('customer')})""",
    "audit_pages_corrupt": DAMAGED_LOG,
    "audit_day_totals": f"""
        select resource_type, ingestion_date, count(*) as pages, cast(sum(records_fetched) as bigint) as records,
               count(*) filter (status = 'ERROR') as errors
        from ({DAMAGED_LOG}) group by resource_type, ingestion_date""",
    "rejected_pages_report": f"""
        select 'Encounter' as resource_type, 'malformed page' as reason, count(*) as pages
        from ({paged('orders')}) where page_number % 5 <> 0 and page_number % 7 = 0 having count(*) > 0""",
    "pages_stream_available_now": """
        select cast(c_custkey as varchar) as resource_id,
               case when c_custkey % 2 = 0 then date '2024-01-02' else date '2024-01-03' end as ingestion_date,
               case when c_custkey % 10 <> 9 then c_name end as name_text,
               cast(c_custkey % 2 as int) as batch from customer""",
    "stream_unique_versions": """
        select cast(o_orderkey as varchar) as resource_id, '1' as meta_version_id, date '2024-01-02' as ingestion_date,
               o_orderstatus as status from orders
        union all
        select cast(o_orderkey as varchar), '2', date '2024-01-03', o_orderstatus from orders
        where o_orderstatus = 'F'""",
    "variant_flatten_lineitem": f"select * exclude (moment) from ({OBSERVATION_ROWS})",
    "schema_drift_orders": """
        with found as (
            select date '2024-01-02' as ingestion_date, 'priority' as path, null as declared, 'object' as found,
                   count(*) filter (o_orderkey % 3 = 0) as records from orders
            union all select date '2024-01-02', 'subject.display', null, 'string', count(*) filter (o_orderkey % 5 = 0) from orders
            union all select date '2024-01-02', 'type[].userSelected', null, 'boolean', count(*) from orders
            union all select date '2024-01-03', 'status', 'string', 'array', count(*) from orders
            union all select date '2024-01-03', 'period', 'object', 'number', count(*) from orders)
        select 'Encounter' as resource_type, *, case when declared is null then 'unknown' else 'retyped' end as drift
        from found where records > 0""",
    "layer_balance_orders": """
        with sent as (
            select date '2024-01-02' as ingestion_date, o_orderkey, 'record' as kind from orders where o_orderkey % 2 = 0
            union all
            select date '2024-01-03', o_orderkey, case when o_orderkey % 11 = 0 then 'empty' when o_orderkey % 7 = 0 then 'blank'
                   else 'record' end from orders
        ), ranked as (select *, row_number() over (partition by o_orderkey, kind order by ingestion_date) as place from sent)
        select 'Encounter' as resource_type, ingestion_date, cast(0 as bigint) as pages_in_error, count(*) as entries,
               count(*) as written, count(*) filter (kind = 'empty') as without_resource,
               count(*) filter (kind = 'blank') as blank_ids, count(*) filter (kind = 'record' and place > 1) as repeats,
               count(*) filter (kind = 'record' and place = 1) as kept, cast(0 as bigint) as unaccounted,
               cast(0 as bigint) as ids_missing
        from ranked group by ingestion_date""",
    "bronze_merge_schema_append": f"""
        select cast(o_orderkey as varchar) as resource_id,
               case when o_orderdate >= {CUT} then o_orderpriority end as type_code,
               case when o_orderdate >= {CUT} then date '2024-01-03' else date '2024-01-02' end as ingestion_date
        from orders""",
    "string_trim_all": "select c_custkey, c_name, chr(9) || c_mktsegment as c_mktsegment from customer",
    "record_hash_orders": f"""
        select resource_id, {md5_of(ENCOUNTER_HASHED)} as record_hash
        from ({encounter_rows('o_orderkey', '1', True, False)})""",
    "dedup_first_extraction": """
        select cast(o_orderkey as varchar) as resource_id, '1' as meta_version_id, o_orderstatus as status,
               date '2024-01-02' as ingestion_date from orders""",
    "changes_new_or_changed": f"""
        with {EARLY_HISTORY}, {newest('arrived', LATE)}
        select a.resource_id, a.record_hash as new_hash, e.record_hash as old_hash,
               case when e.record_hash is null then 'new' when a.record_hash <> e.record_hash then 'changed'
                    else 'unchanged' end as change
        from arrived a left join early_h e on e.resource_id = a.resource_id and e.is_current""",
    "changed_rows_to_write": f"""
        with {EARLY_HISTORY}, {newest('arrived', LATE)}
        select resource_id, meta_version_id from ({LATE}) where resource_id in (
          select a.resource_id from arrived a left join early_h e on e.resource_id = a.resource_id and e.is_current
          where e.record_hash is null or a.record_hash <> e.record_hash)""",
    "scd2_first_load": f"""
        with {newest('arrived', ORDER_VERSIONS)}
        select resource_id, meta_version_id, record_hash, true as is_current, {FIRST_RUN} as valid_from,
               cast(null as timestamp) as valid_to from arrived""",
    "scd2_merge_run": f"""
        with {newest('a', EARLY)}, {newest('b', LATE)}
        select a.resource_id, a.meta_version_id, a.record_hash, b.resource_id is null as is_current,
               {FIRST_RUN} as valid_from, case when b.resource_id is not null then {SECOND_RUN} end as valid_to,
               case when b.resource_id is not null then {SECOND_RUN} else {FIRST_RUN} end as scd_updated_at
        from a left join b on a.resource_id = b.resource_id and a.record_hash <> b.record_hash
        union all
        select b.resource_id, b.meta_version_id, b.record_hash, true, {SECOND_RUN}, null, {SECOND_RUN}
        from b left join a on a.resource_id = b.resource_id
        where a.resource_id is null or a.record_hash <> b.record_hash""",
    "scd2_rebuild_orders": ORDER_HISTORY,
    "scd2_rebuild_events": f"""
        with {history('events_h', EVENT_VERSIONS, ENCOUNTER_HASHED)}
        select resource_id, meta_version_id, status, record_hash, is_current, valid_from, valid_to from events_h""",
    "scd2_rebuild_hot_ids": ORDER_HISTORY,
    "scd2_apply_two_batches": ORDER_HISTORY,
    "scd2_apply_in_order": f"""
        with {ORDERS}, {EARLY_HISTORY}
        select h.resource_id, h.meta_version_id, h.record_hash, h.is_current, h.valid_from, h.valid_to,
               case when e.resource_id is not null and (e.valid_to is null) = (h.valid_to is null) then {FIRST_RUN}
                    else {SECOND_RUN} end as scd_updated_at
        from orders_h h left join early_h e
          on h.resource_id = e.resource_id and h.meta_version_id = e.meta_version_id""",
    "scd2_apply_late_versions": ORDER_HISTORY,
    "history_store_runs": ORDER_HISTORY,
    "history_first_load_many_days": ORDER_HISTORY,
    "history_rerun_day": ORDER_HISTORY,
    "history_backfill_day": ORDER_HISTORY,
    "history_store_compacted": ORDER_HISTORY,
    "scd2_replay_then_late": f"""
        select h.*, case when h.is_current then n.last_version end as last_version from ({ORDER_HISTORY}) h join (
          select cast(o_custkey as varchar) as resource_id,
                 cast(arg_max(o_orderkey, row(o_orderdate, o_orderkey)) as varchar) as last_version
          from orders group by o_custkey) n on n.resource_id = h.resource_id""",
    "changes_replayed_versions": f"""
        select distinct cast(o_custkey as varchar) as resource_id, false as changes from orders where o_orderdate < {CUT}""",
    "pages_stream_new_checkpoint": """
        select cast(c_custkey as varchar) as resource_id,
               case when c_custkey % 2 = 0 then date '2024-01-02' else date '2024-01-03' end as ingestion_date
        from customer""",
    "scd2_current_only": f"with {ORDERS} select resource_id, meta_version_id, valid_from from orders_h where is_current",
    "scd2_as_of": f"""
        with {ORDERS} select resource_id, meta_version_id, valid_from, valid_to from orders_h
        where valid_from <= timestamp '1998-06-01' and (valid_to is null or valid_to > timestamp '1998-06-01')""",
    "scd2_layer_counts": f"""
        with {ORDERS}
        select 'bronze_encounter' as table_name, count(*) as total_rows, cast(null as bigint) as current_rows,
               cast(null as bigint) as historical_rows, count(distinct o_custkey) as distinct_keys from orders
        union all
        select 'silver_encounter', count(*), count(*) filter (is_current), count(*) filter (not is_current),
               count(distinct resource_id) from orders_h""",
    "reference_key_extract": """
        select o_orderkey, case when o_orderkey % 4 < 3 then cast(o_custkey as varchar) end as patient_id,
               case when o_orderkey % 4 < 2 then cast(o_custkey as varchar)
                    when o_orderkey % 4 = 2 then o_custkey || '/_history/2' end as patient_tail,
               cast(null as varchar) as encounter_id
        from orders""",
    "age_years_customer": """
        with b as (select c_custkey, case c_custkey % 4
                     when 0 then date '2000-01-01' - cast(c_custkey % 20000 as int)
                     when 1 then date '1980-05-01' when 2 then date '1980-01-01' end as birth from customer)
        select c_custkey, cast(floor(date_diff('day', birth, date '2024-01-01') / 365.25) as int) as age,
               cast(date_diff('year', birth, date '2024-01-01')
                 - case when strftime(birth, '%m%d') > '0101' then 1 else 0 end as int) as birthdays
        from b""",
    "order_span_hours": f"select resource_id, {SPAN} as duration_hours from ({ENCOUNTER_ROWS})",
    "event_gap_hours": f"""
        select event_id, {hundredths("(cast(epoch(timestamp '2024-02-01') as bigint) - cast(floor(epoch(ts)) as bigint))")}
          as hours from events""",
    "dim_patient": f"with {DIM} select * from dim",
    "dim_condition": f"with {DIAGNOSES} {DIM_CONDITION}",
    "dim_condition_repeated_codes": f"""
        with {DIAGNOSES} select condition_code, count(*) as rows from ({DIM_CONDITION})
        group by condition_code having count(*) > 1""",
    "fact_encounter": f"""
        with {DIM}, {VISITS} select v.*, {CONTEXT} from visits v left join dim d on v.patient_id = d.patient_id""",
    "fact_observation": f"""
        with {DIM}, {MEASURES} select m.*, {CONTEXT} from measures m left join dim d on m.patient_id = d.patient_id""",
    "fact_observation_with_encounter": f"""
        with {VISITS}, {MEASURES}
        select observation_id, m.encounter_id, encounter_status, encounter_class, period_start
        from measures m left join visits v on m.encounter_id = v.encounter_id""",
    "customer_order_kpis": f"with {VISITS} {VISIT_KPIS}",
    "customer_code_set": f"with {DIAGNOSES} {CODE_KPIS}",
    "customer_item_kpis": f"with {MEASURES} {MEASURE_KPIS}",
    "patient_summary": f"with {DIM}, {VISITS}, {DIAGNOSES}, {MEASURES} {SUMMARY}",
    "feed_link_chains": """
        with recursive ordered as (
            select o_custkey % 3 as feed_group, o_custkey, o_orderkey,
                   lead(o_orderkey) over mine as following,
                   first_value(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as opening,
                   first_value(o_orderkey) over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as closing
            from orders window mine as (partition by o_custkey order by o_orderdate, o_orderkey)
        ), nodes as (
            select feed_group, cast(o_orderkey as varchar) as url, cast(case
                       when o_orderkey % 10 = 3 then nullif(closing, o_orderkey)
                       when o_custkey % 4 = 0 and following is null then opening
                       else following end as varchar) as next_url
            from ordered where o_orderkey % 17 <> 0
        ), edges as (
            select a.feed_group, a.url, a.next_url from nodes a join nodes b on a.feed_group = b.feed_group and a.next_url = b.url
        ), reached as (
            select feed_group, url as origin, url from nodes
            union
            select r.feed_group, r.origin, e.next_url from reached r join edges e on r.feed_group = e.feed_group and r.url = e.url
        ), on_cycle as (
            select e.feed_group, e.url from edges e
            join reached r on r.feed_group = e.feed_group and r.origin = e.next_url and r.url = e.url
        ), cyclic as (
            select r.feed_group, r.origin as url, min(r.url) as least from reached r join on_cycle c using (feed_group, url)
            group by r.feed_group, r.origin
        ), tails as (
            select r.feed_group, r.origin as url, n.url as tail, n.next_url as missing
            from reached r join nodes n using (feed_group, url) anti join edges e using (feed_group, url)
        ), lengths as (select feed_group, origin as url, count(*) - 1 as steps from reached group by all),
        ranked as (
            select n.feed_group, n.url, coalesce(t.tail, c.least) as "end",
                   case when c.least is not null then 'cycle' when t.missing is null then 'complete' else 'broken' end as ending,
                   t.missing, case when c.least is null then l.steps end as steps,
                   not exists (select 1 from nodes p where p.feed_group = n.feed_group and p.next_url = n.url and p.url <> n.url) as head
            from nodes n left join tails t using (feed_group, url) left join cyclic c using (feed_group, url)
            join lengths l using (feed_group, url)
        )
        select feed_group, "end", ending, missing, count(*) as pages, max(steps) as longest, count_if(head) as heads, 0 as forks
        from ranked group by all""",
    "patient_summary_by_runs": f"with {DIM}, {VISITS}, {DIAGNOSES}, {MEASURES} {SUMMARY}",
    "gold_view_counts": f"""
        with {DIM}, {VISITS}, {DIAGNOSES}, {MEASURES}
        select 'dim_patient' as table_name, count(*) as total_rows from dim
        union all select 'dim_condition', count(*) from ({DIM_CONDITION})
        union all select 'fact_encounter', count(*) from visits
        union all select 'fact_observation', count(*) from measures
        union all select 'patient_summary', count(*) from dim""",
}
