"""Dimensions, facts and the per-patient summary, from version histories.

All inputs are histories (one current row per id); `as_of` is the day ages are counted to.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.columns import age_years, display_value, instant, reference_key, span_hours
from recordloom.operators.history import current_rows

# Columns of the served tables, each with the history column or derived column it shows.
DIM_PATIENT = {
    "patient_id": "resource_id",
    "first_name": "name_given",
    "last_name": "name_family",
    "full_name": "name_text",
    "gender": "gender",
    "birth_date": "birth_date",
    "age": "age",
    "is_active": "active",
    "identifier_system": "identifier_system",
    "identifier_value": "identifier_value",
    "address_city": "address_city",
    "address_state": "address_state",
    "address_country": "address_country",
    "address_postal_code": "address_postal_code",
    "marital_status_code": "marital_status_code",
    "meta_version_id": "meta_version_id",
    "meta_last_updated": "meta_last_updated",
    "valid_from": "valid_from",
    "valid_to": "valid_to",
    "is_current": "is_current",
}
DIM_CONDITION = {
    "condition_code": "condition_code",
    "code_system": "code_system",
    "condition_display": "condition_display",
    "condition_text": "condition_text",
    "condition_category": "category_code",
    "condition_category_display": "category_display",
}
FACT_ENCOUNTER = {
    "encounter_id": "resource_id",
    "patient_id": "patient_id",
    "encounter_status": "status",
    "encounter_class": "class_code",
    "encounter_class_display": "class_display",
    "encounter_type_code": "type_code",
    "encounter_type_display": "type_display",
    "encounter_reason": "reason_display",
    "period_start": "period_start",
    "period_end": "period_end",
    "duration_hours": "duration_hours",
    "meta_last_updated": "meta_last_updated",
    "ingestion_date": "ingestion_date",
}
FACT_OBSERVATION = {
    "observation_id": "resource_id",
    "patient_id": "patient_id",
    "encounter_id": "encounter_id",
    "observation_status": "status",
    "category_code": "category_code",
    "category_display": "category_display",
    "code_system": "code_system",
    "observation_code": "observation_code",
    "observation_display": "observation_display",
    "observation_text": "observation_text",
    "effective_datetime": "effective_datetime",
    "value_quantity": "value_quantity",
    "value_unit": "value_unit",
    "value_string": "value_string",
    "value_codeable_text": "value_codeable_text",
    "display_value": "display_value",
    "meta_last_updated": "meta_last_updated",
    "ingestion_date": "ingestion_date",
}
PATIENT_SUMMARY = (
    "patient_id",
    "full_name",
    "gender",
    "age",
    "birth_date",
    "is_active",
    "address_city",
    "address_state",
    "address_country",
    "total_encounters",
    "first_encounter",
    "last_encounter",
    "avg_duration_hours",
    "distinct_conditions",
    "condition_list",
    "total_observations",
    "distinct_obs_types",
    "latest_observation",
)
COUNTS = ("total_encounters", "distinct_conditions", "total_observations", "distinct_obs_types")
PATIENT_CONTEXT = {"full_name": "patient_name", "gender": "patient_gender", "age": "patient_age"}


def _shown(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"{source} as {name}" for name, source in columns.items()])


def dim_patient(patients: DataFrame, as_of: date | Column) -> DataFrame:
    """Demographics of every current patient."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    aged = current_rows(patients).withColumn("age", age_years("birth_date", as_of))
    return _shown(aged, DIM_PATIENT)


def dim_condition(conditions: DataFrame) -> DataFrame:
    """Distinct coded conditions in use; a code has one row per wording and category."""
    return _shown(current_rows(conditions).filter("condition_code is not null"), DIM_CONDITION).distinct()


def repeated_codes(dimension: DataFrame) -> DataFrame:
    """Codes that dim_condition holds more than once; join on the code alone would double rows."""
    return dimension.groupBy("condition_code").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def encounters(history: DataFrame) -> DataFrame:
    """Current encounters with keys and duration, before the patient is looked up."""
    derived = {
        "patient_id": reference_key("patient_reference", "Patient"),
        "duration_hours": span_hours("period_start", "period_end"),
    }
    return _shown(current_rows(history).withColumns(derived), FACT_ENCOUNTER)


def observations(history: DataFrame) -> DataFrame:
    """Current observations with keys and display value, before the patient is looked up."""
    derived = {
        "patient_id": reference_key("patient_reference", "Patient"),
        "encounter_id": reference_key("encounter_reference", "Encounter"),
        "display_value": display_value("value_quantity", "value_string", "value_codeable_text"),
    }
    return _shown(current_rows(history).withColumns(derived), FACT_OBSERVATION)


def with_patient(facts: DataFrame, patients: DataFrame) -> DataFrame:
    """Facts with name, gender and age of their patient; facts without a known patient stay.

    The dimension has one row per key, so a patient with very many facts skews only the fact side,
    which adaptive execution splits. It is broadcast only if its size allows.
    """
    context = patients.select("patient_id", *[F.col(c).alias(n) for c, n in PATIENT_CONTEXT.items()])
    columns = [*facts.columns, *PATIENT_CONTEXT.values()]
    return facts.join(context, "patient_id", "left").select(*columns)


def fact_encounter(history: DataFrame, patients: DataFrame) -> DataFrame:
    return with_patient(encounters(history), patients)


def fact_observation(history: DataFrame, patients: DataFrame) -> DataFrame:
    return with_patient(observations(history), patients)


def observations_with_encounter(facts: DataFrame, visits: DataFrame) -> DataFrame:
    """Observation facts with status, class and start of their encounter."""
    context = visits.select("encounter_id", "encounter_status", "encounter_class", "period_start")
    return facts.join(context, "encounter_id", "left")


def timed(text: str, readable_first: bool) -> Column:
    """A text with its instant, in an order that puts readable texts first (or last)."""
    at = instant(text)
    readable = at.isNull() if readable_first else at.isNotNull()
    return F.when(F.col(text).isNotNull(), F.struct(readable.alias("readable"), at.alias("at"), F.col(text).alias("text")))


def earliest(text: str) -> Column:
    """The earliest instant with its text; texts that are no instant count only if there is no other."""
    return F.min(timed(text, True))


def latest(text: str) -> Column:
    return F.max(timed(text, False))


def encounter_kpis(visits: DataFrame) -> DataFrame:
    """Per patient: encounters, first and last start, mean of the rounded durations."""
    return visits.groupBy("patient_id").agg(
        F.count("encounter_id").alias("total_encounters"),
        earliest("period_start")["text"].alias("first_encounter"),
        latest("period_start")["text"].alias("last_encounter"),
        F.avg(F.col("duration_hours").cast("decimal(18,2)")).alias("avg_duration_hours"),
    )


def condition_kpis(history: DataFrame) -> DataFrame:
    """Per patient: number of distinct codes, and the sorted set of their names.

    Repeats are dropped before the rows of a patient meet, so a patient's task sees each wording once.
    """
    key = reference_key("patient_reference", "Patient").alias("patient_id")
    worded = current_rows(history).select(key, "condition_code", "condition_display").filter("patient_id is not null").distinct()
    return worded.groupBy("patient_id").agg(
        F.count_distinct("condition_code").alias("distinct_conditions"),
        F.array_sort(F.collect_set("condition_display")).alias("condition_list"),
    )


def observation_kpis(measured: DataFrame) -> DataFrame:
    """Per patient: observations, distinct codes, latest time.

    Counts per (patient, code) first: a patient with very many observations is spread over its codes,
    and the second step adds up one row per code. An id is current once, so rows are distinct ids.
    """
    per_code = measured.groupBy("patient_id", "observation_code").agg(
        F.count("observation_id").alias("n"),
        latest("effective_datetime").alias("last"),
    )
    return per_code.groupBy("patient_id").agg(
        F.sum("n").alias("total_observations"),
        F.count("observation_code").alias("distinct_obs_types"),
        F.max("last")["text"].alias("latest_observation"),
    )


def patient_summary(
    patients: DataFrame,
    encounter_history: DataFrame,
    condition_history: DataFrame,
    observation_history: DataFrame,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per patient of dim_patient: counts are 0 and the rest NULL where nothing is recorded.

    The three aggregates read the histories directly, so the dimension is joined once and only to
    rows that are already one per patient. With `keep`, such as session.stored, each aggregate is a job of its own, and
    only one history is shuffled at a time.
    """
    visits = encounter_kpis(encounters(encounter_history))
    diagnoses = condition_kpis(condition_history)
    measures = observation_kpis(observations(observation_history))
    sides = [side if keep is None else keep(side) for side in (visits, diagnoses, measures)]
    return with_kpis(patients, *sides)


def with_kpis(patients: DataFrame, *sides: DataFrame) -> DataFrame:
    """Rows of dim_patient with aggregates that have one row per patient each."""
    joined = patients
    for side in sides:
        joined = joined.join(side, "patient_id", "left")
    mean = F.round("avg_duration_hours", 2).cast("double")
    return joined.fillna(0, list(COUNTS)).withColumn("avg_duration_hours", mean).select(*PATIENT_SUMMARY)
