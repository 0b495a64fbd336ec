"""The star-schema tables read as records: customers as patients, orders as encounters, order lines
as observations and conditions. Each adapter gives `full_url` and `r`, a resource struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.bundles import LINEAGE, flatten_bundles, flatten_records
from recordloom.operators.cleaning import deliveries
from recordloom.operators.landing import entry_texts, paged
from recordloom.session import stored
from recordloom.sources.pages import parse_pages
from recordloom.specs import (
    CONCEPT,
    CONCEPT_WITH_TEXT,
    CONDITION,
    ENCOUNTER,
    OBSERVATION,
    PATIENT,
    REFERENCE,
    ResourceSpec,
)

DAY = "2024-01-02"
LANDED = "2024-01-02 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def iso(timestamp: Column | str) -> Column:
    """ISO text of a timestamp taken as UTC."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _coding(code: Column | str, display: Column | str | None = None, system: str | None = None) -> Column:
    display = F.lit(None) if display is None else display
    return F.array(F.struct(F.lit(system).cast("string").alias("system"), _text(code).alias("code"), _text(display).alias("display")))


def _concept(*coding, **system) -> Column:
    return F.struct(_coding(*coding, **system).alias("coding"))


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


# Types of the fields an adapter leaves empty.
CLASS = "struct<system:string,code:string,display:string>"
CONCEPTS = f"array<{CONCEPT}>"
PERIOD = "struct<start:string,end:string>"


def _none(ddl: str = "string") -> Column:
    return F.lit(None).cast(ddl)


def _reference(kind: str, key: str) -> Column:
    return F.struct(F.concat(F.lit(f"{kind}/"), _text(key)).alias("reference"))


def _meta(version: Column, updated: Column, source: str) -> Column:
    return F.struct(version.cast("string").alias("versionId"), updated.alias("lastUpdated"), F.lit(source).alias("source"))


def _record(df: DataFrame, spec: ResourceSpec, key: Column, *fields: Column) -> DataFrame:
    body = F.struct(key.alias("id"), *fields)
    return df.select(F.concat(F.lit(f"urn:{spec.name}:"), key).alias("full_url"), body.alias("r"))


def patients(customer: DataFrame) -> DataFrame:
    """Every tenth customer has no name, every third no gender."""
    key = _text("c_custkey")
    nothing = F.array().cast("array<struct<text:string,family:string,given:array<string>>>")
    number = F.substring_index("c_name", "#", -1)
    name = F.array(
        F.struct(
            F.col("c_name").alias("text"), F.lit("Customer").alias("family"), F.array(number, F.lit("second")).alias("given")
        )
    )
    home = F.struct(
        F.concat(F.lit(" City "), _text("c_nationkey")).alias("city"),
        _text("c_nationkey").alias("state"),
        _none().alias("country"),
        F.lit("").alias("postalCode"),
    )
    return _record(
        customer,
        PATIENT,
        key,
        _meta(F.lit(1), F.lit("2024-01-01T00:00:00Z"), "customer").alias("meta"),
        (F.col("c_acctbal") >= 0).alias("active"),
        F.expr("case c_custkey % 3 when 0 then 'female' when 1 then 'male' end").alias("gender"),
        F.expr("cast(date_sub(date'2000-01-01', cast(c_custkey % 20000 as int)) as string)").alias("birthDate"),
        F.when(F.col("c_custkey") % 10 == 9, nothing).otherwise(name).alias("name"),
        F.array(F.struct(F.lit("urn:customer").alias("system"), F.col("c_name").alias("value"))).alias("identifier"),
        F.array(home).alias("address"),
        _concept("c_mktsegment").alias("maritalStatus"),
    )


def _order_as_encounter(orders: DataFrame, key: Column, version: Column, end: Column) -> DataFrame:
    klass = F.struct(
        F.lit("urn:priority").alias("system"),
        F.substring("o_orderpriority", 1, 1).alias("code"),
        F.col("o_orderpriority").alias("display"),
    )
    return _record(
        orders,
        ENCOUNTER,
        key,
        _meta(version, iso("o_orderdate"), "orders").alias("meta"),
        F.col("o_orderstatus").alias("status"),
        klass.alias("class"),
        F.array(_concept("o_orderpriority", "o_orderpriority")).alias("type"),
        _reference("Patient", "o_custkey").alias("subject"),
        F.struct(iso("o_orderdate").alias("start"), end.alias("end")).alias("period"),
        F.array().cast(CONCEPTS).alias("reasonCode"),
    )


def encounters(orders: DataFrame, lineitem: DataFrame | None = None) -> DataFrame:
    """One encounter per order; with `lineitem` it ends when the last line was shipped."""
    end = _none()
    if lineitem is not None:
        shipped = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
        orders = orders.join(shipped, "o_orderkey", "left")
        end = iso("shipped")
    return _order_as_encounter(orders, _text("o_orderkey"), F.lit(1), end)


def _line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _line_version() -> Column:
    return F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")


def _with_customer(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "left")


def observations(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines; several lines of one order and number are versions of one observation.

    Every third line number has a text value instead of a quantity.
    """
    measured = F.col("l_linenumber") % 3 != 0
    return _record(
        _with_customer(lineitem, orders),
        OBSERVATION,
        _line_key(),
        _meta(_line_version(), iso("l_shipdate"), "lineitem").alias("meta"),
        F.col("l_linestatus").alias("status"),
        F.array(_concept("l_returnflag", "l_returnflag")).alias("category"),
        F.struct(_coding("l_partkey", system="urn:part").alias("coding"), _none().alias("text")).alias("code"),
        _reference("Patient", "o_custkey").alias("subject"),
        _reference("Encounter", "l_orderkey").alias("encounter"),
        iso("l_shipdate").alias("effectiveDateTime"),
        F.when(measured, F.struct(F.col("l_quantity").alias("value"), F.lit("each").alias("unit"))).alias("valueQuantity"),
        F.when(~measured, F.col("l_returnflag")).alias("valueString"),
        _none(CONCEPT_WITH_TEXT).alias("valueCodeableConcept"),
    )


def conditions(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with the brand of the part as code and its type as wording."""
    coded = _with_customer(lineitem, orders).join(
        part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"), "l_partkey", "left"
    )
    return _record(
        coded,
        CONDITION,
        _line_key(),
        _meta(_line_version(), iso("l_shipdate"), "lineitem").alias("meta"),
        _concept("l_returnflag").alias("clinicalStatus"),
        _concept("l_linestatus", "l_linestatus").alias("verificationStatus"),
        F.array(_concept("l_linestatus", "l_linestatus")).alias("category"),
        F.struct(_coding("p_brand", "p_type", "urn:brand").alias("coding"), _none().alias("text")).alias("code"),
        _reference("Patient", "o_custkey").alias("subject"),
        _reference("Encounter", "l_orderkey").alias("encounter"),
        iso("l_shipdate").alias("onsetDateTime"),
        _none().alias("abatementDateTime"),
        _text(F.to_date("l_shipdate")).alias("recordedDate"),
    )


def patients_by_order(orders: DataFrame) -> DataFrame:
    """Orders as the versions of one encounter per customer: status and priority change over time."""
    changing = _order_as_encounter(orders, _text("o_custkey"), F.col("o_orderkey"), _none())
    return changing.withColumn("r", F.col("r").withField("period", _none(PERIOD)))


def users_by_event(events: DataFrame) -> DataFrame:
    """Events as the versions of one encounter per user: only the event type changes."""
    return _record(
        events,
        ENCOUNTER,
        _text("user_id"),
        _meta(F.col("event_id"), iso("ts"), "events").alias("meta"),
        F.col("event_type").alias("status"),
        _none(CLASS).alias("class"),
        _none(CONCEPTS).alias("type"),
        _none(REFERENCE).alias("subject"),
        _none(PERIOD).alias("period"),
        _none(CONCEPTS).alias("reasonCode"),
    )


def lineage(df: DataFrame, spec: ResourceSpec, day: str = DAY, landed: str = LANDED) -> DataFrame:
    """Fixed lineage for records that did not come from a landed file."""
    return df.withColumns(
        {
            "extraction_timestamp": F.lit(landed).cast("timestamp"),
            "api_url_or_params": F.lit(f"table:{spec.name}"),
            "ingestion_date": F.lit(day).cast("date"),
            "resource_type": F.lit(spec.name),
        }
    )


def bronze_rows(records: DataFrame, spec: ResourceSpec, day: str = DAY, landed: str = LANDED) -> DataFrame:
    """Bronze rows straight from records, without the way through pages."""
    return flatten_records(lineage(records, spec, day, landed), spec, *LINEAGE)


def pages_of(records: DataFrame, spec: ResourceSpec, stable: bool = False) -> DataFrame:
    """Records written to JSON pages and parsed again; `stable` when they are a narrow scan."""
    entries = entry_texts(records)
    texts = paged(entries if stable else stored(entries), spec)
    return parse_pages(texts, spec).withColumns(
        {
            "page_path": F.concat_ws("/", F.lit(DAY), "id"),
            "landed_at": F.lit(LANDED).cast("timestamp"),
            "ingestion_date": F.lit(DAY).cast("date"),
            "resource_type": F.lit(spec.name),
        }
    )


def bronze_through_pages(records: DataFrame, spec: ResourceSpec, stable: bool = False) -> DataFrame:
    return flatten_bundles(pages_of(records, spec, stable), spec)


def delivered(records: DataFrame, spec: ResourceSpec, day: str = DAY, landed: str = LANDED) -> DataFrame:
    """Clean deliveries of records, ready for a history."""
    return deliveries(bronze_rows(records, spec, day, landed), spec)
