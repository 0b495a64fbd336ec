"""Schema drift: what the records of a day hold that their type does not declare, or declares otherwise.

Spark gives the structure of each record as text and counts records per structure, so only distinct structures are
shuffled and compared with the spec, however many records there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StructType

from recordloom.specs import ResourceSpec

DAY = ("resource_type", "ingestion_date")
UNKNOWN, RETYPED = "unknown", "retyped"

# Kinds of JSON values by the names Spark gives them in a structure.
KINDS = {
    "OBJECT": "object",
    "ARRAY": "array",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "BIGINT": "number",
    "DECIMAL": "number",
    "DOUBLE": "number",
    "FLOAT": "number",
    "VOID": "null",
    "VARIANT": "mixed",  # elements of one array that differ
}
PART = re.compile(r"`(?:``|[^`])*`|[<>:,]|\w+(?:\(\d+,\s*\d+\))?")


def declared_kinds(shape: DataType, path: str = "") -> dict[str, str]:
    """Path -> kind of every value a declared shape names; `[]` stands for the elements of an array."""
    if isinstance(shape, StructType):
        kinds = {path: "object"}
        for field in shape.fields:
            kinds |= declared_kinds(field.dataType, f"{path}.{field.name}" if path else field.name)
        return kinds
    if isinstance(shape, ArrayType):
        return {path: "array"} | declared_kinds(shape.elementType, f"{path}[]")
    if isinstance(shape, NumericType):
        return {path: "number"}
    return {path: "boolean" if isinstance(shape, BooleanType) else "string"}


def departures(structure: str, declared: dict[str, str]) -> list[tuple[str, str | None, str]]:
    """(path, declared kind, found kind) of each value that departs from what is declared; what lies below it is left out."""
    found, opened = [], []
    path, inside, naming = "", True, False
    kind, fits = "", True
    for part in PART.findall(structure):
        if part == "<":
            opened.append((path, fits))
            naming, inside = kind == "object", fits
            if kind == "array":
                path = f"{path}[]"
        elif part == ">":
            path, _ = opened.pop()
        elif part == ",":
            naming = True
        elif part == ":":
            naming = False
        elif naming:
            above, inside = opened[-1]
            path = f"{above}.{part}" if above else part
        else:
            name = part.split("(")[0]
            kind = KINDS.get(name, name.lower())
            fits = inside and kind in ("null", declared.get(path))
            if inside and not fits:
                # A null says nothing of a declared value; an undeclared path is reported with any value.
                found.append((path, declared.get(path), kind))
            elif inside and path not in declared:
                found.append((path, None, kind))
                fits = False
    return found


def structures(records: DataFrame) -> DataFrame:
    """Distinct structures of whole records per type and day, with the number of records that have them."""
    held = records.filter(F.col("resource").isNotNull())
    return held.groupBy(*DAY, F.schema_of_variant("resource").alias("structure")).agg(F.count(F.lit(1)).alias("records"))


def schema_drift(records: DataFrame, spec: ResourceSpec) -> DataFrame:
    """One row per type, day, path and kind that is not declared so, with the number of records that hold it.

    `records` are those of `raw.raw_records`. `drift` is `unknown` for a path the spec does not name, reported at its
    uppermost undeclared part, and `retyped` for another kind of value than declared. Absent fields, nulls of declared
    paths and empty arrays are no drift. `$` is the record itself. Records without drift give no rows.
    """
    declared = declared_kinds(DataType.fromDDL(spec.body))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*day, path or "$", wanted, kind, count)
                for *day, structure, count in batch.itertuples(index=False, name=None)
                for path, wanted, kind in departures(structure, declared)
            ]
            yield pd.DataFrame(rows, columns=[*DAY, "path", "declared", "found", "records"])

    ddl = "resource_type string, ingestion_date date, path string, declared string, found string, records long"
    counted = structures(records).mapInPandas(compare, ddl).groupBy(*DAY, "path", "declared", "found")
    drift = F.when(F.col("declared").isNull(), UNKNOWN).otherwise(RETYPED)
    return counted.agg(F.sum("records").alias("records")).withColumn("drift", drift)
