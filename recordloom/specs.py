"""The resource types: JSON shape, flat columns and the columns whose change makes a new version.

A new resource type is one more entry in RESOURCES; no other module lists types.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Page size and window of the landing feed.
PAGE_SIZE = 100
WINDOW_DAYS = 3

# JSON shapes, as DDL.
META = "struct<versionId:string,lastUpdated:string,source:string>"
CODING = "array<struct<system:string,code:string,display:string>>"
CONCEPT = f"struct<coding:{CODING}>"
CONCEPT_WITH_TEXT = f"struct<coding:{CODING},text:string>"
REFERENCE = "struct<reference:string>"
LINEAGE_DDL = (
    "extraction_timestamp timestamp, api_url_or_params string, ingestion_date date, resource_type string"
)
LINK = "array<struct<relation:string,url:string>>"

CORRUPT = "_corrupt"
ID = "resource_id"
VERSION = "meta_version_id"
UPDATED = "meta_last_updated"

IDENTITY = {
    ID: "r.id",
    VERSION: "r.meta.versionId",
    UPDATED: "r.meta.lastUpdated",
    "meta_source": "r.meta.source",
}


def page_ddl(entry_fields: str) -> str:
    return (
        f"resourceType string, id string, link {LINK}, entry array<struct<{entry_fields}>>, {CORRUPT} string"
    )


@dataclass(frozen=True)
class ResourceSpec:
    """One resource type.

    `columns` maps each flat column to a Spark SQL expression over `r`, the resource struct. Array
    heads are taken with get(), which gives NULL for an empty array also in ANSI mode. `types` names
    the columns that are not strings.
    """

    name: str
    body: str
    columns: Mapping[str, str]
    types: Mapping[str, str] = field(default_factory=dict)

    @property
    def bundle_ddl(self) -> str:
        """Columns of one page; the corrupt text column catches pages that are not valid JSON."""
        return page_ddl(f"fullUrl:string,resource:{self.body}")

    @property
    def flat_columns(self) -> dict[str, str]:
        return {**IDENTITY, **self.columns}

    @property
    def hash_columns(self) -> tuple[str, ...]:
        """Columns whose change makes a new version: all but the identity of the record, in order."""
        return tuple(self.columns)

    @property
    def bronze_ddl(self) -> str:
        """Columns of the bronze table, for reading it without a look at its files."""
        flat = [f"{column} {self.types.get(column, 'string')}" for column in self.flat_columns]
        return ", ".join(["full_url string", *flat, "raw_resource_json string", LINEAGE_DDL])

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.name.lower()}"

    @property
    def silver_table(self) -> str:
        return f"silver_{self.name.lower()}"


# Field names and flat columns of the four resource types. The order of the columns enters
# record_hash.
PATIENT = ResourceSpec(
    name="Patient",
    body=(
        f"struct<id:string,meta:{META},active:boolean,gender:string,birthDate:string,"
        "name:array<struct<text:string,family:string,given:array<string>>>,"
        "identifier:array<struct<system:string,value:string>>,"
        "address:array<struct<city:string,state:string,country:string,postalCode:string>>,"
        f"maritalStatus:{CONCEPT}>"
    ),
    columns={
        "active": "r.active",
        "gender": "r.gender",
        "birth_date": "r.birthDate",
        "name_text": "get(r.name, 0).text",
        "name_family": "get(r.name, 0).family",
        "name_given": "get(get(r.name, 0).given, 0)",
        "identifier_system": "get(r.identifier, 0).system",
        "identifier_value": "get(r.identifier, 0).value",
        "address_city": "get(r.address, 0).city",
        "address_state": "get(r.address, 0).state",
        "address_country": "get(r.address, 0).country",
        "address_postal_code": "get(r.address, 0).postalCode",
        "marital_status_code": "get(r.maritalStatus.coding, 0).code",
    },
    types={"active": "boolean"},
)

ENCOUNTER = ResourceSpec(
    name="Encounter",
    body=(
        f"struct<id:string,meta:{META},status:string,"
        "class:struct<system:string,code:string,display:string>,"
        f"type:array<{CONCEPT}>,subject:{REFERENCE},"
        f"period:struct<start:string,end:string>,reasonCode:array<{CONCEPT}>>"
    ),
    columns={
        "status": "r.status",
        "class_code": "r.class.code",
        "class_display": "r.class.display",
        "patient_reference": "r.subject.reference",
        "period_start": "r.period.start",
        "period_end": "r.period.end",
        "type_code": "get(get(r.type, 0).coding, 0).code",
        "type_display": "get(get(r.type, 0).coding, 0).display",
        "reason_display": "get(get(r.reasonCode, 0).coding, 0).display",
    },
)

OBSERVATION = ResourceSpec(
    name="Observation",
    body=(
        f"struct<id:string,meta:{META},status:string,category:array<{CONCEPT}>,"
        f"code:{CONCEPT_WITH_TEXT},subject:{REFERENCE},encounter:{REFERENCE},"
        "effectiveDateTime:string,valueQuantity:struct<value:double,unit:string>,"
        f"valueString:string,valueCodeableConcept:{CONCEPT_WITH_TEXT}>"
    ),
    columns={
        "status": "r.status",
        "category_code": "get(get(r.category, 0).coding, 0).code",
        "category_display": "get(get(r.category, 0).coding, 0).display",
        "code_system": "get(r.code.coding, 0).system",
        "observation_code": "get(r.code.coding, 0).code",
        "observation_display": "get(r.code.coding, 0).display",
        "observation_text": "r.code.text",
        "patient_reference": "r.subject.reference",
        "encounter_reference": "r.encounter.reference",
        "effective_datetime": "r.effectiveDateTime",
        "value_quantity": "r.valueQuantity.value",
        "value_unit": "r.valueQuantity.unit",
        "value_string": "r.valueString",
        "value_codeable_text": "r.valueCodeableConcept.text",
    },
    types={"value_quantity": "double"},
)

CONDITION = ResourceSpec(
    name="Condition",
    body=(
        f"struct<id:string,meta:{META},clinicalStatus:{CONCEPT},verificationStatus:{CONCEPT},"
        f"category:array<{CONCEPT}>,code:{CONCEPT_WITH_TEXT},subject:{REFERENCE},"
        f"encounter:{REFERENCE},onsetDateTime:string,abatementDateTime:string,recordedDate:string>"
    ),
    columns={
        "clinical_status": "get(r.clinicalStatus.coding, 0).code",
        "verification_status": "get(r.verificationStatus.coding, 0).code",
        "verification_display": "get(r.verificationStatus.coding, 0).display",
        "category_code": "get(get(r.category, 0).coding, 0).code",
        "category_display": "get(get(r.category, 0).coding, 0).display",
        "code_system": "get(r.code.coding, 0).system",
        "condition_code": "get(r.code.coding, 0).code",
        "condition_display": "get(r.code.coding, 0).display",
        "condition_text": "r.code.text",
        "patient_reference": "r.subject.reference",
        "encounter_reference": "r.encounter.reference",
        "onset_datetime": "r.onsetDateTime",
        "abatement_datetime": "r.abatementDateTime",
        "recorded_date": "r.recordedDate",
    },
)

RESOURCES: dict[str, ResourceSpec] = {s.name: s for s in (PATIENT, ENCOUNTER, OBSERVATION, CONDITION)}


def spec_for(name: str) -> ResourceSpec:
    """The spec of a resource type; an unknown name is an error, not an empty result."""
    try:
        return RESOURCES[name]
    except KeyError:
        raise ValueError(f"unknown resource type {name!r}; known: {', '.join(RESOURCES)}") from None
