"""The four business domains: columns, cleaners, star tables and constraints, as data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T

from veilwork.functions import cleaners as C

Parser = Callable[[Column], Column]

LINEAGE = ("_source_file", "_ingestion_batch_id", "_ingested_at")


@dataclass(frozen=True)
class Field:
    """A source column, its cleaned type, and the two halves of its cleaner."""

    name: str
    dtype: str = "string"
    parse: Parser | None = None
    prepare: Parser = C.clean_text


@dataclass(frozen=True)
class Dim:
    """A dimension: distinct source attributes that are absent from the table so far."""

    name: str
    key: str
    attrs: tuple[str, ...]
    match: tuple[str, ...]  # columns that decide whether a member exists
    lookup: tuple[str, ...] = ()  # columns the fact joins on, if not `match`
    null_safe_load: bool = False
    null_safe_lookup: bool = False
    required: tuple[str, ...] = ()
    fact_key: str = ""  # name of the key in the fact, if not `key`
    is_person: bool = False
    is_date: bool = False

    @property
    def lookup_columns(self) -> tuple[str, ...]:
        return self.lookup or self.match


@dataclass(frozen=True)
class Fact:
    name: str
    measures: tuple[tuple[str, str], ...]  # (column, SQL expression over the source row)


@dataclass(frozen=True)
class Domain:
    name: str
    primary_key: str
    fields: tuple[Field, ...]
    routing: frozenset[str]  # a file with all of these columns belongs to the domain
    dims: tuple[Dim, ...]
    fact: Fact
    date_columns: tuple[str, ...] = field(default=())  # must not lie in the future

    @property
    def source_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def bronze_schema(self) -> T.StructType:
        columns = [T.StructField("_bronze_id", T.LongType())]
        columns += [T.StructField(c, T.StringType()) for c in self.source_columns]
        columns += [
            T.StructField("_source_file", T.StringType()),
            T.StructField("_ingestion_batch_id", T.StringType()),
            T.StructField("_ingested_at", T.TimestampType()),
        ]
        return T.StructType(columns)

    @property
    def silver_schema(self) -> T.StructType:
        columns = ["_bronze_id bigint", *[f"{f.name} {f.dtype}" for f in self.fields]]
        return T.StructType.fromDDL(", ".join([*columns, "city string", "state string"]))


def _name(name: str) -> Field:
    return Field(name, "string", C.to_name, C.stripped_text)


_CONTACT = (
    _name("first_name"),
    _name("last_name"),
    Field("email", "string", C.to_email),
    Field("phone", "string", C.to_phone),
)
_BIRTH = Field("date_of_birth", "date", C.to_date)
_ADDRESS = Field("address")


def _person(name: str, key: str, natural: str, *extra: str) -> Dim:
    attrs = (natural, "first_name", "last_name", "email", "phone", *extra)
    return Dim(name, key, attrs, match=(natural,), is_person=True)


def _single(name: str, key: str, column: str) -> Dim:
    return Dim(name, key, (column,), match=(column,), required=(column,))


_PLACE = ("address", "city", "state")
LOCATION = Dim(
    "dim_location", "location_key", _PLACE, match=_PLACE, null_safe_load=True, null_safe_lookup=True
)


def _dates(source: str) -> Dim:
    return Dim(
        "dim_date", "date_key", (source,), match=(source,), required=(source,),
        fact_key=f"{source}_key", is_date=True,
    )


BANKING = Domain(
    name="banking",
    primary_key="customer_id",
    fields=(
        Field("customer_id", "bigint", C.to_int, C.number_text),
        *_CONTACT,
        _BIRTH,
        Field("account_number", "string", C.to_record_number),
        Field("account_type", "string", C.to_account_type),
        Field("balance", "double", C.to_amount, C.number_text),
        _ADDRESS,
    ),
    routing=frozenset({"customer_id", "account_number", "account_type", "balance"}),
    dims=(
        _person("dim_customer", "customer_key", "customer_id", "date_of_birth"),
        # Members are looked for by number alone when loading, by both columns from the fact.
        Dim(
            "dim_account", "account_key", ("account_number", "account_type"),
            match=("account_number",), lookup=("account_number", "account_type"),
            required=("account_number",), null_safe_lookup=True,
        ),
        LOCATION,
    ),
    fact=Fact("fact_account", (("balance", "balance"),)),
    date_columns=("date_of_birth",),
)

EDUCATION = Domain(
    name="education",
    primary_key="student_id",
    fields=(
        Field("student_id", "bigint", C.to_int, C.number_text),
        *_CONTACT,
        _BIRTH,
        _ADDRESS,
        Field("course"),
        Field("department"),
        Field("enrollment_date", "date", C.to_date),
        Field("percentage", "double", C.to_percentage, C.number_text),
    ),
    routing=frozenset({"student_id", "course", "department", "enrollment_date", "percentage"}),
    dims=(
        _person("dim_student", "student_key", "student_id", "date_of_birth"),
        _single("dim_course", "course_key", "course"),
        _single("dim_department", "department_key", "department"),
        LOCATION,
        _dates("enrollment_date"),
    ),
    fact=Fact("fact_enrollment", (("percentage", "percentage"),)),
    date_columns=("date_of_birth", "enrollment_date"),
)

MEDICAL = Domain(
    name="medical",
    primary_key="patient_id",
    fields=(
        Field("patient_id", "bigint", C.to_int, C.number_text),
        *_CONTACT,
        _BIRTH,
        _ADDRESS,
        Field("blood_group", "string", C.to_blood_group),
        Field("diagnosis"),
        _name("doctor_name"),
        Field("admission_date", "date", C.to_date),
        Field("medical_record_number", "string", C.to_record_number),
    ),
    routing=frozenset(
        {"patient_id", "diagnosis", "doctor_name", "admission_date", "medical_record_number"}
    ),
    dims=(
        _person(
            "dim_patient", "patient_key", "patient_id",
            "date_of_birth", "blood_group", "medical_record_number",
        ),
        _single("dim_doctor", "doctor_key", "doctor_name"),
        _single("dim_diagnosis", "diagnosis_key", "diagnosis"),
        LOCATION,
        _dates("admission_date"),
    ),
    fact=Fact("fact_admission", (("admission_count", "1"),)),
    date_columns=("date_of_birth", "admission_date"),
)

MARKETING = Domain(
    name="marketing",
    primary_key="customer_id",
    fields=(
        Field("customer_id", "bigint", C.to_int, C.number_text),
        *_CONTACT,
        _ADDRESS,
        Field("age", "int", C.to_age, C.number_text),
        Field("gender", "string", C.to_gender),
        Field("campaign_name"),
        Field("campaign_date", "date", C.to_date),
        Field("channel", "string", C.to_channel),
    ),
    routing=frozenset({"customer_id", "campaign_name", "campaign_date", "channel"}),
    dims=(
        _person("dim_customer", "customer_key", "customer_id", "age", "gender"),
        _single("dim_campaign", "campaign_key", "campaign_name"),
        _single("dim_channel", "channel_key", "channel"),
        LOCATION,
        _dates("campaign_date"),
    ),
    fact=Fact("fact_campaign", (("campaign_count", "1"),)),
    date_columns=("campaign_date",),
)

DOMAINS: dict[str, Domain] = {d.name: d for d in (BANKING, EDUCATION, MEDICAL, MARKETING)}

# The kinds of personal data and what each one means.
PII_TYPES = {
    "NON_PII": "Information that is not classified as personally identifiable information",
    "DIRECT_IDENTIFIER": "Information that directly identifies an individual",
    "PERSON_NAME": "First name, last name, or full name",
    "EMAIL": "Email address",
    "PHONE": "Telephone or mobile number",
    "ADDRESS": "Residential or postal address",
    "DATE_OF_BIRTH": "Date of birth",
    "BANK_ACCOUNT_NUMBER": "Bank account number",
    "FINANCIAL_INFORMATION": "Financial or monetary information",
    "HEALTH_INFORMATION": "Health-related personal information",
    "MEDICAL_RECORD_NUMBER": "Medical record identifier",
    "DEMOGRAPHIC_INFORMATION": "Personal demographic information",
    "LOCATION": "Location-related personal information",
}

# The sensitivity each kind is given.
SENSITIVITY_POLICY = {
    "NON_PII": "LOW",
    "DIRECT_IDENTIFIER": "HIGH",
    "EMAIL": "HIGH",
    "PHONE": "HIGH",
    "ADDRESS": "HIGH",
    "DATE_OF_BIRTH": "HIGH",
    "BANK_ACCOUNT_NUMBER": "HIGH",
    "FINANCIAL_INFORMATION": "HIGH",
    "HEALTH_INFORMATION": "HIGH",
    "MEDICAL_RECORD_NUMBER": "HIGH",
    "PERSON_NAME": "MEDIUM",
    "DEMOGRAPHIC_INFORMATION": "MEDIUM",
    "LOCATION": "MEDIUM",
}

SENSITIVITY_LEVELS = {
    "HIGH": "Highly sensitive personal information requiring strong protection",
    "MEDIUM": "Moderately sensitive personal information",
    "LOW": "Lower sensitivity information that may still require governance",
}

STAR_SCHEMAS = tuple(f"star_{name}" for name in DOMAINS)


def star_constraints() -> list[tuple[str, str, str, str]]:
    """(schema, table, column, PRIMARY KEY | FOREIGN KEY) of every star table."""
    rows = []
    for domain in DOMAINS.values():
        schema = f"star_{domain.name}"
        for dim in domain.dims:
            rows.append((schema, dim.name, dim.key, "PRIMARY KEY"))
            rows.append((schema, domain.fact.name, dim.fact_key or dim.key, "FOREIGN KEY"))
    return rows


def star_references() -> list[tuple[tuple[str, str, str], tuple[str, str, str]]]:
    """(fact key, dimension key) of every foreign key, as (schema, table, column)."""
    return [
        ((f"star_{d.name}", d.fact.name, dim.fact_key or dim.key), (f"star_{d.name}", dim.name, dim.key))
        for d in DOMAINS.values()
        for dim in d.dims
    ]
