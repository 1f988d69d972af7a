"""Declarative description of a source: schema, keys, column expressions and reject rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from recordloom.functions import address, dates, lookup, text
from recordloom.settings import MIN_LOCATION_LENGTH

DATE = T.StructType([T.StructField(p, T.IntegerType()) for p in ("year", "month", "day")])


@dataclass(frozen=True)
class Reject:
    """A row for which ``condition`` is true is rejected with ``code``."""

    code: str
    condition: Callable[[], Column]


@dataclass(frozen=True)
class SourceSpec:
    """Everything the load, dedup, resolution and audit jobs need to know about a source.

    ``columns`` maps canonical names to expressions over the raw (all-string) columns.
    ``derived`` names intermediate values that several of them use, computed once per row.
    ``raw_rejects`` see the raw columns, ``rejects`` the canonical ones.
    ``lookups`` are applied to the cleaned frame (for example a code-to-label join).
    ``multi_line`` tells whether values of its CSV files span lines; None has the files looked at.
    """

    name: str
    path_pattern: str
    primary_key: tuple[str, ...]
    schema: T.StructType
    columns: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    partition_key: str | None = None
    raw_header: tuple[str, ...] = ()
    rejects: tuple[Reject, ...] = ()
    raw_rejects: tuple[Reject, ...] = ()
    lookups: tuple[Callable[[DataFrame], DataFrame], ...] = ()
    weight_column: str | None = None
    multi_line: bool | None = None

    def __post_init__(self):
        names = set(self.schema.fieldNames())
        missing = [k for k in (*self.primary_key, *filter(None, [self.partition_key])) if k not in names]
        if not self.primary_key or missing:
            raise TypeError(f"source {self.name!r} needs a primary key and keys inside its schema, got {missing}")

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(h, T.StringType()) for h in self.raw_header])

    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    def with_lookups(self, *lookups: Callable[[DataFrame], DataFrame]) -> "SourceSpec":
        return replace(self, lookups=(*self.lookups, *lookups))




def _raw(name: str) -> Column:
    """Raw field: empty means missing, white space around it does not count."""
    return text.strip(text.empty_to_null(F.col(f"`{name}`")))


# Columns, types and nullability of the three silver tables.
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.StringType(), False),
        T.StructField("company_name", T.StringType(), False),
        T.StructField("company_name_normalized", T.StringType()),
        T.StructField("address_1", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("is_active", T.BooleanType(), False),
    ]
)
LICENSE_SCHEMA = T.StructType(
    [
        T.StructField("license_id", T.StringType(), False),
        T.StructField("company_name", T.StringType(), False),
        T.StructField("company_name_normalized", T.StringType()),
        T.StructField("address_1", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("naics_code", T.StringType()),
        T.StructField("naics_code_label", T.StringType()),
        T.StructField("expiration_date", DATE),
    ]
)
VENDOR_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.StringType(), False),
        T.StructField("entity_id", T.StringType()),
        T.StructField("company_name", T.StringType(), False),
        T.StructField("company_name_normalized", T.StringType()),
        T.StructField("certification_type", T.StringType()),
        T.StructField("trade_specialty", T.StringType()),
    ]
)


def business_entity_registry() -> SourceSpec:
    name = _raw("Official Business Name")
    return SourceSpec(
        name="business_entity_registry",
        path_pattern="business_entity_registry",
        primary_key=("entity_id",),
        partition_key="city",
        weight_column="city",
        schema=ENTITY_SCHEMA,
        raw_header=(
            "Entity UEI", "Official Business Name", "Address Line 1", "City Name", "Zip Code", "Registration Status",
        ),
        columns={
            "entity_id": lambda: text.normalize_id(_raw("Entity UEI")),
            "company_name": lambda: name,
            "company_name_normalized": lambda: text.normalize_company_name(name),
            "address_1": lambda: address.clean_street(text.soft_string(_raw("Address Line 1"))),
            "postal_code": lambda: text.canonical(_raw("Zip Code")),
            "city": lambda: text.canonical(text.soft_string(_raw("City Name"))),
            "is_active": lambda: F.coalesce(_raw("Registration Status") == "ACT", F.lit(False)),
        },
    )


def licenses_registry(
    naics: DataFrame | None = None, on_bad_date: str = "null", short_location: str = "null"
) -> SourceSpec:
    """``on_bad_date`` and ``short_location`` choose between nulling the value and rejecting the row."""
    for option in (on_bad_date, short_location):
        if option not in ("null", "reject"):
            raise ValueError(f"expected 'null' or 'reject', got {option!r}")
    name, raw_location = _raw("COMPANY NAME"), _raw("HQ LOCATION")
    location = address.parse_location(text.min_length(text.soft_string(raw_location), MIN_LOCATION_LENGTH))
    raw_rejects = []
    if on_bad_date == "reject":
        raw_rejects.append(
            Reject("expiration_date_unparseable", lambda: dates.date_is_unparseable(_raw("CERT_EXPIRY_DATE")))
        )
    if short_location == "reject":
        raw_rejects.append(Reject("location_too_short", lambda: F.length(raw_location) < MIN_LOCATION_LENGTH))
    spec = SourceSpec(
        name="licenses_registry",
        path_pattern="licenses_registry",
        primary_key=("license_id",),
        partition_key="city",
        weight_column="naics_code",
        schema=LICENSE_SCHEMA,
        derived={"_location": lambda: location},
        raw_header=("LICENSE_NUM", "COMPANY NAME", "HQ LOCATION", "NAICS CODE", "CERT_EXPIRY_DATE"),
        columns={
            "license_id": lambda: text.normalize_id(_raw("LICENSE_NUM")),
            "company_name": lambda: name,
            "company_name_normalized": lambda: text.normalize_company_name(name),
            "address_1": lambda: F.col("_location.address_1"),
            "postal_code": lambda: F.col("_location.postal_code"),
            "city": lambda: F.col("_location.city"),
            "naics_code": lambda: _raw("NAICS CODE"),
            "naics_code_label": lambda: F.lit(None).cast("string"),
            "expiration_date": lambda: dates.parse_partial_date(_raw("CERT_EXPIRY_DATE")),
        },
        raw_rejects=tuple(raw_rejects),
        rejects=(
            Reject("expiration_date_out_of_range", lambda: ~dates.date_parts_in_range(F.col("expiration_date"))),
        ),
    )
    if naics is not None:
        spec = spec.with_lookups(
            lambda df: lookup.code_label(df.drop("naics_code_label"), "naics_code", naics, "naics_code_label")
        )
    return spec


def sub_contractors_registry() -> SourceSpec:
    name = _raw("Firm Name")
    return SourceSpec(
        name="sub_contractors_registry",
        path_pattern="sub_contractors_registry",
        primary_key=("vendor_id",),
        partition_key="trade_specialty",
        weight_column="trade_specialty",
        schema=VENDOR_SCHEMA,
        raw_header=("Vendor ID", "Firm Name", "Vendor UEI", "Certification Type", "Trade Specialty"),
        columns={
            "vendor_id": lambda: text.normalize_id(_raw("Vendor ID")),
            "entity_id": lambda: text.normalize_id(_raw("Vendor UEI")),
            "company_name": lambda: name,
            "company_name_normalized": lambda: text.normalize_company_name(name),
            "certification_type": lambda: _raw("Certification Type"),
            "trade_specialty": lambda: _raw("Trade Specialty"),
        },
    )


def default_specs(naics: DataFrame | None = None) -> tuple[SourceSpec, ...]:
    return business_entity_registry(), licenses_registry(naics), sub_contractors_registry()


def route(path: str | Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """Name of the first pattern (case-insensitive search) that occurs in the path, else null."""
    column = F.lit(path) if isinstance(path, str) else path
    hits = [F.when(column.rlike(f"(?i){pattern}"), F.lit(name)) for pattern, name in patterns]
    return F.coalesce(*hits)


def spec_for_path(path: str, specs: Sequence[SourceSpec]) -> SourceSpec | None:
    """Driver-side routing of one path to its source."""
    return next((s for s in specs if re.search(s.path_pattern, path, re.IGNORECASE)), None)
