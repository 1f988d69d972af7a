"""Free-text address parsing for the shapes that occur: ``street[, unit], city[ ST][ 12345]``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordloom.functions.abbreviations import expand_abbreviations
from recordloom.functions.text import canonical, empty_to_null, let, strip

POSTAL_CODE = r"\b(\d{5}(?:-\d{4})?)\s*$"
STATE = r"(?i)[\s,]([a-z]{2})\s*(?:\d{5}(?:-\d{4})?)?\s*$"
STREET = r"^\d"


def parse_location(location: Column) -> Column:
    """Struct of address_1, address_2, postal_code, city, state; all null when no street is found."""
    parts = F.transform(F.split(strip(location), ","), lambda p: strip(p))
    return let(parts, _from_parts)


def _from_parts(parts: Column) -> Column:
    n = F.size(parts)
    parsed = (n >= 2) & F.element_at(parts, 1).rlike(STREET)

    last = F.element_at(parts, -1)
    padded = F.concat(F.lit(" "), last)
    postal = empty_to_null(F.regexp_extract(last, POSTAL_CODE, 1))
    has_state = postal.isNotNull() & padded.rlike(STATE)
    state = F.when(has_state, empty_to_null(F.regexp_extract(padded, STATE, 1)))
    tail = F.when(has_state, F.regexp_replace(padded, STATE, "")).otherwise(F.regexp_replace(last, POSTAL_CODE, ""))
    tail = empty_to_null(strip(tail))
    # "street, city, ST 12345": the last part holds no city, so the one before it does
    city_before = tail.isNull() & (n >= 3)
    city = F.when(city_before, F.try_element_at(parts, F.lit(-2))).otherwise(tail)
    units = F.when(city_before, n - 3).otherwise(n - 2)
    address_2 = F.when(units > 0, F.array_join(F.slice(parts, F.lit(2), F.greatest(units, F.lit(0))), ", "))

    def only_parsed(c: Column) -> Column:
        return F.when(parsed, empty_to_null(canonical(c)))

    return F.struct(
        only_parsed(expand_abbreviations(F.element_at(parts, 1))).alias("address_1"),
        only_parsed(address_2).alias("address_2"),
        only_parsed(postal).alias("postal_code"),
        only_parsed(city).alias("city"),
        only_parsed(state).alias("state"),
    )


def clean_street(address: Column) -> Column:
    """Street line of a registry address; the raw value stays when it does not parse."""
    first = F.element_at(F.split(strip(address), ","), 1)
    street = F.when(first.rlike(STREET), expand_abbreviations(first))
    return empty_to_null(canonical(F.coalesce(empty_to_null(street), address)))
