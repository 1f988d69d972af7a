"""String cleaning as column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# The characters that count as white space and as ASCII punctuation.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
PUNCTUATION = string.punctuation

# Legal forms dropped from the end of a company name.
LEGAL_FORMS = (
    "incorporated inc corporation corp company co limited ltd llc llp lllp lp plc pllc pc "
    "gmbh ag kg ohg se sa sas sarl srl spa bv nv ab oy as aps pty pte"
).split()
LEGAL_SUFFIX = r"(?i)([\s,]+(l\.l\.c|l\.p|" + "|".join(LEGAL_FORMS) + r")\.?)+[\s.,]*$"

DIGITS_AND_PUNCTUATION = r"^[\d\p{Punct}\s]+$"


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Both-end strip of any white space (``trim`` alone removes blanks only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def drop_punctuation(c: Column) -> Column:
    return F.translate(c, PUNCTUATION, "")


def canonical(c: Column) -> Column:
    """Upper-cased and stripped form used whenever two values are compared."""
    return F.upper(strip(c))


def normalize_id(c: Column) -> Column:
    """``UEI_5560`` -> ``UEI5560``; nothing left -> null."""
    return empty_to_null(canonical(drop_punctuation(c.cast("string"))))


def normalize_company_name(c: Column) -> Column:
    """Drop trailing legal forms and punctuation, then upper-case and strip."""
    base = F.regexp_replace(strip(c), LEGAL_SUFFIX, "")
    return empty_to_null(canonical(drop_punctuation(base)))


def soft_string(c: Column) -> Column:
    """A string of only digits, punctuation and white space becomes null."""
    return F.when(~c.rlike(DIGITS_AND_PUNCTUATION), c)


def min_length(c: Column, n: int) -> Column:
    """A string shorter than ``n`` becomes null (the row itself is kept)."""
    return F.when(F.length(c) >= n, c)


def null_if_blank(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)
