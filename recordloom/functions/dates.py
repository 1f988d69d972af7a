"""Mixed-format dates as ``struct<year,month,day>`` with trailing parts missing when unknown."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from recordloom.functions.text import let, strip

DATE_TYPE = "struct<year:int,month:int,day:int>"

# Accepted shapes in order of precedence; the first that parses wins,
# so month-first is preferred where a slash or dash date reads both ways.
DAY_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", "d/M/yy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
)
MONTH_FORMATS = ((r"^\d{4}-\d{1,2}$", "yyyy-M"), (r"^\d{4}/\d{1,2}$", "yyyy/M"))
YEAR_SHAPE = r"^\d{4}$"
TWO_DIGIT_YEAR = r"/\d{2}$"
YEAR_MIN = 1500
TWO_DIGIT_PIVOT = 2069  # a two-digit year from 69 on belongs to the last century


def _first_parse(text: Column, formats) -> Column:
    # the shape test comes first: it is cheaper than a failed parse
    return F.coalesce(*[F.when(text.rlike(shape), F.try_to_date(text, fmt)) for shape, fmt in formats])


def parse_partial_date(value: Column) -> Column:
    """Struct for a parsed value, null for null or unparseable input."""

    def parse(t: Column) -> Column:
        year = F.when(t.rlike(YEAR_SHAPE), t.cast("int"))
        day, month = _first_parse(t, DAY_FORMATS), _first_parse(t, MONTH_FORMATS)
        return let(F.struct(day.alias("d"), month.alias("m"), year.alias("y"), t.rlike(TWO_DIGIT_YEAR).alias("short")), parts)

    def parts(x: Column) -> Column:
        found = F.coalesce(x["d"], x["m"])
        year = F.year(found) - F.when(x["short"] & (F.year(found) >= TWO_DIGIT_PIVOT), 100).otherwise(0)
        return partial_date(F.coalesce(year, x["y"]), F.month(found), F.dayofmonth(x["d"]))

    text = F.regexp_replace(strip(value.cast("string")), r"^(.*?\d{1,2})(?:st|nd|rd|th)\b", "$1")
    return let(text, parse)


def partial_date(year: Column, month: Column, day: Column) -> Column:
    """Keep only the leading known parts; no year means no date."""
    return F.when(
        year.isNotNull(),
        F.struct(
            year.cast("int").alias("year"),
            month.cast("int").alias("month"),
            F.when(month.isNotNull(), day.cast("int")).alias("day"),
        ),
    )


def date_is_unparseable(value: Column) -> Column:
    """True for a non-empty value that no format reads."""
    return F.coalesce(strip(value.cast("string")) != "", F.lit(False)) & parse_partial_date(value).isNull()


def date_parts_in_range(date: Column) -> Column:
    """Range rule for the parts that are present; a null date passes."""
    return (
        F.coalesce(date["year"] >= YEAR_MIN, F.lit(True))
        & F.coalesce(date["month"].between(1, 12), F.lit(True))
        & F.coalesce(date["day"].between(1, 31), F.lit(True))
    )
