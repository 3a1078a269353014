"""Survey periods, quarters and year dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import strip

# Spanish month abbreviations in calendar order.
MONTHS = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")


def _month_number(abbreviation: Column) -> Column:
    months = F.create_map(*[F.lit(x) for pair in zip(MONTHS, range(1, 13)) for x in pair])
    return F.try_element_at(months, abbreviation)


def period_date(c: Column) -> Column:
    """Date of a survey round: ``dic-07`` means 1 December 2007, an ISO date is itself."""
    s = F.lower(strip(c.cast("string")))
    # a month name, a hyphen or none, the last two digits of the year; what follows does not matter
    month = _month_number(F.left(s, F.lit(3)))
    rest = F.ltrim(F.substring(s, 4, 3), F.lit("-"))
    digits = F.left(rest, F.lit(2))
    two = (F.length(digits) == 2) & (F.translate(digits, "0123456789", "") == "")
    year = F.when(two, digits.try_cast("int") + 2000)
    iso = F.nullif(F.regexp_extract(s, r"^\d{4}-\d{2}-\d{2}", 0), F.lit("")).try_cast("date")
    return F.coalesce(iso, F.make_date(year, month, F.lit(1)))


def period_quarter(c: Column) -> Column:
    """Quarter of a survey round, from its date whichever way that is written."""
    return F.quarter(period_date(c))


def year_start(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def period_text(date: Column) -> Column:
    """Survey round label ``mmm-yy`` of a date."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat(F.element_at(names, F.month(date)), F.lit("-"), F.date_format(date, "yy"))
