"""Tolerant number parsing, exact sums, half-up rounding and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import WHITESPACE, is_ascii, strip

# Fixed value: plain decimal notation. Checked before the cast, which takes more for a number
# (12d, 0x1p3, nan) and is slow to fail.
DECIMAL_TEXT = r"^[\s\x1c-\x1f]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[\s\x1c-\x1f]*$"

# Sums in it do not depend on the order of the rows, so a task that is run again gives the same
# total. Twelve digits after the point; a value of 1e26 or more ends the job rather than go missing.
EXACT = "decimal(38,12)"


def _castable(c: Column) -> Column:
    """Text without the whitespace a cast does not skip itself (it skips the ASCII kinds)."""
    text = c.cast("string")
    return F.when(is_ascii(text), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def number_or_null(c: Column) -> Column:
    """Text to double; whatever is not a plain number becomes NULL."""
    s = _castable(c)
    return F.when(s.rlike(DECIMAL_TEXT), s.try_cast("double"))


def amount_or_null(c: Column) -> Column:
    """As :func:`number_or_null`, with thousands commas allowed."""
    return number_or_null(F.replace(c.cast("string"), F.lit(","), F.lit("")))


def number_or_zero(c: Column) -> Column:
    """Text to number with 0 for what is not one, cut to a whole number."""
    return F.coalesce(number_or_null(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def integer_or_zero(c: Column) -> Column:
    """Integer text to bigint; other text, decimals included, counts as 0. A number is cut to a whole one."""
    s = _castable(c)
    text = F.when(~s.contains("."), s.try_cast("bigint"))
    # the type is known when the plan is made, so only one branch is left
    whole = F.when(F.typeof(c) == "string", text).otherwise(number_or_null(c).try_cast("bigint"))
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def whole_or_null(c: Column) -> Column:
    """A whole number written in any plain way (``12``, ``12.0``) to bigint; NULL for everything else."""
    n = number_or_null(c)
    return F.when(n == F.floor(n), n.try_cast("bigint"))


def year_of_label(c: Column, suffix: str = " (p)") -> Column:
    """Year label without its provisional mark, as int."""
    return strip(F.replace(c.cast("string"), F.lit(suffix), F.lit(""))).try_cast("int")


def half_up(c: Column, digits: int) -> Column:
    """Round half away from zero, in decimals, and return a double. Digits well behind the last one kept are
    rounded away first, so that a double a hair below a half counts as the half it stands for."""
    return F.round(c.cast(f"decimal(38,{max(6, digits + 2)})"), digits).cast("double")


def exact_sum(c: Column) -> Column:
    """Sum free of floating-point order effects; stays a decimal. NaN counts as missing; digits after the
    twelfth are rounded away first."""
    return F.sum(c.cast(EXACT))


def exact_avg(c: Column) -> Column:
    """Mean of the values that :func:`exact_sum` adds, as double."""
    return exact_sum(c).cast("double") / F.nullif(F.count(c.cast(EXACT)), F.lit(0))


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; NULL where the denominator is zero or missing."""
    return half_up(numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent; 0 where there is nothing to share."""
    return F.coalesce(ratio(part * 100, whole, digits), F.lit(0.0))


def row_sum(*cols: Column) -> Column:
    """Sum across the columns of a row, with missing values as 0."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(c, F.lit(0))
    return total
