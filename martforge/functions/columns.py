"""Scalar formulas shared by the silver and gold operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_castable(col: Column | str) -> Column:
    """True when the value is present and converts to a 32-bit int.

    ``try_cast`` keeps the test two-valued and independent of ANSI mode: text,
    decimal text and out-of-range numbers are all rejected.
    """
    c = _c(col)
    return c.isNotNull() & c.try_cast("int").isNotNull()


def matches_pattern(col: Column | str, pattern: str) -> Column:
    """True when the value is present and the regex matches (Java semantics, as in Spark)."""
    c = _c(col)
    return c.isNotNull() & (F.regexp_extract(c, pattern, 0) != F.lit(""))


def exact_measure(col: Column | str, scale: int) -> Column:
    """A measure as a decimal with ``scale`` digits after the point, to be summed without error in any order.

    Digits finer than that are rounded half up, value by value, so a total is
    within (rows x half of the last digit) of the true one and the same in every run;
    with the default of ten digits that is below what doubles keep of amounts above 10^5.
    Values that no sum can hold (NaN, infinities, 10^(38 - scale) and more) count as null.
    """
    return _c(col).cast("double").try_cast(f"decimal(38,{scale})")


def fits_scale(col: Column | str, scale: int) -> Column:
    """True when the value is null, or a number that ``scale`` digits after the point hold without rounding."""
    c = _c(col)
    number = c.try_cast("double")
    return F.coalesce(c.isNull() | (number.try_cast(f"decimal(38,{scale})").cast("double") == number), F.lit(False))


def growth_pct(current: Column | str, previous: Column | str, digits: int | None = 2) -> Column:
    """``(cur - coalesce(prev, 0)) / nullif(prev, 0) * 100``; NULL when prev is missing or zero."""
    cur, prev = _c(current), _c(previous)
    value = ((cur - F.coalesce(prev, F.lit(0))) / F.nullif(prev, F.lit(0))) * F.lit(100)
    return value if digits is None else F.round(value, digits)


def share_pct(part: Column | str, total: Column | str, digits: int | None = 2) -> Column:
    """``part * 100 / total`` as a double, rounded half-up."""
    value = _c(part).cast("double") * F.lit(100.0) / _c(total)
    return value if digits is None else F.round(value, digits)
