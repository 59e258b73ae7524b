"""Column expressions. All of them stay inside built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_type(site_id: str | Column) -> Column:
    """Type code of a site: the last three characters of its id (shorter ids whole)."""
    return F.right(_col(site_id), F.lit(3))


def paste(*parts: str | Column, sep: str = "") -> Column:
    """Concatenate, writing a missing part as ``NA`` instead of returning null."""
    return F.concat_ws(sep, *[F.coalesce(_col(p), F.lit("NA")) for p in parts])


def slice_chars(text: str | Column, start: int, stop: int) -> Column:
    """Characters ``start`` to ``stop``, 1-based and both included."""
    return F.substring(_col(text), start, stop - start + 1)


def department(code: str | Column) -> Column:
    """Department of a station code: its third and fourth characters."""
    return slice_chars(code, 3, 4)


def to_number(text: str | Column) -> Column:
    """Text to double; what does not parse is null.

    The JVM accepts a trailing ``d`` or ``f`` ("12f"); those are not numbers here.
    """
    value = F.trim(_col(text))
    return F.when(~value.rlike("[dDfF]$"), value.try_cast("double"))


def decimal_comma(text: str | Column) -> Column:
    """Number written with a decimal comma."""
    return to_number(F.replace(_col(text), F.lit(","), F.lit(".")))


def grouped_decimal_comma(text: str | Column) -> Column:
    """Number with ``.`` between thousands and ``,`` before decimals."""
    return decimal_comma(F.replace(_col(text), F.lit("."), F.lit("")))


def without_nan(value: str | Column) -> Column:
    """NaN counts as missing."""
    return F.nanvl(_col(value), F.lit(None).cast("double"))


def days_in_month(day: str | Column) -> Column:
    return F.day(F.last_day(_col(day)))


def classify(value: Column, classes: dict[str, str], default: str | None = None) -> Column:
    """First matching class; without a match the default (null when none is given)."""
    result = F.lit(None).cast("string") if default is None else F.lit(default)
    for code, label in reversed(list(classes.items())):
        result = F.when(value == code, label).otherwise(result)
    return result


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
