"""Reading outside text without failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -2147483648, 2147483647


def text_or_null(value: Column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(value, F.lit(""))


def decimal_text(value: Column) -> Column:
    """Decimal text as double, NULL for anything else.

    The character test keeps out spellings that a JVM parser takes but an
    export never means (``1.5f``, ``0x1p3``, ``NaN``, ``Infinity``). Spaces pass
    it: the cast drops outer ones and takes inner ones for no number.
    """
    return F.when(~value.rlike(r"[^0-9eE+\-. ]"), value.try_cast("double"))


def finite(value: Column) -> Column:
    """NULL instead of an overflowed number: JSON cannot spell infinity."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def number_or_null(value: Column) -> Column:
    """Finite decimal text as double; anything else is missing."""
    return finite(decimal_text(value))


def clock_hour(hour: Column) -> Column:
    """Hour number, truncated; 0 when missing, the largest number when beyond it."""
    beyond = F.when(hour.isNotNull(), F.lit(2**63 - 1))
    return F.coalesce(hour.try_cast("bigint"), beyond, F.lit(0))


def clock_text(date: Column, hour: Column) -> Column:
    """``2021-05-24`` and ``7`` as ``2021-05-24T07:00:00``.

    Put together from parts: a formatter reads its pattern anew for every row.
    """
    digits = hour.cast("string")
    return F.concat(date, F.lit("T"), F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), "0"), F.lit(":00:00"))


def millisecond_text(moment: Column) -> Column:
    """Timestamp text with three fraction digits."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def narrow_to_int(value: Column) -> Column:
    """Float to int: truncates, saturates at the int range, NaN becomes 0.

    Saturating instead of nulling matters to range checks, which accept NULL
    but must reject a value that is too large.
    """
    outside = (
        F.when(F.isnan(value), F.lit(0)).when(value > 0, F.lit(INT_MAX)).when(value < 0, F.lit(INT_MIN))
    )
    return F.coalesce(value.try_cast("int"), outside)
