"""Column expressions for cleaning text, numbers, dates and join keys.

All casts are ``try_`` variants: dirty values become NULL, also under ANSI mode. A
failing cast or date parse is slow (it raises inside the JVM), so values whose shape
cannot parse are ruled out by a pattern first.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Date layouts accepted in the source files, tried in this order.
DATE_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and all-space text; never NULL."""
    c = _col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def blank_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.trim(c) != "", c)


def status_key(c: Column | str) -> Column:
    """Upper-case trimmed text, the form in which statuses are compared."""
    return F.upper(F.trim(_col(c).cast("string")))


def parse_number_ptbr(c: Column | str, precision: int = 17, scale: int = 2) -> Column:
    """``1.234,56`` to decimal: dots group thousands, the comma is the decimal mark."""
    text = F.regexp_replace(_col(c).cast("string"), r'["\s.]', "")
    return F.translate(text, ",", ".").try_cast(f"decimal({precision},{scale})")


def parse_number_us(c: Column | str, scale: int, precision: int = 17) -> Column:
    """``1,234.565`` to decimal, rounded half-up on the double value.

    Commas group thousands and a missing leading zero is accepted (``.02``, ``-.02``).
    """
    text = F.translate(F.trim(_col(c).cast("string")), ",", "")
    value = F.nullif(text, F.lit("")).try_cast("double")
    return F.round(value, scale).try_cast(f"decimal({precision},{scale})")


def _date_shape(layout: str) -> str:
    """Pattern for the date part of a layout and the character behind it."""
    plain = layout.replace("'", "")
    date, after = plain[:10], plain[10:11]
    return "^" + re.sub("[yMd]", r"\\d", date) + (after or "$")


def parse_date(c: Column | str) -> Column:
    """A plain cast, else the first layout of :data:`DATE_FORMATS` that parses, else NULL."""
    text = _col(c).cast("string")
    by_layout = [
        F.when(text.rlike(_date_shape(f)), F.try_to_timestamp(text, F.lit(f))).cast("date")
        for f in DATE_FORMATS
    ]
    return F.coalesce(text.try_cast("date"), *by_layout)


def as_date(df: DataFrame, c: str) -> Column:
    """The column as a date: a plain cast for date types, :func:`parse_date` for text."""
    kind = dict(df.dtypes)[c]
    if kind == "date" or kind.startswith("timestamp"):
        return F.col(c).cast("date")
    return parse_date(c)


def whole_number(text: Column) -> Column:
    """Integer part of number text as ``bigint``, NULL for any other text.

    Doubles printed with an exponent (``9.2890001E9``) are resolved too.
    """
    return F.when(
        text.rlike(r"^[+-]?\d+(\.\d*)?$"), F.substring_index(text, ".", 1).try_cast("bigint")
    ).when(text.rlike(r"^-?\d+\.\d+E-?\d+$"), text.try_cast("double").try_cast("bigint"))


def make_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from three parts; impossible dates and non-numbers give NULL."""
    y, m, d = (whole_number(F.trim(_col(p).cast("string"))) for p in (year, month, day))
    text = F.when(
        y.between(1, 9999) & m.between(1, 12) & d.between(1, 31),
        F.format_string("%04d-%02d-%02d", y, m, d),
    )
    return text.try_cast("date")


def normalize_key(c: Column | str) -> Column:
    """Comparable text form of a join key.

    Numbers go through ``bigint``, so leading zeros and a fraction disappear. Other text,
    also product codes like ``5D`` or ``1E5``, is only trimmed. Blanks become NULL.
    """
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(whole_number(text).cast("string"), F.nullif(text, F.lit("")))


def looks_numeric(c: Column | str) -> Column:
    """False for text that cannot be a number: no digit, and not a NaN or infinity."""
    return _col(c).rlike(r"\d|(?i)nan|inf")
