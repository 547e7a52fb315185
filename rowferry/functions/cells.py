"""Cell values: null tokens, casts, European dates, truncation, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
NULL_TOKENS = ("#n/a", "null", "undefined", "#error!", "#value!")
TRUE_TOKENS = ("1", "true", "yes", "y", "on")
FALSE_TOKENS = ("0", "false", "no", "n", "off")
WRITE_NULL = "#N/A"
WHITESPACE = " \t\n\r\f\v ﻿"

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_EU_DATE = r"^([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{4}|[0-9]{2})$"
_EU_DATETIME = (
    r"^([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{4}|[0-9]{2})"
    r"(?:[ T]([0-9]{1,2})(?::([0-9]{1,2}))?(?::([0-9]{1,2}))?)?$"
)

INTEGER_TYPES = ("int", "integer", "long")
DOUBLE_TYPES = ("double", "percent", "number", "currency", "decimal")


def strip(text: Column) -> Column:
    """Text without blanks, tabs, line ends and no-break spaces at either end."""
    return F.btrim(text, F.lit(WHITESPACE))


def normalize_cell(
    cell: Column, blank_as_null: bool = True, keep_null_tokens: bool = False
) -> Column:
    """K1: trailing carriage returns go, blanks and null tokens become null."""
    raw = F.rtrim(F.coalesce(cell, F.lit("")), F.lit("\r"))
    trimmed = strip(raw)
    if keep_null_tokens:
        return raw
    blank = F.lit(None).cast("string") if blank_as_null else F.lit("")
    return (
        F.when(trimmed == "", blank)
        .when(F.lower(trimmed).isin(*NULL_TOKENS), F.lit(None).cast("string"))
        .otherwise(raw)
    )


def to_number(text: Column) -> Column:
    """K2: double, or null where the text is not a finite number."""
    trimmed = strip(text)
    value = F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def to_integer(text: Column) -> Column:
    """K2: long, or null where the text is not a whole number. Exact beyond 2^53."""
    trimmed = strip(text)
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("long")).otherwise(
        to_number(text).try_cast("long")
    )


def to_boolean(text: Column) -> Column:
    """K3: boolean, or null where the text is neither a true nor a false word."""
    word = F.lower(strip(text))
    return F.when(word.isin(*TRUE_TOKENS), True).when(word.isin(*FALSE_TOKENS), False)


def truthy(value: Column, kind: T.DataType) -> Column:
    """Flag columns of any type: only true, 1 and their text forms count."""
    if isinstance(kind, T.BooleanType):
        return F.coalesce(value, F.lit(False))
    if isinstance(kind, T.NumericType):
        return F.coalesce(value == 1, F.lit(False))
    word = F.lower(strip(value.cast("string")))
    return F.coalesce(~word.isin("false", "0", ""), F.lit(False))


def _full_year(year: Column) -> Column:
    return F.when(year >= 100, year).when(year <= 69, year + 2000).otherwise(year + 1900)


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.coalesce(F.regexp_extract(text, pattern, group).try_cast("int"), F.lit(0))


def european_date(text: Column) -> Column:
    """K4: d.m.y with ``.``, ``/`` or ``-``; two-digit years pivot at 69; null if no such date."""
    trimmed = strip(text)
    made = F.try_make_timestamp(
        _full_year(_part(trimmed, _EU_DATE, 3)),
        _part(trimmed, _EU_DATE, 2),
        _part(trimmed, _EU_DATE, 1),
        F.lit(0),
        F.lit(0),
        F.lit(0).cast("decimal(16,6)"),
    )
    return F.when(trimmed.rlike(_EU_DATE), F.to_date(made))


def european_datetime(text: Column) -> Column:
    """K5: K4 with an optional time of day, read as UTC."""
    trimmed = strip(text)
    hour, minute, second = (_part(trimmed, _EU_DATETIME, g) for g in (4, 5, 6))
    made = F.try_make_timestamp(
        _full_year(_part(trimmed, _EU_DATETIME, 3)),
        _part(trimmed, _EU_DATETIME, 2),
        _part(trimmed, _EU_DATETIME, 1),
        hour,
        minute,
        second.cast("decimal(16,6)"),
    )
    valid = trimmed.rlike(_EU_DATETIME) & (hour <= 23) & (minute <= 59) & (second <= 59)
    return F.when(valid, made)


def european_date_text(text: Column) -> Column:
    """K4 as ISO text; text that is no such date stays as it is."""
    return F.coalesce(F.date_format(european_date(text), "yyyy-MM-dd"), text)


def european_datetime_text(text: Column) -> Column:
    """K5 as ISO text with ``.000Z``; other text stays as it is."""
    iso = F.date_format(european_datetime(text), "yyyy-MM-dd'T'HH:mm:ss'.000Z'")
    return F.coalesce(iso, text)


def datetime_text(value: Column, milliseconds: bool = True) -> Column:
    """K6: ``yyyy-MM-dd  HH:mm:ss.SSS``, with two blanks."""
    return F.date_format(value, "yyyy-MM-dd  HH:mm:ss" + (".SSS" if milliseconds else ""))


def cast_cell(text: Column, kind: str, european_dates: bool = False) -> Column:
    """The typed value of a normalised cell, null where the text does not fit the type."""
    kind = kind.lower()
    if kind == "boolean":
        return to_boolean(text)
    if kind in INTEGER_TYPES:
        return to_integer(text)
    if kind in DOUBLE_TYPES:
        return to_number(text)
    if kind == "date":
        iso = strip(text).try_cast("date")
        return F.coalesce(european_date(text), iso) if european_dates else iso
    if kind == "datetime":
        iso = strip(text).try_cast("timestamp")
        return F.coalesce(european_datetime(text), iso) if european_dates else iso
    return text


def truncate(value: Column, length: int) -> Column:
    """K8: text cut to the length of its field."""
    return F.substring(value.cast("string"), 1, length)


def differs(left: Column, right: Column, kind: T.DataType) -> Column:
    """Loose inequality. Both sides take the type of the target; null equals null only."""
    if isinstance(kind, T.BooleanType):
        # "true" and 1 equal true on either side.
        def as_flag(value: Column) -> Column:
            return F.coalesce(to_boolean(value.cast("string")), value.try_cast("boolean"))

        return ~as_flag(left).eqNullSafe(as_flag(right))
    return ~left.try_cast(kind).eqNullSafe(right.try_cast(kind))


def unwrite_null(text: Column) -> Column:
    """The null token of files becomes null before a write."""
    return F.when(text == WRITE_NULL, F.lit(None).cast("string")).otherwise(text)
