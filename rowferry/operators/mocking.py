"""Mock values in place of real ones.

Patterns: ``ids``, ``c_seq_number(prefix,from,step)``, ``c_seq_date(from,step)``,
``c_set_value(value)`` where ``RAW_VALUE`` stands for the old value, and the names of the
generators below. A generator picks from a word list by a hash of row id and field, so the
same row gets the same value on every run and every retry.
"""

from __future__ import annotations

import ast
import functools
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.text import ascii_bounds
from rowferry.functions.names import quoted
from rowferry.operators.project import INTERNAL
from rowferry.operators.ranking import rank_rows
from rowferry.operators.stats import changed_counts
from rowferry.spec import MockField

# Fixed values.
ROW_FLAG = "--row"
ALL_FIELDS = "all"
ANY_VALUE = "*"
NO_VALUE = "^*"

FIRST_NAMES = ("Ada", "Ben", "Carla", "David", "Elena", "Felix", "Grace", "Hugo", "Ines", "Jonas")
LAST_NAMES = ("Abel", "Brandt", "Costa", "Dunn", "Evans", "Fischer", "Garcia", "Hill", "Ito", "Jensen")
CITIES = ("Arden", "Brookfield", "Clayton", "Dover", "Easton", "Fairview", "Greenville", "Hudson")
COUNTRIES = ("Austria", "Brazil", "Canada", "Denmark", "Estonia", "France", "Ghana", "Japan")
STREETS = ("Oak Street", "Mill Road", "Lake Avenue", "Hill Lane", "Park Drive", "River Way")
COMPANIES = ("Acorn", "Beacon", "Cobalt", "Delta", "Ember", "Fjord", "Granite", "Harbor")
SUFFIXES = ("Ltd", "Inc", "Group", "Partners")
WORDS = ("amber", "birch", "cedar", "dune", "elm", "fern", "grove", "heath", "iris", "juniper")


def _number(seed: Sequence[Column], salt: str) -> Column:
    """A number from 0 to 2^32 that depends on row and salt alone."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(s.cast("string"), F.lit("")) for s in seed], F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _one_of(words: Sequence[str], seed: Sequence[Column], salt: str) -> Column:
    return F.element_at(
        F.array(*[F.lit(w) for w in words]), ((_number(seed, salt) % len(words)) + 1).cast("int")
    )


def generated(kind: str, seed: Sequence[Column], field: str) -> Column:
    """A made-up value of a kind, picked by row and field."""
    pick = functools.partial(_one_of, seed=seed)
    first, last = pick(FIRST_NAMES, salt=f"{field}|first"), pick(LAST_NAMES, salt=f"{field}|last")
    number = _number(seed, f"{field}|number")
    kinds = {
        "first_name": first,
        "last_name": last,
        "name": F.concat_ws(" ", first, last),
        "full_name": F.concat_ws(" ", first, last),
        "username": F.concat(F.lower(first), F.lit("_"), (number % 10000).cast("string")),
        "email": F.concat(F.lower(first), F.lit("."), F.lower(last), (number % 10000).cast("string"), F.lit("@example.com")),
        "phone": F.concat(F.lit("555-"), F.lpad((number % 10000000).cast("string"), 7, "0")),
        "city": pick(CITIES, salt=f"{field}|city"),
        "country": pick(COUNTRIES, salt=f"{field}|country"),
        "street": pick(STREETS, salt=f"{field}|street"),
        "address": F.concat((number % 200 + 1).cast("string"), F.lit(" "), pick(STREETS, salt=f"{field}|street")),
        "zip": F.lpad((number % 100000).cast("string"), 5, "0"),
        "company_name": F.concat_ws(" ", pick(COMPANIES, salt=f"{field}|company"), pick(SUFFIXES, salt=f"{field}|suffix")),
        "url": F.concat(F.lit("https://"), pick(WORDS, salt=f"{field}|w1"), F.lit(".example.com")),
        "word": pick(WORDS, salt=f"{field}|w1"),
        "title": F.initcap(F.concat_ws(" ", pick(WORDS, salt=f"{field}|w1"), pick(WORDS, salt=f"{field}|w2"))),
        "sentence": F.concat(
            F.concat_ws(" ", F.initcap(pick(WORDS, salt=f"{field}|w1")), pick(WORDS, salt=f"{field}|w2"), pick(WORDS, salt=f"{field}|w3")),
            F.lit("."),
        ),
        "integer": number,
        "boolean": number % 2 == 0,
    }
    if kind not in kinds:
        raise ValueError(f"unknown generator {kind!r}")
    return kinds[kind]


def sequence_number(position: Column, prefix: str = "", start: int = 1, step: int = 1) -> Column:
    """W5. A start of 0 counts as missing and means 1."""
    value = F.lit(start or 1) + (position - 1) * step
    return F.concat(F.lit(prefix), value.cast("string"))


def sequence_date(position: Column, start: str, step: str = "d") -> Column:
    """One step per row from the start. Month and year steps clamp to the month's end."""
    begin, n = F.lit(start).cast("timestamp"), position - 1
    if step.startswith("-"):
        step, n = step[1:], -n
    zero = F.lit(0)
    if step in ("m", "y"):
        months = n * (12 if step == "y" else 1)
        return begin + F.make_interval(months=months.cast("int"))
    if step == "d":
        return begin + F.make_interval(days=n.cast("int"))
    seconds = {"s": n.cast("decimal(18,6)"), "ms": (n / 1000).cast("decimal(18,6)")}
    if step in seconds:
        return begin + F.make_interval(zero, zero, zero, zero, zero, zero, seconds[step])
    return begin


def test(expression: str, value: Column, kind: T.DataType | None = None) -> Column:
    """T5: ``*`` has a value, ``^*`` has none, anything else is a pattern in any case.

    0, NaN and false are no values; the texts ``0`` and ``false`` are.
    """
    text = F.coalesce(value.cast("string"), F.lit(""))
    filled = text != ""
    if isinstance(kind, T.BooleanType):
        filled = F.coalesce(value, F.lit(False))
    elif isinstance(kind, T.NumericType):
        filled = F.coalesce((value != 0) & ~F.isnan(value.cast("double")), F.lit(False))
    if expression == ANY_VALUE:
        return filled
    if expression == NO_VALUE:
        return ~filled
    return text.rlike(f"(?iu){ascii_bounds(expression)}")


def _pattern(text: str) -> tuple[str, bool]:
    """The pattern without its flag, and whether the whole row is meant."""
    return text.split(ROW_FLAG)[0].strip(), ROW_FLAG in text


def fields_to_mock(df: DataFrame, mocks: Sequence[MockField], id_column: str) -> dict[str, MockField]:
    """The first rule for each column, named or ``all``. Ids are never mocked."""
    chosen = {}
    for name in df.columns:
        if name == id_column or name in INTERNAL or name.startswith("_"):
            continue
        for mock in mocks:
            if mock.name in (name, ALL_FIELDS) and name not in mock.exclude_names:
                if mock.pattern:
                    chosen[name] = mock
                break
    return chosen


def mask_flags(df: DataFrame, chosen: dict[str, MockField]) -> dict[str, Column]:
    """For every field the condition under which it is mocked.

    Fields are judged in order. A row-wide exclusion leaves the whole row; a row-wide
    inclusion mocks its field and all fields.
    """
    row_excluded, row_included = F.lit(False), F.lit(False)
    own: dict[str, Column] = {}
    for name, mock in chosen.items():
        value = F.col(quoted(name))
        excl, excl_row = _pattern(mock.excluded)
        incl, incl_row = _pattern(mock.included)
        excluded = test(excl, value, df.schema[name].dataType) if excl else F.lit(False)
        included = test(incl, value, df.schema[name].dataType) if incl else F.lit(False)
        if incl and incl_row:
            row_included = row_included | included
        if excl and excl_row:
            row_excluded = row_excluded | excluded
        own[name] = ~excluded & (included if incl else F.lit(True))
    return {name: ~row_excluded & (row_included | flag) for name, flag in own.items()}


def _call(pattern: str) -> tuple[str, list]:
    """Name and literal arguments of ``name`` or ``name(args)``."""
    found = re.match(r"^\s*(\w+)\s*(?:\((.*)\))?\s*$", pattern, re.DOTALL)
    if not found:
        raise ValueError(f"mock pattern {pattern!r} is not a call")
    args = ast.literal_eval(f"({found.group(2)},)") if found.group(2) else ()
    return found.group(1), list(args)


def apply(df: DataFrame, mocks: Sequence[MockField], id_column: str, order_by: Sequence[str]) -> DataFrame:
    """T4: mocks the columns of ``df``. Sequences count the mocked rows of their field only."""
    chosen = fields_to_mock(df, mocks, id_column)
    if not chosen:
        return df
    flags = mask_flags(df, chosen)
    out = df.withColumns({f"_mock_{name}": flag for name, flag in flags.items()})
    positions: dict[str, str] = {}
    for name, mock in chosen.items():
        if _call(mock.pattern)[0] in ("c_seq_number", "c_seq_date"):
            positions[name] = f"_pos_{name}"
            out = rank_rows(out, [f"_mock_{name}"], order_by, positions[name])
    seed = [F.col(quoted(id_column))]
    values = {}
    for name, mock in chosen.items():
        kind, args = _call(mock.pattern)
        old = F.col(quoted(name))
        if kind == "ids":
            new = F.col(quoted(id_column))
        elif kind == "c_seq_number":
            new = sequence_number(F.col(positions[name]), *args)
        elif kind == "c_seq_date":
            new = sequence_date(F.col(positions[name]), *args)
        elif kind == "c_set_value":
            value = args[0] if args else None
            if isinstance(value, str) and "RAW_VALUE" in value:
                head, _, tail = value.partition("RAW_VALUE")
                new = F.concat(F.lit(head), F.coalesce(old.cast("string"), F.lit("")), F.lit(tail))
            else:
                new = F.lit(value)
        else:
            new = generated(kind, seed, name)
        target = df.schema[name].dataType
        values[name] = F.when(F.col(f"_mock_{name}"), new.cast(target)).otherwise(old).alias(name)
    return out.select(*[values.get(c, F.col(quoted(c))) for c in df.columns])


def apply_counts(df: DataFrame, mocks: Sequence[MockField], id_column: str) -> DataFrame:
    """Mocked rows per field."""
    flags = mask_flags(df, fields_to_mock(df, mocks, id_column))
    return changed_counts(df, flags)

