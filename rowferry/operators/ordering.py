"""ORDER BY, LIMIT, OFFSET."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ITEM = re.compile(r"^\s*(?P<name>.+?)(?:\s+(?P<way>ASC|DESC))?(?:\s+NULLS\s+(?P<nulls>FIRST|LAST))?\s*$", re.I)


def _items(order_by: str, names: Mapping[str, str] | None) -> list[tuple[str, bool, bool]]:
    """(column, descending, nulls last) of each part; names are those of the target."""
    lower = {k.lower(): v for k, v in (names or {}).items()}
    out = []
    for part in order_by.split(","):
        found = _ITEM.match(part)
        name = found["name"].strip()
        descending = (found["way"] or "").upper() == "DESC"
        nulls_last = found["nulls"].upper() == "LAST" if found["nulls"] else descending
        out.append((lower.get(name.lower(), name), descending, nulls_last))
    return out


def _sort(name: str, descending: bool, nulls_last: bool) -> Column:
    column = F.col(name)
    if descending:
        return column.desc_nulls_last() if nulls_last else column.desc_nulls_first()
    return column.asc_nulls_last() if nulls_last else column.asc_nulls_first()


def order_rows(df: DataFrame, order_by: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """O1: the order of a source read; ``names`` maps the columns to those of the target."""
    return df.orderBy(*[_sort(*item) for item in _items(order_by, names)])


def limit_rows(df: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """O2. Counts and full target reads leave it out."""
    out = df.offset(offset) if offset else df
    return out if limit is None else out.limit(limit)


def order_keys(df: DataFrame, order_by: str) -> tuple[DataFrame, list[str]]:
    """The order as plain ascending columns, for operators that take the first of a key.

    A descending number changes its sign, a descending date counts back, other descending
    types are refused. Nulls stand where the order puts them.
    """
    names = []
    for i, (name, descending, nulls_last) in enumerate(_items(order_by, None)):
        column, kind = F.col(name), df.schema[name].dataType
        if descending:
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                column = -F.unix_micros(column.cast("timestamp"))
            elif isinstance(kind, T.DateType):
                column = -F.unix_date(column)
            elif isinstance(kind, T.NumericType):
                column = -column
            else:
                raise ValueError(f"{name} cannot be taken in descending order")
        absent = column.isNull() if nulls_last else column.isNotNull()
        df = df.withColumn(f"_s{i}n", absent).withColumn(f"_s{i}", column)
        names += [f"_s{i}n", f"_s{i}"]
    return df, names
