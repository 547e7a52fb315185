"""Column names that may hold dots or blanks, such as ``Account.Name`` from a file header."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flat(names: Iterable[str]) -> list[Column]:
    """The named top-level columns."""
    return [F.col(quoted(name)) for name in names]


def every(df: DataFrame) -> list[str]:
    """All columns of a frame as they are, for a ``select``."""
    return [quoted(name) for name in df.columns]


def column(df: DataFrame, name: str | Column) -> Column:
    """A top-level column of that name, else a path through structs."""
    if isinstance(name, Column):
        return name
    return F.col(quoted(name)) if name in df.columns else F.col(name)
