"""User code at fixed points of a run (H2-H7).

A hook is a Python callable over DataFrames. It declares a plan like everything else, so it
runs on the cluster and never sees rows on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rowferry.operators.project import rename, rename_back

RowsHook = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class HookContext:
    """H6: what a hook may read and write."""

    spark: SparkSession
    sources: Mapping[str, DataFrame]
    targets: Mapping[str, DataFrame]
    sink: Callable[[str, DataFrame], None]

    def read(self, table: str, from_source: bool, condition: str | None = None) -> DataFrame:
        df = (self.sources if from_source else self.targets)[table]
        return df if condition is None else df.where(condition)

    def read_many(self, tables: list[str], from_source: bool) -> dict[str, DataFrame]:
        return {table: self.read(table, from_source) for table in tables}

    def write(self, table: str, rows: DataFrame) -> None:
        self.sink(table, rows)


def data_retrieved(tables: dict[str, DataFrame], hook: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """H2: all loaded tables at once; tables the hook leaves out stay as they are."""
    return {**tables, **hook(dict(tables))}


def before_update(rows: DataFrame, hook: RowsHook) -> DataFrame:
    """H3."""
    return rows.transform(hook)


def after_update(plan: DataFrame, hook: Callable[[DataFrame], None]) -> DataFrame:
    """H4: the hook sees the outcome; the outcome stays as it is."""
    hook(plan)
    return plan


def in_source_names(rows: DataFrame, names: dict[str, str], hook: RowsHook) -> DataFrame:
    """H7: target names to source names, the hook, and back."""
    return rename(rename_back(rows, names).transform(hook), names)
