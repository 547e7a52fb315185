"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowferry.session import load

Query = Callable[[SparkSession, str], DataFrame]
CASES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = load(self.spark, self.folder, name)
        setattr(self, name, table)
        return table


def case(name: str, sql: str | None = None):
    """Registers a function of ``Tables`` as a query, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in CASES:
            raise ValueError(f"{name} is registered twice")
        CASES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn

    return register
