"""Unions, distinct rows, removals, defaults."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.operators.ranking import first_per_key

# What users and groups have in common.
USER_GROUP_COLUMNS = ("Id", "Name", "CreatedDate", "LastModifiedDate", "SystemModstamp")


def union_distinct(frames: Sequence[DataFrame], id_column: str, order_by: Sequence[str]) -> DataFrame:
    """Batches appended in the given order, each id once, its first row kept."""
    numbered = [df.withColumn("_batch", F.lit(i)) for i, df in enumerate(frames)]
    everything = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    return first_per_key(everything, [id_column], ["_batch", *order_by]).drop("_batch")


def union_common(first: DataFrame, second: DataFrame, columns: Sequence[str] = USER_GROUP_COLUMNS) -> DataFrame:
    """Two tables over their shared columns."""
    return first.select(*columns).unionByName(second.select(*columns))


def append(first: DataFrame, second: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One table after the other over a fixed column list; missing columns are null."""
    both = first.unionByName(second, allowMissingColumns=True)
    for name in columns:
        if name not in both.columns:
            both = both.withColumn(name, F.lit(None).cast("string"))
    return both.select(*columns)


def distinct_by(df: DataFrame, column: str, order_by: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """U4: the first row per value."""
    value = F.col(column)
    if ignore_case:
        value = F.lower(F.coalesce(value.cast("string"), F.lit("")))
    return first_per_key(df.withColumn("_by", value), ["_by"], order_by).drop("_by")


def remove_first(df: DataFrame, condition: Column, order_by: Sequence[str]) -> DataFrame:
    """Without the first row that meets the condition; all rows if none does."""
    first = df.where(condition).agg(F.min(F.struct(*order_by)).alias("_first"))
    return df.where(~F.struct(*order_by).eqNullSafe(first.scalar()))


def keep_listed(df: DataFrame, column: str, keys: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """One row per listed key; keys that are not there get the defaults."""
    wanted = keys.select(F.col(column).alias("_want")).distinct()
    joined = wanted.join(df.withColumn("_hit", F.lit(True)), F.col("_want") == F.col(column), "left")

    def value(name: str) -> Column:
        if name == column:
            return F.col("_want").alias(name)
        if name not in defaults:
            return F.col(name)
        return F.when(F.col("_hit"), F.col(name)).otherwise(defaults[name]).alias(name)

    return joined.select(*[value(name) for name in df.columns])


def not_processed(prepared: DataFrame, written: DataFrame, id_column: str) -> DataFrame:
    """Prepared rows that no pass wrote."""
    done = written.select(F.col(id_column).alias("_done")).distinct()
    return prepared.join(done, F.col(id_column) == F.col("_done"), "left_anti")
