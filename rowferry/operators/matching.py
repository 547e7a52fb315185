"""Source to target matching on external keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import key_text
from rowferry.functions.names import column, quoted
from rowferry.operators.ranking import last_per_key

SOURCE_ID = "source_id"
TARGET_ID = "target_id"


def keyed(
    df: DataFrame,
    id_column: str,
    key: Sequence[str | Column],
    order_by: Sequence[str],
    id_name: str,
    payload: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """One row per external key: the last one, as later rows overwrite earlier ones."""
    order = [column(df, name).alias(f"_o{i}") for i, name in enumerate(order_by)]
    slim = df.select(
        key_text([column(df, part) for part in key], strict).alias("_key"),
        column(df, id_column).alias(id_name),
        *order,
        *[column(df, name).alias(f"_t_{name}") for name in payload],
    ).where(F.col("_key").isNotNull() & F.col(id_name).isNotNull())
    if list(order_by) == [id_column] and not payload:
        return slim.groupBy("_key").agg(F.max(id_name).alias(id_name))
    last = last_per_key(slim, ["_key"], [f"_o{i}" for i in range(len(order_by))])
    return last.drop(*[f"_o{i}" for i in range(len(order_by))])


def match(
    source: DataFrame,
    target: DataFrame,
    source_id: str,
    target_id: str,
    source_key: Sequence[str | Column],
    target_key: Sequence[str | Column] | None = None,
    source_order: Sequence[str] | None = None,
    target_order: Sequence[str] | None = None,
    payload: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """The linked pairs as (source_id, target_id) and the asked target columns.

    Keys are text, case-sensitive, and an empty key never matches. Both sides are brought
    to one row per key before they meet, so the join has no pairs to multiply. One source
    row has at most one target row.
    """
    left = keyed(source, source_id, source_key, source_order or [source_id], SOURCE_ID, strict=strict)
    right = keyed(
        target,
        target_id,
        target_key or source_key,
        target_order or [target_id],
        TARGET_ID,
        payload,
        strict,
    )
    return left.join(right, "_key").drop("_key")


def reverse(xref: DataFrame) -> DataFrame:
    """Target id to source id."""
    return xref.select(F.col(TARGET_ID).alias(SOURCE_ID), F.col(SOURCE_ID).alias(TARGET_ID))


def target_subset(
    target: DataFrame, target_key: str, source: DataFrame, source_key: str
) -> DataFrame:
    """Target rows whose single-column key occurs in the source."""
    keys = source.select(column(source, source_key).alias("_in")).where("_in IS NOT NULL").distinct()
    return target.join(keys, column(target, target_key) == F.col("_in"), "left_semi")


def merge_by_id(first: DataFrame, second: DataFrame, id_column: str) -> DataFrame:
    """Rows of the first result, replaced where the second has the same id."""
    values = [c for c in first.columns if c != id_column]
    newer = second.select(
        F.col(id_column).alias("_id"), F.lit(True).alias("_hit"), *[F.col(quoted(c)).alias(f"_n_{c}") for c in values]
    )
    return first.join(newer, F.col(id_column) == F.col("_id"), "left").select(
        *[
            F.col(quoted(c))
            if c == id_column
            else F.when(F.col("_hit"), F.col(quoted(f"_n_{c}"))).otherwise(F.col(quoted(c))).alias(c)
            for c in first.columns
        ]
    )


def hierarchy_ids(xref: DataFrame) -> DataFrame:
    """Target ids of all linked source rows."""
    return xref.select(F.col(TARGET_ID).alias("Id")).where("Id IS NOT NULL")
