"""Write plans: what is inserted, updated, skipped and deleted, and why."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.cells import differs, strip
from rowferry.functions.keys import row_id
from rowferry.functions.names import every, flat, quoted
from rowferry.operators.matching import SOURCE_ID, TARGET_ID
from rowferry.operators.ranking import rank_rows

INSERT, UPDATE, SKIP = "insert", "update", "skip"
DELETE, HARD_DELETE = "delete", "hard_delete"


def row_differs(columns: Mapping[str, T.DataType]) -> Column:
    """M2: true when a prepared value differs from the target's, compared as target type."""
    checks = [differs(F.col(quoted(name)), F.col(quoted(f"_t_{name}")), kind) for name, kind in columns.items()]
    return functools.reduce(operator.or_, checks, F.lit(False))


def classify(
    prepared: DataFrame,
    links: DataFrame,
    source_id: str,
    compare: Mapping[str, T.DataType],
    operation: str,
    backward: bool = False,
    skip_existing: bool = False,
    always_update: bool = False,
    keep_target: Sequence[str] = (),
) -> DataFrame:
    """M1: adds ``target_id``, ``action`` and ``skip_reason`` to every prepared row.

    ``links`` has one row per linked source row (``matching.match`` with the compared columns
    as payload). A source row whose key a later row repeats is not linked, so it counts as new.
    The backward pass (M4) updates linked rows and nothing else.
    """
    joined = prepared.join(links, F.col(quoted(source_id)) == F.col(SOURCE_ID), "left")
    linked = F.col(TARGET_ID).isNotNull()
    can_insert = operation in ("Insert", "Upsert") and not backward
    can_update = operation in ("Update", "Upsert") or backward
    different = F.lit(True) if always_update else row_differs(compare)

    reason = F.when(linked & F.lit(skip_existing), "existing")
    if can_insert:
        reason = reason.when(~linked, F.lit(None).cast("string"))
    else:
        reason = reason.when(~linked, "no_match")
    if can_update:
        reason = reason.when(linked & ~different, "same_data")
    else:
        reason = reason.when(linked, "other")
    staged = joined.withColumn("skip_reason", reason)
    action = F.when(F.col("skip_reason").isNotNull(), SKIP).when(~linked, INSERT).otherwise(UPDATE)
    return staged.withColumn("action", action).select(
        *every(prepared),
        TARGET_ID,
        *flat(f"_t_{c}" for c in keep_target),
        "action",
        "skip_reason",
    )


def new_id(table: str, source_id: str, id_type: T.DataType | None = None) -> Column:
    """The id an inserted row will have in the target, from table and source id.

    A target with numeric ids gets the number that the first 15 hex digits stand for.
    """
    made = row_id(table, F.col(quoted(source_id)).cast("string"))
    if isinstance(id_type, T.IntegralType):
        return F.conv(F.substring(made, 1, 15), 16, 10).cast("long")
    return made


def with_new_ids(plan: DataFrame, table: str, source_id: str, id_type: T.DataType | None = None) -> DataFrame:
    """M5, M6: inserts get their ids. A dry run and a real run give the same ones."""
    made = new_id(table, source_id, id_type)
    return plan.withColumn(TARGET_ID, F.when(F.col("action") == INSERT, made).otherwise(F.col(TARGET_ID)))


def dense_pairs(source: DataFrame, links: DataFrame, source_id: str, target: DataFrame, target_id: str) -> DataFrame:
    """M5 for ids of 32 bits or less, where hashes would not fit: new rows continue after the largest id
    of the target, in the order of their source ids. Linked rows keep their pairs."""
    ids = source.select(F.col(quoted(source_id)).alias("_sid"))
    joined = ids.join(links.select(SOURCE_ID, TARGET_ID), F.col("_sid") == F.col(SOURCE_ID), "left")
    new = rank_rows(joined.where(F.col(TARGET_ID).isNull()).select("_sid"), [], ["_sid"], "_n")
    largest = target.agg(F.coalesce(F.max(quoted(target_id)).cast("bigint"), F.lit(0))).scalar()
    kind = target.schema[target_id].dataType
    made = new.select(F.col("_sid").alias(SOURCE_ID), (largest + F.col("_n")).cast(kind).alias(TARGET_ID))
    return joined.where(F.col(TARGET_ID).isNotNull()).select(F.col("_sid").alias(SOURCE_ID), TARGET_ID).unionByName(made)


def with_ids_of(plan: DataFrame, pairs: DataFrame, source_id: str) -> DataFrame:
    """M5: inserts get their ids from pairs that are known already."""
    theirs = pairs.select(F.col(SOURCE_ID).alias("_sid"), F.col(TARGET_ID).alias("_new_id"))
    joined = plan.join(theirs, F.col(quoted(source_id)) == F.col("_sid"), "left")
    return joined.withColumn(TARGET_ID, F.when(F.col("action") == INSERT, F.col("_new_id")).otherwise(F.col(TARGET_ID))).select(*every(plan))


def pairs_after(plan: DataFrame, source_id: str) -> DataFrame:
    """M5: (source_id, target_id) of rows that were linked and of those just inserted."""
    return plan.where(F.col(TARGET_ID).isNotNull()).select(F.col(quoted(source_id)).alias(SOURCE_ID), TARGET_ID)


def pairs_of_all(
    source: DataFrame, links: DataFrame, table: str, source_id: str, id_type: T.DataType | None = None
) -> DataFrame:
    """M5 where every source row is written: the same pairs, from ids alone.

    Children remap their lookups through these. They need no column of the parent's plan, so
    the plans of a deep hierarchy do not nest.
    """
    ids = source.select(F.col(quoted(source_id)).alias("_sid"))
    known = links.select(SOURCE_ID, TARGET_ID)
    joined = ids.join(known, F.col("_sid") == F.col(SOURCE_ID), "left")
    made = new_id(table, "_sid", id_type)
    return joined.select(F.col("_sid").alias(SOURCE_ID), F.coalesce(TARGET_ID, made).alias(TARGET_ID))


def delete_plan(rows: DataFrame, id_column: str, hard: bool = False) -> DataFrame:
    """One row per id to delete; blank ids are left out."""
    filled = rows.where(F.length(strip(F.col(id_column).cast("string"))) > 0)
    return filled.select(F.col(id_column).alias(TARGET_ID), F.lit(HARD_DELETE if hard else DELETE).alias("action"))


def old_data_plan(target: DataFrame, id_column: str, condition: str | None, hard: bool = False) -> DataFrame:
    """M7: everything the delete filter selects, before the run writes anything."""
    return delete_plan(target if condition is None else target.where(condition), id_column, hard)


def hierarchy_delete_plan(links: DataFrame, hard: bool = False) -> DataFrame:
    """M9: the target rows of all linked source rows."""
    return delete_plan(links, TARGET_ID, hard)


def ordered_deletes(plan: DataFrame, rows: DataFrame, id_column: str, order_by: Sequence[str]) -> DataFrame:
    """O3: the delete plan with ``seq``, the place of each row in the order of the query."""
    wanted = rows.select(F.col(id_column).alias("_id"), *order_by)
    return rank_rows(plan.join(wanted, F.col(TARGET_ID) == F.col("_id")), [], order_by, "seq").select(
        TARGET_ID, "action", "seq"
    )
