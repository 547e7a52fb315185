"""Foreign keys: remap, repair, missing parents.

The parent side of every join here has one row per key. The child side may be as skewed as
it likes: nothing multiplies, and adaptive execution splits the hot partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import key_text, row_id
from rowferry.functions.names import column as column_of
from rowferry.functions.names import every, quoted
from rowferry.operators.matching import SOURCE_ID, TARGET_ID
from rowferry.operators.ranking import first_per_key, last_per_key

# The columns and texts of an issue row.
ISSUE_COLUMNS = (
    "Date update",
    "sObject name",
    "Field name",
    "Field value",
    "Parent SObject name",
    "Parent field name",
    "Parent field value",
    "Error",
)
MISSING_TABLE = "MISSING CSV FILE"
MISSING_COLUMN = "MISSING COLUMN IN THE CSV FILE"
MISSING_PARENT = "MISSING PARENT LOOKUP RECORD"
LOOKUP_CONFLICT = "LOOKUP ID/REFERENCE CONFLICT"


def issue_rows(df: DataFrame, error: str, **values: Column) -> DataFrame:
    """Issue rows with the eight fixed columns. The date is left to the sink."""
    named = {
        "sObject name": values.get("table"),
        "Field name": values.get("field"),
        "Field value": values.get("value"),
        "Parent SObject name": values.get("parent"),
        "Parent field name": values.get("parent_field"),
        "Parent field value": values.get("parent_value"),
        "Error": F.lit(error),
    }
    missing = F.lit(None)
    return df.select(
        missing.cast("string").alias("Date update"),
        *[(missing if v is None else v).cast("string").alias(n) for n, v in named.items()],
    )


def remap(
    child: DataFrame, xref: DataFrame, column: str, name: str | None = None, missing: str | None = None
) -> DataFrame:
    """The lookup holds a source parent id; it becomes the id of the linked target parent.

    Unresolved ids become null. ``missing`` names a flag column that marks them (J8).
    """
    pairs = xref.select(F.col(SOURCE_ID).alias("_pid"), F.col(TARGET_ID).alias("_tid"))
    joined = child.join(pairs, F.col(quoted(column)) == F.col("_pid"), "left")
    if missing:
        flag = F.col(quoted(column)).isNotNull() & F.col("_tid").isNull()
        joined = joined.withColumn(missing, flag)
    return joined.withColumn(name or column, F.col("_tid")).drop("_pid", "_tid")


def missing_parents(
    child: DataFrame,
    xref: DataFrame,
    id_column: str,
    column: str,
    table: str,
    parent: str,
    parent_key: str,
    reference: str | None = None,
) -> DataFrame:
    """One row per lookup value that has no linked target parent."""
    pairs = xref.select(F.col(SOURCE_ID).alias("_pid"))
    blank = F.length(F.col(quoted(column)).cast("string")) > 0
    orphans = child.where(blank).join(pairs, F.col(quoted(column)) == F.col("_pid"), "left_anti")
    value = F.col(quoted(column)).cast("string")
    if reference and reference in child.columns:
        value = F.coalesce(F.nullif(F.col(quoted(reference)).cast("string"), F.lit("")), value)
    return orphans.select(
        F.col(quoted(id_column)).cast("string").alias("Record Id"),
        F.lit(column).alias("Lookup field name"),
        F.lit(reference).cast("string").alias("Lookup reference field name"),
        F.lit(table).alias("sObject name"),
        F.lit(parent).alias("Parent SObject name"),
        F.lit(parent_key).alias("Parent ExternalId field name"),
        value.alias("Missing parent External Id value"),
    )


def polymorphic(
    child: DataFrame,
    column: str,
    users: DataFrame | None,
    groups: DataFrame | None,
    name: str,
) -> DataFrame:
    """A lookup into two tables. Users win, groups fill the gaps."""
    out, found = child, []
    for prefix, xref in (("_u", users), ("_g", groups)):
        if xref is None:
            continue
        pairs = xref.select(F.col(SOURCE_ID).alias(f"{prefix}s"), F.col(TARGET_ID).alias(f"{prefix}t"))
        out = out.join(pairs, F.col(quoted(column)) == F.col(f"{prefix}s"), "left")
        found.append(F.col(f"{prefix}t"))
    return out.withColumn(name, F.coalesce(*found)).select(*every(child), name)


def value_to_id(child: DataFrame, column: str, reference: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """External value of a parent to its id as the children have it; the last value wins."""
    order = [column_of(child, o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    slim = child.select(
        key_text([column_of(child, r) for r in reference]).alias("lookup_value"),
        F.col(quoted(column)).alias("lookup_id"),
        *order,
    ).where("lookup_value IS NOT NULL AND lookup_id IS NOT NULL")
    names = [f"_o{i}" for i in range(len(order_by))]
    return last_per_key(slim, ["lookup_value"], names).select("lookup_value", "lookup_id")


def relink(child: DataFrame, column: str, reference: str, parents: DataFrame) -> DataFrame:
    """After a value map changed the reference, the id is looked up again.

    ``parents`` is (lookup_value, lookup_id). Without a hit the old id stays.
    """
    renamed = parents.select(F.col("lookup_value").alias("_v"), F.col("lookup_id").alias("_i"))
    return (
        child.join(renamed, F.col(quoted(reference)) == F.col("_v"), "left")
        .withColumn(column, F.coalesce("_i", F.col(quoted(column))))
        .select(*every(child))
    )


def parent_columns(
    child: DataFrame, parent: DataFrame, column: str, parent_id: str, relation: str, fields: Sequence[str]
) -> DataFrame:
    """``relation.field`` columns from the parent; columns that are there already stay."""
    needed = [f for f in fields if f"{relation}.{f}" not in child.columns]
    if not needed:
        return child
    slim = parent.select(
        column_of(parent, parent_id).alias("_pid"), *[column_of(parent, f).alias(f"_p{i}") for i, f in enumerate(needed)]
    )
    joined = child.join(slim, F.col(quoted(column)) == F.col("_pid"), "left")
    added = [F.col(f"_p{i}").alias(f"{relation}.{f}") for i, f in enumerate(needed)]
    return joined.select(*every(child), *added)


@dataclass(frozen=True)
class ParentKeys:
    """A parent table as two lookups: by id (first row) and by external key (last row)."""

    by_id: DataFrame
    by_key: DataFrame


def parent_keys(parent: DataFrame, id_column: str, key: Sequence[str], order_by: Sequence[str]) -> ParentKeys:
    order = [column_of(parent, o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    names = [f"_o{i}" for i in range(len(order_by))]
    slim = parent.select(
        column_of(parent, id_column).alias("_id"), key_text([column_of(parent, k) for k in key]).alias("_ref"), *order
    )
    by_id = first_per_key(slim.where("_id IS NOT NULL"), ["_id"], names)
    by_key = last_per_key(slim.where("_ref IS NOT NULL"), ["_ref"], names)
    return ParentKeys(
        by_id.select(F.col("_id").alias("_pid"), F.col("_ref").alias("_pref")),
        by_key.select(F.col("_ref").alias("_kref"), F.col("_id").alias("_kid")),
    )


def check_conflicts(child: DataFrame, column: str, reference: str, parents: ParentKeys) -> DataFrame:
    """Both id and reference are there. Adds the repaired values and ``_state``.

    The id is trusted where it is known; else a known reference gives the id; else it is a
    conflict. Rows with a blank id or reference are left alone.
    """
    known_ids = parents.by_id.withColumn("_id_hit", F.lit(True))
    joined = child.join(known_ids, F.col(quoted(column)) == F.col("_pid"), "left").join(
        parents.by_key, F.col(quoted(reference)) == F.col("_kref"), "left"
    )
    id_text, ref_text = F.col(quoted(column)).cast("string"), F.col(quoted(reference)).cast("string")
    both = (F.length(id_text) > 0) & (F.length(ref_text) > 0)
    by_id = F.coalesce(F.col("_id_hit"), F.lit(False))
    new_ref = by_id & F.col("_pref").isNotNull() & (F.col("_pref") != ref_text)
    new_id = ~by_id & F.col("_kid").isNotNull() & (F.col("_kid").cast("string") != id_text)
    state = (
        F.when(~F.coalesce(both, F.lit(False)), "blank")
        .when(new_ref, "reference_fixed")
        .when(by_id, "ok")
        .when(new_id, "id_fixed")
        .when(F.col("_kref").isNotNull(), "ok")
        .otherwise("conflict")
    )
    return joined.withColumn("_state", state)


def repair_conflicts(
    child: DataFrame, column: str, reference: str, parents: ParentKeys, state: str | None = None
) -> DataFrame:
    """The children with id or reference put right. ``state`` names a result column."""
    checked = check_conflicts(child, column, reference, parents)
    values = {
        column: F.when(F.col("_state") == "id_fixed", F.col("_kid")).otherwise(F.col(quoted(column))),
        reference: F.when(F.col("_state") == "reference_fixed", F.col("_pref")).otherwise(
            F.col(quoted(reference))
        ),
    }
    chosen = [values[c].alias(c) if c in values else F.col(quoted(c)) for c in child.columns]
    return checked.select(*chosen, *([F.col("_state").alias(state)] if state else []))


def conflict_issues(
    child: DataFrame, table: str, column: str, reference: str, parent_key: str, parents: ParentKeys
) -> DataFrame:
    """Q9: id and reference disagree and neither is known."""
    bad = check_conflicts(child, column, reference, parents).where("_state = 'conflict'")
    return issue_rows(
        bad,
        LOOKUP_CONFLICT,
        table=F.lit(table),
        field=F.lit(column),
        value=F.col(quoted(column)),
        parent_field=F.lit(parent_key),
        parent_value=F.col(quoted(reference)),
    )


def new_parents_from_references(
    child: DataFrame, reference: str, parents: ParentKeys, parent: str, id_name: str, key_name: str
) -> DataFrame:
    """One new parent row per distinct reference that no parent has."""
    wanted = child.select(F.col(quoted(reference)).cast("string").alias("_want"))
    wanted = wanted.where("_want IS NOT NULL AND _want <> ''").distinct()
    missing = wanted.join(parents.by_key, F.col("_want") == F.col("_kref"), "left_anti")
    return missing.select(
        row_id(parent, "_want").alias(id_name), F.col("_want").alias(key_name)
    )


def fill_lookup_id(
    child: DataFrame,
    column: str,
    reference: str,
    parents: ParentKeys,
    parent: str,
    generate: bool = False,
    self_lookup: bool = False,
) -> DataFrame:
    """The id column is absent and comes from the reference.

    Ids are filled in ids-excluded mode only (``generate``): the id of the parent with that
    reference, else the id of the parent that J19 makes for it. A self-lookup is never made
    up. Otherwise the column is added empty.
    """
    if not generate:
        return child.withColumn(column, F.lit(None).cast("string"))
    if reference not in child.columns:
        made = row_id(f"{parent}|{column}", *every(child))
        return child.withColumn(column, made).withColumn(reference, made)
    text = F.col(quoted(reference)).cast("string")
    made = F.lit(None).cast("string") if self_lookup else row_id(parent, F.col(quoted(reference)))
    joined = child.join(parents.by_key, text == F.col("_kref"), "left")
    value = F.when(F.length(text) > 0, F.coalesce(F.col("_kid").cast("string"), made))
    return joined.withColumn(column, value).drop("_kref", "_kid")


def fill_reference(
    child: DataFrame,
    column: str,
    reference: str,
    parents: ParentKeys,
    parent: str,
    generate: bool = False,
    self_lookup: bool = False,
) -> DataFrame:
    """The reference column is absent and comes from the parent with that id."""
    joined = child.join(parents.by_id, F.col(quoted(column)) == F.col("_pid"), "left")
    value = F.col("_pref")
    if generate and not self_lookup:
        value = F.when(F.col("_pid").isNull(), row_id(parent, "id", F.col(quoted(column)))).otherwise(value)
    value = F.when(F.length(F.col(quoted(column)).cast("string")) > 0, value)
    return joined.withColumn(reference, value).drop("_pid", "_pref")


def new_parents_from_ids(
    child: DataFrame, column: str, parents: ParentKeys, parent: str, id_name: str, key_name: str
) -> DataFrame:
    """J19 for J18: one new parent row per distinct id that no parent has."""
    wanted = child.select(F.col(quoted(column)).alias("_want")).distinct()
    wanted = wanted.where(F.length(F.col("_want").cast("string")) > 0)
    missing = wanted.join(parents.by_id, F.col("_want") == F.col("_pid"), "left_anti")
    return missing.select(F.col("_want").alias(id_name), row_id(parent, F.lit("id"), "_want").alias(key_name))


def orphan_issues(
    child: DataFrame, table: str, column: str, parent: str, parent_ids: DataFrame, parent_id: str, error: str = MISSING_PARENT
) -> DataFrame:
    """Q8: lookup values without a parent row."""
    ids = parent_ids.select(F.col(quoted(parent_id)).alias("_pid"))
    filled = child.where(F.length(F.col(quoted(column)).cast("string")) > 0)
    orphans = filled.join(ids, F.col(quoted(column)) == F.col("_pid"), "left_anti")
    return issue_rows(
        orphans,
        error,
        table=F.lit(table),
        field=F.lit(column),
        value=F.col(quoted(column)),
        parent=F.lit(parent),
        parent_field=F.lit(parent_id),
    )


def propagate_parent_ids(
    child: DataFrame, column: str, relation_id: str, reference: str, parents: ParentKeys
) -> DataFrame:
    """Parents got new ids; the children find theirs again through the external key."""
    joined = child.join(parents.by_key, F.col(quoted(reference)) == F.col("_kref"), "left")
    text = F.col("_kid").cast("string")
    old = {
        c: F.col(quoted(c)).cast("string") if c in child.columns else F.lit(None).cast("string")
        for c in (column, relation_id)
    }
    out = joined.withColumn(column, F.coalesce(text, old[column]))
    return out.withColumn(relation_id, F.coalesce(text, old[relation_id])).drop("_kref", "_kid")


def person_contacts(
    source_contacts: DataFrame,
    target_contacts: DataFrame,
    inserted_accounts: DataFrame,
    linked: DataFrame,
    contact_id: str,
    account_column: str,
    order_by: Sequence[str],
) -> DataFrame:
    """Contacts that came to be with inserted person accounts, linked by account.

    Gives (source_id, target_id). Contacts that are linked already stay out; per account the
    last source contact and the first target contact count.
    """
    pairs = inserted_accounts.select(F.col(SOURCE_ID).alias("_sa"), F.col(TARGET_ID).alias("_ta"))
    free = source_contacts.join(
        linked.select(F.col(SOURCE_ID).alias("_done")), F.col(contact_id) == F.col("_done"), "left_anti"
    )
    order = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    names = [f"_o{i}" for i in range(len(order_by))]
    last = last_per_key(
        free.select(F.col(account_column).alias("_acc"), F.col(contact_id).alias(SOURCE_ID), *order)
        .where("_acc IS NOT NULL"),
        ["_acc"],
        names,
    ).drop(*names)
    mapped = last.join(pairs, F.col("_acc") == F.col("_sa")).select(SOURCE_ID, "_ta")
    first = first_per_key(
        target_contacts.select(F.col(account_column).alias("_tacc"), F.col(contact_id).alias(TARGET_ID), *order)
        .where("_tacc IS NOT NULL"),
        ["_tacc"],
        names,
    ).drop(*names)
    return mapped.join(first, F.col("_ta") == F.col("_tacc")).select(SOURCE_ID, TARGET_ID)
