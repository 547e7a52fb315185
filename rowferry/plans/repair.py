"""Repair of a set of damaged tables (Q4)."""

from __future__ import annotations

import functools
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators import lookups, project, quality
from rowferry.spec import MigrationSpec


@dataclass
class Repaired:
    """The repaired tables and the issues found on the way."""

    tables: dict[str, DataFrame]
    issues: DataFrame


def repair(
    spec: MigrationSpec,
    tables: Mapping[str, DataFrame],
    ids_excluded: bool = False,
    legacy: Mapping[str, tuple[str, tuple[str, ...], str]] | None = None,
) -> Repaired:
    """Names, ids, legacy keys, lookups, unknown columns, final ids; parents before children.

    ``legacy`` maps a table to (relation, parts, key column) for keys still in several columns.
    """
    work: dict[str, DataFrame] = {}
    for table in spec.tables:
        canonical = [table.id, *table.key, *table.columns, *table.lookup_columns]
        canonical += [l.reference for l in table.lookups if l.reference]
        named = project.repair_names(tables[table.name], canonical)
        work[table.name] = quality.add_ids(named, table.name, table.id, table.order_by)
    issues: list[DataFrame] = []
    for table in spec.tables:
        df = work[table.name]
        if legacy and table.name in legacy:
            df = quality.combine_legacy_key(df, *legacy[table.name])
        for lookup in table.lookups:
            if lookup.parent not in work or not lookup.reference:
                continue
            df = _repair_lookup(spec, table, lookup, df, work, issues, ids_excluded)
        work[table.name] = df
    for table in spec.tables:
        allowed = {
            n.lower()
            for n in (table.id, *table.key, *table.columns, *table.lookup_columns, *table.order_by)
        }
        allowed |= {l.reference.lower() for l in table.lookups if l.reference}
        keep = [c for c in work[table.name].columns if c.lower() in allowed]
        slim = project.clone(work[table.name], include=keep)
        order = [o for o in table.order if o in slim.columns]
        work[table.name] = quality.repair_ids(slim, table.name, table.id, order)
    spark = next(iter(tables.values())).sparkSession
    nothing = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in lookups.ISSUE_COLUMNS))
    return Repaired(work, functools.reduce(DataFrame.unionByName, issues, nothing))


def _repair_lookup(spec, table, lookup, df, work, issues, ids_excluded) -> DataFrame:
    parent = spec.table(lookup.parent)
    own = parent.name == table.name
    parent_df = df if own else work[parent.name]
    keys = lookups.parent_keys(parent_df, parent.id, parent.key, parent.order)
    has_id, has_ref = lookup.column in df.columns, lookup.reference in df.columns
    key_name = ";".join(parent.key)
    if has_id and has_ref:
        issues.append(lookups.conflict_issues(df, table.name, lookup.column, lookup.reference, key_name, keys))
        return lookups.repair_conflicts(df, lookup.column, lookup.reference, keys)
    if not has_id:
        if has_ref and ids_excluded and not own:
            made = lookups.new_parents_from_references(df, lookup.reference, keys, parent.name, parent.id, parent.key[0])
            work[parent.name] = _append_parents(work[parent.name], made)
        return lookups.fill_lookup_id(df, lookup.column, lookup.reference, keys, parent.name, ids_excluded, own)
    if not ids_excluded:
        issues.append(
            lookups.orphan_issues(df, table.name, lookup.column, parent.name, parent_df, parent.id)
        )
    elif not own:
        made = lookups.new_parents_from_ids(df, lookup.column, keys, parent.name, parent.id, parent.key[0])
        work[parent.name] = _append_parents(work[parent.name], made)
    return lookups.fill_reference(df, lookup.column, lookup.reference, keys, parent.name, ids_excluded, own)


def _append_parents(parents: DataFrame, made: DataFrame) -> DataFrame:
    """The new rows carry id and key only; both sides agree on text where types differ."""
    for name in made.columns:
        if parents.schema[name].dataType != made.schema[name].dataType:
            parents = parents.withColumn(name, F.col(name).cast("string"))
            made = made.withColumn(name, F.col(name).cast("string"))
    return parents.unionByName(made, allowMissingColumns=True)
