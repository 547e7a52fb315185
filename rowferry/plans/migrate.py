"""A whole run over related tables: select, prepare, match, plan, defer, apply."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.cells import truncate
from rowferry.functions.names import flat
from rowferry.operators import closure, filters, lookups, mapping, matching, mocking, project, ranking
from rowferry.plans import apply as apply_
from rowferry.plans import keygraph, upsert
from rowferry.session import settled
from rowferry.spec import MigrationSpec, TableSpec

Tables = Mapping[str, DataFrame]


#: Operations that write rows.
WRITES = ("Insert", "Update", "Upsert")


@dataclass
class TableRun:
    """What a run has worked out for one table. All frames are lazy."""

    spec: TableSpec
    plan: DataFrame
    links: DataFrame
    deferred: DataFrame | None = None
    missing: DataFrame | None = None
    deletes: DataFrame | None = None
    source_deletes: DataFrame | None = None


def _read_source(table: TableSpec, source: DataFrame) -> DataFrame:
    """Rows with an id that the source filter keeps, each id once."""
    rows = filters.with_id(filters.source_records_filter(source, table.source_filter), table.id)
    return rows if table.unique_id else ranking.first_per_key(rows, [table.id], table.order)


def select_sources(spec: MigrationSpec, sources: Tables) -> dict[str, DataFrame]:
    """Which source rows take part. Master tables and tables without lookups in full, the
    others as children (J5) and parents (J6) of what is selected, with self-references (J7)."""
    read = {t.name: _read_source(t, sources[t.name]) for t in spec.tables}
    chosen: dict[str, DataFrame] = {}
    for table in spec.tables:
        pivots = closure.allowed_lookups([(l.column, l.parent) for l in table.lookups])
        above = [
            (column, chosen[parent], spec.table(parent).id)
            for column, parent in pivots
            if parent in chosen
        ]
        if table.master or not above:
            chosen[table.name] = read[table.name]
        else:
            chosen[table.name] = closure.children_of(read[table.name], above)
    for table in reversed(spec.tables):
        own = [l.column for l in table.lookups if l.parent == table.name]
        for column in own if not table.master else ():
            chosen[table.name] = closure.with_self_references(
                read[table.name], table.id, column, chosen[table.name], spec.max_hops
            )
        if table.master:
            continue
        below = [
            (chosen[child.name], l.column)
            for child in spec.tables
            for l in child.lookups
            if l.parent == table.name and child.name != table.name
        ]
        if below:
            ids = chosen[table.name].select(F.col(table.id).alias("_keep"))
            ids = ids.unionByName(
                closure.referenced_ids(below).select(F.col("_pid").alias("_keep"))
            ).distinct()
            chosen[table.name] = read[table.name].join(ids, F.col(table.id) == F.col("_keep"), "left_semi")
    return chosen


def _hooked(df: DataFrame, hook, names: dict[str, str]) -> DataFrame:
    """H7: a hook sees source names; what it gives is renamed again."""
    if hook is None:
        return df
    if not names:
        return df.transform(hook)
    return project.rename(df.transform(lambda d: hook(project.rename_back(d, names))), names)


def prepare(table: TableSpec, source: DataFrame, columns: list[str], lengths: Mapping[str, int] | None = None) -> DataFrame:
    """Source rows as they will be written: filtered, mocked, cut, mapped, renamed."""
    rows = project.clone(source, include=[table.id, *columns])
    rows = filters.filter_hook(rows, table.record_filter)
    rows = filters.target_records_filter(rows, table.prepared_filter)
    rows = mocking.apply(rows, table.mock, table.id, table.order) if table.mock else rows
    for name, length in (lengths or {}).items():
        if name in rows.columns:
            rows = rows.withColumn(name, truncate(F.col(name), length))
    rows = mapping.map_values(rows, table.name, table.value_rules, columns) if table.value_rules else rows
    rows = project.rename(rows, table.rename) if table.rename else rows
    return _hooked(rows, table.before_update, table.rename)


def _types(target: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    return {c: target.schema[c].dataType for c in columns if c in target.columns}


def plan_run(
    spec: MigrationSpec,
    sources: Tables,
    targets: Tables,
    data_retrieved: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None,
    lengths: Mapping[str, Mapping[str, int]] | None = None,
    store: str | None = None,
) -> dict[str, TableRun]:
    """The plan of every table (M6: nothing is written but scratch tables, where keys go through parents).

    Forward, in table order: plain columns and lookups to earlier tables (M3). Ids of inserts
    come from the source ids, so later tables can point to rows that do not exist yet.
    Then lookups to later tables and to the table itself are planned as updates (M4).

    ``store`` names a folder on shared storage. Plans and id pairs are then written there as
    they are made and read back by what follows, so that each is worked out once: pairs that
    several tables remap through, and the forward plan that the deferred one builds on.
    """
    chosen = select_sources(spec, sources)
    if data_retrieved is not None:
        chosen = data_retrieved(chosen)  # H2
    through = keygraph.natural_keys(spec, chosen, targets)
    runs: dict[str, TableRun] = {}
    xrefs: dict[str, DataFrame] = {}
    for position, table in enumerate(spec.tables):
        source, target = chosen[table.name], targets[table.name]
        early = [l for l in table.lookups if spec.position(l.parent) < position]
        late = [l for l in table.lookups if spec.position(l.parent) >= position]
        plain = [c for c in table.columns if c not in table.lookup_columns and c not in table.excluded]
        columns = [*plain, *[l.column for l in early]]
        missing = None
        for lookup in early:
            report = lookups.missing_parents(
                source, xrefs[lookup.parent], table.id, lookup.column, table.name, lookup.parent,
                ";".join(spec.table(lookup.parent).key), lookup.reference,
            )
            missing = report if missing is None else missing.unionByName(report)
            source = lookups.remap(source, xrefs[lookup.parent], lookup.column)
        key = [table.rename.get(k, k) for k in table.key]
        compare = [table.rename.get(c, c) for c in columns]
        held = [table.rename.get(l.column, l.column) for l in late]
        # Old data goes before anything is matched, so a row that is deleted is never linked.
        there = _without(target, _old_data(table, target), table.target_id) if table.delete_old_data and table.operation in WRITES else target
        ours, theirs, own_key = chosen[table.name], filters.target_read(there, table.target_filter), table.key
        payload = [c for c in (*compare, *held) if c in target.columns]
        unlinked = table.operation == "Insert" and not table.skip_existing  # every row is inserted, whatever the target has
        # Keys through parents take joins of whole tables. The target's rows and the links are then written,
        # so that what one step has shuffled is off the disk before the next one starts.
        in_steps = table.name in through and table.operation in WRITES and not unlinked
        if table.name in through:
            ours, theirs = (keyed(rows) for keyed, rows in zip(through[table.name], (ours, theirs)))
            own_key = key = [keygraph.NATURAL]
        if in_steps:
            theirs = settled(theirs.select(*flat(dict.fromkeys([keygraph.NATURAL, table.target_id, *payload]))), "keyed")
        links = matching.match(
            ours,
            theirs,
            table.id, table.target_id, own_key, key,
            source_order=table.order, target_order=[table.target_id],
            payload=payload,
        )
        if unlinked:
            links = links.limit(0)
        if in_steps:
            links = settled(links, "links")
        if table.operation in WRITES:
            rows = prepare(table, source, columns, (lengths or {}).get(table.name))
            plan = upsert.classify(
                rows, links, table.target_id, _types(target, compare), table.operation,
                skip_existing=table.skip_existing, always_update=table.always_update,
                keep_target=[c for c in held if c in target.columns],
            )
            kind = target.schema[table.target_id].dataType
            if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
                # the target as it was: ids of rows that are deleted in this run are not given again
                dense = upsert.dense_pairs(chosen[table.name], links, table.id, target, table.target_id)
                dense = _stored(dense, store, f"{table.name}/ids")
                plan = upsert.with_ids_of(plan, dense, table.target_id)
            else:
                dense, plan = None, upsert.with_new_ids(plan, table.name, table.target_id, kind)
            plan = _stored(plan, store, f"{table.name}/plan")
            xrefs[table.name] = _pairs(table, chosen[table.name], plan, links, target, dense)
        else:
            plan = None
            xrefs[table.name] = links.select(matching.SOURCE_ID, matching.TARGET_ID)  # M11
        if any(l.parent == table.name for other in spec.tables for l in other.lookups):
            xrefs[table.name] = _stored(xrefs[table.name], store, f"{table.name}/pairs")
        runs[table.name] = TableRun(table, plan, links, missing=missing)
        _plan_deletes(runs[table.name], chosen[table.name], target)
    for table in spec.tables:
        run = runs[table.name]
        _plan_deferred(spec, table, run, chosen[table.name], targets[table.name], xrefs)
        if run.deferred is not None:
            run.deferred = _stored(run.deferred, store, f"{table.name}/deferred")
    for table in spec.tables:
        if table.after_update is not None and runs[table.name].plan is not None:
            table.after_update(runs[table.name].plan)  # H4
    return runs


def _stored(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    if folder is None:
        return df
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def _pairs(table: TableSpec, source: DataFrame, plan: DataFrame, links: DataFrame, target: DataFrame, dense: DataFrame | None) -> DataFrame:
    """Source and target ids of the rows that children may point to."""
    known = links.select(matching.SOURCE_ID, matching.TARGET_ID)
    if table.operation == "Update":
        return known
    if table.prepared_filter or table.record_filter or table.before_update:
        # Not every row is written. Rows that are left out still serve where they are linked.
        return upsert.pairs_after(plan, table.target_id).unionByName(known).dropDuplicates([matching.SOURCE_ID])
    if dense is not None:
        return dense
    return upsert.pairs_of_all(source, links, table.name, table.id, target.schema[table.target_id].dataType)


def _without(target: DataFrame, deletes: DataFrame, id_column: str) -> DataFrame:
    """The target's rows that a delete plan leaves."""
    gone = deletes.select(F.col(matching.TARGET_ID).alias("_gone")).distinct()
    return target.join(gone, F.col(id_column) == F.col("_gone"), "left_anti")


def _is_hard(table: TableSpec) -> bool:
    return table.hard_delete or table.operation == "HardDelete"


def _old_data(table: TableSpec, target: DataFrame) -> DataFrame:
    return upsert.old_data_plan(target, table.target_id, table.delete_filter or table.target_filter, _is_hard(table))


def _plan_deletes(run: TableRun, source: DataFrame, target: DataFrame) -> None:
    table, hard = run.spec, _is_hard(run.spec)
    if table.operation == "DeleteHierarchy":
        run.deletes = upsert.hierarchy_delete_plan(run.links, hard)
    elif table.operation in ("Delete", "HardDelete") or table.delete_old_data:
        run.deletes = _old_data(table, target)
    elif table.operation == "DeleteSource":
        run.source_deletes = upsert.delete_plan(source, table.id, hard)


def _plan_deferred(spec, table: TableSpec, run: TableRun, source: DataFrame, target: DataFrame, xrefs) -> None:
    late = [l for l in table.lookups if spec.position(l.parent) >= spec.position(table.name)]
    named = {l.column: table.rename.get(l.column, l.column) for l in late}
    late = [l for l in late if named[l.column] in target.columns]
    if not late or run.plan is None:
        return
    rows = source.select(table.id, *[l.column for l in late])
    for lookup in late:
        rows = lookups.remap(rows, xrefs[lookup.parent], lookup.column)
    rows = rows.withColumnsRenamed({l.column: named[l.column] for l in late})
    # A row that is inserted in this run has no lookup value yet; a linked one has its old value.
    now = run.plan.where(F.col(matching.TARGET_ID).isNotNull()).select(
        F.col(table.target_id).alias(matching.SOURCE_ID),
        matching.TARGET_ID,
        *[F.col(f"_t_{named[l.column]}") for l in late],
    )
    run.deferred = upsert.classify(
        rows, now, table.id, _types(target, [named[l.column] for l in late]), table.operation, backward=True
    )


def apply_run(runs: Mapping[str, TableRun], targets: Tables, deleted_flags: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """M13 for all tables: deletes first, then inserts and updates, then deferred lookups; one join a table."""
    out = {}
    for name, run in runs.items():
        target, table, phases = targets[name], run.spec, []
        if run.deletes is not None:
            phases.append(apply_.Phase(run.deletes, []))
        if run.plan is not None:
            columns = [c for c in run.plan.columns if c in target.columns]
            phases.append(apply_.Phase(run.plan, columns, table.not_insertable, table.not_updateable))
        if run.deferred is not None:
            columns = [c for c in (table.rename.get(n, n) for n in table.lookup_columns) if c in run.deferred.columns]
            phases.append(apply_.Phase(run.deferred, columns, not_updateable=table.not_updateable))
        flag = (deleted_flags or {}).get(name)
        out[name] = apply_.apply_phases(target, phases, table.target_id, flag) if phases else target
    return out


def summary(runs: Mapping[str, TableRun]) -> DataFrame:
    """A3 input: (object, pass, action, skip_reason) of everything that was planned."""
    parts = []
    for name, run in runs.items():
        for pass_, plan in (("forward", run.plan), ("backward", run.deferred), ("delete", run.deletes)):
            if plan is None:
                continue
            reason = F.col("skip_reason") if "skip_reason" in plan.columns else F.lit(None).cast("string")
            parts.append(
                plan.select(F.lit(name).alias("object"), F.lit(pass_).alias("pass"), "action", reason.alias("skip_reason"))
            )
    return functools.reduce(DataFrame.unionByName, parts)
