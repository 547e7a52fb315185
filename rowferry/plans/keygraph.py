"""Natural keys that reach through parents (J2, J3, K9 inside a run).

A part of a table's key is a column, a lookup column (it stands for the whole key of the parent row,
since ids differ between the sides), or a path ``lookup.part`` that goes on in the parent. Keys thus
form a graph over the tables. Tables whose keys do not depend on themselves are resolved by joins,
parents first, each once. Tables whose keys form a ring are resolved together, both sides at once:
every row starts with its plain parts and takes in its parents' keys round by round, until no round
tells rows apart that were equal before.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import SEPARATOR, key_text
from rowferry.functions.names import quoted
from rowferry.session import cut_lineage
from rowferry.spec import LookupSpec, MigrationSpec, TableSpec

#: The key column that the functions of ``natural_keys`` add.
NATURAL = "_natural"
Keyed = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Part:
    """One part of a key: the lookups to follow, and the column at the end (none: the whole key)."""

    hops: tuple[LookupSpec, ...]
    column: str | None

    @property
    def end(self) -> str | None:
        """The table whose whole key the part stands for."""
        return self.hops[-1].parent if self.hops and self.column is None else None


def part_of(spec: MigrationSpec, table: TableSpec, text: str) -> Part:
    """Reads a key part of ``table``. A name that is no lookup path is a column."""
    hops: list[LookupSpec] = []
    while True:
        head, dot, rest = text.partition(".")
        lookup = next((l for l in table.lookups if l.column == head), None)
        if lookup is None:
            return Part(tuple(hops), text)
        hops.append(lookup)
        if not dot:
            return Part(tuple(hops), None)
        table, text = spec.table(lookup.parent), rest


def reaches_parents(spec: MigrationSpec, table: TableSpec) -> bool:
    return any(part_of(spec, table, k).hops for k in table.key)


def _needs(spec: MigrationSpec, table: TableSpec) -> set[str]:
    """Tables whose whole keys the key of ``table`` contains."""
    return {spec.table(end).name for k in table.key if (end := part_of(spec, table, k).end)}


def _below(spec: MigrationSpec, name: str) -> set[str]:
    found, todo = set(), [name]
    while todo:
        new = _needs(spec, spec.table(todo.pop())) - found
        found |= new
        todo += new
    return found


@dataclass
class _Side:
    """The tables of one side, under the names that columns have there."""

    spec: MigrationSpec
    tables: Mapping[str, DataFrame]
    renamed: bool
    keys: dict[str, DataFrame]

    def name(self, table: TableSpec, column: str) -> str:
        return table.rename.get(column, column) if self.renamed else column

    def id(self, table: TableSpec) -> Column:
        return F.col(quoted(self.name(table, table.id)))

    def parts(self, table: TableSpec, rows: DataFrame, ring: set[str]) -> DataFrame:
        """``rows`` of the table with a column ``_p<i>`` per key part as text, and for parts that stand for
        the key of a table in ``ring`` the parent's id in ``_r<i>`` instead.

        All lookups that go through one column follow each other, so that the rows move once for them.
        """
        parts = [part_of(self.spec, table, k) for k in table.key]
        first = lambda p: p.hops[0].column if p.hops else p.column
        rows = rows.withColumns({f"_p{i}": F.col(quoted(self.name(table, first(p)))) for i, p in enumerate(parts)})
        for i in sorted(range(len(parts)), key=lambda i: first(parts[i])):
            part = parts[i]
            for hop, follows in zip(part.hops, [*part.hops[1:], None]):
                parent = self.spec.table(hop.parent)
                if follows is not None or part.column is not None:
                    column = follows.column if follows is not None else part.column
                    step = self.tables[parent.name].select(self.id(parent).alias("_pid"), F.col(quoted(self.name(parent, column))).alias("_value"))
                elif parent.name in ring:
                    rows = rows.withColumn(f"_r{i}", F.col(f"_p{i}").cast("string")).withColumn(f"_p{i}", F.lit(None).cast("string"))
                    continue
                else:
                    step = self.of(parent).select(F.col("_kid").alias("_pid"), F.col(NATURAL).alias("_value"))
                rows = rows.join(step, _same_id(rows, f"_p{i}", step, "_pid"), "left").drop("_pid", f"_p{i}").withColumnRenamed("_value", f"_p{i}")
        return rows.withColumns({f"_p{i}": F.col(f"_p{i}").cast("string") for i in range(len(parts))})

    def keyed(self, table: TableSpec, rows: DataFrame) -> DataFrame:
        """``rows`` of a table, all or some, with their natural key."""
        if table.name in self.keys:  # a ring's table
            theirs = self.keys[table.name].withColumnRenamed("_kid", "_key_id")
            return rows.join(theirs, self.id(table).cast("string") == F.col("_key_id"), "left").drop("_key_id")
        names = [f"_p{i}" for i in range(len(table.key))]
        return self.parts(table, rows, set()).withColumn(NATURAL, key_text(names)).drop(*names)

    def of(self, table: TableSpec) -> DataFrame:
        """``_kid`` and the natural key of every row of a table."""
        return self.keyed(table, self.tables[table.name]).select(self.id(table).alias("_kid"), NATURAL)


def _same_id(left: DataFrame, a: str, right: DataFrame, b: str) -> Column:
    """Whether two ids are the same text. Texts and whole numbers meet as they are, so that a join finds
    the rows where an earlier one on the same column has left them."""
    kinds = left.schema[a].dataType, right.schema[b].dataType
    if all(isinstance(k, T.IntegralType) for k in kinds) or all(isinstance(k, T.StringType) for k in kinds):
        return F.col(a) == F.col(b)
    return F.col(a).cast("string") == F.col(b).cast("string")


def _resolve_ring(spec: MigrationSpec, names: set[str], sides: tuple[_Side, _Side]) -> None:
    """The keys of the tables of a ring, as hashes that are equal where the keys are, also where rows
    refer to each other in a circle. A round per level of parents; every round is checkpointed."""
    most = max(len(spec.table(n).key) for n in names)

    def rows(side: int, name: str) -> DataFrame:
        table = spec.table(name)
        parts = sides[side].parts(table, sides[side].tables[name], names).withColumn("_kid", sides[side].id(table).cast("string"))
        ends = [part_of(spec, table, k).end for k in table.key]
        refs = [(f"_r{i}", spec.table(e).name) if e and spec.table(e).name in names else None for i, e in enumerate(ends)]
        refs += [None] * (most - len(refs))
        return parts.select(
            F.lit(side).alias("_side"), F.lit(name).alias("_table"), "_kid", F.array(*[f"_p{i}" for i in range(len(table.key))]).alias("_values"),
            *[(F.lit(r[1]) if r else F.lit(None).cast("string")).alias(f"_t{i}") for i, r in enumerate(refs)],
            *[(F.col(r[0]) if r else F.lit(None).cast("string")).alias(f"_r{i}") for i, r in enumerate(refs)],
        )

    def colour(values: Column) -> Column:
        text = F.array_join(F.filter(values, lambda v: F.coalesce(v != "", F.lit(False))), SEPARATOR)
        return F.when(text != "", F.sha2(text, 256))

    nodes = cut_lineage(functools.reduce(DataFrame.unionByName, [rows(side, name) for side in (0, 1) for name in sorted(names)]))
    used = [i for i in range(most) if any(i < len(spec.table(n).key) and (e := part_of(spec, spec.table(n), spec.table(n).key[i]).end) and spec.table(e).name in names for n in names)]
    state = nodes.withColumn(NATURAL, colour(F.col("_values")))
    while True:
        met = state
        known = state.select(F.col("_side").alias("_s"), F.col("_table").alias("_t"), F.col("_kid").alias("_k"), F.col(NATURAL).alias("_of_parent"))
        for i in used:
            same = (F.col("_side") == F.col("_s")) & (F.col(f"_t{i}") == F.col("_t")) & (F.col(f"_r{i}") == F.col("_k"))
            met = met.join(known, same, "left").drop("_s", "_t", "_k").withColumnRenamed("_of_parent", f"_c{i}")
        values = F.transform("_values", lambda v, i: functools.reduce(lambda out, j: F.when(i == j, F.col(f"_c{j}")).otherwise(out), used, v))
        new = met.withColumn("_before", F.col(NATURAL)).withColumn(NATURAL, colour(values)).select(*nodes.columns, NATURAL, "_before")
        new = cut_lineage(new)
        kinds = new.select("_table", NATURAL, "_before").distinct()
        count = kinds.agg(F.count("*").alias("both"), F.count_distinct("_table", F.coalesce("_before", F.lit(""))).alias("before"), F.count_distinct("_table", F.coalesce(NATURAL, F.lit(""))).alias("after")).first()
        state = new.drop("_before")
        if count["both"] == count["before"] == count["after"]:
            break
    for i, side in enumerate(sides):
        for name in names:
            side.keys[name] = state.where((F.col("_side") == i) & (F.col("_table") == name)).select("_kid", NATURAL)


def natural_keys(spec: MigrationSpec, sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame]) -> dict[str, tuple[Keyed, Keyed]]:
    """For each table whose key reaches through parents, functions that give rows of its source and of
    its target their keys in ``_natural``. Missing parents are empty parts.

    The rows themselves go through the joins to their parents; no table of keys is made that they would
    have to meet by id. Only the keys of a ring come from such a table.
    """
    wanted = [t for t in spec.tables if reaches_parents(spec, t)]
    sides = (_Side(spec, sources, False, {}), _Side(spec, targets, True, {}))
    below = {t.name: _below(spec, t.name) for t in spec.tables}
    rings = {frozenset(n for n in below[t.name] if t.name in below[n]) for t in spec.tables if t.name in below[t.name]}
    # a ring that another one's keys contain comes first
    for ring in sorted(rings, key=lambda r: len(set().union(*[below[n] for n in r]))):
        _resolve_ring(spec, set(ring), sides)
    return {t.name: tuple(functools.partial(side.keyed, t) for side in sides) for t in wanted}
