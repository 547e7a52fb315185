"""Formula columns and their inputs.

Inputs are added as columns, gathered in a struct named ``formula`` and used by a Spark SQL
expression as ``formula.alias``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.functions.names import every

from rowferry.operators.conditions import first_where
from rowferry.operators.ranking import first_per_key, with_cells


def same_row(df: DataFrame, other: DataFrame, on: str, other_id: str, value: str, name: str) -> DataFrame:
    """A value of the row itself as it is on the other side."""
    slim = other.select(F.col(other_id).alias("_oid"), F.col(value).alias(name))
    return df.join(slim, F.col(on) == F.col("_oid"), "left").drop("_oid")


def from_parent(
    df: DataFrame, lookups: Sequence[str], parent: DataFrame, parent_id: str, value: str, name: str
) -> DataFrame:
    """Value of the parent. Of several lookups the last one that is filled wins."""
    out, found = df, []
    for i, lookup in enumerate(lookups):
        slim = parent.select(F.col(parent_id).alias(f"_i{i}"), F.struct(F.col(value).alias("v")).alias(f"_v{i}"))
        out = out.join(slim, F.col(lookup) == F.col(f"_i{i}"), "left")
        found.append(F.when(F.col(lookup).isNotNull(), F.coalesce(f"_v{i}", F.struct(_null_like(parent, value)))))
    last = F.coalesce(*reversed(found))
    return out.withColumn(name, last.getField("v")).select(*every(df), name)


def _null_like(df: DataFrame, column: str) -> Column:
    return F.lit(None).cast(df.schema[column].dataType).alias("v")


def from_child(
    df: DataFrame, id_column: str, child: DataFrame, lookups: Sequence[str], value: str, order_by: Sequence[str], name: str
) -> DataFrame:
    """Value of the first child that looks up to this row through any of the lookups."""
    order = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    names = [f"_o{i}" for i in range(len(order_by))]
    slim = child.select(
        F.explode(F.array_distinct(F.array(*[F.col(c) for c in lookups]))).alias("_parent"),
        F.col(value).alias(name),
        *order,
    ).where("_parent IS NOT NULL")
    first = first_per_key(slim, ["_parent"], names).drop(*names)
    return df.join(first, F.col(id_column) == F.col("_parent"), "left").drop("_parent")


def by_equality(
    df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]], value: str, order_by: Sequence[str], name: str
) -> DataFrame:
    """J26 with equalities only: first row of the other table whose columns equal ours."""
    keys = [f"_k{i}" for i in range(len(on))]
    names = [f"_o{i}" for i in range(len(order_by))]
    slim = other.select(
        *[F.col(theirs).alias(k) for k, (_, theirs) in zip(keys, on)],
        F.col(value).alias(name),
        *[F.col(o).alias(n) for n, o in zip(names, order_by)],
    ).na.drop(subset=keys)
    first = first_per_key(slim, keys, names).drop(*names)
    condition = [F.col(ours) == F.col(k) for k, (ours, _) in zip(keys, on)]
    return df.join(first, condition, "left").drop(*keys)


def by_comparison(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[tuple[str, str]],
    compare: tuple[str, str, str],
    value: str,
    order_by: Sequence[str],
    name: str,
    cells: int | None = None,
) -> DataFrame:
    """J26 with one comparison: first row of the other table, in ``order_by``, whose columns
    equal ours and whose value compares as asked, for example ``("limit", "<=", "amount")``
    for their ``limit <= `` our ``amount``. ``on`` may be empty.

    No pairs are made. The distinct values of both tables are laid out along the compared
    value, and each asked value takes the smallest order seen so far: within its cell by a
    window, before it by a running minimum over one row per cell. The rows then fetch the
    answer to their own value.
    """
    theirs, op, ours = compare
    if op not in ("<=", "<", ">=", ">"):
        raise ValueError(f"comparison {op} is not supported")
    along = F.asc if op in ("<=", "<") else F.desc
    both = other.select(F.col(theirs).alias("_at")).union(df.select(ours))
    kind = both.schema["_at"].dataType
    other_first = op in ("<=", ">=")
    best = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order_by)], F.col(value).alias("v"))
    their_key = F.struct(F.lit(1).alias("k"), *[F.col(t).alias(f"k{i}") for i, (_, t) in enumerate(on)])
    our_key = F.struct(F.lit(1).alias("k"), *[F.col(o).alias(f"k{i}") for i, (o, _) in enumerate(on)])
    candidates = (
        other.na.drop(subset=[theirs, *[t for _, t in on]])
        .select(their_key.alias("_key"), F.col(theirs).cast(kind).alias("_at"), best.alias("_best"))
        .groupBy("_key", "_at")
        .agg(F.min("_best").alias("_best"))
        .withColumn("_side", F.lit(0 if other_first else 1))
    )
    wanted = df.na.drop(subset=[ours, *[o for o, _ in on]])
    asked = (
        wanted.select(our_key.alias("_key"), F.col(ours).cast(kind).alias("_at"))
        .distinct()
        .withColumn("_best", F.lit(None).cast(candidates.schema["_best"].dataType))
        .withColumn("_side", F.lit(1 if other_first else 0))
    )
    line = with_cells(candidates.unionByName(asked), ["_at"], "_cell", cells)
    upto = Window.partitionBy("_key", "_cell").orderBy(along("_at"), "_side")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = line.withColumn("_local", F.min("_best").over(upto))
    earlier = Window.partitionBy("_key").orderBy(along("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        line.groupBy("_key", "_cell")
        .agg(F.min("_best").alias("_min"))
        .select("_key", "_cell", F.min("_min").over(earlier).alias("_carry"))
    )
    answers = (
        local.where(F.col("_side") == (1 if other_first else 0))
        .join(carried, ["_key", "_cell"])
        .select("_key", "_at", F.least("_local", "_carry").getField("v").alias(name))
    )
    asking = df.withColumn("_key", our_key).withColumn("_at", F.col(ours).cast(kind))
    return asking.join(answers, ["_key", "_at"], "left").select(*every(df), name)


#: J26 with equalities, comparisons and a rest: the general form.
by_condition = first_where


def constant(df: DataFrame, other: DataFrame, value: str, order_by: Sequence[str], name: str, condition: Column | str | None = None) -> DataFrame:
    """One value, found once and the same for all rows: the first that is not null."""
    candidates = other if condition is None else other.where(condition)
    found = candidates.where(F.col(value).isNotNull()).agg(F.min_by(value, F.struct(*order_by)).alias("c"))
    return df.withColumn(name, found.scalar())


def apply(
    df: DataFrame,
    aliases: dict[str, Column],
    formula: str,
    target: str,
    expressions: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """``target`` = formula of ``formula.<alias>``; preparing expressions set aliases first."""
    out = df.withColumn("formula", F.struct(*[value.alias(name) for name, value in aliases.items()]))
    for name, expression in expressions:
        out = out.withColumn("formula", F.col("formula").withField(name, F.expr(expression)))
    out = out.withColumn(target, F.expr(formula))
    return out.drop("formula")
