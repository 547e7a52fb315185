"""Carrying out a plan."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.names import quoted
from rowferry.operators.matching import TARGET_ID
from rowferry.plans.upsert import DELETE, HARD_DELETE, INSERT, UPDATE

WRITES = (INSERT, UPDATE, DELETE, HARD_DELETE)


class Phase(NamedTuple):
    """A plan, the columns it may write, and those that it must not insert or update."""

    plan: DataFrame
    columns: Sequence[str]
    not_insertable: Sequence[str] = ()
    not_updateable: Sequence[str] = ()


def apply_plan(
    target: DataFrame,
    plan: DataFrame,
    id_column: str,
    columns: Sequence[str],
    deleted_flag: str | None = None,
    not_insertable: Sequence[str] = (),
    not_updateable: Sequence[str] = (),
) -> DataFrame:
    """The target as it is after the plan.

    One full join on the id does inserts, updates and deletes together. A soft delete sets
    ``deleted_flag``; without such a column, and for a hard delete, the row is gone.
    """
    return apply_phases(target, [Phase(plan, columns, not_insertable, not_updateable)], id_column, deleted_flag)


def apply_phases(target: DataFrame, phases: Sequence[Phase], id_column: str, deleted_flag: str | None = None) -> DataFrame:
    """The target as it is after several plans, one after the other, with one join.

    The plans have a row per target id at most. They are brought to one row per id first, dealt as the
    join needs it, so the target is shuffled once, whatever the number of plans. A plan meets the rows as
    the plans before it left them: what one deletes, a later one can insert anew.
    """
    known = [[c for c in phase.columns if c in phase.plan.columns and c != id_column] for phase in phases]
    joined = target.withColumn("_there", F.lit(True)).join(_folded(phases, known), F.col(quoted(id_column)) == F.col("_nid"), "full")
    state = joined.withColumn("_there", F.col("_there").isNotNull())
    for i, (phase, names) in enumerate(zip(phases, known)):
        action = F.col(f"_p{i}.action")
        gone = action == HARD_DELETE if deleted_flag else action.isin(DELETE, HARD_DELETE)
        there = F.when(gone, False).otherwise(F.col("_there") | action.isNotNull())

        def value(name: str):
            before = F.when(F.col("_there"), F.col(quoted(name))) if i else F.col(quoted(name))
            if name == deleted_flag:
                return F.when(action == DELETE, True).when(action == INSERT, False).otherwise(before)
            if name not in names:
                return before
            writers = [a for a, barred in ((INSERT, phase.not_insertable), (UPDATE, phase.not_updateable)) if name not in barred]
            new = F.col(f"_p{i}.v{names.index(name)}").cast(target.schema[name].dataType)
            return F.when(action.isin(*writers), new).otherwise(before)

        values = {c: value(c) for c in target.columns if c != id_column}
        state = state.withColumns({**values, "_there": there})
    final = [F.coalesce(quoted(c), "_nid").alias(c) if c == id_column else F.col(quoted(c)) for c in target.columns]
    return state.where("_there").select(*final)


def _folded(phases: Sequence[Phase], known: Sequence[Sequence[str]]) -> DataFrame:
    """What the plans write: a row per target id, plan i in the struct ``_p<i>``."""
    parts = []
    for i, (phase, names) in enumerate(zip(phases, known)):
        written = F.struct("action", *[F.col(quoted(c)).alias(f"v{j}") for j, c in enumerate(names)])
        parts.append(phase.plan.where(F.col("action").isin(*WRITES)).select(F.col(TARGET_ID).alias("_nid"), written.alias(f"_p{i}")))
    if len(parts) == 1:
        return parts[0]
    united = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # rows without an id stay apart
    apart = F.when(F.col("_nid").isNull(), F.monotonically_increasing_id())
    dealt = united.withColumn("_apart", apart).repartition("_nid")
    picked = [F.any_value(f"_p{i}", F.lit(True)).alias(f"_p{i}") for i in range(len(parts))]
    return dealt.groupBy("_nid", "_apart").agg(*picked).drop("_apart")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside the old table and swaps the folders, so that readers see old or new."""
    spark = df.sparkSession
    fs, final = _file_system(spark, path)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    staged, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    df.write.parquet(staged)
    if fs.exists(final):
        fs.rename(final, path_of(old))
    fs.rename(path_of(staged), final)
    if fs.exists(path_of(old)):
        fs.delete(path_of(old), True)


def apply_all_or_none(result: DataFrame, errors: DataFrame, path: str) -> bool:
    """Writes the result only if the plan has no error row. Says whether it did."""
    if not errors.isEmpty():
        return False
    replace_table(result, path)
    return True


def write_external(plan: DataFrame, send_partition) -> None:
    """M13 for sinks outside Spark: ``send_partition`` gets the rows of each partition."""
    plan.where(F.col("action").isin(*WRITES)).foreachPartition(send_partition)
