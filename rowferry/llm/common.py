"""What the operators share on the Spark side: row identity, stored tables, Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.session import scratch_folder, tune

#: Stands for a null id inside an operator; such a row comes after all others.
NO_ID = (1 << 63) - 1


def find_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers look for this package where the driver has it, should it not be
    installed for them."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])
    return tune(spark)


def batches_of_texts(spark: SparkSession) -> SparkSession:
    """Bounds what a Python worker holds at a time by bytes, not only by rows."""
    find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Reads one table for an operator on texts."""
    return batches_of_texts(spark).read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared checkpoint folder and reads it back: the lineage ends there,
    and a lost executor costs no more than the tasks it was running."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a number written as text, modulo ``modulus``; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def sampled(rows: DataFrame, rank: str, size: int) -> DataFrame:
    """The rows with the ``size`` smallest values of ``rank``, which is distinct per row but for
    copies. Only the ranks are sorted; the rows themselves stay where they are."""
    last = rows.select(rank).distinct().orderBy(rank).limit(size).agg(F.max(rank)).first()[0]
    return rows.where(F.lit(False) if last is None else F.col(rank) <= last)


def join_counted(left: DataFrame, right: DataFrame, keys: tuple[str, ...], count: str, total: int) -> DataFrame:
    """Inner join where ``right`` has one row per key and says in ``count`` how many of the ``total``
    rows of ``left`` have it.

    Keys with more than a thousandth of the rows, of which there are fewer than a thousand, are
    broadcast, so that their rows stay where they are; all others meet by a shuffle. ``left`` is read
    twice and should be a stored table.
    """
    theirs = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    hot = theirs.where(F.col(count) > total // 1000)
    rest = left.join(F.broadcast(hot.select(*[f"_{k}" for k in keys])), same, "left_anti")
    met = left.join(F.broadcast(hot), same).unionByName(rest.join(theirs.where(F.col(count) <= total // 1000), same))
    return met.drop(*[f"_{k}" for k in keys])


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names; all other columns, whatever their names, stay out."""
    return docs.select(*[docs[f"`{source}`"].alias(name) for name, source in columns.items()])


def columns_of(df: DataFrame) -> str:
    """The columns of a frame as a schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def over_batches(function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]) -> Callable:
    """A function of one batch as one for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return run


def record(**columns) -> pa.RecordBatch:
    """A record batch from arrays by name."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()], names=list(columns))
