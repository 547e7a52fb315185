"""Session settings, table loading and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark removes what a query has shuffled as soon as the query ends.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Adaptive execution splits the hot partitions of a join whose key is skewed. Lookups into
# a parent table are such joins: one parent may own a third of the children.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Sets the runtime options the operators count on."""
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Reads one parquet table of a folder."""
    return tune(spark).read.parquet(f"{folder}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session. Only a local master gets a temporary one where none is
    named; on a cluster other machines would not see it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for a table that is written and read back."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the checkpoint folder and returns a frame that reads it back."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a frame that reads it back. What was shuffled for it
    is removed at once, so that the disk holds one step's shuffles at a time and not a whole run's."""
    if re.search(r"\b(void|interval)\b", ",".join(f.dataType.simpleString() for f in df.schema)):
        return cut_lineage(df)  # Parquet has no such types
    spark, path = df.sparkSession, scratch_folder(df.sparkSession, name)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names may differ in case alone
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        plain.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(plain.schema).parquet(path).toDF(*df.columns)
