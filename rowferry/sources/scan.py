"""Reading tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.cells import cast_cell, normalize_cell, strip
from rowferry.operators.filters import where
from rowferry.functions.names import quoted
from rowferry.plans.apply import path_exists, replace_table

# Fixed values.
ID_PREFIXES = {"User": "005", "Group": "00G"}


def scan(df: DataFrame, columns: Sequence[str] | None = None, condition: str | None = None) -> DataFrame:
    """Projection and filter right above a reader, where Catalyst pushes them down."""
    filtered = where(df, condition)
    return filtered if columns is None else filtered.select(*[F.col(quoted(c)) for c in columns])


def read_text_csv(
    spark: SparkSession, path: str, separator: str = ",", encoding: str = "UTF-8", multi_line: bool = True,
    columns: Sequence[str] = (),
) -> DataFrame:
    """S2, first half: a header CSV as text. A missing file gives an empty table.

    Cells may have line breaks; a file is then one task, and ``multi_line=False`` splits files that
    have none. Records with more or fewer cells than the header are left out by a filter, which keeps
    a cell beside the mark, so that ``count()`` sees the same rows as ``collect()``.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    try:
        names = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    mark = "_corrupt_record"
    while mark.lower() in {n.lower() for n in names}:
        mark += "_"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, mark]])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", mark).csv(path)
    whole = F.col(mark).isNull() & (F.coalesce(F.length(F.col(quoted(names[0]))), F.lit(0)) >= 0)
    return rows.where(whole).drop(mark)


def typed(
    df: DataFrame,
    types: Mapping[str, str],
    blank_as_null: bool = True,
    european_dates: bool = False,
    keep_failures: bool = True,
) -> DataFrame:
    """S2, second half: null tokens and casts (K1-K5). Types are found in any case.

    A typed column cannot keep text that does not fit. Such text goes to ``<column>__raw``.
    """
    kinds = {name.strip().lower(): kind for name, kind in types.items()}
    normal = df.select(*[normalize_cell(F.col(quoted(c)), blank_as_null).alias(c) for c in df.columns])
    columns = []
    for name in df.columns:
        kind = kinds.get(name.strip().lower())
        cell = F.col(quoted(name))
        value = cell if kind is None else cast_cell(cell, kind, european_dates)
        columns.append(value.alias(name))
        if keep_failures and kind and kind.lower() not in ("string", "id", "reference", "picklist", "textarea"):
            columns.append(F.when((cell != "") & value.isNull(), cell).alias(f"{name}__raw"))
    return normal.select(*columns)


def read_csv(spark: SparkSession, path: str, types: Mapping[str, str], **options) -> DataFrame:
    """A typed CSV scan."""
    cast = {k: options.pop(k) for k in ("blank_as_null", "european_dates", "keep_failures") if k in options}
    return typed(read_text_csv(spark, path, columns=list(types), **options), types, **cast)


def split_by_prefix(df: DataFrame, id_column: str, prefixes: Mapping[str, str] = ID_PREFIXES) -> dict[str, DataFrame]:
    """One combined table into one per id prefix. Rows with a blank id are in none."""
    start = F.upper(F.substring(strip(F.col(quoted(id_column)).cast("string")), 1, 3))
    return {name: df.where(start == prefix.upper()) for name, prefix in prefixes.items()}


def snapshot(spark: SparkSession, folder: str, query: str, read: Callable[[], DataFrame]) -> DataFrame:
    """The stored result of a query text; the first call stores it."""
    path = f"{folder}/{hashlib.sha256(query.encode()).hexdigest()}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        replace_table(read(), path)
    return spark.read.parquet(path)


PACKAGE = ("versions", "links", "attachments", "notes")


def read_package(
    tables: Mapping[str, DataFrame], parents: DataFrame, parent_id: str
) -> dict[str, DataFrame]:
    """Versions, links, attachments and notes of the given parents."""
    ids = parents.select(F.col(parent_id).alias("_pid")).distinct()
    out = {
        name: tables[name].join(ids, F.col("parent_id") == F.col("_pid"), "left_semi")
        for name in ("links", "attachments", "notes")
    }
    docs = out["links"].select(F.col("doc_id").alias("_doc")).distinct()
    out["versions"] = tables["versions"].join(docs, F.col("doc_id") == F.col("_doc"), "left_semi")
    return out


def read_bodies(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Binary files as (path, size, body in base64)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.base64("content").alias("body"))
