"""Writing tables and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.cells import WRITE_NULL, datetime_text
from rowferry.operators.lookups import ISSUE_COLUMNS
from rowferry.functions.names import quoted
from rowferry.operators.project import audit_columns, ordered_columns, strip_ids
from rowferry.operators.sets import append
from rowferry.sources.scan import PACKAGE, typed

AUDIT_DATE = "Date update"


def write_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    keep_order: bool = False,
    quote_all: bool = True,
    upper_header: bool = False,
    null_value: str = WRITE_NULL,
    separator: str = ",",
    encoding: str = "UTF-8",
) -> None:
    """A CSV folder. Without rows it still has a header."""
    names = list(columns) if columns else ordered_columns(df.columns, keep_order)
    header = [name.upper() if upper_header else name for name in names]
    out = df.select(*[F.col(quoted(n)).cast("string").alias(h) for n, h in zip(names, header)])
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", quote_all)
        .option("escape", '"')
        .option("nullValue", null_value)
        .option("emptyValue", "")
        .option("sep", separator)
        .option("encoding", encoding)
        .csv(path)
    )


def export_rows(df: DataFrame, id_column: str, lookups: Sequence[str], without_ids: bool = False) -> DataFrame:
    """Prepared rows (parent columns added, J15) as they are exported."""
    return strip_ids(df, id_column, lookups) if without_ids else df


def export_table(df: DataFrame, folder: str, table: str, id_column: str, lookups: Sequence[str] = (), without_ids: bool = False) -> None:
    """To ``<folder>/<table>.csv``."""
    write_csv(export_rows(df, id_column, lookups, without_ids), f"{folder}/{table}.csv")


def audit_rows(plan: DataFrame, source_id: str) -> DataFrame:
    """Written rows with the target ``Id``, ``Old Id``, their values and ``Errors``."""
    written = plan.where("action <> 'skip'").withColumnRenamed("action", "operation")
    renamed = written.withColumn("_src_id", F.col(source_id)).withColumn("Id", F.col("target_id"))
    return audit_columns(renamed.drop("target_id", "skip_reason", *([source_id] if source_id != "Id" else [])))


def write_audit(plan: DataFrame, folder: str, table: str, source_id: str, persons: bool = False) -> None:
    """One folder per operation under ``<table>[_person]_target``."""
    rows = audit_rows(plan, source_id)
    suffix = "_person" if persons else ""
    values = [c for c in ordered_columns(rows.columns) if c != "operation"]
    out = rows.select(*[F.col(quoted(c)).cast("string").alias(c) for c in values], "operation")
    (
        out.write.mode("overwrite").partitionBy("operation")
        .option("header", True).option("quoteAll", True).option("escape", '"').option("nullValue", WRITE_NULL)
        .csv(f"{folder}/{table}{suffix}_target")
    )


def merge_csv(first: DataFrame, second: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Two tables into one file set over a fixed column list."""
    write_csv(append(first, second, columns), path, columns)


def write_bounded(df: DataFrame, path: str, max_rows: int) -> None:
    """Files of at most ``max_rows`` rows."""
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", max_rows).csv(path)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(AUDIT_DATE, datetime_text(F.current_timestamp()))


def write_issues(issues: DataFrame, path: str) -> None:
    """The eight fixed columns, dated."""
    write_csv(_dated(issues).select(*[F.col(quoted(c)) for c in ISSUE_COLUMNS]), path, ISSUE_COLUMNS, null_value="")


def write_missing_parents(missing: DataFrame, path: str) -> None:
    """One row per unresolved lookup, dated."""
    dated = _dated(missing)
    columns = [AUDIT_DATE, *missing.columns]
    write_csv(dated, path, columns, null_value="")


def copy_normalised(df: DataFrame, path: str, types: Mapping[str, str] | None = None) -> None:
    """Raw rows in one internal format: comma, quoted, UTF-8; validated when types are given."""
    rows = df if types is None else typed(df, types, keep_failures=False)
    write_csv(rows, path, rows.columns)


def write_package(package: Mapping[str, DataFrame], folder: str) -> None:
    """The four document tables, one folder each."""
    for name in PACKAGE:
        package[name].write.mode("overwrite").parquet(f"{folder}/{name}")
