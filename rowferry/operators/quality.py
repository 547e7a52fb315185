"""Checks and repairs of input tables (Q1, Q5-Q9)."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.functions.cells import strip
from rowferry.functions.keys import key_text, row_id
from rowferry.operators.lookups import MISSING_COLUMN, MISSING_TABLE
from rowferry.functions.names import every, quoted
from rowferry.operators.ranking import flag_first, rank_rows

BLANK_VALUES = "BLANK VALUES"


def _plain(name: str) -> str:
    return name.strip().strip("'\"`").lower()


def has_column(header: Sequence[str], name: str) -> bool:
    """Whether a header holds a column: any case, quotes ignored, dotted names match by part."""
    wanted = _plain(name)
    if not wanted:
        return False
    parts = [_plain(p) for p in wanted.lstrip("$").replace("$", ";").split(";")] if "$$" in name else []
    for column in header:
        plain = _plain(column)
        if plain == wanted or wanted in [_plain(p) for p in plain.split(".")] or plain in parts:
            return True
    return False


def missing_columns(
    header: Sequence[str],
    required: Sequence[str],
    lookups: Sequence[tuple[str, str]] = (),
    ids_excluded: bool = False,
    id_fields: Sequence[str] = (),
) -> list[str]:
    """Q1: names that are missing, each once. A lookup id is missing where its reference is there.

    In ids-excluded mode ``id_fields`` may be absent.
    """
    absent: dict[str, None] = {}
    for name in required:
        if not has_column(header, name) and not (ids_excluded and name in id_fields):
            absent.setdefault(name)
    for id_name, reference in lookups:
        if has_column(header, reference) and not has_column(header, id_name):
            if not (ids_excluded and id_name in id_fields):
                absent.setdefault(id_name)
    return list(absent)


def check_contract(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    required: Mapping[str, Sequence[str]],
    lookups: Mapping[str, Sequence[tuple[str, str]]] | None = None,
    ids_excluded: bool = False,
    id_fields: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Q1 over all tables, as (table, field, error, blanks).

    Missing tables and columns are schema facts. Blank values are counted in one pass per
    table over the required columns only.
    """
    facts, counts = [], []
    for table, wanted in required.items():
        df = tables.get(table)
        if df is None:
            if not ids_excluded:
                facts.append((table, None, MISSING_TABLE, None))
            continue
        pairs = (lookups or {}).get(table, ())
        allowed = (id_fields or {}).get(table, ())
        for name in missing_columns(df.columns, wanted, pairs, ids_excluded, allowed):
            facts.append((table, name, MISSING_COLUMN, None))
        present = {_plain(c): c for c in df.columns}
        checked = list(dict.fromkeys(present[_plain(n)] for n in wanted if _plain(n) in present))
        if checked:
            blanks = [
                F.count_if(F.coalesce(strip(F.col(quoted(c)).cast("string")), F.lit("")) == "").alias(f"_b{i}")
                for i, c in enumerate(checked)
            ]
            rows = F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table"),
                        F.lit(c).alias("field"),
                        F.lit(BLANK_VALUES).alias("error"),
                        F.col(f"_b{i}").alias("blanks"),
                    )
                    for i, c in enumerate(checked)
                ]
            )
            counts.append(df.agg(*blanks).select(F.inline(rows)).where("blanks > 0"))
    schema = "table string, field string, error string, blanks long"
    return functools.reduce(DataFrame.unionByName, counts, spark.createDataFrame(facts, schema))


def combine_legacy_key(df: DataFrame, relation: str, parts: Sequence[str], name: str) -> DataFrame:
    """Q5: ``relation.A``, ``relation.B`` ... become one key column and go."""
    old = [f"{relation}.{p}" for p in parts if f"{relation}.{p}" in df.columns]
    if not old:
        return df
    combined = key_text([F.col(quoted(c)) for c in old])
    if name in df.columns:
        combined = F.coalesce(combined, F.col(quoted(name)))
    kept = [F.col(quoted(c)) for c in df.columns if c not in old and c != name]
    return df.select(*kept, combined.alias(name))


def add_ids(df: DataFrame, table: str, id_column: str, identify_by: Sequence[str] = ()) -> DataFrame:
    """Q6: an id column where there is none.

    The id comes from the columns that identify a row. Without any, from the whole row and
    its ordinal among equal rows, which are interchangeable.
    """
    if id_column in df.columns:
        return df
    if identify_by:
        return df.withColumn(id_column, row_id(table, *[F.col(quoted(c)) for c in identify_by]))
    digest = F.sha2(F.to_json(F.struct(*every(df))), 256)
    ranked = rank_rows(df.withColumn("_digest", digest), ["_digest"], ["_digest"])
    return ranked.withColumn(id_column, row_id(table, "_digest", "_rn")).select(
        *every(df), id_column
    )


def repair_ids(df: DataFrame, table: str, id_column: str, order_by: Sequence[str], length: int = 18) -> DataFrame:
    """Q7: blank and repeated ids are replaced, the first row keeps its id. Ids become text, all distinct.

    Rows with a blank id need no comparison. The rest are compared on (id, order), which
    spreads an id that a large share of the rows has. Rows that agree there are told apart by their
    content, equal rows by their number. A new id that is taken already, by a row of the table or by
    another new id, is made again from at least 128 bits.
    """
    trimmed = F.coalesce(strip(F.col(quoted(id_column)).cast("string")), F.lit(""))
    digest = F.sha2(F.to_json(F.struct(*every(df))), 256)
    prepared = rank_rows(df.withColumns({"_trimmed": trimmed, "_digest": digest}), ["_trimmed", *order_by], ["_digest"], "_tie")
    filled = prepared.where("_trimmed <> ''")
    flagged = flag_first(filled, ["_trimmed"], [*order_by, "_tie"], "_first").unionByName(
        prepared.where("_trimmed = ''").withColumn("_first", F.lit(False))
    )
    parts = ["_trimmed", *[F.col(quoted(o)) for o in order_by]]
    tied = F.col("_tie") > 1
    made = F.when(tied, row_id(table, *parts, "_tie", length=length)).otherwise(row_id(table, *parts, length=length))
    given = flagged.withColumn("_given", F.when(F.col("_first"), F.col("_trimmed")).otherwise(made))
    taken = given.groupBy("_given").count().where("count > 1").select(F.col("_given").alias("_taken"))
    again = row_id(table, F.lit("again"), "_trimmed", "_digest", "_tie", length=max(length, 32))
    fixed = F.when(F.col("_first") | F.col("_taken").isNull(), F.col("_given")).otherwise(again)
    kept = [fixed.alias(c) if c == id_column else F.col(quoted(c)) for c in df.columns]
    return given.join(taken, F.col("_given") == F.col("_taken"), "left").select(*kept)
