"""Counts and summaries (A1-A14). All are partial aggregates; none holds a group in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.operators.project import joined_key
from rowferry.operators.ranking import last_per_key, rank_rows


def row_count(df: DataFrame, id_column: str, limit: int | None = None) -> DataFrame:
    """A1, A2: rows with an id; with ``limit`` never more than that."""
    count = F.count(id_column)
    return df.agg((count if limit is None else F.least(count, F.lit(limit))).alias("CNT"))


def write_summary(plan: DataFrame, table: str = "object", pass_: str = "pass", action: str = "action") -> DataFrame:
    """A3: rows per table, pass and action."""
    return plan.groupBy(table, pass_, action).agg(F.count("*").alias("rows"))


def write_totals(plan: DataFrame, table: str = "object", action: str = "action") -> DataFrame:
    """A3 as one row per table."""
    return plan.groupBy(table).agg(
        F.count_if(F.col(action) == "insert").alias("inserted"),
        F.count_if(F.col(action) == "update").alias("updated"),
        F.count_if(F.col(action).isin("delete", "hard_delete")).alias("deleted"),
    )


def skip_counts(plan: DataFrame, action: str = "action", reason: str = "skip_reason") -> DataFrame:
    """A4: skipped rows by reason. What is neither known reason is ``other``, never below 0."""
    skipped = F.count_if(F.col(action) == "skip")
    same = F.count_if(F.col(reason) == "same_data")
    unmatched = F.count_if(F.col(reason) == "no_match")
    return plan.agg(
        same.alias("same_data"),
        unmatched.alias("no_match"),
        F.greatest(skipped - same - unmatched, F.lit(0)).alias("other"),
    )


def changed_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows changed per field, in one pass, as (field, rows)."""
    counts = df.agg(*[F.count_if(condition).alias(f"_n{i}") for i, condition in enumerate(conditions.values())])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(f"_n{i}").alias("rows")) for i, name in enumerate(conditions)]
    )
    return counts.select(F.inline(pairs))


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues per table and error text."""
    return issues.groupBy(F.col("`sObject name`").alias("table"), F.col("Error").alias("error")).agg(
        F.count("*").alias("issues")
    )


def write_results(results: DataFrame, errors: str = "Errors") -> DataFrame:
    """Processed and failed rows of a write."""
    return results.agg(
        F.count("*").alias("processed"), F.count_if(F.col(errors).isNotNull()).alias("failed")
    )


def rows_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], delimiter: str = "|"
) -> DataFrame:
    """A10: the multi-map of a key to its rows, in long form.

    One row per entry, with the joined key and the position under it. A key may own any share
    of the table, so its rows are never put into one list.
    """
    keyed = df.withColumn("group_key", joined_key(df, keys, delimiter))
    return rank_rows(keyed, ["group_key"], order_by, "position")


def last_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], delimiter: str = "|") -> DataFrame:
    """The last row per joined key."""
    return last_per_key(df.withColumn("group_key", joined_key(df, keys, delimiter)), ["group_key"], order_by)


def distinct_values(df: DataFrame, columns: Sequence[str], delimiter: str = "|") -> DataFrame:
    """Distinct joined texts."""
    return df.select(joined_key(df, columns, delimiter).alias("value")).distinct()


def distinct_ignoring_case(df: DataFrame, column: str, order_by: Sequence[str]) -> DataFrame:
    """Distinct texts in any case; the last spelling is kept."""
    slim = df.select(
        F.lower(column).alias("folded"), F.col(column).alias("value"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    ).where("folded IS NOT NULL")
    return last_per_key(slim, ["folded"], [f"_o{i}" for i in range(len(order_by))]).select("value")


def match_counts(df: DataFrame, match: Column) -> DataFrame:
    """Rows kept and rows removed by a filter."""
    hit = F.coalesce(match, F.lit(False))
    return df.agg(F.count_if(hit).alias("kept"), F.count_if(~hit).alias("filtered"))


def volume(df: DataFrame, size: str, url: str) -> DataFrame:
    """Number of versions, of those that are links, and bytes in all."""
    return df.agg(
        F.count("*").alias("versions"),
        F.count_if(F.length(url) > 0).alias("urls"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
    )
