"""Row filters."""

from __future__ import annotations

import functools
import logging
import operator
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.cells import strip, truthy
from rowferry.functions.text import highlight, words_pattern

log = logging.getLogger("rowferry")

# Fixed values.
DEFAULT_GROUP_FILTER = "Type = 'Queue'"


def where(df: DataFrame, condition: str | Column | None) -> DataFrame:
    """the filter of a table."""
    return df if condition is None or condition is True else df.where(condition)


def where_or_all(df: DataFrame, condition: str | None, what: str) -> DataFrame:
    """a filter from outside. One that does not fit the table keeps every row.

    A value that the condition cannot work on (text that is no number, a division by zero, a place
    that a list does not have) gives null there and does not end the job: such a row is not kept.
    """
    if not condition or not condition.strip():
        return df
    conf, name = df.sparkSession.conf, "spark.sql.ansi.enabled"
    strict = conf.get(name)
    try:
        conf.set(name, "false")  # functions keep the mode in which they were resolved
        return df.where(F.expr(condition))
    except (AnalysisException, ParseException) as error:
        log.warning("%s is skipped: %s", what, error)
        return df
    finally:
        conf.set(name, strict)


def source_records_filter(df: DataFrame, condition: str | None) -> DataFrame:
    """F2."""
    return where_or_all(df, condition, "source records filter")


def target_records_filter(df: DataFrame, condition: str | None) -> DataFrame:
    """over prepared rows, after hooks and before mocking."""
    return where_or_all(df, condition, "target records filter")


def in_keys(df: DataFrame, column: str, keys: DataFrame, key: str | None = None) -> DataFrame:
    """rows whose column is among the keys. A semi-join takes lists of any length.

    The key list is made distinct first, so that a hot key is one row when it is shuffled.
    """
    wanted = keys.select(F.col(key or column).alias("_in")).where("_in IS NOT NULL").distinct()
    return df.join(wanted, F.col(column) == F.col("_in"), "left_semi")


def not_deleted(df: DataFrame, flag: str, include_deleted: bool = False) -> DataFrame:
    """rows marked as deleted are left out unless the reader asks for all."""
    return df if include_deleted else df.where(~F.coalesce(F.col(flag), F.lit(False)))


def target_read(
    df: DataFrame,
    condition: str | None,
    deleted_flag: str | None = None,
    all_rows: bool = False,
    hierarchy_delete: bool = False,
) -> DataFrame:
    """a target is read without filter for hierarchy deletes and full reads."""
    if all_rows or hierarchy_delete:
        return df
    filtered = where(df, condition)
    return not_deleted(filtered, deleted_flag) if deleted_flag else filtered


def all_of(*conditions: str | Column) -> Column:
    """F8: AND, each part in its own parentheses."""
    return functools.reduce(operator.and_, [_expression(c) for c in conditions])


def any_of(*conditions: str | Column) -> Column:
    """F8: OR, each part in its own parentheses."""
    return functools.reduce(operator.or_, [_expression(c) for c in conditions])


def _expression(condition: str | Column) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def word_match(columns: Sequence[str], words: Sequence[str]) -> Column:
    """True where one of the words stands in one of the columns; the same test for any number of words."""
    pattern = words_pattern(words)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return functools.reduce(operator.or_, [text.rlike(pattern) for text in texts])


def keep_words(
    df: DataFrame, columns: Sequence[str], words: Sequence[str], mark: bool = False
) -> DataFrame:
    """rows that hold a listed word; ``mark`` puts ``***`` around each.

    Every value is searched from its start, whatever the value before it gave.
    """
    kept = df.where(word_match(columns, words))
    if mark:
        kept = kept.withColumns({c: highlight(F.col(c), words) for c in columns})
    return kept


def filter_hook(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """User code that takes rows and gives rows."""
    return df if hook is None else df.transform(hook)


def latest_files(
    df: DataFrame,
    latest: str,
    size: str,
    max_size: int | None = None,
    extra: str | None = None,
) -> DataFrame:
    """latest versions, up to a size where the caller gives one, and the caller's own condition."""
    kept = df.where(F.col(latest))
    if max_size is not None:
        kept = kept.where(F.col(size) <= max_size)
    return where(kept, extra)


def group_filter(df: DataFrame, user_filter: str | None = None, default: str = DEFAULT_GROUP_FILTER) -> DataFrame:
    """groups default to queues; the user's own condition takes its place."""
    return df.where(user_filter or default)


def feed_content(df: DataFrame, column: str = "Type", value: str = "ContentPost") -> DataFrame:
    """F13."""
    return df.where(F.col(column) == value)


def person_side(df: DataFrame, flag: str, persons: bool) -> DataFrame:
    """one side of the person / business split. Every row is on exactly one side."""
    is_person = truthy(F.col(flag), df.schema[flag].dataType)
    return df.where(is_person if persons else ~is_person)


def with_id(df: DataFrame, id_column: str) -> DataFrame:
    """rows whose id is not blank."""
    return df.where(F.length(strip(F.col(id_column).cast("string"))) > 0)
