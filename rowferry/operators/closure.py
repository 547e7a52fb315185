"""Which rows belong to the selection: children, parents, self-references."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.names import every

from rowferry.session import cut_lineage

# Tables that are never used to select others.
NEVER_PIVOTS = ("User", "Group", "RecordType")

#: J7 walks at most so many hops one by one, and only while they find less than this share of the links.
EARLY_HOPS = 6
LARGE_SHARE = 0.05


def allowed_lookups(
    lookups: Sequence[tuple[str, str]],
    included: Sequence[str] = (),
    excluded: Sequence[str] = (),
) -> list[tuple[str, str]]:
    """(column, parent) pairs that may select rows."""
    inc = {name.strip().lower() for name in included}
    exc = {name.strip().lower() for name in excluded}
    return [
        (column, parent)
        for column, parent in lookups
        if parent not in NEVER_PIVOTS
        and (not inc or column.lower() in inc)
        and column.lower() not in exc
    ]


def children_of(
    child: DataFrame, selected: Sequence[tuple[str, DataFrame, str]], order_by: Sequence[str] = ()
) -> DataFrame:
    """Rows whose lookup is in a selection; ``selected`` is (column, parents, parent id).

    Several lookups are an OR. One pass marks each lookup and keeps rows with any mark, so
    a row that qualifies twice is there once without a dedupe of the whole table.
    """
    out, marks = child, []
    for i, (column, parents, parent_id) in enumerate(selected):
        ids = parents.select(F.col(parent_id).alias(f"_p{i}")).where(f"_p{i} IS NOT NULL").distinct()
        if len(selected) == 1:
            return child.join(ids, F.col(column) == F.col("_p0"), "left_semi")
        out = out.join(ids, F.col(column) == F.col(f"_p{i}"), "left")
        marks.append(F.col(f"_p{i}").isNotNull())
    return out.where(functools.reduce(lambda a, b: a | b, marks)).select(*every(child))


def referenced_ids(children: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct ids that the children point to."""
    parts = [
        df.select(F.col(column).alias("_pid")).where("_pid IS NOT NULL").distinct()
        for df, column in children
    ]
    return functools.reduce(DataFrame.unionByName, parts).distinct()


def parents_of(parent: DataFrame, parent_id: str, children: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose id some selected child uses. A self-lookup counts as well."""
    return parent.join(referenced_ids(children), F.col(parent_id) == F.col("_pid"), "left_semi")


def unseen(keys: DataFrame, seen: DataFrame, column: str) -> DataFrame:
    """Keys that no earlier pass has read."""
    done = seen.select(F.col(column).alias("_seen")).distinct()
    return keys.select(column).distinct().join(done, F.col(column) == F.col("_seen"), "left_anti")


def with_self_references(
    table: DataFrame, id_column: str, parent_column: str, selected: DataFrame, max_hops: int | None = None
) -> DataFrame:
    """The selected rows and all rows they point to, directly or over others.

    Only ids move. The walk starts hop by hop, each hop a join of the ids found last. Where these are a large
    share of the table, and after ``EARLY_HOPS``, it goes on in larger steps: the links that lead on to rows not reached yet are joined with
    themselves, so that every round doubles the distance and a chain of h rows takes log(h) rounds. A round
    without new ids ends the walk; rings end it as well. With ``max_hops`` all of it goes hop by hop and
    stops there. The rows are fetched once.
    """
    links = table.select(F.col(id_column).alias("_id"), F.col(parent_column).alias("_up")).where("_id IS NOT NULL AND _up IS NOT NULL")
    frontier = cut_lineage(selected.select(F.col(id_column).alias("_id")).where("_id IS NOT NULL").distinct())
    ids, closed, hops = frontier, None, 0
    many = links.count() * LARGE_SHARE if max_hops is None else None
    while (size := frontier.count()) and hops != max_hops:
        if max_hops is None and (hops == EARLY_HOPS or size > many):
            onward = links if closed is None else links.join(closed, "_id", "left_anti")
            onward = onward.join(ids.withColumnRenamed("_id", "_up"), "_up", "left_anti")
            ids = ids.unionByName(_by_doubling(onward, frontier))
            break
        found = cut_lineage(_one_up(links, frontier).join(ids, "_id", "left_anti"))
        closed, frontier, hops = ids, found, hops + 1
        ids = ids.unionByName(found)
    return table.join(ids, F.col(id_column) == F.col("_id"), "left_semi")


def _one_up(links: DataFrame, start: DataFrame) -> DataFrame:
    return links.join(start, "_id", "left_semi").select(F.col("_up").alias("_id")).distinct()


def _by_doubling(links: DataFrame, start: DataFrame) -> DataFrame:
    """The ids that ``start`` leads to over any number of links, ``start`` itself left out."""
    jumps, reached = cut_lineage(links.select("_id", "_up").distinct()), start
    while True:
        found = cut_lineage(_one_up(jumps, reached).join(reached, "_id", "left_anti"))
        if found.isEmpty():
            return reached.join(start, "_id", "left_anti")
        reached = reached.unionByName(found)
        second = jumps.select(F.col("_id").alias("_up"), F.col("_up").alias("_far"))
        jumps = cut_lineage(jumps.join(second, "_up").select("_id", F.col("_far").alias("_up")).distinct())
