"""Size-bound batches.

A batch takes rows in order until the next one would pass the limit. Where a batch begins thus
depends on all rows before it. Every row therefore gets a link to the row that would begin the next
batch if a batch began with it: running sums and an as-of search give it. The batches are the path of
links from the first row. It is followed by doubling: within blocks of ``BLOCK`` rows by arrays, and
over the rows through which a block can be entered by joins, so that no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.names import every
from rowferry.operators.ranking import rank_rows, with_cells
from rowferry.session import cut_lineage

#: Rows that one task follows at a time.
BLOCK = 1 << 16


def last_starts(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a block the last batch start on its path, and the number of links to it.
    ``link`` is the place of the next start; places from its length on lie outside."""
    n = len(link)
    jump, steps = np.where(link < n, link, np.arange(n)), (link < n).astype(np.int64)
    for _ in range(max(n, 2).bit_length()):
        steps, jump = steps + steps[jump], jump[jump]
    return jump, steps


def starts_from(link: np.ndarray, entry: int) -> np.ndarray:
    """Whether a batch begins at each row of a block, if one begins at ``entry``."""
    n = len(link)
    jump = np.append(np.minimum(link, n), n)
    on_path = np.zeros(n + 1, bool)
    on_path[entry] = True
    for _ in range(max(n, 2).bit_length()):
        on_path[jump[on_path]] = True
        jump = jump[jump]
    return on_path[:n]


def _running(rows: DataFrame) -> DataFrame:
    """Adds ``_from`` and ``_to``, the sums of sizes before and after each row of its group."""
    within = Window.partitionBy("_group", "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_group", "_block").agg(F.sum("_size").alias("_total"))
    carried = totals.select("_group", "_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry"))
    summed = rows.withColumn("_local", F.sum("_size").over(within)).join(carried, ["_group", "_block"])
    to = F.col("_carry") + F.col("_local")
    return summed.select("_group", "_block", "_pos", (to - F.col("_size")).alias("_from"), to.alias("_to"))


def _linked(rows: DataFrame, limit: float) -> DataFrame:
    """Adds ``_next``: where the next batch begins if one begins here; null after the last.

    The first row whose sum passes ours plus the limit is found on one line of all sums and all
    asked values, each value once, cut into cells. Within a cell a window looks ahead, beyond it a
    minimum over one row per cell.
    """
    asked = F.col("_from") + F.lit(limit)
    sums = rows.groupBy("_group", F.col("_to").alias("_at")).agg(F.min("_pos").alias("_first")).withColumn("_asks", F.lit(False))
    asks = rows.select("_group", asked.alias("_at")).distinct().select("_group", "_at", F.lit(None).cast("bigint").alias("_first"), F.lit(True).alias("_asks"))
    line = with_cells(sums.unionByName(asks), ["_at"], "_cell")
    ahead = Window.partitionBy("_group", "_cell").orderBy(F.desc("_at"), F.desc("_asks")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy("_group").orderBy(F.desc("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = line.groupBy("_group", "_cell").agg(F.min("_first").alias("_least"))
    beyond = beyond.select("_group", "_cell", F.min("_least").over(later).alias("_beyond"))
    found = line.withColumn("_here", F.min("_first").over(ahead)).where("_asks").join(beyond, ["_group", "_cell"])
    found = found.select(F.col("_group").alias("_g"), F.col("_at").alias("_v"), F.least("_here", "_beyond").alias("_next"))
    ends = rows.groupBy("_group").agg(F.max("_pos").alias("_end")).withColumnRenamed("_group", "_h")
    alone = F.when(F.col("_pos") < F.col("_end"), F.col("_pos") + 1)  # after a row that is over the limit by itself
    linked = rows.join(found, (F.col("_group") == F.col("_g")) & (asked == F.col("_v"))).join(ends, F.col("_group") == F.col("_h"))
    after = F.when(F.col("_next") == F.col("_pos"), alone).otherwise(F.col("_next"))
    return linked.select("_group", "_block", "_pos", after.alias("_next"))


def _block_of(position: Column, block: int) -> Column:
    return F.floor((position - 1) / block)


def _entries(links: DataFrame, block: int) -> DataFrame:
    """Where the path enters blocks: ``_group``, ``_block``, ``_entry`` and ``_batch``, the number of
    the batch that begins there."""
    first = links.groupBy("_group").agg(F.min("_pos").alias("_entry"))
    crossing = links.where(_block_of(F.col("_next"), block) > F.col("_block"))
    possible = crossing.select("_group", F.col("_next").alias("_entry")).unionByName(first).distinct()
    possible = possible.withColumnRenamed("_group", "_g")
    flagged = links.join(possible, (F.col("_group") == F.col("_g")) & (F.col("_pos") == F.col("_entry")), "left")
    flagged = flagged.select("_group", "_block", "_pos", "_next", F.col("_entry").isNotNull().alias("_enters"))

    def exits(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_pos")
        last, steps = last_starts(_places(part))
        rows = np.flatnonzero(part["_enters"])
        leads = part["_next"].to_numpy()[last[rows]]
        out = pd.DataFrame({"_group": part["_group"].iloc[:1].repeat(len(rows)), "_entry": part["_pos"].to_numpy()[rows], "_to": pd.array(leads, "Int64"), "_batches": steps[rows] + 1})
        return out[out["_to"].notna()]

    jumps = cut_lineage(flagged.groupBy("_group", "_block").applyInPandas(exits, "_group string, _entry bigint, _to bigint, _batches bigint"))
    reached = cut_lineage(first.withColumn("_batch", F.lit(0).cast("bigint")))
    while not jumps.isEmpty():
        step = jumps.select(F.col("_group").alias("_g"), F.col("_entry").alias("_e"), "_to", "_batches")
        at = (F.col("_group") == F.col("_g")) & (F.col("_entry") == F.col("_e"))
        new = reached.join(step, at).select("_group", F.col("_to").alias("_entry"), (F.col("_batch") + F.col("_batches")).alias("_batch"))
        reached = cut_lineage(reached.unionByName(new).distinct())
        far = step.withColumnsRenamed({"_to": "_far", "_batches": "_more"})
        twice = jumps.join(far, (F.col("_group") == F.col("_g")) & (F.col("_to") == F.col("_e")))
        jumps = cut_lineage(twice.select("_group", "_entry", F.col("_far").alias("_to"), (F.col("_batches") + F.col("_more")).alias("_batches")))
    return reached.withColumn("_block", _block_of(F.col("_entry"), block))


def _places(part: pd.DataFrame) -> np.ndarray:
    """The links of a block as places in it; null and later blocks lie outside."""
    link = part["_next"].to_numpy(np.float64, na_value=np.inf) - float(part["_pos"].iloc[0])
    return np.where(link < len(part), link, len(part)).astype(np.int64)


def size_batches(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[str],
    size: str,
    limit: float,
    name: str = "batch",
    block: int = BLOCK,
) -> DataFrame:
    """Adds the batch number within each group, from 0. Order columns identify a row.

    A row that is over the limit by itself is a batch of its own. Null sizes count as 0, negative ones
    as well. Sums of whole numbers are exact.
    """
    whole = isinstance(df.schema[size].dataType, T.IntegralType)
    group = F.to_json(F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group_by)])) if group_by else F.lit("")
    ranked = rank_rows(df, group_by, order_by, "_pos").withColumn("_group", group)
    amount = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint" if whole else "double")
    rows = cut_lineage(ranked.select("_group", "_pos", _block_of(F.col("_pos"), block).alias("_block"), amount.alias("_size")))
    bound = int(limit) if whole else float(limit)
    links = cut_lineage(_linked(cut_lineage(_running(rows)), bound))
    entries = _entries(links, block)

    def number(part: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_pos")
        first, begins = int(part["_pos"].iloc[0]), np.zeros(len(part), bool)
        batch = -1
        if len(entry):
            begins, batch = starts_from(_places(part), int(entry["_entry"].iloc[0]) - first), int(entry["_batch"].iloc[0])
        own = batch + np.cumsum(begins) - 1
        return part[["_group", "_block", "_pos"]].assign(_own=np.where(np.cumsum(begins) > 0, own, -1))

    numbered = links.groupBy("_group", "_block").cogroup(entries.groupBy("_group", "_block")).applyInPandas(number, "_group string, _block bigint, _pos bigint, _own bigint")
    numbered = cut_lineage(numbered)
    # rows before a block's entry are in the batch that is open when the block begins
    open_ = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    last = numbered.groupBy("_group", "_block").agg(F.max("_own").alias("_last"))
    last = last.select(F.col("_group").alias("_g"), F.col("_block").alias("_b"), F.max("_last").over(open_).alias("_open"))
    batches = numbered.join(last, (F.col("_group") == F.col("_g")) & (F.col("_block") == F.col("_b")))
    batches = batches.select(F.col("_group").alias("_g"), F.col("_pos").alias("_p"), F.when(F.col("_own") >= 0, F.col("_own")).otherwise(F.col("_open")).alias("_batch"))
    return ranked.join(batches, (F.col("_group") == F.col("_g")) & (F.col("_pos") == F.col("_p"))).withColumn(name, F.col("_batch")).select(*every(df), name)


def block_batches(df: DataFrame, order_by: Sequence[str], text: str, limit: int, block_rows: int, name: str = "chunk") -> DataFrame:
    """Rows go in blocks of ``block_rows``; blocks fill a chunk up to ``limit`` bytes.

    Bytes are those of the row as CSV text with its line end.
    """
    from rowferry.operators.ranking import chunks

    blocked = chunks(df, order_by, block_rows, "_block")
    sizes = blocked.groupBy("_block").agg(F.sum(F.octet_length(text) + 1).alias("_bytes"))
    packed = size_batches(sizes, [], ["_block"], "_bytes", limit, name).select("_block", name)
    return blocked.join(packed, "_block").select(*every(df), name)
