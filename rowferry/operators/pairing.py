"""Pairing of two lists in order, duplicates one to one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.keys import row_digest
from rowferry.operators.ranking import rank_rows


def _pair(left, right, left_id, right_id, left_key, right_key, left_order, right_order) -> DataFrame:
    a = left.select(
        left_key.alias("_key"), F.col(left_id).alias("left_id"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(left_order)]
    )
    b = right.select(
        right_key.alias("_key"), F.col(right_id).alias("right_id"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(right_order)]
    )
    a = rank_rows(a, ["_key"], [f"_o{i}" for i in range(len(left_order))])
    b = rank_rows(b, ["_key"], [f"_o{i}" for i in range(len(right_order))])
    b = b.select(F.col("_key").alias("_bkey"), F.col("_rn").alias("_brn"), "right_id")
    same = F.col("_key").eqNullSafe(F.col("_bkey")) & (F.col("_rn") == F.col("_brn"))
    return a.join(b, same, "left").select("_key", F.col("_rn").alias("ordinal"), "left_id", "right_id")


def pair_by_key(
    left: DataFrame,
    right: DataFrame,
    key: str | Column,
    left_id: str,
    right_id: str,
    left_order: Sequence[str],
    right_order: Sequence[str],
    right_key: str | Column | None = None,
) -> DataFrame:
    """The n-th left row of a key goes with the n-th right row of that key.

    (key, ordinal) is unique on both sides, so the join neither multiplies nor skews.
    """
    def as_column(k: str | Column) -> Column:
        return F.col(k) if isinstance(k, str) else k

    out = _pair(left, right, left_id, right_id, as_column(key), as_column(right_key or key), left_order, right_order)
    return out.withColumnRenamed("_key", "pair_key")


def pair_by_content(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    left_order: Sequence[str],
    right_order: Sequence[str],
    exclude: Sequence[str] = (),
) -> DataFrame:
    """As J21, on the digest of the normalised rows without the excluded columns."""
    out = _pair(
        left, right, left_id, right_id,
        row_digest(left, exclude), row_digest(right, exclude), left_order, right_order,
    )
    return out.withColumnRenamed("_key", "digest")
