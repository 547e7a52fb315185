"""The text anonymiser over a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.names import every

from rowferry.functions import masking as M


def anonymize(
    df: DataFrame, column: str, seed: str, known: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """Masks ``column`` in place.

    Each mask is its own projection over a plain column. Nested in one expression, every
    stage would repeat the one before it and the tree would double at each step.

    Which masks a text can need is found once, by plain searches in the text after the known
    values are masked. Tokens put in later end in ``<...>`` and complete none of the marks.
    """
    keep = F.coalesce(M.bypasses(F.col(column)), F.lit(True))
    out = df.withColumn("_keep", keep).withColumn("_text", M.without_marker(F.col(column)))
    asked = F.lower("_text").contains("prompt answer:")
    out = out.withColumn("_masked", M.mask_prompt_answers(F.col("_text"), seed, asked))
    out = out.withColumn("_masked", M.mask_known(F.col("_masked"), known, seed))
    out = out.withColumn("_lower", F.lower("_masked"))
    signs = M.signs(F.col("_masked"), F.col("_lower"))
    out = out.withColumns({f"_is_{name}": sign for name, sign in signs.items()})
    for stage, sign in M.STAGES:
        out = out.withColumn("_masked", stage(F.col("_masked"), seed, F.col(f"_is_{sign}") & ~F.col("_keep")))
    result = F.when(F.col("_keep"), F.col("_text")).otherwise(F.col("_masked"))
    return out.withColumn(column, result).select(*every(df))


def anonymize_values(df: DataFrame, column: str, seed: str, *stages) -> DataFrame:
    """Single masks, such as ``mask_emails``, over a column, one projection each."""
    out = df.withColumn("_lower", F.lower(column))
    wanted = dict(M.STAGES)
    signs = M.signs(F.col(column), F.col("_lower"))
    out = out.withColumns({f"_is_{name}": signs[name] for name in dict.fromkeys(wanted[s] for s in stages)})
    for stage in stages:
        out = out.withColumn(column, stage(F.col(column), seed, F.col(f"_is_{wanted[stage]}")))
    return out.select(*every(df))
