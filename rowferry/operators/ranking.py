"""Row order: first and last row per key, ordinals, sequences and chunks.

Picking a row per key is written as an aggregate, not as a window. The aggregate keeps one
row per key on the map side, so a key with a third of all rows costs one row per task.

Ordinals need every row. For a key that is too large for one task, ``rank_rows`` deals its rows
by range over the whole order, ties by a hash of the row, ranks each range on its own and adds
the row counts of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.names import column, every, flat, quoted
from rowferry.session import cut_lineage

_SEGMENTS = 32

#: A key with more rows than this is not ranked by one task.
HOT_ROWS = 1_000_000


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], chooser) -> DataFrame:
    payload = [name for name in df.columns if name not in keys]
    if not payload:
        return df.distinct()
    if len(payload) == 1 and len(order_by) == 1:
        # Plain columns keep the buffer fixed-width, so this stays a hash aggregate.
        return (
            df.groupBy(*flat(keys))
            .agg(chooser(quoted(payload[0]), quoted(order_by[0])).alias(payload[0]))
            .select(*every(df))
        )
    picked = chooser(F.struct(*flat(payload)), F.struct(*flat(order_by)))
    return (
        df.groupBy(*flat(keys))
        .agg(picked.alias("_row"))
        .select(*flat(keys), "_row.*")
        .select(*every(df))
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in ``order_by``."""
    return _pick(df, keys, order_by, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in ``order_by``."""
    return _pick(df, keys, order_by, F.max_by)


def _flag(df, keys, order_by, name, chooser) -> DataFrame:
    chosen = (
        df.groupBy(*flat(keys))
        .agg(chooser(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(flat(order_by))])).alias("_chosen"))
        .select(*[c.alias(f"_k{i}") for i, c in enumerate(flat(keys))], "_chosen.*", F.lit(True).alias("_hit"))
    )
    # The order columns identify a row, so joining on them as well spreads a hot key.
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & F.col(quoted(k)).eqNullSafe(F.col(f"_k{i}"))
    for i, o in enumerate(order_by):
        condition = condition & F.col(quoted(o)).eqNullSafe(F.col(f"_o{i}"))
    return (
        df.join(chosen, condition, "left")
        .withColumn(name, F.coalesce("_hit", F.lit(False)))
        .select(*every(df), name)
    )


def flag_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """All rows, with a flag that is true on the first row of each key."""
    return _flag(df, keys, order_by, name, F.min)


def flag_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """All rows, with a flag that is true on the last row of each key."""
    return _flag(df, keys, order_by, name, F.max)


def _as_number(df: DataFrame, name: str) -> Column | None:
    kind, value = df.schema[name].dataType, F.col(quoted(name))
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp").cast("double")
    return None


def _cell_of(name: str, bounds: list[float], per_segment: int) -> Column:
    """Order-preserving cell number, linear between neighbouring ``bounds``."""

    def branch(low: int, high: int) -> str:
        if high - low == 1:
            start, end = bounds[low], bounds[high]
            if end <= start:
                return str(low * per_segment)
            scale = per_segment / (end - start)
            step = f"floor(({name} - {start!r}D) * {scale!r}D)"
            return f"{low * per_segment} + least(greatest({step}, 0), {per_segment - 1})"
        middle = (low + high) // 2
        return f"CASE WHEN {name} < {bounds[middle]!r}D THEN {branch(low, middle)} ELSE {branch(middle, high)} END"

    return F.coalesce(F.expr(branch(0, len(bounds) - 1)).cast("long"), F.lit(-1))


def _ranges(df: DataFrame) -> int:
    """Into how many ranges rows are dealt: up to four times the session's shuffle partitions, as far as
    map tasks still write straight to a file per range. With more they buffer and sort all they read."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unbuffered = int(df.sparkSession.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(partitions, min(4 * partitions, unbuffered))


def with_cells(
    df: DataFrame, order_by: Sequence[str], name: str = "_cell", cells: int | None = None
) -> DataFrame:
    """Adds a cell number that never falls as the rows rise in ``order_by``.

    Numbers, dates and timestamps: a small quantile sketch of the first order column is read
    up front (one job over that column alone, 33 numbers come back) and turned into literals,
    so a retried task computes the same cell. Other types: the rows are range-partitioned and
    the partition number is kept in a checkpoint, which is as stable.

    The first order column should be close to unique, since rows equal in it share a cell.
    """
    wanted = cells or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = _as_number(df, order_by[0])
    if number is None:
        ranged = df.repartitionByRange(cells or _ranges(df), *flat(order_by))
        return cut_lineage(ranged.withColumn(name, F.spark_partition_id().cast("long")))
    probabilities = [i / _SEGMENTS for i in range(_SEGMENTS + 1)]
    finite = df.select(number.alias("_v")).where("_v IS NOT NULL AND abs(_v) < double('Infinity')")
    bounds = finite.agg(F.percentile_approx("_v", probabilities, 2000).alias("b")).first()["b"]
    if not bounds:
        return df.withColumn(name, F.lit(0).cast("long"))
    cell = _cell_of("_cell_value", bounds, max(1, wanted // _SEGMENTS))
    cell = F.when(F.isnan("_cell_value"), F.lit(1 << 40)).otherwise(cell)  # NaN comes last
    return df.withColumn("_cell_value", number).withColumn(name, cell).drop("_cell_value")


_ZERO = {T.StringType: "", T.BooleanType: False}


def _key_parts(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """The keys as columns without nulls, so that plain equality compares them."""
    parts: dict[str, Column] = {}
    for i, key in enumerate(keys):
        kind, value = df.schema[key].dataType, F.col(quoted(key))
        if isinstance(kind, (T.StringType, T.BooleanType, T.NumericType)):
            zero = F.lit(_ZERO.get(type(kind), 0)).cast(kind)
            parts[f"_k{i}"], parts[f"_n{i}"] = F.coalesce(value, zero), value.isNull()
        else:
            parts[f"_k{i}"] = F.struct(value)
    return parts


def _row_hash(df: DataFrame) -> Column:
    """Tells rows apart that are equal in the order columns."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*flat(plain))


def deal_by_range(df: DataFrame, parts: dict[str, Column], order_by: Sequence[str], cells: int | None = None) -> DataFrame:
    """The rows with the key columns, ``_row_hash`` and ``_range``, a number that never falls in the order.

    The ranges are over key, order and row hash, in the order that a window sorts by (nulls first, NaN
    last), so a value that many rows share in the first order columns fills as many ranges as it needs.
    The dealt rows are checkpointed: counts and ordinals are of the same rows, whatever is run again.
    """
    wanted = cells or _ranges(df)
    order = [*flat(order_by), F.col("_row_hash")]
    marked = df.withColumn("_row_hash", _row_hash(df)).withColumns(parts)
    return cut_lineage(marked.repartitionByRange(wanted, *parts, *order).withColumn("_range", F.spark_partition_id()))


def _rank_by_ranges(df: DataFrame, parts: dict[str, Column], order_by: Sequence[str], name: str, cells: int | None) -> DataFrame:
    """``row_number`` per key over rows that are dealt by range."""
    names, order = list(parts), [*flat(order_by), F.col("_row_hash")]
    dealt = deal_by_range(df, parts, order_by, cells)
    at = [*names, "_range"]
    counts = dealt.groupBy(*at).count()
    earlier = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(c).alias(f"_at{i}") for i, c in enumerate(at)], F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    local = dealt.withColumn("_local", F.row_number().over(Window.partitionBy(*at).orderBy(*order)))
    same = [F.col(c).eqNullSafe(F.col(f"_at{i}")) for i, c in enumerate(at)]
    return local.join(before, same).withColumn(name, (F.col("_local") + F.col("_before")).cast("long")).select(*every(df), name)


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str = "_rn",
    cells: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact ``row_number`` per key, or over all rows when ``keys`` is empty.

    Keys of at most ``hot_rows`` rows are ranked by a plain window. Whether there are larger
    ones is asked up front: a count per key, combined before the shuffle, over the key columns
    alone. The few keys found are checkpointed, and only their rows are dealt by range. Rows that
    are equal in all order columns follow each other by a hash of the row.
    """
    parts = _key_parts(df, keys)
    names = list(parts)
    if not keys:
        return _rank_by_ranges(df, {}, order_by, name, cells)
    counted = df.select(*[c.alias(n) for n, c in parts.items()]).groupBy(*names).count()
    hot = counted.where(F.col("count") > hot_rows).select(*[F.col(n).alias(f"_hot{n}") for n in names])
    hot = cut_lineage(hot)
    within = Window.partitionBy(*flat(keys)).orderBy(*flat(order_by))
    if hot.isEmpty():
        return df.withColumn(name, F.row_number().over(within).cast("long"))
    # one row per hot key; Spark decides by size how to join it
    same = [parts[n] == F.col(f"_hot{n}") for n in names]
    cold = df.join(hot, same, "left_anti").withColumn(name, F.row_number().over(within).cast("long"))
    return _rank_by_ranges(df.join(hot, same, "left_semi"), parts, order_by, name, cells).unionByName(cold)


def duplicate_names(
    df: DataFrame, values_of: str, order_by: Sequence[str], name: str = "_unique"
) -> DataFrame:
    """The value for its first row, then ``value_0``, ``value_1`` and so on."""
    ranked = rank_rows(df, [values_of], order_by, "_rn")
    text = column(df, values_of).cast("string")
    return ranked.withColumn(
        name,
        F.when(F.col("_rn") == 1, text).otherwise(
            F.concat(text, F.lit("_"), (F.col("_rn") - 2).cast("string"))
        ),
    ).drop("_rn")


def chunks(df: DataFrame, order_by: Sequence[str], size: int, name: str = "chunk") -> DataFrame:
    """Number of the batch of ``size`` rows a row falls in, from 0."""
    ranked = rank_rows(df, [], order_by, "_rn")
    return ranked.withColumn(name, F.floor((F.col("_rn") - 1) / size)).drop("_rn")
