"""J26 with any condition that has an equality or a comparison between the two tables.

A condition is given by its terms ``(theirs, op, ours)`` with ``=``, ``<``, ``<=``, ``>`` or ``>=``, and
a rest that may be any expression. Equalities are join keys. Comparisons that share one column make
that column a point and the others an interval on the other side. Points and bounds become ranks of
their values, so all types that have an order work, without loss.

An interval of ranks is the union of few aligned blocks of 1, 2, 4 .. ranks, two per size at most, and a
point lies in one block of each size. So both sides go to some log(values) blocks, and a point and an
interval that holds it meet in exactly one. Without a rest the other table keeps one row per block before
the join: no pairs are made, and a crowded value costs a row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.names import every, quoted
from rowferry.operators.ranking import rank_rows
from rowferry.session import cut_lineage

Term = tuple[str, str, str]

_TURNED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}
_TESTS = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def first_where(
    df: DataFrame,
    other: DataFrame,
    terms: Sequence[Term],
    value: str,
    order_by: Sequence[str],
    name: str,
    rest: Callable[[dict[str, Column]], Column] | None = None,
    using: Sequence[str] = (),
) -> DataFrame:
    """Adds ``value`` of the first row of ``other``, in ``order_by``, for which the condition holds.

    ``rest`` gets the other table's columns by name and reads ours by ``F.col``; ``using`` lists those
    that it reads. Comparisons that do not share a column with the ones chosen are tested like a rest.
    With such tests every pair that fulfils the other terms is tested once per different set of our
    values; without, no pairs are made. A term with a null does not hold. NaN equals itself and is the largest number.
    No match, and an empty table, give null. A condition without any term is refused.
    """
    for _, op, _ in terms:
        if op != "=" and op not in _TURNED:
            raise ValueError(f"comparison {op} is not supported")
    if not terms:
        raise ValueError("a condition needs an equality or a comparison between the tables")
    equal = [term for term in terms if term[1] == "="]
    ranged, tested = _shared([term for term in terms if term[1] != "="])

    ours = list(dict.fromkeys([*[o for _, _, o in terms], *using]))
    theirs = list(dict.fromkeys(t for t, _, _ in terms))
    asked = df.select(*[F.col(quoted(c)) for c in ours]).where(_filled(o for _, _, o in terms)).distinct()

    best = F.struct(*[F.col(quoted(o)).alias(f"o{i}") for i, o in enumerate(order_by)], F.col(quoted(value)).alias("v"))
    carried = list(other.columns) if rest is not None else theirs
    offered = other.where(_filled(theirs)).select(*[F.col(quoted(c)).alias(_theirs(c)) for c in carried], best.alias("_best"))
    pairwise = rest is not None or bool(tested)
    if not pairwise:
        offered = offered.groupBy(*[quoted(_theirs(c)) for c in theirs]).agg(F.min("_best").alias("_best"))

    keys = [f"_key{i}" for i in range(len(equal))]
    asked = asked.withColumns({k: F.col(quoted(o)) for k, (_, _, o) in zip(keys, equal)})
    offered = offered.withColumns({k: F.col(quoted(_theirs(t))) for k, (t, _, _) in zip(keys, equal)})
    if ranged:
        asked, offered = _in_blocks(asked, offered, ranged)
        keys.append("_block")
    if not pairwise:
        offered = offered.groupBy(*keys).agg(F.min("_best").alias("_best"))
    same = [F.col(k) == F.col(f"_o{k}") for k in keys]
    met = asked.join(offered.withColumnsRenamed({k: f"_o{k}" for k in keys}), same)
    for t, op, o in tested:
        met = met.where(_TESTS[op](F.col(quoted(_theirs(t))), F.col(quoted(o))))
    if rest is not None:
        met = met.where(rest({c: F.col(quoted(_theirs(c))) for c in other.columns}))
    found = met.groupBy(*[quoted(c) for c in ours]).agg(F.min("_best").alias("_best"))
    answers = found.select(*[F.col(quoted(c)).alias(f"_ask{i}") for i, c in enumerate(ours)], F.col("_best.v").alias("_found"))
    match = [F.col(quoted(c)).eqNullSafe(F.col(f"_ask{i}")) for i, c in enumerate(ours)]
    kept = [c for c in every(df) if c != quoted(name)]
    return df.join(answers, match, "left").select(*kept, F.col("_found").alias(name))


def _theirs(name: str) -> str:
    return f"_their {name}"


def _filled(names) -> Column:
    """None of the columns is null."""
    out = F.lit(True)
    for name in names:
        out = out & F.col(quoted(name)).isNotNull()
    return out


def _shared(comparisons: list[Term]) -> tuple[list[Term], list[Term]]:
    """The largest set of comparisons that share a column, and the others."""
    groups: dict[tuple[int, str], list[Term]] = {}
    for side in (2, 0):
        for term in comparisons:
            groups.setdefault((side, term[side]), []).append(term)
    chosen = max(groups.values(), key=len, default=[])
    return chosen, [term for term in comparisons if term not in chosen]


def _in_blocks(asked: DataFrame, offered: DataFrame, terms: list[Term]) -> tuple[DataFrame, DataFrame]:
    """Both sides once per block they go to, in ``_block``."""
    point_is_ours = len({o for _, _, o in terms}) == 1
    if point_is_ours:  # theirs <= ours: their value is a lower bound of our point
        points, point, intervals = asked, terms[0][2], offered
        bounds = [(_theirs(t), _TURNED[op]) for t, op, _ in terms]
    else:
        points, point, intervals = offered, _theirs(terms[0][0]), asked
        bounds = [(o, op) for _, op, o in terms]
    values = points.select(F.col(quoted(point)).alias("_value"))
    for bound, _ in bounds:  # a union widens types as a comparison does
        values = values.union(intervals.select(quoted(bound)))
    kind = values.schema["_value"].dataType
    ranks = cut_lineage(rank_rows(values.distinct(), [], ["_value"], "_rank"))
    last = ranks.agg(F.max("_rank")).first()[0] or 0

    def ranked(df: DataFrame, source: str, target: str) -> DataFrame:
        at = ranks.select(F.col("_value").alias("_at"), F.col("_rank").alias(target))
        return df.join(at, F.col(quoted(source)).cast(kind) == F.col("_at")).drop("_at")

    low, high = [F.lit(1).cast("long")], [F.lit(last).cast("long")]
    for i, (bound, op) in enumerate(bounds):  # point op bound
        intervals = ranked(intervals, bound, f"_bound{i}")
        edge = F.col(f"_bound{i}") + {"<": -1, ">": 1}.get(op, 0)
        (high if op in ("<", "<=") else low).append(edge)
    intervals = intervals.withColumn("_low", F.greatest(*low, F.lit(1))).withColumn("_high", F.least(*high, F.lit(last)))
    sizes = f"sequence(0, {last.bit_length()})"
    start, end = "shiftright(_low + shiftleft(1L, k) - 1, k)", "shiftright(_high + 1, k)"
    cover = f"""filter(flatten(transform({sizes}, k -> array(
        CASE WHEN {start} < {end} AND {start} % 2 = 1 THEN {start} * 64 + k END,
        CASE WHEN {start} < {end} AND {end} % 2 = 1 THEN ({end} - 1) * 64 + k END))), b -> b IS NOT NULL)"""
    intervals = intervals.where("_low <= _high").withColumn("_block", F.explode(F.expr(cover)))
    intervals = intervals.drop("_low", "_high", *[f"_bound{i}" for i in range(len(bounds))])
    around = f"transform({sizes}, k -> shiftright(_rank, k) * 64 + k)"
    points = ranked(points, point, "_rank").withColumn("_block", F.explode(F.expr(around))).drop("_rank")
    return (points, intervals) if point_is_ours else (intervals, points)
