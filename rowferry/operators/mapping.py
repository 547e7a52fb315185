"""Value mapping and computed mapping."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.cells import strip
from rowferry.functions.names import every, quoted
from rowferry.session import cut_lineage
from rowferry.spec import ValueRule

# Fixed values.
_REGEX_RULE = re.compile(r"^/(.*)/$", re.DOTALL)
_EVAL = r"(?is)^eval[(](.*)[)]$"
_TRUE = ("TRUE", "true")
_FALSE = ("FALSE", "false")
_NULL = ("null", "NULL", "undefined", "#N/A")

# Up to this many literal rules become a map inside the expression; more become a join.
MAX_INLINE_RULES = 200


@dataclass(frozen=True)
class RuleTable:
    """A rule table of any size: ``rows`` (ObjectName, FieldName, RawValue, Value), in the order of
    ``order_by``, which later rules come last in. It stays a DataFrame and is joined by value. Only what
    is code goes through the driver: the one regular expression of each column, and the different
    ``eval(...)`` texts, each once however many rules have it."""

    rows: DataFrame
    order_by: tuple[str, ...]

    def of(self, table: str, columns: Sequence[str]) -> DataFrame:
        """``_field``, ``_k``, ``_v`` and ``_seen``: the last value of each raw value, empty ones too,
        and where the raw value stands first."""
        text = lambda c: F.coalesce(strip(F.col(c).cast("string")), F.lit(""))
        rows = self.rows.where(text("ObjectName") == table).select(
            text("FieldName").alias("_field"), text("RawValue").alias("_k"), text("Value").alias("_v"), F.struct(*self.order_by).alias("_order")
        )
        named = rows.where(F.col("_field").isin(*columns))
        return named.groupBy("_field", "_k").agg(F.max_by("_v", "_order").alias("_v"), F.min("_order").alias("_seen"))


@dataclass(frozen=True)
class FieldRules:
    """The rules of one column: literal values and the one regular expression that counts."""

    literal: dict[str, str]
    pattern: str | None = None
    pattern_key: str | None = None
    replacement: str | None = None
    table: DataFrame | None = None
    evals: tuple[str, ...] = ()


def rules_for(rules: Sequence[ValueRule], table: str, column: str) -> FieldRules:
    """A later rule for the same raw value takes the place of an earlier one, and so do regexes."""
    values: dict[str, str] = {}
    for rule in rules:
        if rule.table == table and rule.column == column:
            values[rule.raw.strip()] = (rule.value or "").strip()
    pattern = key = replacement = None
    for raw, value in values.items():
        found = _REGEX_RULE.match(raw)
        if found:
            # An empty value switches the regular expression off.
            pattern, key, replacement = (found.group(1) if value else None), raw, value
    return FieldRules({r: v for r, v in values.items() if v}, pattern, key, replacement)


def rules_from_table(df: DataFrame, limit: int = 100_000) -> list[ValueRule]:
    """The rule table (ObjectName, FieldName, RawValue, Value) as rules. Its size is checked; a
    ``RuleTable`` has no such bound."""
    rows = df.select("ObjectName", "FieldName", "RawValue", "Value").take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"more than {limit} value rules")
    return [ValueRule(*[(cell or "").strip() for cell in row]) for row in rows]


def _expression(sql: str) -> Column:
    return F.expr(re.sub(r"(?i)\bRAW_VALUE\b", "_raw", sql))


def _evaluated(df: DataFrame, value: str) -> Column:
    """A rule value as a column: T2 for ``eval(...)``, the text itself otherwise.

    ``RAW_VALUE`` is the raw text. An expression that does not compile gives the raw text, and
    so does one that gives null at run time; ``try_`` functions turn failures into null.
    """
    found = re.match(_EVAL, value)
    if not found:
        return F.lit(value)
    try:
        column = F.coalesce(_expression(found.group(1)).cast("string"), F.col("_raw"))
        df.select(column)
        return column
    except (AnalysisException, ParseException):
        return F.col("_raw")


def _typed(value: str, column: Column) -> Column:
    text = value.strip()
    if text in _TRUE:
        return F.lit("true")
    if text in _FALSE:
        return F.lit("false")
    if text in _NULL:
        return F.lit(None).cast("string")
    return column


def _typed_text(column: Column) -> Column:
    trimmed = strip(column)
    return (
        F.when(trimmed.isin(*_TRUE), "true")
        .when(trimmed.isin(*_FALSE), "false")
        .when(trimmed.isin(*_NULL), F.lit(None).cast("string"))
        .otherwise(column)
    )


def _rules_of_table(rules: RuleTable, table: str, columns: Sequence[str]) -> dict[str, FieldRules]:
    """The rules of each column, literal ones as a table (``_k``, ``_v``)."""
    last = cut_lineage(rules.of(table, columns))
    is_regex, is_eval = F.col("_k").rlike(r"(?s)^/.*/$"), F.col("_v").rlike(_EVAL)
    regex = last.where(is_regex).groupBy("_field").agg(F.max_by(F.struct("_k", "_v"), "_seen").alias("r"))
    regexes = {r["_field"]: r["r"] for r in regex.collect()}  # a row per column
    evals: dict[str, list[str]] = {}
    for row in last.where(is_eval).select("_field", "_v").distinct().orderBy("_field", "_v").collect():  # code, not data
        evals.setdefault(row["_field"], []).append(row["_v"])
    filled = {r["_field"] for r in last.where("_v <> ''").select("_field").distinct().collect()}
    out = {}
    for name in columns:
        if name in filled:
            raw, value = regexes.get(name, (None, None))
            pattern = _REGEX_RULE.match(raw).group(1) if value else None
            own = last.where((F.col("_field") == name) & (F.col("_v") != "")).select("_k", "_v")
            out[name] = FieldRules({}, pattern, raw, value, own, tuple(evals.get(name, ())))
    return out


def _groups(pattern: str) -> int:
    try:
        return re.compile(pattern).groups
    except re.error:
        return len(re.findall(r"(?<!\\)\((?!\?)", pattern))


def replacement_text(pattern: str, value: str) -> str:
    """A replacement as users write it, for the regular expressions of the JVM: ``$1`` stands for a
    group that the pattern has, ``$&`` for the match, ``$$`` for a dollar; all else is text."""
    groups = _groups(pattern)

    def swap(found: re.Match) -> str:
        text = found.group(0)
        if text in ("\\", "$$", "$&"):
            return {"\\": "\\\\", "$$": "\\$", "$&": "$0"}[text]
        for digits in (text[1:], text[1:2]):
            if digits and 1 <= int(digits) <= groups:
                return f"${int(digits)}" + text[1 + len(digits) :]
        return "\\" + text

    return re.sub(r"\\|\$(?:\$|&|\d\d?)?", swap, value)


def _replacement(df: DataFrame, rules: FieldRules) -> Column:
    if re.match(_EVAL, rules.replacement):
        return F.regexp_replace(_evaluated(df, rules.replacement), r"([\\$])", r"\\$1")
    return F.lit(replacement_text(rules.pattern, rules.replacement))


def map_values(
    df: DataFrame, table: str, rules: Sequence[ValueRule] | RuleTable, columns: Sequence[str] | None = None, hits: bool = False
) -> DataFrame:
    """Applies the rules of ``table`` to each of its columns.

    The value is taken as trimmed text, null as empty text. A regular expression replaces its
    matches in any case; the result, and if that is empty the raw value, is looked up among
    the literal rules. ``true``, ``false`` and null words become typed. A mapped column is
    text, also where no rule hits. ``hits`` adds ``<column>__rules``, the rules that applied.
    """
    out, names = df, list(columns or df.columns)
    of_table = _rules_of_table(rules, table, names) if isinstance(rules, RuleTable) else None
    for name in names:
        found = rules_for(rules, table, name) if of_table is None else of_table.get(name, FieldRules({}))
        if found.literal or found.pattern or found.table is not None:
            out = _map_column(out, name, found, hits)
    return out


def _map_column(df: DataFrame, name: str, rules: FieldRules, hits: bool) -> DataFrame:
    raw = strip(F.coalesce(F.col(quoted(name)).cast("string"), F.lit("")))
    out = df.withColumn("_raw", raw)
    if rules.pattern:
        pattern = f"(?iu){rules.pattern}"
        swapped = F.regexp_replace(F.col("_raw"), F.lit(pattern), _replacement(out, rules))
        matched = F.col("_raw").rlike(pattern)
        out = out.withColumn("_regex", matched).withColumn("_new", F.when(matched, swapped).otherwise(""))
    else:
        out = out.withColumn("_regex", F.lit(False)).withColumn("_new", F.lit(""))

    if rules.table is not None:
        lookup = _lookup_table
    else:
        lookup = _lookup_map if len(rules.literal) <= MAX_INLINE_RULES else _lookup_join
    if rules.pattern:
        out = lookup(out, rules, "_new", "_by_new")
    else:
        out = out.withColumn("_by_new", F.lit(None).cast("struct<v:string>"))
    out = lookup(out, rules, "_raw", "_by_raw")
    result = (
        F.when((F.col("_new") != "") & F.col("_by_new").isNotNull(), F.col("_by_new.v"))
        .when(F.col("_new") != "", _typed_text(F.col("_new")))
        .when(F.col("_by_raw").isNotNull(), F.col("_by_raw.v"))
        .otherwise(_typed_text(F.col("_raw")))
    )
    kept = [F.col(quoted(c)) if c != name else result.alias(name) for c in df.columns]
    if hits:
        literal = F.when(
            (F.col("_new") != "") & F.col("_by_new").isNotNull(), F.col("_new")
        ).when((F.col("_new") == "") & F.col("_by_raw").isNotNull(), F.col("_raw"))
        regex = F.when(F.col("_regex"), F.lit(rules.pattern_key))
        kept.append(F.array_compact(F.array(regex, literal)).alias(f"{name}__rules"))
    return out.select(*kept)


def _lookup_map(df: DataFrame, rules: FieldRules, key: str, name: str) -> DataFrame:
    result = F.lit(None).cast("struct<v:string>")
    plain = {r: v for r, v in rules.literal.items() if not re.match(_EVAL, v)}
    if plain:
        pairs = [F.lit(x) for raw in plain for x in (raw, raw)]
        known = F.create_map(*pairs)
        values = F.create_map(*[c for raw, v in plain.items() for c in (F.lit(raw), _typed(v, F.lit(v)).cast("string"))])
        hit = F.try_element_at(known, F.col(key)).isNotNull()
        result = F.when(hit, F.struct(F.try_element_at(values, F.col(key)).alias("v")))
    for raw, value in rules.literal.items():
        if raw not in plain:
            result = F.when(F.col(key) == raw, F.struct(_evaluated(df, value).alias("v"))).otherwise(result)
    return df.withColumn(name, result)


def _lookup_join(df: DataFrame, rules: FieldRules, key: str, name: str) -> DataFrame:
    """Many rules: a join with the rule table, which Catalyst broadcasts by its known size."""
    plain = {r: v for r, v in rules.literal.items() if not re.match(_EVAL, v)}
    rows = [(raw, _python_typed(value)) for raw, value in plain.items()]
    table = df.sparkSession.createDataFrame(rows, "_k string, _v string")
    table = table.select("_k", F.struct(F.col("_v").alias("v")).alias(name))
    out = df.join(table, F.col(key) == F.col("_k"), "left").drop("_k")
    for raw, value in rules.literal.items():
        if raw not in plain:
            own = F.struct(_evaluated(df, value).alias("v"))
            out = out.withColumn(name, F.when(F.col(key) == raw, own).otherwise(F.col(name)))
    return out


def _lookup_table(df: DataFrame, rules: FieldRules, key: str, name: str) -> DataFrame:
    """A rule table: one row per raw value, joined by it. Spark splits values that many rows have."""
    known = rules.table.select(F.col("_k").alias("_rk"), F.col("_v").alias("_rv"))
    out = df.join(known, F.col(key) == F.col("_rk"), "left")
    value = F.when(F.col("_rv").isNotNull(), F.struct(_typed_text(F.col("_rv")).alias("v")))
    for text in rules.evals:
        value = F.when(F.col("_rv") == text, F.struct(_evaluated(df, text).alias("v"))).otherwise(value)
    return out.withColumn(name, value).drop("_rk", "_rv")


def _python_typed(value: str) -> str | None:
    if value in _TRUE:
        return "true"
    if value in _FALSE:
        return "false"
    return None if value in _NULL else value


def compute(df: DataFrame, column: str, expression: str) -> DataFrame:
    """The column becomes a Spark SQL expression of ``RAW_VALUE``, its trimmed text."""
    raw = strip(F.coalesce(F.col(quoted(column)).cast("string"), F.lit("")))
    out = df.withColumn("_raw", raw)
    return out.withColumn(column, _evaluated(out, f"eval({expression})")).select(
        *every(df)
    )


def rule_hits(df: DataFrame, table: str, rules: Sequence[ValueRule] | RuleTable, columns: Sequence[str]) -> DataFrame:
    """A5: rows per applied rule, as (object, field, rule, rows). Rules without a hit give 0."""
    mapped = map_values(df, table, rules, columns, hits=True)
    def tagged(name: str) -> Column:
        return F.transform(f"{name}__rules", lambda rule: F.struct(F.lit(name).alias("field"), rule.alias("rule")))

    listed = [tagged(name) for name in columns if f"{name}__rules" in mapped.columns]
    counted = (
        mapped.select(F.explode(F.concat(*listed)).alias("h"))
        .groupBy(F.col("h.field").alias("field"), F.col("h.rule").alias("rule"))
        .agg(F.count("*").alias("rows"))
    )
    if isinstance(rules, RuleTable):
        every = rules.of(table, columns).select(F.col("_field").alias("field"), F.col("_k").alias("rule"))
    else:
        names = [
            (name, rule)
            for name in columns
            for rule in dict.fromkeys(r.raw.strip() for r in rules if r.table == table and r.column == name)
        ]
        every = df.sparkSession.createDataFrame(names, "field string, rule string")
    return every.join(counted, ["field", "rule"], "left").select(
        F.lit(table).alias("object"), "field", "rule", F.coalesce("rows", F.lit(0)).alias("rows")
    )
