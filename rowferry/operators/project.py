"""Column choice, names and order (P1-P19). All of it is decided on the schema alone."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.names import column, flat, quoted

ERRORS = "Errors"
OLD_ID = "Old Id"
INTERNAL = ("_src_id", "_ord", "_processed")

# The parts of an address.
_ADDRESS_PARTS = (
    "GeocodeAccuracy",
    "City",
    "Country",
    "Latitude",
    "Longitude",
    "PostalCode",
    "State",
    "Street",
)
COMPOUNDS = {
    f"{prefix}Address": [f"{prefix}{part}" for part in _ADDRESS_PARTS]
    for prefix in ("Billing", "Shipping", "Mailing")
}


def _select(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*flat(names))


def project(
    df: DataFrame, columns: Sequence[str], id_column: str, key: Sequence[str] = ()
) -> DataFrame:
    """The listed columns; the id and the external key always come along."""
    return _select(df, dict.fromkeys([*columns, id_column, *key]))


def _flag_of(field: T.StructField, name: str) -> object:
    meta = field.metadata or {}
    if name == "readonly":
        return not (meta.get("createable", True) or meta.get("updateable", True))
    if name == "standard":
        return not meta.get("custom", False)
    if name == "type":
        return str(meta.get("type", field.dataType.simpleString())).lower()
    default = name in ("createable", "updateable")
    return bool(meta.get(name, default))


def by_keyword(df: DataFrame, keywords: Sequence[str], restricted: Sequence[str] = ()) -> DataFrame:
    """Columns that match every keyword: ``all``, ``lookup_true``, ``type_string``, ...

    Flags are read from the metadata of the schema. Lookups in ``restricted`` are left out.
    """
    wanted: dict[str, object] = {}
    for keyword in keywords:
        name, _, value = keyword.lower().partition("_")
        if name != "all":
            wanted[name] = {"true": True, "false": False}.get(value, value)
    take_all = "all" in [keyword.lower() for keyword in keywords]
    chosen = []
    for field in df.schema.fields:
        if field.name in restricted and _flag_of(field, "lookup"):
            continue
        if take_all or all(_flag_of(field, name) == value for name, value in wanted.items()):
            chosen.append(field.name)
    return _select(df, chosen)


def expand_compounds(columns: Sequence[str]) -> list[str]:
    """Address names become their parts."""
    return [part for name in columns for part in COMPOUNDS.get(name, [name])]


def select_compounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As above, and struct columns become their fields."""
    chosen = []
    for name in expand_compounds(columns):
        if name in df.columns and isinstance(df.schema[name].dataType, T.StructType):
            chosen.append(F.col(f"{quoted(name)}.*"))
        else:
            chosen.append(F.col(quoted(name)))
    return df.select(*chosen)


def exclude(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Drops columns, named in a list or in text split at ``;``, in any case."""
    names = columns.split(";") if isinstance(columns, str) else columns
    unwanted = {name.strip().lower() for name in names}
    return _select(df, [name for name in df.columns if name.lower() not in unwanted])


def known_columns(df: DataFrame, wanted: Sequence[str], *others: DataFrame) -> list[str]:
    """The wanted columns that ``df`` and every other frame have, as spelled in ``df``."""
    spelled = {name.lower(): name for name in df.columns}
    found = []
    for name in wanted:
        lower = name.lower()
        everywhere = lower in spelled and all(
            lower in {c.lower() for c in other.columns} for other in others
        )
        if everywhere:
            found.append(spelled[lower])
        else:
            warnings.warn(f"column {name} is not in every table and is left out", stacklevel=2)
    return list(dict.fromkeys(found))


def prune_unknown(df: DataFrame, wanted: Sequence[str], *others: DataFrame) -> DataFrame:
    """P5: the wanted columns that exist on both sides; the others are dropped with a warning."""
    return _select(df, known_columns(df, wanted, *others))


def writable(
    df: DataFrame,
    target_schema: T.StructType,
    id_column: str,
    mapped: Sequence[str] = (),
    excluded: Sequence[str] = (),
    extra: Sequence[str] = (),
) -> DataFrame:
    """The id and the columns that the target lets be created or updated.

    ``mapped`` columns are kept whatever the metadata says, ``excluded`` ones never.
    """
    fields = {field.name.lower(): field for field in target_schema.fields}

    def keeps(name: str) -> bool:
        if name in excluded:
            return False
        if name == id_column or name in mapped or name in extra:
            return True
        field = fields.get(name.lower())
        if field is None:
            return False
        return bool(_flag_of(field, "createable") or _flag_of(field, "updateable"))

    return _select(df, [name for name in df.columns if keeps(name)])


def for_operation(df: DataFrame, forbidden: Sequence[str], id_column: str) -> DataFrame:
    """Drops what an insert or update must not write; the id stays."""
    return _select(df, [n for n in df.columns if n == id_column or n not in forbidden])


def rename_map(
    rules: Sequence[tuple[str, str, str]], table: str
) -> tuple[str, dict[str, str]]:
    """Target table name and column map from (table, column, target) rows.

    An empty column renames the table. The first row for a name counts.
    """
    target, columns = table, {}
    for rule_table, field, to in rules:
        if rule_table.lower() != table.lower():
            continue
        if not field:
            target = to if target == table else target
        else:
            columns.setdefault(field, to)
    return target, columns


def _polymorphic(name: str, mapping: dict[str, str]) -> str:
    field, _, table = name.partition("$")
    return mapping.get(field, field) + ("$" + mapping.get(table, table) if table else "")


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Source names to target names. ``A.b`` follows its lookup, ``A$B`` goes part by part."""
    lower = {key.lower(): value for key, value in mapping.items()}

    def to(name: str) -> str:
        if name.lower() in lower:
            return lower[name.lower()]
        if "$" in name:
            return _polymorphic(name, mapping)
        head, dot, rest = name.partition(".")
        return lower[head.lower()] + dot + rest if dot and head.lower() in lower else name

    return df.toDF(*[to(name) for name in df.columns])


def rename_back(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Target names to source names."""
    return rename(df, {target: source for source, target in mapping.items()})


def relationship(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """``Parent.Field`` paths through structs, each as a flat column of that name."""
    return df.select(*[column(df, path).alias(path) for path in paths])


def ordered_columns(columns: Sequence[str], keep_order: bool = False) -> list[str]:
    """Id, then Old Id, the rest (by name unless ``keep_order``), Errors last."""
    id_first = [c for c in columns if c == "Id"]
    old = [c for c in columns if c.lower() == OLD_ID.lower()]
    errors = [c for c in columns if c.lower() == ERRORS.lower()]
    middle = [c for c in columns if c not in (*id_first, *old, *errors)]
    return [*id_first, *old, *(middle if keep_order else sorted(middle)), *errors]


def order_columns(df: DataFrame, keep_order: bool = False) -> DataFrame:
    return _select(df, ordered_columns(df.columns, keep_order))


def repair_names(df: DataFrame, canonical: Sequence[str], drop_others: bool = False) -> DataFrame:
    """Trimmed names in the spelling of the spec.

    Where a column is there in several spellings, the exact one wins, else the first.
    """
    spelling = {name.lower(): name for name in canonical}
    chosen: dict[str, int] = {}
    exact: set[str] = set()
    for position, raw in enumerate(df.columns):
        name = raw.strip()
        to = spelling.get(name.lower(), name)
        if drop_others and name.lower() not in spelling:
            continue
        if to not in chosen or (name == to and to not in exact):
            chosen[to] = position
        if name == to:
            exact.add(to)
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{position}").alias(name) for name, position in chosen.items()])


def strip_ids(df: DataFrame, id_column: str, lookups: Sequence[str]) -> DataFrame:
    """Without the id, the lookup ids and every ``*.Id`` column."""
    unwanted = {id_column.lower(), *(name.lower() for name in lookups)}
    keep = [
        name
        for name in df.columns
        if name.lower() not in unwanted and not name.lower().endswith(".id")
    ]
    return _select(df, keep)


def audit_columns(df: DataFrame, source_id: str = "_src_id") -> DataFrame:
    """The source id becomes ``Old Id``, internal columns go, ``Errors`` is there."""
    out = df
    if source_id in df.columns:
        out = out.withColumn(OLD_ID, F.col(source_id).cast("string"))
    out = out.drop(source_id, *INTERNAL)
    if ERRORS not in out.columns:
        out = out.withColumn(ERRORS, F.lit(None).cast("string"))
    return out


def clone(df: DataFrame, include: Sequence[str] = (), exclude_: Sequence[str] = ()) -> DataFrame:
    """The included columns (all if none is named) without the excluded ones."""
    names = [n for n in df.columns if (not include or n in include) and n not in exclude_]
    return _select(df, names)


def flatten_lists(df: DataFrame, values_of: str, name: str) -> DataFrame:
    """One row per element of a list, or of a list of lists."""
    kind = df.schema[values_of].dataType
    nested = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType)
    values = F.flatten(quoted(values_of)) if nested else F.col(quoted(values_of))
    return df.select(*flat(c for c in df.columns if c != values_of), F.explode(values).alias(name))


def joined_key(df: DataFrame, columns: Sequence[str], delimiter: str = "|"):
    """The columns as text, joined; nulls count as empty."""
    return F.concat_ws(delimiter, *[F.coalesce(column(df, c).cast("string"), F.lit("")) for c in columns])

