"""Keys, row hashes and generated ids."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.cells import strip
from rowferry.functions.names import quoted

SEPARATOR = ";"


def key_text(parts: Sequence[Column | str], strict: bool = False) -> Column:
    """K9: the non-empty parts joined with ``;``, null when nothing is left.

    Dropping empty parts makes ("A", "") and ("", "A") one key, as users of such keys expect.
    ``strict`` keeps every part in its place instead.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    if strict:
        filled = [F.coalesce(text, F.lit("")) for text in texts]
        joined = F.concat_ws(SEPARATOR, *filled)
        return F.when(F.length(F.concat(*filled)) > 0, joined)
    return F.nullif(F.concat_ws(SEPARATOR, *[F.nullif(t, F.lit("")) for t in texts]), F.lit(""))


def _hash_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.coalesce(value.cast("string"), F.lit("0"))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.unix_millis(value.cast("timestamp")).cast("string"), F.lit("0"))
    if isinstance(kind, T.NumericType):
        return F.coalesce(_number_text(value.cast("double")), F.lit("0"))
    if not isinstance(kind, T.StringType):
        return F.coalesce(F.to_json(value), F.lit("0"))
    squeezed = F.regexp_replace(value, r"\s", "")
    as_number = F.when(squeezed.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), squeezed.try_cast("double"))
    return (
        F.when(F.coalesce(strip(value), F.lit("")) == "", "0")
        .when(value == "TRUE", "true")
        .when(value == "FALSE", "false")
        .when(value == "#N/A", "")
        .otherwise(F.coalesce(_number_text(as_number), squeezed))
    )


def _number_text(value: Column) -> Column:
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.try_cast("long").cast("string")).otherwise(value.cast("string"))


def _normalised(df: DataFrame, exclude: Iterable[str]) -> list[Column]:
    left_out = set(exclude)
    names = sorted(name for name in df.columns if name not in left_out)
    return [_hash_text(F.col(quoted(name)), df.schema[name].dataType) for name in names]


def row_hash(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """64-bit hash of the normalised values in name order."""
    return F.xxhash64(*_normalised(df, exclude))


def row_digest(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """K11 for pairing: the same normalised values, wide enough to stand for the row."""
    return F.sha2(F.concat_ws("|", *_normalised(df, exclude)), 256)


def row_id(table: str, *parts: Column | str, length: int = 18) -> Column:
    """An id made from table and key, so that retries and re-runs give the same one.

    18 hex digits hold 72 bits. Past some 10^9 generated ids take a larger ``length``
    (up to 64) where the id column allows it.
    """
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.upper(F.substring(F.sha2(F.concat_ws("|", F.lit(table), *texts), 256), 1, length))


def counter_id(number: Column) -> Column:
    """K12, second form: ``ID`` and a 16-digit counter."""
    return F.concat(F.lit("ID"), F.lpad(number.cast("string"), 16, "0"))
