"""Column-expression builders.

All of these return JVM-side ``Column`` expressions (whole-stage codegen);
no Python runs per row.  Type decisions are made at plan time from the
schema, because under ANSI mode comparing a string column with ``0`` raises.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.FloatType, T.DoubleType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def name_lookup(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Resolve names case-insensitively to the frame's spelling; missing → error."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for n in names:
        hit = by_lower.get(n.lower())
        if hit is None:
            raise KeyError(f"column {n!r} not in {df.columns}")
        out.append(hit)
    return out


def is_missing(c: Column | str, dtype: T.DataType) -> Column:
    """One notion of missing: null, or NaN for float/double."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, _FLOATING):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def sentinel_null(c: Column | str, dtype: T.DataType,
                  values: Iterable[str] = ("null", "0"), zero: bool = True,
                  false_is_missing: bool = True) -> Column:
    """Turn sentinel values into null, whole-value and case-sensitive.

    strings: exact members of ``values``; numbers: ``== 0`` (also -0.0) and NaN;
    booleans: ``false`` (False == 0 in the reference's test) when
    ``false_is_missing``.  Other types pass through.
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.StringType):
        vals = list(values)
        return F.when(col.isin(vals), F.lit(None).cast(dtype)).otherwise(col) if vals else col
    if isinstance(dtype, _NUMERIC):
        cond = F.lit(False)
        if zero:
            cond = col == F.lit(0)
        if isinstance(dtype, _FLOATING):
            cond = cond | F.isnan(col)
        return F.when(cond, F.lit(None).cast(dtype)).otherwise(col)
    if isinstance(dtype, T.BooleanType):
        if zero and false_is_missing:
            return F.when(~col, F.lit(None).cast(dtype)).otherwise(col)
        return col
    return col


def epoch_day_string(c: Column | str, dtype: T.DataType, fmt: str = "yyyy-MM-dd",
                     errors: str = "raise") -> Column:
    """Epoch seconds → UTC calendar day formatted with ``fmt``.

    ``0``, ``'0'``, ``'null'``, null and NaN give null.  Seconds are truncated
    toward zero first (so -0.5 → 1970-01-01), then floored to whole days,
    which keeps negative values on the previous day and keeps the session
    time zone out of the result.  Bad text raises (``errors='raise'``) or
    gives null (``errors='null'``).
    """
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.StringType):
        missing = col.isNull() | col.isin("null", "0")
        whole = col.try_cast("bigint") if errors == "null" else col.cast("bigint")
    elif isinstance(dtype, _FLOATING):
        missing = col.isNull() | F.isnan(col) | (col == F.lit(0.0))
        whole = F.when(~F.isnan(col), col).cast("bigint")
    elif isinstance(dtype, _NUMERIC):
        missing = col.isNull() | (col == F.lit(0))
        whole = col.cast("bigint")
    else:
        raise TypeError(f"epoch column must be numeric or string, got {dtype}")
    days = F.floor(whole / F.lit(86400)).cast("int")
    day = F.date_from_unix_date(days)
    text = day.cast("string") if fmt == "yyyy-MM-dd" else F.date_format(day, fmt)
    return F.when(missing, F.lit(None).cast("string")).otherwise(text)


def hash_rank_key(cols: Iterable[Column | str], seed: int | str) -> Column:
    """Deterministic pseudo-random sort key: md5 of the values and a seed.

    Lowercase hex, so text order equals numeric order of the digest.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def hash_uniform(cols: Iterable[Column | str], seed: int | str) -> Column:
    """u in [0, 1): first 8 hex digits of the md5 key divided by 2**32."""
    key = hash_rank_key(cols, seed)
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
