"""Projections and cleaning (P1-P7, P9): all narrow, one ``select`` each.

Each operator builds one expression per column from the schema at plan time,
so the whole cleaning step is a single projection inside whole-stage codegen
and also runs unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile import defaults as D
from turnstile.functions.expressions import epoch_day_string, name_lookup, sentinel_null


def select_datapoints(df: DataFrame, mandatory: Sequence[str],
                      optional: Sequence[str] = ()) -> DataFrame:
    """Ordered projection ``mandatory + optional``; any missing name raises.

    Applied right on a scan, Catalyst prunes the other columns in the reader.
    """
    return df.select(*name_lookup(df, [*mandatory, *optional]))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Remove columns; unknown names raise (``DataFrame.drop`` would ignore them)."""
    cols = list(cols)
    if not cols:
        return df
    return df.drop(*name_lookup(df, cols))


def fill_null(df: DataFrame, cols: Iterable[str], value=0) -> DataFrame:
    """Replace null (and NaN for floating columns) with a constant."""
    targets = {c.lower() for c in name_lookup(df, cols)}
    out = []
    for f in df.schema.fields:
        if f.name.lower() in targets:
            col = F.col(f.name)
            if f.dataType.typeName() in ("double", "float"):
                col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
            out.append(F.coalesce(col, F.lit(value).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def sentinels_to_null(df: DataFrame, cols: Iterable[str] | None = None,
                      exempt: Iterable[str] = (), values: Sequence[str] = D.SENTINEL_STRINGS,
                      zero: bool = True, false_is_missing: bool = True) -> DataFrame:
    """``'null'``, ``'0'`` (text), ``0`` (numbers), ``false`` (booleans) → null.

    ``cols`` limits the rule (default: all); ``exempt`` columns pass through.
    """
    targets = {c.lower() for c in (name_lookup(df, cols) if cols is not None else df.columns)}
    skip = {c.lower() for c in exempt}
    out = []
    for f in df.schema.fields:
        key = f.name.lower()
        if key in targets and key not in skip:
            out.append(sentinel_null(f.name, f.dataType, values, zero,
                                     false_is_missing).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def epoch_to_date(df: DataFrame, cols: Iterable[str], fmt: str = D.DATE_FORMAT,
                  errors: str = "raise") -> DataFrame:
    """Epoch seconds → ``yyyy-MM-dd`` strings in UTC (0 / 'null' / null / NaN → null)."""
    targets = {c.lower() for c in name_lookup(df, cols)}
    return df.select(*[
        epoch_day_string(f.name, f.dataType, fmt, errors).alias(f.name)
        if f.name.lower() in targets else F.col(f.name)
        for f in df.schema.fields
    ])


def clean(df: DataFrame, exempt: Iterable[str] = D.HR_EXEMPT,
          date_columns: Iterable[str] = D.HR_DATES, fmt: str = D.DATE_FORMAT,
          errors: str = "raise", false_is_missing: bool = True) -> DataFrame:
    """Per-column dispatch by name: exempt → unchanged; date column → epoch
    to day string (after a 0 fill, so null → null); else the sentinel rule.

    Output keeps the input's column order.  Names match case-insensitively and
    names absent from the frame are ignored (the config may not select them).
    """
    skip = {c.lower() for c in exempt}
    dates = {c.lower() for c in date_columns}
    out = []
    for f in df.schema.fields:
        key = f.name.lower()
        if key in skip:
            out.append(F.col(f.name))
        elif key in dates:
            out.append(epoch_day_string(f.name, f.dataType, fmt, errors).alias(f.name))
        else:
            out.append(sentinel_null(f.name, f.dataType, D.SENTINEL_STRINGS, True,
                                     false_is_missing).alias(f.name))
    return df.select(*out)


def split_target(df: DataFrame, label: str, exclude_id: str | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    """Label vs. feature columns: ``(features, label_frame)``.

    In the Spark plans below one frame carries both, with ``labelCol`` /
    ``featuresCol``; this is the column-list split of the reference.
    """
    (lab,) = name_lookup(df, [label])
    drop = [lab] + (name_lookup(df, [exclude_id]) if exclude_id else [])
    return df.drop(*drop), df.select(lab)
