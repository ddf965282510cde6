"""Profiling (A1, A2, A4-A10, O1, P8, P11).

Every profile is ONE aggregate over the table (partial aggregation on the map
side, one result row), then reshaped to at most one row per column.  Nothing
row-sized reaches the driver.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile import defaults as D
from turnstile.functions.expressions import is_missing, name_lookup


def _missing_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One aggregate: per-column missing counts + row count, long format
    ``(ordinal, column_name, n_missing, n_rows)``."""
    names = set(c.lower() for c in name_lookup(df, cols)) if cols is not None else None
    fields = [f for f in df.schema.fields if names is None or f.name.lower() in names]
    aggs = [F.count_if(is_missing(f.name, f.dataType)).alias(f"_m{i}")
            for i, f in enumerate(fields)]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    entries = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"),
                 F.col(f"_m{i}").alias("n_missing"))
        for i, f in enumerate(fields)
    ])
    return wide.select(F.inline(entries), "n_rows")


def missing_percent(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``(column_name, percent_missing)`` with percent = missing·100/rows (double).

    An empty table gives null percentages (not an error).
    """
    counts = _missing_counts(df, cols)
    pct = F.try_divide(F.col("n_missing") * F.lit(100.0), F.col("n_rows"))
    return counts.select("column_name", pct.alias("percent_missing"))


def filter_missing_above(report: DataFrame, threshold: float = D.MISSING_THRESHOLD) -> DataFrame:
    """Keep report rows with ``percent_missing > threshold`` (strict)."""
    return report.where(F.col("percent_missing") > F.lit(float(threshold)))


def high_missing_columns(df: DataFrame, threshold: float = D.MISSING_THRESHOLD,
                         ascending: bool = True, report: DataFrame | None = None) -> DataFrame:
    """Columns whose missing share exceeds ``threshold``, sorted by percent
    (ties by name).  Pass a precomputed ``report`` to reuse one profile pass."""
    rep = report if report is not None else missing_percent(df)
    order = F.asc("percent_missing") if ascending else F.desc("percent_missing")
    return filter_missing_above(rep, threshold).orderBy(order, F.asc("column_name"))


def high_missing_names(df: DataFrame, threshold: float = D.MISSING_THRESHOLD,
                       report: DataFrame | None = None) -> list[str]:
    """Names only (at most one row per column, so collecting is bounded)."""
    return [r.column_name for r in
            high_missing_columns(df, threshold, report=report).collect()]


def profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Row count, column count and missing counts per column (A6-A8)."""
    counts = _missing_counts(df, cols)
    return counts.select(
        "column_name", "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        "n_missing",
        F.try_divide(F.col("n_missing") * F.lit(100.0), F.col("n_rows")).alias("percent_missing"))


def missing_mask(df: DataFrame, cols: Iterable[str] | None = None,
                 keep: Iterable[str] = ()) -> DataFrame:
    """Boolean missing indicator per column (``<name>_missing``), narrow."""
    names = set(c.lower() for c in name_lookup(df, cols)) if cols is not None else None
    kept = name_lookup(df, keep)
    return df.select(*kept, *[
        is_missing(f.name, f.dataType).alias(f"{f.name}_missing")
        for f in df.schema.fields if names is None or f.name.lower() in names])


def total_missing(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One row: the number of missing cells in the table."""
    names = set(c.lower() for c in name_lookup(df, cols)) if cols is not None else None
    terms = [F.count_if(is_missing(f.name, f.dataType))
             for f in df.schema.fields if names is None or f.name.lower() in names]
    total = terms[0] if terms else F.lit(0)
    for t in terms[1:]:
        total = total + t
    return df.agg(total.cast("bigint").alias("total_missing"))


def require_complete(df: DataFrame, strict: bool = False) -> bool:
    """True when no cell is missing; ``strict`` raises instead of returning False."""
    n = total_missing(df).first()["total_missing"]
    if n and strict:
        raise ValueError(f"{n} missing cells; training needs a complete table")
    return n == 0


def is_unique(df: DataFrame, col: str) -> DataFrame:
    """One row ``is_unique``: no value occurs twice (two nulls count as a
    duplicate, as in pandas).  Partial counts per key are combined map-side, so
    a hot key does not land whole in one task."""
    (c,) = name_lookup(df, [col])
    per_key = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.max("n") <= 1, F.lit(True)).alias("is_unique"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Label histogram ``(label, n)``."""
    (c,) = name_lookup(df, [label])
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
