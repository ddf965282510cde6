"""Encoding and scaling (M1, M4-M7, P9, P10, P12).

* ``label_encode`` builds the dictionary on the executors: unpivot the text
  columns to ``(column_name, value)``, ``distinct`` (map-side partial), then
  rank.  A dictionary whose size is proven small is ranked in one window and
  applied as an inline map literal (pure projection, no join); a large one is
  ranked by range partitioning + per-partition offsets and applied by joins
  (broadcast only after a size check).
* ``standardize`` is one aggregate (mean, population σ) plus a projection.
* ``one_hot`` ranks the levels as a dictionary in their natural order and
  compares codes.  Models take the codes as sparse vectors
  (``FeatureModel``), which has no limit on the number of levels.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.functions.expressions import name_lookup
from turnstile.session import BROADCAST_MAX_BYTES, ROW_BYTES, VALUE_BYTES, cut_lineage

# Entries of one column up to which its codes are applied as a map literal.
INLINE_COLUMN_MAX = 256
# Entries up to which one window ranks the whole dictionary in a single task.
SINGLE_TASK_RANK_MAX = 1_000_000
# Range partitions used to rank a dictionary above that size.
RANK_PARTITIONS = 64


# ---------------------------------------------------------------------------
# M1: label encoding
# ---------------------------------------------------------------------------

def _unpivot_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, value, number)``: a numeric value sorts by its number,
    any other by its text."""
    def number(c: str) -> Column:
        numeric = isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))
        return (F.col(c) if numeric else F.lit(None)).cast("double").alias("number")

    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(c).cast("string").alias("value"), number(c)) for c in cols])
    return df.select(F.inline(entries))


def _rank_dictionary(vals: DataFrame, total: int) -> DataFrame:
    """Dense codes 0..n-1 per column in value order (``vals``: distinct,
    non-null ``(column_name, value, number)``; ``total``: its exact row count).

    Up to ``SINGLE_TASK_RANK_MAX`` entries one window does it; beyond that the
    entries are range partitioned, each partition ranked locally, and
    per-partition counts (one row per partition) give the offsets.
    """
    if total <= SINGLE_TASK_RANK_MAX:
        w = Window.partitionBy("column_name").orderBy("number", "value")
        return vals.select("column_name", "value",
                           (F.row_number().over(w) - 1).cast("bigint").alias("code"))
    parts = max(RANK_PARTITIONS, total // 500_000 + 1)
    # Partition ids are read twice, so they must not be computed twice: a lost
    # block of a cached frame could come back with other range bounds.
    ranged = cut_lineage(vals.repartitionByRange(parts, "column_name", "number", "value")
                         .select("column_name", "value", "number", F.spark_partition_id().alias("_pid")))
    sizes = ranged.groupBy("column_name", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("column_name").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("column_name", "_pid",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy("column_name", "_pid").orderBy("number", "value")
    # offsets has one row per (column, partition): bounded by parts x columns.
    return (ranged.join(F.broadcast(offsets), ["column_name", "_pid"])
            .select("column_name", "value",
                    (F.col("_off") + F.row_number().over(local) - 1).cast("bigint").alias("code")))


@dataclass
class LabelDictionary:
    """Fitted codes: ``frame`` has ``(column_name, value, code)`` for non-null
    values; ``sizes`` maps column → number of non-null values; ``has_null``
    marks columns that held nulls; ``inline`` holds the codes of columns small
    enough to apply as a map literal."""
    columns: list[str]
    frame: DataFrame
    sizes: dict[str, int]
    has_null: dict[str, bool]
    inline: dict[str, dict[str, int]]
    missing: str = "last_code"
    bytes: dict[str, int] = field(default_factory=dict)    # about, per column

    def transform(self, df: DataFrame) -> DataFrame:
        return apply_dictionary(df, self)


def fit_label_dictionary(df: DataFrame, cols: Iterable[str] | None = None,
                         missing: str = "last_code") -> LabelDictionary:
    """One pass over the table: unpivot the text columns, ``distinct`` with
    map-side partial aggregation, persist the (small) distinct set; sizes,
    null presence and codes all come from it."""
    if missing not in ("last_code", "null", "error"):
        raise ValueError("missing must be 'last_code', 'null' or 'error'")
    names = name_lookup(df, cols) if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return LabelDictionary([], df.sparkSession.createDataFrame(
            [], "column_name string, value string, code bigint"), {}, {}, {}, missing)
    distinct_vals = _unpivot_values(df, names).distinct().persist()
    stats = distinct_vals.groupBy("column_name").agg(
        F.count("value").alias("n"), F.max(F.col("value").isNull()).alias("has_null"),
        F.sum(F.coalesce(F.octet_length("value"), F.lit(0))).alias("text")).collect()
    sizes = {c: 0 for c in names}
    has_null = {c: False for c in names}
    weight = {c: 0 for c in names}
    for r in stats:
        sizes[r.column_name], has_null[r.column_name] = r.n, bool(r.has_null)
        weight[r.column_name] = r.n * (ROW_BYTES + 2 * VALUE_BYTES) + r.text
    vals = distinct_vals.where(F.col("value").isNotNull())
    codes = cut_lineage(_rank_dictionary(vals, sum(sizes.values())))
    distinct_vals.unpersist()
    small = [c for c in names if sizes[c] <= INLINE_COLUMN_MAX]
    inline: dict[str, dict[str, int]] = {c: {} for c in small}
    if small:
        for r in codes.where(F.col("column_name").isin(small)).collect():
            inline[r.column_name][r.value] = r.code
    return LabelDictionary(names, codes, sizes, has_null, inline, missing, weight)


def _missing_code(c: str, d: LabelDictionary, code: Column, value: Column) -> Column:
    n = d.sizes.get(c, 0)
    if d.missing == "last_code":
        return F.coalesce(code, F.lit(n).cast("bigint"))
    if d.missing == "null":
        return code
    return F.when(code.isNull(), F.raise_error(
        F.concat(F.lit(f"label_encode: missing or unseen value in {c}: "),
                 F.coalesce(value, F.lit("null"))))).otherwise(code).cast("bigint")


def apply_dictionary(df: DataFrame, d: LabelDictionary) -> DataFrame:
    """Replace each encoded column by its code (bigint).  Missing and unseen
    values get the last code ``n`` (``missing='last_code'``), null, or an error.

    Small dictionaries are map literals (a projection, also fine on a stream);
    larger ones are equi-joins, broadcast when their known size allows it."""
    if not d.columns:
        return df
    exprs = {}
    for c in d.columns:
        if c not in d.inline:
            continue
        entries = d.inline[c]
        if entries:
            m = F.create_map(*[x for k, v in sorted(entries.items())
                               for x in (F.lit(k), F.lit(v).cast("bigint"))])
            code = F.try_element_at(m, F.col(c).cast("string"))
        else:
            code = F.lit(None).cast("bigint")
        exprs[c] = _missing_code(c, d, code, F.col(c).cast("string")).alias(c)
    out = df.select(*[exprs.get(c, F.col(c)) for c in df.columns])
    for i, c in enumerate(x for x in d.columns if x not in d.inline):
        out = _join_code(out, d, c, f"_code{i}")
        out = out.withColumn(c, _missing_code(c, d, F.col(f"_code{i}"), F.col(c).cast("string")))
        out = out.drop(f"_code{i}")
    return out.select(*df.columns)


def _join_code(df: DataFrame, d: LabelDictionary, c: str, output: str) -> DataFrame:
    """The code of column ``c`` by an equi-join; null for a missing or unseen
    value.  Broadcast if the dictionary's size is known to allow it; else one
    shuffle of the table, in which rows with a null value are spread out."""
    side = (d.frame.where(F.col("column_name") == c)
            .select(F.col("value").alias("_val"), F.col("code").alias(output)))
    value = F.col(c).cast("string")
    if d.bytes.get(c, 0) <= BROADCAST_MAX_BYTES:
        return df.join(F.broadcast(side), value == F.col("_val"), "left").drop("_val")
    known = df.where(F.col(c).isNotNull()).join(side, value == F.col("_val"), "left").drop("_val")
    return known.unionByName(df.where(F.col(c).isNull()).withColumn(output, F.lit(None).cast("bigint")))


def _level_codes(df: DataFrame, d: LabelDictionary) -> DataFrame:
    """``df`` with ``_code_<column>`` per column: the code of its level, a null
    being the last level if the fit saw one; null for an unseen level."""
    out = df
    for c in d.columns:
        name = f"_code_{c}"
        if c in d.inline:
            entries = [x for k, v in sorted(d.inline[c].items())
                       for x in (F.lit(k), F.lit(v).cast("bigint"))]
            code = (F.try_element_at(F.create_map(*entries), F.col(c).cast("string"))
                    if entries else F.lit(None).cast("bigint"))
            out = out.withColumn(name, code)
        else:
            out = _join_code(out, d, c, name)
        if d.has_null[c]:
            out = out.withColumn(name, F.when(F.col(c).isNull(), F.lit(d.sizes[c]).cast("bigint"))
                                 .otherwise(F.col(name)))
    return out


def level_count(d: LabelDictionary, c: str) -> int:
    return d.sizes[c] + int(d.has_null[c])


def label_encode(df: DataFrame, cols: Iterable[str] | None = None,
                 missing: str = "last_code") -> tuple[DataFrame, DataFrame]:
    """Every text column (default) → integer code 0..n-1 in sorted text order.

    Returns ``(encoded frame, dictionary frame (column_name, value, code))``;
    with ``missing='last_code'`` null becomes code ``n`` and the dictionary
    lists it with a null value.
    """
    d = fit_label_dictionary(df, cols, missing)
    frame = d.frame
    if missing == "last_code" and d.columns:
        null_rows = [(c, d.sizes[c]) for c in d.columns if d.has_null[c]]
        if null_rows:
            nulls = df.sparkSession.createDataFrame(null_rows, "column_name string, code bigint")
            frame = frame.unionByName(nulls.select(
                "column_name", F.lit(None).cast("string").alias("value"), "code"))
    return apply_dictionary(df, d), frame


# ---------------------------------------------------------------------------
# M5: standardisation
# ---------------------------------------------------------------------------

def fit_scaler(df: DataFrame, cols: Sequence[str],
               fit_rows: Column | None = None) -> dict[str, tuple[float, float]]:
    """``{col: (mean, population σ)}`` from one aggregate."""
    src = df.where(fit_rows) if fit_rows is not None else df
    row = src.agg(*[x for i, c in enumerate(cols) for x in (
        F.avg(F.col(c).cast("double")).alias(f"_m{i}"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"_s{i}"))]).first()
    return {c: (row[f"_m{i}"], row[f"_s{i}"]) for i, c in enumerate(cols)}


def scale_columns(df: DataFrame, stats: dict[str, tuple[float, float]],
                  suffix: str = "") -> DataFrame:
    exprs = {}
    for c, (mean, sd) in stats.items():
        if mean is None:
            val = F.lit(None).cast("double")
        elif not sd:
            val = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
        else:
            val = (F.col(c).cast("double") - F.lit(float(mean))) / F.lit(float(sd))
        exprs[c] = val.alias(c + suffix)
    if suffix:
        return df.select("*", *exprs.values())
    return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])


def standardize(df: DataFrame, cols: Iterable[str], fit_on: str = "all",
                split_col: str = "split") -> DataFrame:
    """(x − mean) / population σ; a constant column gives 0.

    ``fit_on='all'`` (parity) fits on every row; ``'train'`` only on rows whose
    ``split_col`` is ``'train'``.
    """
    names = name_lookup(df, cols)
    rows = F.col(split_col) == F.lit("train") if fit_on == "train" else None
    return scale_columns(df, fit_scaler(df, names, rows))


# ---------------------------------------------------------------------------
# M4 / M7: one-hot
# ---------------------------------------------------------------------------

def fit_levels(df: DataFrame, cols: Sequence[str]) -> LabelDictionary:
    """The exact levels of every column with codes in their natural order
    (numbers by value), null last; the table of levels stays distributed."""
    return fit_label_dictionary(df, cols, missing="null")


def _level_name(c: str, k: int) -> str:
    return f"{c}_{k}"


def one_hot(df: DataFrame, cols: Iterable[str], drop: bool = True,
            levels: LabelDictionary | None = None) -> tuple[DataFrame, list[str]]:
    """Indicator columns ``<col>_<k>`` (double) for the k-th observed level in
    natural order, null last, no level dropped; returns the new column names in
    order.  One column per level: for columns with very many use
    ``one_hot_long``, or ``prepare_features`` for a sparse vector."""
    names = name_lookup(df, cols)
    d = levels or fit_levels(df, names)
    coded = _level_codes(df, d)
    new_cols, exprs = [], []
    for c in names:
        for k in range(level_count(d, c)):
            hit = F.coalesce(F.col(f"_code_{c}") == k, F.lit(False))
            exprs.append(hit.cast("double").alias(_level_name(c, k)))
            new_cols.append(_level_name(c, k))
    keep = [F.col(c) for c in df.columns if not (drop and c in names)]
    return coded.select(*keep, *exprs), new_cols


def one_hot_long(df: DataFrame, id_col: str, cols: Iterable[str],
                 levels: LabelDictionary | None = None) -> DataFrame:
    """``(id, column_name, code)``: the one indicator that is 1 per row and
    column, for any number of levels."""
    (i,) = name_lookup(df, [id_col])
    names = name_lookup(df, cols)
    d = levels or fit_levels(df, names)
    coded = _level_codes(df.select(i, *[c for c in names if c != i]), d)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_code_{c}").alias("code"))
                        for c in names])
    return coded.select(i, F.inline(entries)).where(F.col("code").isNotNull())


def one_hot_label(df: DataFrame, label: str, n_levels: int | None = 2
                  ) -> tuple[DataFrame, list]:
    """Label → indicator columns ``<label>_0 .. <label>_{k-1}`` in sorted order
    (slot 0 = 'No', slot 1 = 'Yes').  ``n_levels`` validates the level count
    the network output expects."""
    (c,) = name_lookup(df, [label])
    d = fit_levels(df, [c])
    n = level_count(d, c)
    if n_levels is not None and n != n_levels:
        raise ValueError(f"label {c} has {n} levels; expected {n_levels}")
    found = d.frame.orderBy("code").limit(n).collect()
    levels = [r.value for r in found] + ([None] if d.has_null[c] else [])
    out, _ = one_hot(df, [c], drop=False, levels=d)
    return out, levels


# ---------------------------------------------------------------------------
# M6 / P10 / P12: feature matrix
# ---------------------------------------------------------------------------

@dataclass
class FeatureModel:
    """Fitted feature block: scaler statistics of the numeric columns and the
    dictionary of the categorical levels.  ``transform`` is a projection (plus
    a join per column with very many levels, and the vector assembler), so it
    runs on new batches and on streams."""
    numeric: list[str]
    categorical: list[str]
    stats: dict[str, tuple[float, float]]
    levels: LabelDictionary
    output: str = "features"

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *[_level_name(c, k) for c in self.categorical
                                 for k in range(level_count(self.levels, c))]]

    def transform(self, df: DataFrame, keep: Sequence[str] = (), assemble: bool = True) -> DataFrame:
        """``keep`` and the feature vector (sparse where that is smaller), or
        with ``assemble=False`` the flat columns ``names``.  A level that the
        fit didn't see has no indicator."""
        kept = [c for c in dict.fromkeys(keep)]
        block = df.select(*kept, *[F.col(c).alias(f"_num_{c}") for c in self.numeric],
                          *[F.col(c).alias(f"_cat_{c}") for c in self.categorical])
        block = scale_columns(block, {f"_num_{c}": v for c, v in self.stats.items()})
        coded = _level_codes(block, self._renamed())
        if not assemble:
            flat = [F.col(f"_num_{c}").alias(c) for c in self.numeric]
            for c in self.categorical:
                for k in range(level_count(self.levels, c)):
                    hit = F.coalesce(F.col(f"_code__cat_{c}") == k, F.lit(False))
                    flat.append(hit.cast("double").alias(_level_name(c, k)))
            return coded.select(*kept, *flat)
        # One more category stands for "unseen"; the encoder drops the last one.
        index = []
        for c in self.categorical:
            n = level_count(self.levels, c)
            meta = {"ml_attr": {"type": "nominal", "name": c, "num_vals": n + 1}}
            index.append(F.coalesce(F.col(f"_code__cat_{c}"), F.lit(n)).cast("double")
                         .alias(f"_index_{c}", metadata=meta))
        coded = coded.select(*kept, *[f"_num_{c}" for c in self.numeric], *index)
        parts = [f"_num_{c}" for c in self.numeric]
        if self.categorical:
            hot = [f"_hot_{c}" for c in self.categorical]
            coded = OneHotEncoder(inputCols=[f"_index_{c}" for c in self.categorical], outputCols=hot,
                                  dropLast=True, handleInvalid="error").fit(coded).transform(coded)
            parts += hot
        return VectorAssembler(inputCols=parts, outputCol=self.output,
                               handleInvalid="error").transform(coded).select(*kept, self.output)

    def _renamed(self) -> LabelDictionary:
        """The dictionary for columns called ``_cat_<column>``."""
        d, new = self.levels, "_cat_{}".format
        return LabelDictionary(
            [new(c) for c in d.columns], d.frame.withColumn("column_name", F.concat(F.lit("_cat_"), "column_name")),
            *[{new(c): v for c, v in x.items()} for x in (d.sizes, d.has_null, d.inline)],
            d.missing, {new(c): v for c, v in d.bytes.items()})


def fit_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 fit_on: str = "all", split_col: str = "split",
                 output: str = "features") -> FeatureModel:
    """Scaler statistics (one aggregate) and the categorical levels (one
    distinct over the unpivoted columns)."""
    num = name_lookup(df, numeric)
    cat = name_lookup(df, categorical)
    rows = F.col(split_col) == F.lit("train") if fit_on == "train" else None
    return FeatureModel(num, cat, fit_scaler(df, num, rows), fit_levels(df, cat), output)


def prepare_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     keep: Sequence[str] = (), output: str = "features",
                     fit_on: str = "all", split_col: str = "split",
                     assemble: bool = True, return_model: bool = False):
    """Scaled numerics, then one-hot groups, as one vector or as flat columns.

    Returns ``(frame with keep + the vector, or with assemble=False + the flat
    columns, flat names)`` (plus the fitted ``FeatureModel`` with
    ``return_model=True``).  A column that the table hasn't raises.
    """
    model = fit_features(df, numeric, categorical, fit_on, split_col, output)
    kept = name_lookup(df, keep)
    if fit_on == "train" and split_col not in kept:
        kept.append(split_col)
    out = model.transform(df, kept, assemble)
    if return_model:
        return out, model.names, model
    return out, model.names
