"""Imputation (A3/W1, M2, M3).

* ``fill_group_mode`` — aggregate-then-join: ``(group, value)`` counts with
  map-side partial aggregation (a hot group never lands whole in one task),
  one mode per group, joined back (broadcast only after a size check).
* ``mean_impute`` — one aggregate, then a projection.
* ``iterative_impute`` — chained equations.  Rows that miss the same cells
  share an affine map from their observed values to the imputed ones, so ONE
  aggregate of moment sums (n, Σx, Σxxᵀ) per missing pattern is enough for
  every regression of every round; the p x p solves run on the driver.  One
  scan gives the change of each round, and the result is one matrix product
  per row (Arrow batches).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile import defaults as D
from turnstile.functions.expressions import is_missing, name_lookup
from turnstile.session import cut_lineage, maybe_broadcast


# ---------------------------------------------------------------------------
# A3 / W1: group mode fill
# ---------------------------------------------------------------------------

def group_modes(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, mode)``: most frequent non-null value per non-null group,
    ties → smallest value.  Groups with no values are absent."""
    g, v = name_lookup(df, [group, value])
    counts = (df.where(F.col(g).isNotNull() & F.col(v).isNotNull())
              .groupBy(g, v).agg(F.count(F.lit(1)).alias("_n")))
    best = F.min(F.struct((-F.col("_n")).alias("neg_n"), F.col(v).alias("v")))
    return counts.groupBy(g).agg(best["v"].alias("_mode"))


def apply_group_modes(df: DataFrame, modes: DataFrame, group: str, value: str,
                      null_group: str = "null", empty_group: str = "error") -> DataFrame:
    """Fill nulls of ``value`` from a fitted ``(group, _mode)`` table (batch or
    stream; the mode table is broadcast only after a size check)."""
    if null_group not in ("null", "keep") or empty_group not in ("error", "null"):
        raise ValueError("null_group in {'null','keep'}, empty_group in {'error','null'}")
    g, v = name_lookup(df, [group, value])
    side = modes.select(F.col(modes.columns[0]).alias("_g"), F.col("_mode"))
    joined = df.join(maybe_broadcast(side), F.col(g) == F.col("_g"), "left")
    vtype = df.schema[v].dataType
    filled = F.coalesce(F.col(v), F.col("_mode").cast(vtype))
    if empty_group == "error":
        no_mode = F.col(g).isNotNull() & F.col(v).isNull() & F.col("_mode").isNull()
        filled = F.when(no_mode, F.raise_error(
            F.concat(F.lit(f"fill_group_mode: group without any {v} value: "),
                     F.col(g).cast("string")))).otherwise(filled).cast(vtype)
    if null_group == "null":
        filled = F.when(F.col(g).isNull(), F.lit(None).cast(vtype)).otherwise(filled)
    else:
        filled = F.when(F.col(g).isNull(), F.col(v)).otherwise(filled)
    return joined.select(*[filled.alias(c) if c == v else F.col(c) for c in df.columns])


def fill_group_mode(df: DataFrame, group: str = D.HR_GROUP, value: str = D.HR_GROUP_VALUE,
                    null_group: str = "null", empty_group: str = "error") -> DataFrame:
    """Fill nulls of ``value`` with the mode of ``value`` inside its ``group``.

    ``null_group='null'`` (parity) nulls the value of rows whose group is null,
    even when they had a value; ``'keep'`` leaves those rows unchanged.
    ``empty_group='error'`` raises when a group has no value to take a mode
    from (checked inside the same pass with ``raise_error``); ``'null'``
    leaves such cells null.
    """
    g, v = name_lookup(df, [group, value])
    modes = cut_lineage(group_modes(df, g, v))
    return apply_group_modes(df, modes, g, v, null_group, empty_group)


# ---------------------------------------------------------------------------
# M3: mean fill
# ---------------------------------------------------------------------------

def _as_double(c: str, dtype: T.DataType) -> Column:
    """Double view with NaN folded into null (one notion of missing)."""
    col = F.col(c).cast("double")
    return F.when(is_missing(F.col(c), dtype), F.lit(None).cast("double")).otherwise(col)


def column_means(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Observed means of ``cols`` in one aggregate (one row to the driver)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.agg(*[F.avg(_as_double(c, types[c])).alias(f"_a{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: row[f"_a{i}"] for i, c in enumerate(cols)}


def mean_impute(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Fill missing cells with the column's observed mean; columns become double.

    An all-missing column raises (there is no mean to use)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    targets = name_lookup(df, cols) if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    means = column_means(df, targets)
    empty = [c for c, m in means.items() if m is None]
    if empty:
        raise ValueError(f"mean_impute: no observed value in {empty}")
    return df.select(*[
        F.coalesce(_as_double(c, types[c]), F.lit(float(means[c]))).alias(c)
        if c in means else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# M2: chained-equation imputation
# ---------------------------------------------------------------------------

_EPS = float(np.finfo(np.float64).eps)
# Different sets of missing cells whose moments the driver holds.
MAX_PATTERNS = 20_000
# A column update: the column, its intercept, (column, coefficient) of the rest.
Step = tuple[int, float, list[tuple[int, float]]]


def bayesian_ridge(G: np.ndarray, g: np.ndarray, yy: float, n: float,
                   tol: float = 1e-3, max_iter: int = 300, alpha_1: float = 1e-6,
                   alpha_2: float = 1e-6, lambda_1: float = 1e-6,
                   lambda_2: float = 1e-6) -> np.ndarray:
    """Bayesian ridge (evidence maximisation, MacKay 1992) from centred
    moments: ``G = XcᵀXc``, ``g = Xcᵀyc``, ``yy = ycᵀyc``.  Returns coefficients.

    Same update rules as the usual iterative estimator: precision of the noise
    ``alpha`` and of the weights ``lambda`` re-estimated until the
    coefficients move less than ``tol`` (L1), then one final solve.
    """
    p = G.shape[0]
    if p == 0:
        return np.zeros(0)
    eig, V = np.linalg.eigh(G)
    eig = np.clip(eig, 0.0, None)
    Vg = V.T @ g
    alpha = 1.0 / (yy / n + _EPS) if n > 0 else 1.0
    lam = 1.0

    def solve(alpha, lam):
        return V @ (Vg / (eig + lam / alpha))

    coef_old = None
    for it in range(max_iter):
        coef = solve(alpha, lam)
        rss = max(yy - 2.0 * coef @ g + coef @ G @ coef, 0.0)
        gamma = float(np.sum(alpha * eig / (lam + alpha * eig)))
        lam = (gamma + 2 * lambda_1) / (float(coef @ coef) + 2 * lambda_2)
        alpha = (n - gamma + 2 * alpha_1) / (rss + 2 * alpha_2)
        if it != 0 and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef.copy()
    return solve(alpha, lam)


def least_squares(G: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Ordinary least squares from centred moments (minimum-norm solution)."""
    if G.shape[0] == 0:
        return np.zeros(0)
    return np.linalg.lstsq(G, g, rcond=None)[0]


def _unpack(row, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    n = float(row["_n"] or 0)
    s = np.array([row[f"_s{a}"] or 0.0 for a in range(p)], dtype=float)
    M = np.zeros((p, p))
    for a in range(p):
        for b in range(a, p):
            M[a, b] = M[b, a] = row[f"_m{a}_{b}"] or 0.0
    return n, s, M


def pattern_maps(pattern: np.ndarray, means: np.ndarray, rounds: list[list[Step]]) -> list[np.ndarray]:
    """Imputation as affine maps.  ``pattern``: which columns a row misses.
    Entry t turns the row's shifted values (x - mean, 0 where missing, and a 1)
    into those after t rounds; entry 0 is the mean fill."""
    p = len(pattern)
    cur = np.hstack([np.diag((~pattern).astype(float)), np.zeros((p, 1))])
    out = [cur]
    for steps in rounds:
        cur = cur.copy()
        for j, icpt, coefs in steps:
            if pattern[j]:
                row = np.zeros(p + 1)
                row[p] = icpt - means[j]
                for a, b in coefs:
                    row += b * cur[a]
                cur[j] = row
        out.append(cur)
    return out


def _by_pattern(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pattern, row numbers) of the rows of ``x`` that miss the same cells."""
    missing = np.isnan(x)
    patterns, which = np.unique(missing, axis=0, return_inverse=True)
    which = which.reshape(-1)
    for k, pattern in enumerate(patterns):
        yield pattern, np.nonzero(which == k)[0]


def _matrix(column: pd.Series, p: int) -> np.ndarray:
    return np.array([np.array(v, dtype=float) for v in column], dtype=float).reshape(len(column), p)


@dataclass
class ImputerModel:
    """Fitted chained equations: observed means and, round by round and in
    order, every column update ``x_j := icpt + Σ coef_a (x_a − mean_a)`` applied
    to the cells of ``x_j`` that were missing.  For rows that miss the same
    cells all the updates together are one affine map, so replaying them is one
    matrix product, on new batches and on a stream alike."""
    names: list[str]
    means: list[float]
    rounds: list[list[Step]]

    def transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        values = F.array(*[_as_double(c, types[c]) for c in self.names])
        filled = df.select("*", self.fill(values).alias("_filled"))
        place = {c: i for i, c in enumerate(self.names)}
        return filled.select(*[F.col("_filled")[place[c]].alias(c) if c in place else F.col(c)
                               for c in df.columns])

    def fill(self, values: Column) -> Column:
        """An array of the columns' values (null where missing), completed."""
        means, rounds, p = np.array(self.means), self.rounds, len(self.names)
        known: dict[bytes, np.ndarray] = {}

        @F.pandas_udf("array<double>")
        def run(column: pd.Series) -> pd.Series:
            x = _matrix(column, p)
            out = x.copy()
            for pattern, rows in _by_pattern(x):
                if not pattern.any():
                    continue
                key = pattern.tobytes()
                if key not in known:
                    if len(known) >= MAX_PATTERNS:
                        known.clear()
                    known[key] = pattern_maps(pattern, means, rounds)[-1]
                z = np.where(pattern, 0.0, x[rows] - means)
                full = z @ known[key][:, :p].T + known[key][:, p]
                out[rows] = np.where(pattern, full + means, x[rows])
            return pd.Series(list(out))

        return run(values)


def iterative_impute(df: DataFrame, cols: Iterable[str] | None = None,
                     exclude: Iterable[str] = (), max_iter: int = D.IMPUTE_MAX_ITER,
                     tol: float = D.IMPUTE_TOL, estimator: str = "bayes",
                     checkpoint: bool = True, return_model: bool = False):
    """Impute every missing numeric cell by regressing its column on the others.

    Start from the observed means; visit columns with missing cells in
    ascending order of their missing count; for each, fit ``estimator``
    (``'bayes'``: Bayesian ridge, ``'ols'``: least squares) on the rows where it
    is observed and replace only its missing cells.  Stop after ``max_iter``
    rounds or when the largest per-row total absolute change falls below
    ``tol · max|observed|``.  Output columns are double; other columns and
    the column order are kept.

    The number of jobs doesn't depend on the rounds: rows that miss the same
    cells share an affine map from their observed values, so one aggregate of
    moments by missing pattern is all the regressions need, and one more scan
    gives the change of every round.
    """
    if estimator not in ("bayes", "ols"):
        raise ValueError("estimator must be 'bayes' or 'ols'")
    types = {f.name: f.dataType for f in df.schema.fields}
    skip = {c.lower() for c in exclude}
    names = name_lookup(df, cols) if cols is not None else [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name.lower() not in skip]
    names = [c for c in names if c.lower() not in skip]
    p = len(names)

    def done(frame, means=(), rounds=()):
        if return_model:
            return frame, ImputerModel(names, [float(m) for m in means], list(rounds))
        return frame

    if p == 0:
        return done(df)

    # The values as one array beside the other columns, written once: the
    # profile, the moments, the scan of changes and the result read it.
    others = [c for c in df.columns if c not in set(names)]
    base = df.select(*[F.col(c) for c in others],
                     F.array(*[_as_double(c, types[c]) for c in names]).alias("_x"))
    if checkpoint:
        base = cut_lineage(base)
    x = [F.col("_x")[i] for i in range(p)]

    def columns(frame: DataFrame, values: Column) -> DataFrame:
        place = {c: i for i, c in enumerate(names)}
        wide = frame.select(*[F.col(c) for c in others], values.alias("_filled"))
        return wide.select(*[F.col("_filled")[place[c]].alias(c) if c in place else F.col(c)
                             for c in df.columns])

    # One aggregate: observed means, missing counts, max |observed|.
    prof = base.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.avg(x[i]).alias(f"_mean{i}") for i in range(p)],
        *[F.count_if(x[i].isNull()).alias(f"_nmiss{i}") for i in range(p)],
        F.greatest(*[F.max(F.abs(v)) for v in x], F.lit(0.0)).alias("_absmax"),
    ).first()
    means = np.array([prof[f"_mean{i}"] if prof[f"_mean{i}"] is not None else np.nan
                      for i in range(p)])
    if prof["_rows"] and np.isnan(means).any():
        empty = [names[i] for i in range(p) if np.isnan(means[i])]
        raise ValueError(f"iterative_impute: no observed value in {empty}")
    nmiss = [prof[f"_nmiss{i}"] for i in range(p)]
    order = [i for i in sorted(range(p), key=lambda i: (nmiss[i], i)) if nmiss[i] > 0]
    if not order:
        return done(columns(base, F.col("_x")), means)

    moments = _pattern_moments(base, x, means)
    rounds = _fit_rounds(moments, means, order, max_iter, estimator)
    threshold = tol * float(prof["_absmax"] or 0.0)
    for t, change in enumerate(_changes(base, means, rounds)):
        if change < threshold:
            rounds = rounds[:t + 1]
            break
    model = ImputerModel(names, [float(m) for m in means], rounds)
    return done(columns(base, model.fill(F.col("_x"))), means, rounds)


def _pattern_moments(base: DataFrame, x: list[Column], means: np.ndarray):
    """Σz, Σzzᵀ and the count per missing pattern, z the values shifted by the
    observed means (so that the products don't cancel), 0 where missing."""
    p = len(x)
    z = [F.coalesce(v - F.lit(float(m)), F.lit(0.0)) for v, m in zip(x, means)]
    pattern = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in x])
    rows = cut_lineage(base.groupBy(pattern.alias("_pattern")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(z[a]).alias(f"_s{a}") for a in range(p)],
        *[F.sum(z[a] * z[b]).alias(f"_m{a}_{b}") for a in range(p) for b in range(a, p)]))
    few = rows.limit(MAX_PATTERNS + 1).count() <= MAX_PATTERNS
    return LocalMoments(rows.collect(), means) if few else SparkMoments(rows, means)


def _parsed(rows, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns, and their moments with a row and column for the constant 1."""
    missing = np.array([[c == "1" for c in r["_pattern"]] for r in rows], bool).reshape(len(rows), p)
    seen = np.zeros((len(rows), p + 1, p + 1))
    for k, r in enumerate(rows):
        n, s, m = _unpack(r, p)
        seen[k, :p, :p], seen[k, :p, p], seen[k, p, :p], seen[k, p, p] = m, s, s, n
    return missing, seen


class LocalMoments:
    """Moments of the completed rows, pattern by pattern, on the driver."""

    def __init__(self, rows: list, means: np.ndarray):
        p = len(means)
        self.missing, self.seen = _parsed(rows, p)
        self.maps = np.array([pattern_maps(m, means, [])[0] for m in self.missing]).reshape(-1, p, p + 1)
        self.full, self.total = self.seen[:, :p, :p].copy(), self.seen[:, :p, p].copy()

    def where_observed(self, j: int, _: list) -> tuple[float, np.ndarray, np.ndarray]:
        has = ~self.missing[:, j]
        return self.seen[has, -1, -1].sum(), self.total[has].sum(axis=0), self.full[has].sum(axis=0)

    def update(self, j: int, shift: float, coef: np.ndarray, rest: list[int]) -> None:
        """Column j becomes ``shift + coef · rest``: only its row and column of
        the completed moments change."""
        lacks = self.missing[:, j]
        row = np.einsum("a,kab->kb", coef, self.maps[lacks][:, rest])
        row[:, -1] += shift
        self.maps[lacks, j] = row
        cross = np.einsum("kb,kbc->kc", row, self.seen[lacks])
        products = np.einsum("kc,kac->ka", cross, self.maps[lacks])
        self.full[lacks, j, :] = products
        self.full[lacks, :, j] = products
        self.total[lacks, j] = cross[:, -1]


class SparkMoments:
    """The same for any number of patterns: their table stays distributed, and
    every column update is one job over it."""

    def __init__(self, rows: DataFrame, means: np.ndarray):
        self.rows, self.means = rows, means

    def where_observed(self, j: int, rounds: list) -> tuple[float, np.ndarray, np.ndarray]:
        means, p = self.means, len(self.means)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((p + 1, p + 1))
            for batch in batches:
                for pattern, seen in zip(*_parsed(batch.to_dict("records"), p)):
                    if not pattern[j]:
                        full = np.vstack([pattern_maps(pattern, means, rounds)[-1], np.eye(p + 1)[p]])
                        sums += full @ seen @ full.T
            yield pd.DataFrame({"sums": [sums.ravel()]})

        got = self.rows.mapInPandas(run, "sums array<double>").collect()      # one row per task
        sums = np.sum([r["sums"] for r in got], axis=0).reshape(p + 1, p + 1)
        return sums[p, p], sums[:p, p], sums[:p, :p]

    def update(self, j: int, shift: float, coef: np.ndarray, rest: list[int]) -> None:
        pass


def _fit_rounds(moments, means: np.ndarray, order: list[int], max_iter: int,
                estimator: str) -> list[list[Step]]:
    """The regressions of all rounds, from the moments alone."""
    p = len(means)
    rounds: list[list[Step]] = []
    for _ in range(max_iter):
        rounds.append([])
        for j in order:
            n, s, M = moments.where_observed(j, rounds)
            mu = s / n if n > 0 else np.zeros(p)
            C = M - n * np.outer(mu, mu)
            rest = [a for a in range(p) if a != j]
            G, g, yy = C[np.ix_(rest, rest)], C[rest, j], C[j, j]
            coef = (bayesian_ridge(G, g, yy, n, tol=1e-3) if estimator == "bayes"
                    else least_squares(G, g))
            icpt = mu[j] - float(coef @ mu[rest])
            rounds[-1].append((j, float(icpt + means[j]), [(a, float(b)) for a, b in zip(rest, coef)]))
            moments.update(j, icpt, coef, rest)
    return rounds


def _changes(base: DataFrame, means: np.ndarray, rounds: list[list[Step]]) -> list[float]:
    """Per round the largest total absolute change of a row, in one scan."""
    p = len(means)
    if not rounds:
        return []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, list[np.ndarray]] = {}
        most = np.zeros(len(rounds))
        for batch in batches:
            x = _matrix(batch["_x"], p)
            for pattern, rows in _by_pattern(x):
                if not pattern.any():
                    continue
                key = pattern.tobytes()
                if key not in known:
                    known[key] = pattern_maps(pattern, means, rounds)
                z = np.hstack([np.where(pattern, 0.0, x[rows] - means), np.ones((len(rows), 1))])
                maps = known[key]
                for t in range(len(rounds)):
                    change = np.abs(z @ (maps[t + 1] - maps[t])[pattern].T).sum(axis=1).max()
                    most[t] = max(most[t], change)
        yield pd.DataFrame({"round": np.arange(len(rounds)), "change": most})

    found = base.select("_x").mapInPandas(run, "round int, change double").groupBy("round").agg(
        F.max("change").alias("change")).collect()
    return [c for _, c in sorted((r["round"], r["change"]) for r in found)]
