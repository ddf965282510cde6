"""Whole pipelines (L1-L3) as function composition over DataFrames.

Only small fitted state crosses to the driver (missing shares, dictionaries of
checked size, scaler statistics, moment sums, model parameters).  The table
the models read is cut from its lineage once (a reliable checkpoint into the
shared folder), so the iterative trainers re-read a materialised table and a
lost executor does not replay cleaning, encoding and imputation.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile import defaults as D
from turnstile.functions.expressions import name_lookup
from turnstile.operators.clean import clean, drop_columns
from turnstile.operators.encode import apply_dictionary, fit_label_dictionary, prepare_features
from turnstile.operators.impute import apply_group_modes, group_modes, iterative_impute
from turnstile.operators.model import (
    evaluate_accuracy,
    feature_importance,
    fit_forest,
    fit_mlp,
    turnover_report,
)
from turnstile.operators.neighbors import class_values
from turnstile.operators.network import fit_relu
from turnstile.operators.profile import class_counts, high_missing_names, missing_percent, require_complete
from turnstile.operators.sample import smote, train_test_split
from turnstile.session import cut_lineage, fit_partitions


@dataclass(frozen=True)
class Columns:
    """Column roles.  Defaults are the reference's HR names."""
    id: str = D.HR_ID
    label: str = D.HR_LABEL
    exempt: tuple[str, ...] = D.HR_EXEMPT
    dates: tuple[str, ...] = D.HR_DATES
    group: str = D.HR_GROUP
    group_value: str = D.HR_GROUP_VALUE
    numeric: tuple[str, ...] = D.HR_NUMERIC
    categorical: tuple[str, ...] = D.HR_CATEGORICAL
    drop: tuple[str, ...] | None = None          # fixed drop list (legacy); None = data-driven
    impute_exclude: tuple[str, ...] = ()         # parity: id and label take part


# Rows per partition: the forest does heavy work per row (many trees), the
# network light work per row but one job per iteration.
FOREST_ROWS_PER_PARTITION = 1_000
NETWORK_ROWS_PER_PARTITION = 25_000

LEGACY = Columns(dates=D.HR_DATES_LEGACY, drop=D.HR_LEGACY_DROP)


@dataclass
class Settings:
    threshold: float = D.MISSING_THRESHOLD
    null_group: str = "null"
    empty_group: str = "error"
    impute_max_iter: int = D.IMPUTE_MAX_ITER
    impute_estimator: str = "bayes"
    test_size: float = D.TEST_SIZE
    split_seed: int = D.SPLIT_SEED
    forest: dict = field(default_factory=dict)
    network: str = "relu"            # or "sigmoid": Spark ML's, by L-BFGS
    mlp_max_iter: int = D.MLP_MAX_ITER
    count_balanced: bool = True      # class counts after SMOTE, which cost a neighbour search
    use_balanced: bool = False       # parity: balanced rows are only counted
    fit_forest: bool = True          # importances
    fit_network: bool = True         # turnover report and accuracy


def prepare_table(df: DataFrame, cols: Columns = Columns(), s: Settings = Settings()) -> dict:
    """L1 up to the imputed table: clean → profile → drop → mode fill →
    label encode → chained-equation imputation."""
    cleaned = clean(df, cols.exempt, cols.dates)
    # One row per column, read several times.
    report = cut_lineage(missing_percent(cleaned))
    if cols.drop is None:
        dropped = high_missing_names(cleaned, s.threshold, report=report)
    else:
        dropped = name_lookup(cleaned, cols.drop)      # an absent column raises
    slim = drop_columns(cleaned, dropped)
    present = {c.lower() for c in slim.columns}
    modes = None
    if cols.group.lower() in present and cols.group_value.lower() in present:
        modes = cut_lineage(group_modes(slim, cols.group, cols.group_value))
        slim = apply_group_modes(slim, modes, cols.group, cols.group_value,
                                 s.null_group, s.empty_group)
    (id_name,) = name_lookup(slim, [cols.id])
    slim = slim.withColumn("_orig_id", F.col(id_name))
    dictionary = fit_label_dictionary(slim)
    encoded = apply_dictionary(slim, dictionary)
    imputed, imputer = iterative_impute(encoded, exclude=(*cols.impute_exclude, "_orig_id"),
                                        max_iter=s.impute_max_iter,
                                        estimator=s.impute_estimator, return_model=True)
    return {"cleaned": cleaned, "missing_report": report, "dropped": dropped,
            "modes": modes, "label_dictionary": dictionary, "dictionary": dictionary.frame,
            "imputer": imputer, "imputed": imputed}


def train_and_score(df: DataFrame, cols: Columns = Columns(), s: Settings = Settings(),
                    id_col: str | None = None) -> dict:
    """L3 on an encoded, complete table: counts, (balancing), features,
    split, forest importances, network, turnover report, test accuracy."""
    spark = df.sparkSession
    ident = id_col or cols.id
    (lab,) = name_lookup(df, [cols.label])
    # Written before anything reads it, so that imputation runs once.
    df = cut_lineage(df)
    counts = class_counts(df, lab)
    result = {"class_counts": counts, "trained": False}
    class_values(df, lab)                               # raises if it is no class label
    if not require_complete(df):
        return result                                   # reference skips silently
    count_rows = {r[lab]: r["n"] for r in counts.collect()}
    if s.fit_network and len(count_rows) != 2:
        raise ValueError(f"label {lab} has levels {sorted(count_rows)}; the network's "
                         "output has two units, so exactly two are needed")
    n_rows = sum(count_rows.values())
    spread = fit_partitions(df, n_rows, FOREST_ROWS_PER_PARTITION, per_core=2)
    table = df if spread is df else cut_lineage(spread)
    feature_cols = [c for c in table.columns if c not in (lab, "_orig_id")]
    # The split is on the id as it was read: the imputed one is a double.
    split_id = "_orig_id" if "_orig_id" in table.columns else ident
    numeric, categorical = name_lookup(table, cols.numeric), name_lookup(table, cols.categorical)
    split = train_test_split(table, split_id, s.test_size, s.split_seed)
    if s.count_balanced:
        # SMOTE on the whole table, as the reference runs it: for its counts.
        result["balanced_counts"] = class_counts(smote(table, split_id, feature_cols, lab), lab)
    train_rows = split.where(F.col("split") == "train")
    if s.use_balanced:
        # Only the train part; synthetic rows are in no report.
        train_rows = cut_lineage(smote(train_rows, split_id, feature_cols, lab)
                                 .drop("is_synthetic", "copy_index")).withColumn("split", F.lit("train"))
    report_id = "_orig_id" if "_orig_id" in table.columns else ident
    # The forest and the network are independent fits on the same table: the
    # forest runs on a second thread (as Spark ML's own model-selection
    # `parallelism` does), so its jobs fill the cores the network's short
    # per-iteration jobs leave idle.
    pool = ThreadPoolExecutor(max_workers=1) if s.fit_forest else None
    forest_job = None
    if pool is not None:
        forest_job = pool.submit(fit_forest, train_rows, feature_cols, lab, **s.forest)
    try:
        if s.fit_network:
            keep = list(dict.fromkeys([report_id, lab, "split"]))
            prepared, flat, feature_model = prepare_features(split, numeric, categorical,
                                                             keep=keep, return_model=True)
            result["feature_model"] = feature_model
            # The network's gradient per row is cheap: few large partitions keep
            # the per-iteration job short.
            prepared = fit_partitions(prepared, n_rows, NETWORK_ROWS_PER_PARTITION)
            test = prepared.where(F.col("split") == "test")
            train = (feature_model.transform(train_rows, keep=[lab]) if s.use_balanced
                     else prepared.where(F.col("split") == "train"))
            if s.network == "relu":
                # Reads its rows once.
                mlp = fit_relu(train, "features", lab, n_inputs=len(flat), passes=s.mlp_max_iter)
            else:
                train = train.persist()
                mlp = fit_mlp(train, "features", lab, n_inputs=len(flat), max_iter=s.mlp_max_iter)
                train.unpersist()
            result["turnover"] = turnover_report(mlp, prepared, report_id)
            result["accuracy"] = evaluate_accuracy(mlp, test, lab)
            result["feature_names"] = flat
            result["mlp"] = mlp
        if forest_job is not None:
            forest = forest_job.result()
            result["importances"] = feature_importance(spark, forest, feature_cols)
            result["forest"] = forest
    finally:
        if pool is not None:
            pool.shutdown(wait=True)
    result["trained"] = True
    return result


def run_pipeline(df: DataFrame, cols: Columns = Columns(), s: Settings = Settings()) -> dict:
    """L1 (canonical): clean, profile, drop >threshold columns, mode fill,
    encode, impute, then train and score.  Returns frames and models."""
    prepared = prepare_table(df, cols, s)
    imputed = prepared["imputed"]
    keep = [c for c in imputed.columns]
    out = train_and_score(imputed.select(*keep), cols, s)
    return {**prepared, **out}


def run_legacy(df: DataFrame, s: Settings = Settings(), cols: Columns = LEGACY) -> dict:
    """L2: fixed drop list, only Start_Date treated as a date."""
    return run_pipeline(df, cols, s)


def with_columns(cols: Columns, **changes) -> Columns:
    return replace(cols, **changes)
