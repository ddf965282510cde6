"""turnstile — a Spark-native data-preparation and scoring engine for
employee-turnover tables.

Every operator takes a DataFrame plus column names and returns a DataFrame
(or small fitted state plus a DataFrame).  Work runs on the executors; only
bounded state (counts, dictionaries of checked size, means, a p x p Gram
matrix, model parameters) reaches the driver.
"""

from turnstile.operators.clean import (
    clean,
    drop_columns,
    epoch_to_date,
    fill_null,
    select_datapoints,
    sentinels_to_null,
    split_target,
)
from turnstile.operators.profile import (
    class_counts,
    high_missing_columns,
    is_unique,
    missing_mask,
    missing_percent,
    profile,
    require_complete,
    total_missing,
)
from turnstile.operators.impute import fill_group_mode, iterative_impute, mean_impute
from turnstile.operators.encode import (
    label_encode,
    one_hot,
    one_hot_label,
    prepare_features,
    standardize,
)
from turnstile.operators.sample import smote, smote_neighbors, train_test_split
from turnstile.operators.model import (
    evaluate_accuracy,
    feature_importance,
    fit_forest,
    fit_mlp,
    turnover_report,
)
from turnstile.sources.files import read_config, read_csv, read_table, write_csv
from turnstile.plans.pipeline import run_pipeline, train_and_score

__all__ = [
    "clean", "drop_columns", "epoch_to_date", "fill_null", "select_datapoints",
    "sentinels_to_null", "split_target",
    "class_counts", "high_missing_columns", "is_unique", "missing_mask",
    "missing_percent", "profile", "require_complete", "total_missing",
    "fill_group_mode", "iterative_impute", "mean_impute",
    "label_encode", "one_hot", "one_hot_label", "prepare_features", "standardize",
    "smote", "smote_neighbors", "train_test_split",
    "evaluate_accuracy", "feature_importance", "fit_forest", "fit_mlp",
    "turnover_report",
    "read_config", "read_csv", "read_table", "write_csv",
    "run_pipeline", "train_and_score",
]
