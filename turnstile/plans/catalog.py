"""Registered queries: one Spark plan per operator, plus the equivalent SQL
for the DuckDB oracle.  All run over the whole derived views (``emp`` from
orders, ``cust_emp`` from customer); doubles are rounded the same way on both
sides so results compare exactly.
"""

from __future__ import annotations

import uuid
from typing import Callable

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile import defaults as D
from turnstile.operators import clean as C
from turnstile.operators import encode as E
from turnstile.operators import impute as I
from turnstile.operators import model as M
from turnstile.operators import profile as P
from turnstile.operators import sample as S
from turnstile.operators.network import Network
from turnstile.plans.pipeline import Columns, Settings, run_legacy, run_pipeline, train_and_score
from turnstile.session import checkpoint_dir
from turnstile.sources.files import read_config, read_configured, read_csv, write_csv
from turnstile.sources.fixtures import CUST_EMP_SQL, EMP_SQL, cust_emp, emp, emp_stream

# Column roles of the derived views.
EMP_STRINGS = ["position", "department", "gender", "is_active", "education_field",
               "salary_scale", "start_date"]
EMP_CATEGORICAL = ["position", "department", "gender", "education_field"]
CUST_FEATURES = ["age", "monthly_income", "total_working_years"]
EMP_COLUMNS = Columns(id="employee_id", label="is_active", group="department",
                      group_value="position",
                      numeric=("age", "education", "job_satisfaction", "monthly_income",
                               "start_date"),
                      categorical=tuple(EMP_CATEGORICAL))
CUST_COLUMNS = Columns(id="employee_id", label="is_active", exempt=("employee_id",),
                       dates=(), numeric=tuple(CUST_FEATURES), categorical=("department",))


def _r(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _cleaned(spark, d):
    return C.clean(emp(spark, d))


def _encoded_cust(spark, d):
    enc, _ = E.label_encode(cust_emp(spark, d), ["department", "is_active"])
    return enc


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def q_select_datapoints(spark, d):
    return C.select_datapoints(
        emp(spark, d),
        ["employee_id", "position", "is_active", "education", "job_satisfaction",
         "monthly_income", "salary_scale", "start_date"],
        ["department", "age", "gender", "education_field", "standard_hours"])


def q_drop_columns(spark, d):
    return C.drop_columns(emp(spark, d), ["standard_hours", "salary_scale"])


def q_sentinels_to_null(spark, d):
    return C.sentinels_to_null(emp(spark, d), exempt=D.HR_EXEMPT)


def q_fill_null(spark, d):
    return C.fill_null(emp(spark, d), ["monthly_income", "start_date", "education"], 0)


def q_epoch_to_date(spark, d):
    return C.epoch_to_date(emp(spark, d).select("employee_id", "start_date"), ["start_date"])


def q_clean(spark, d):
    return _cleaned(spark, d)


def q_missing_percent(spark, d):
    return P.missing_percent(_cleaned(spark, d))


def q_high_missing_columns(spark, d):
    return P.high_missing_columns(_cleaned(spark, d), D.MISSING_THRESHOLD)


def q_profile(spark, d):
    return P.profile(_cleaned(spark, d))


def q_missing_mask(spark, d):
    return P.missing_mask(_cleaned(spark, d), keep=["employee_id"])


def q_total_missing(spark, d):
    return P.total_missing(_cleaned(spark, d))


def q_is_unique(spark, d):
    return P.is_unique(emp(spark, d), "employee_id")


def q_class_counts(spark, d):
    return P.class_counts(emp(spark, d), "is_active")


def q_fill_group_mode(spark, d):
    filled = I.fill_group_mode(_cleaned(spark, d), "department", "position")
    return filled.select("employee_id", "department", "position")


def q_label_encode(spark, d):
    enc, _ = E.label_encode(_cleaned(spark, d))
    return enc


def q_label_dictionary(spark, d):
    _, dictionary = E.label_encode(_cleaned(spark, d))
    return dictionary


def q_mean_impute(spark, d):
    cols = ["age", "education", "job_satisfaction", "monthly_income", "standard_hours"]
    out = I.mean_impute(_cleaned(spark, d).select("employee_id", *cols), cols)
    return _r(out, cols)


def q_missing_after_impute(spark, d):
    cols = ["age", "education", "job_satisfaction", "monthly_income", "standard_hours"]
    return P.total_missing(I.mean_impute(_cleaned(spark, d).select(*cols), cols))


def q_iterative_impute_round1(spark, d):
    base = _cleaned(spark, d).select("employee_id", "age", "monthly_income")
    out = I.iterative_impute(base, ["age", "monthly_income"], estimator="ols", max_iter=1)
    return _r(out, ["age", "monthly_income"], 2)


OLS_COLUMNS = ["age", "education", "monthly_income"]
OLS_ROUNDS = 10


def q_iterative_impute_ols(spark, d):
    base = _cleaned(spark, d).select("employee_id", *OLS_COLUMNS)
    out = I.iterative_impute(base, OLS_COLUMNS, estimator="ols", max_iter=OLS_ROUNDS, tol=0.0)
    return _r(out, OLS_COLUMNS, 2)


def q_iterative_impute(spark, d):
    enc, _ = E.label_encode(_cleaned(spark, d).drop("salary_scale", "standard_hours"))
    return I.iterative_impute(enc, exclude=["employee_id"])


def q_standardize(spark, d):
    out = E.standardize(_cleaned(spark, d).select("employee_id", "age", "monthly_income"),
                        ["age", "monthly_income"])
    return _r(out, ["age", "monthly_income"])


def q_one_hot(spark, d):
    out, _ = E.one_hot(_cleaned(spark, d).select("employee_id", *EMP_CATEGORICAL),
                       EMP_CATEGORICAL)
    return out


def q_one_hot_wide(spark, d):
    return E.one_hot_long(_cleaned(spark, d), "employee_id", EMP_STRINGS)


def q_one_hot_label(spark, d):
    out, _ = E.one_hot_label(emp(spark, d).select("employee_id", "is_active"), "is_active")
    return out


def q_prepare_features(spark, d):
    out, flat = E.prepare_features(cust_emp(spark, d), CUST_FEATURES, ["department"],
                                   keep=["employee_id"], assemble=False)
    return _r(out, flat)


def q_split_target(spark, d):
    features, _ = C.split_target(emp(spark, d), "is_active")
    return features


def q_train_test_split(spark, d):
    return S.train_test_split(emp(spark, d).select("employee_id"), "employee_id")


def q_smote_neighbors(spark, d):
    out = S.smote_neighbors(cust_emp(spark, d), "employee_id", CUST_FEATURES, "is_active")
    return _r(out, ["distance"])


# Twelve features of very unequal scale, as in the HR table, from the customers.
WIDE_FEATURES = ["employee_id", "monthly_income", "age", "total_working_years", *[f"f{k}" for k in range(8)]]


def _wide_emp(spark, d):
    k = F.col("employee_id")
    mods = [3, 4, 5, 7, 40, 97, 1009, 2411]
    return cust_emp(spark, d).select(
        "*", *[((k * (2 * j + 3)) % m).cast("double").alias(f"f{j}") for j, m in enumerate(mods)])


def q_smote_neighbors_wide(spark, d):
    out = S.smote_neighbors(_wide_emp(spark, d), "employee_id", WIDE_FEATURES, "is_active")
    return _r(out, ["distance"])


def q_smote_neighbors_k3(spark, d):
    out = S.smote_neighbors(cust_emp(spark, d), "employee_id", CUST_FEATURES, "is_active", k=3)
    return _r(out, ["distance"])


def q_smote_neighbors_k3_ties(spark, d):
    """Few points with many rows each: neighbours at distance zero, by id."""
    out = S.smote_neighbors(cust_emp(spark, d), "employee_id", ["total_working_years", "age"], "is_active", k=3)
    return _r(out, ["distance"])


def q_smote_k3(spark, d):
    out = S.smote(cust_emp(spark, d).drop("department"), "employee_id", CUST_FEATURES, "is_active", k=3)
    return _r(out, CUST_FEATURES)


def q_smote(spark, d):
    out = S.smote(cust_emp(spark, d).drop("department"), "employee_id", CUST_FEATURES,
                  "is_active")
    return _r(out, CUST_FEATURES)


def q_smote_counts(spark, d):
    out = S.smote(cust_emp(spark, d).drop("department"), "employee_id", CUST_FEATURES,
                  "is_active")
    return P.class_counts(out, "is_active")


def q_csv_roundtrip(spark, d):
    # Texts with spaces at both ends, quotes and separators; read by names in
    # another order than the file's.
    cleaned = _cleaned(spark, d).withColumn("note", F.concat(
        F.lit(' "'), F.coalesce("position", F.lit("none")), F.lit('", 0 ')))
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex}"
    write_csv(cleaned, path)
    turned = T.StructType(list(reversed(cleaned.schema.fields)))
    return read_csv(spark, path, schema=turned)


def q_csv_multiline(spark, d):
    """Line ends, quotes and separators inside cells; read in parts."""
    rows = C.clean(emp(spark, d)).withColumn("note", F.concat(
        F.lit('a "'), F.coalesce("position", F.lit("none")), F.lit('",\nsecond\r\n\n"'),
        F.coalesce("department", F.lit("")), F.lit('"\nend')))
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-multiline-{uuid.uuid4().hex}"
    write_csv(rows, path)
    return read_csv(spark, path, schema=rows.schema, multi_line=True)


def _cust_trained(spark, d, forest: bool = True, network: bool = True):
    settings = Settings(fit_forest=forest, fit_network=network, count_balanced=False)
    return train_and_score(_encoded_cust(spark, d), CUST_COLUMNS, settings)


def q_balanced_counts(spark, d):
    """SMOTE as the training step runs it, the id among the features."""
    settings = Settings(fit_forest=False, fit_network=False)
    return train_and_score(_encoded_cust(spark, d), CUST_COLUMNS, settings)["balanced_counts"]


# Companions of the model queries: what must hold whatever the model learnt.

def q_turnover_check(spark, d):
    t = _cust_trained(spark, d, forest=False)["turnover"]
    p = F.col("turnover_percent")
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("emp_identifier").alias("n_ids"),
                 F.sum("emp_identifier").alias("id_sum"),
                 F.count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 100)).alias("n_out_of_range"))


def q_importance_check(spark, d):
    i = _cust_trained(spark, d, network=False)["importances"]
    total = i.agg(F.sum("importance").alias("total"), F.min("importance").alias("least"))
    return i.crossJoin(F.broadcast(total)).select(
        "feature", (F.abs(F.col("total") - 100.0) <= 1.0).alias("sums_to_100"),
        (F.col("least") >= 0).alias("none_negative"))


def q_accuracy_check(spark, d):
    a = _cust_trained(spark, d, forest=False)["accuracy"]
    share = cust_emp(spark, d).agg((100.0 * F.avg((F.col("is_active") == "Yes").cast("double"))).alias("share"))
    # The test part is a fifth of the rows, so its own share may differ a little.
    return a.crossJoin(F.broadcast(share)).select(
        "n_rows", (F.col("accuracy_percent") >= F.col("share") - 10).alias("at_least_majority"))


def q_stream_equals_batch(spark, d):
    from turnstile.streaming.score import fit_scoring_model, run_to_table
    model = fit_scoring_model(emp(spark, d), EMP_COLUMNS)
    stream = run_to_table(model.transform(emp_stream(spark, d)), f"same-{uuid.uuid4().hex}")
    batch = model.transform(emp(spark, d))
    a = stream.select(F.col("emp_identifier").alias("i"), F.round("turnover_percent", 6).alias("p"))
    b = batch.select(F.col("emp_identifier").alias("i"), F.round("turnover_percent", 6).alias("p"))
    both = a.join(b.withColumnRenamed("p", "q"), "i", "full")
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(~F.col("p").eqNullSafe(F.col("q"))).alias("n_different"))


def q_impute_check(spark, d):
    """Complete after imputation, and observed cells unchanged."""
    enc, _ = E.label_encode(_cleaned(spark, d).drop("salary_scale", "standard_hours"))
    done = I.iterative_impute(enc, exclude=["employee_id"])
    names = [c for c in enc.columns if c != "employee_id"]
    both = done.join(enc.select("employee_id", *[F.col(c).alias(f"_{c}") for c in names]), "employee_id")
    changed = [F.col(f"_{c}").isNotNull() & (F.abs(F.col(c) - F.col(f"_{c}")) > 1e-9) for c in names]
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        sum((F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in names),
            F.lit(0)).cast("bigint").alias("n_missing"),
        sum((F.count_if(c) for c in changed), F.lit(0)).cast("bigint").alias("n_changed"))


def q_pipeline_check(spark, d):
    t = run_pipeline(emp(spark, d), EMP_COLUMNS, Settings(fit_forest=False))["turnover"]
    p = F.col("turnover_percent")
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("emp_identifier").alias("id_sum"),
                 F.count_if(p.isNull() | (p < 0) | (p > 100)).alias("n_out_of_range"))


def q_legacy_check(spark, d):
    t = q_run_legacy(spark, d)
    p = F.col("turnover_percent")
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("emp_identifier").alias("id_sum"),
                 F.count_if(p.isNull() | (p < 0) | (p > 100)).alias("n_out_of_range"))


# A signal planted in the customers: who is old and long at work leaves.  Rows
# near the boundary are left out where single rows are compared.
SIGNAL_LIMIT, SIGNAL_MARGIN = 58, 5


def _planted_cust(spark, d):
    """The customers whose label is a function of two features."""
    leaves = F.col("age") + F.col("total_working_years") >= SIGNAL_LIMIT
    return cust_emp(spark, d).withColumn("is_active", F.when(leaves, "No").otherwise("Yes"))


def _planted_trained(spark, d, **settings):
    enc, _ = E.label_encode(_planted_cust(spark, d), ["department", "is_active"])
    return train_and_score(enc, CUST_COLUMNS, Settings(count_balanced=False, **settings))


def q_planted_turnover(spark, d):
    """Who leaves by the trained network, for all rows off the boundary."""
    t = _planted_trained(spark, d, fit_forest=False)["turnover"]
    off = _planted_cust(spark, d).where(
        F.abs(F.col("age") + F.col("total_working_years") - SIGNAL_LIMIT + 0.5) >= SIGNAL_MARGIN)
    return t.join(off.select(F.col("employee_id").alias("emp_identifier")), "emp_identifier").select(
        F.col("emp_identifier").cast("bigint").alias("emp_identifier"),
        (F.col("turnover_percent") > 50).alias("leaves"))


def q_planted_accuracy(spark, d):
    """Of the test part, and how far the report's means by class are apart."""
    out = _planted_trained(spark, d, fit_forest=False)
    by_class = out["turnover"].join(
        _planted_cust(spark, d).select(F.col("employee_id").alias("emp_identifier"), "is_active"), "emp_identifier").agg(
        F.avg(F.when(F.col("is_active") == "No", F.col("turnover_percent"))).alias("gone"),
        F.avg(F.when(F.col("is_active") == "Yes", F.col("turnover_percent"))).alias("here"))
    return out["accuracy"].crossJoin(F.broadcast(by_class)).select(
        "n_rows", (F.col("accuracy_percent") >= 95).alias("accurate"),
        ((F.col("gone") >= 85) & (F.col("here") <= 15)).alias("far_apart"))


def q_planted_importance(spark, d):
    """The two planted features come first, in the order of the report."""
    i = _planted_trained(spark, d, fit_network=False)["importances"]
    by = Window.orderBy(F.desc("importance"), "feature")  # a row per feature
    ranked = i.withColumn("position", F.row_number().over(by)).where("position <= 2")
    return ranked.select("position", "feature", (F.col("importance") >= 15).alias("large"))


# A network with fixed weights: multiples of an eighth, by a rule.
FORWARD_LAYERS = [3, 6, 6, 6, 2]
FORWARD_NET = Network(
    [np.array([[((7 * i + 3 * j + 5 * k) % 11 - 5) / 8 for j in range(m)] for i in range(n)])
     for k, (n, m) in enumerate(zip(FORWARD_LAYERS, FORWARD_LAYERS[1:]))],
    [np.array([((i + k) % 5 - 2) / 8 for i in range(m)]) for k, m in enumerate(FORWARD_LAYERS[1:])])


def q_mlp_forward(spark, d):
    inputs = F.array(F.col("age") / 64, F.col("total_working_years") / 25, F.col("monthly_income") / 10000)
    scored = FORWARD_NET.score(cust_emp(spark, d).withColumn("x", inputs), F.col("x"))
    return scored.select("employee_id", F.round(F.col("probability")[0], 9).alias("p_no"),
                         F.round(F.col("probability")[1], 9).alias("p_yes"))


def q_require_complete(spark, d):
    """The gate before training, before and after imputation."""
    enc, _ = E.label_encode(_cleaned(spark, d).drop("salary_scale", "standard_hours"))
    filled = I.mean_impute(enc)
    rows = [(name, P.total_missing(df).select(F.col("total_missing"))) for name, df in
            (("encoded", enc), ("imputed", filled))]
    out = None
    for name, missing in rows:
        part = missing.select(F.lit(name).alias("stage"), "total_missing",
                              (F.col("total_missing") == 0).alias("complete"))
        out = part if out is None else out.union(part)
    return out


def q_assemble(spark, d):
    """Columns to one vector and back, cell by cell."""
    df = M.assemble(cust_emp(spark, d), CUST_FEATURES)
    x = vector_to_array("features")
    return df.select("employee_id", F.size(x).alias("width"),
                     *[x[k].alias(f"x{k}") for k in range(len(CUST_FEATURES))])


def q_configured_scan(spark, d):
    """The configured columns of one table, written in four formats, each read by
    a config document that names its format and columns."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/configured-{uuid.uuid4().hex}"
    source = emp(spark, d)
    mandatory, optional = ["employee_id", "position", "is_active"], ["monthly_income", "start_date"]
    out = None
    for fmt in ("csv", "parquet", "json", "orc"):
        path = f"{root}/{fmt}"
        if fmt == "csv":
            write_csv(source, path)
        else:
            source.write.format(fmt).save(path)
        lists = F.struct(F.array(*map(F.lit, mandatory)).alias("mandatory"),
                         F.array(*map(F.lit, optional)).alias("optional"))
        config = F.struct(F.lit(fmt).alias("data_source"), lists.alias("list_of_datapoint"))
        spark.range(1).select(config.alias("config")).coalesce(1).write.json(f"{root}/{fmt}-config")
        part = read_configured(spark, path, read_config(spark, f"{root}/{fmt}-config"), schema=source.schema)
        part = part.select(F.lit(fmt).alias("format"), "*")
        out = part if out is None else out.union(part)
    return out


def q_split_repeated_ids(spark, d):
    """Exact size although ids repeat: a fifth of the rows of orders by customer."""
    rows = emp(spark, d).select((F.col("employee_id") % 7).alias("team"), "position")
    split = S.train_test_split(rows, "team")
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_split_label(spark, d):
    features, label = C.split_target(emp(spark, d), "is_active")
    return label


def q_feature_importance(spark, d):
    return _cust_trained(spark, d, network=False)["importances"]


def q_turnover_report(spark, d):
    return _cust_trained(spark, d, forest=False)["turnover"]


def q_evaluate_accuracy(spark, d):
    return _cust_trained(spark, d, forest=False)["accuracy"]


def q_stream_clean(spark, d):
    from turnstile.streaming.score import run_to_table
    return run_to_table(C.clean(emp_stream(spark, d)), f"clean-{uuid.uuid4().hex}")


def q_stream_score(spark, d):
    from turnstile.streaming.score import fit_scoring_model, run_to_table
    model = fit_scoring_model(emp(spark, d), EMP_COLUMNS)
    return run_to_table(model.transform(emp_stream(spark, d)), f"score-{uuid.uuid4().hex}")


def q_run_legacy(spark, d):
    # Legacy variant: a fixed drop list instead of the computed one, and only
    # the start date treated as epoch seconds.
    cols = Columns(id="employee_id", label="is_active", group="department",
                   group_value="position", dates=("start_date",),
                   drop=("standard_hours", "salary_scale"),
                   numeric=EMP_COLUMNS.numeric, categorical=EMP_COLUMNS.categorical)
    return run_legacy(emp(spark, d), Settings(), cols)["turnover"]


def q_run_pipeline(spark, d):
    return run_pipeline(emp(spark, d), EMP_COLUMNS, Settings())["turnover"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "select_datapoints": q_select_datapoints,
    "drop_columns": q_drop_columns,
    "sentinels_to_null": q_sentinels_to_null,
    "fill_null": q_fill_null,
    "epoch_to_date": q_epoch_to_date,
    "clean": q_clean,
    "missing_percent": q_missing_percent,
    "high_missing_columns": q_high_missing_columns,
    "profile": q_profile,
    "missing_mask": q_missing_mask,
    "total_missing": q_total_missing,
    "is_unique": q_is_unique,
    "class_counts": q_class_counts,
    "fill_group_mode": q_fill_group_mode,
    "label_encode": q_label_encode,
    "label_dictionary": q_label_dictionary,
    "mean_impute": q_mean_impute,
    "missing_after_impute": q_missing_after_impute,
    "iterative_impute_round1": q_iterative_impute_round1,
    "iterative_impute_ols": q_iterative_impute_ols,
    "iterative_impute": q_iterative_impute,
    "standardize": q_standardize,
    "one_hot": q_one_hot,
    "one_hot_wide": q_one_hot_wide,
    "one_hot_label": q_one_hot_label,
    "prepare_features": q_prepare_features,
    "split_target": q_split_target,
    "split_label": q_split_label,
    "train_test_split": q_train_test_split,
    "smote_neighbors": q_smote_neighbors,
    "smote_neighbors_wide": q_smote_neighbors_wide,
    "smote_neighbors_k3": q_smote_neighbors_k3,
    "smote_neighbors_k3_ties": q_smote_neighbors_k3_ties,
    "smote_k3": q_smote_k3,
    "smote": q_smote,
    "smote_counts": q_smote_counts,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_multiline": q_csv_multiline,
    "feature_importance": q_feature_importance,
    "turnover_report": q_turnover_report,
    "evaluate_accuracy": q_evaluate_accuracy,
    "stream_clean": q_stream_clean,
    "stream_score": q_stream_score,
    "run_pipeline": q_run_pipeline,
    "run_legacy": q_run_legacy,
    "balanced_counts": q_balanced_counts,
    "turnover_check": q_turnover_check,
    "importance_check": q_importance_check,
    "accuracy_check": q_accuracy_check,
    "impute_check": q_impute_check,
    "stream_equals_batch": q_stream_equals_batch,
    "pipeline_check": q_pipeline_check,
    "legacy_check": q_legacy_check,
    "mlp_forward": q_mlp_forward,
    "planted_turnover": q_planted_turnover,
    "planted_accuracy": q_planted_accuracy,
    "planted_importance": q_planted_importance,
    "require_complete": q_require_complete,
    "assemble": q_assemble,
    "configured_scan": q_configured_scan,
    "split_repeated_ids": q_split_repeated_ids,
}


# ---------------------------------------------------------------------------
# Oracle side (DuckDB SQL over the same parquet tables)
# ---------------------------------------------------------------------------

def _str_clean(c: str) -> str:
    return f"case when {c} in ('null', '0') then null else {c} end as {c}"


def _num_clean(c: str, floating: bool) -> str:
    nan = f" or isnan({c})" if floating else ""
    return f"case when {c} = 0{nan} then null else {c} end as {c}"


CLEANED_SQL = f"""
select employee_id,
  {_str_clean('position')}, {_str_clean('department')},
  {_num_clean('age', True)}, {_str_clean('gender')}, {_str_clean('is_active')},
  education, {_str_clean('education_field')}, job_satisfaction,
  {_num_clean('monthly_income', True)}, {_num_clean('standard_hours', False)},
  {_str_clean('salary_scale')},
  case when start_date is null or start_date = 0 then null
       else strftime(date '1970-01-01' + cast(floor(start_date / 86400.0) as integer), '%Y-%m-%d')
  end as start_date
from emp"""

WITH_EMP = f"with emp as ({EMP_SQL})"
WITH_CLEAN = f"with emp as ({EMP_SQL}), cleaned as ({CLEANED_SQL})"
WITH_CUST = f"with ce as ({CUST_EMP_SQL})"

CLEANED_COLS = [("employee_id", False), ("position", False), ("department", False),
                ("age", True), ("gender", False), ("is_active", False), ("education", False),
                ("education_field", False), ("job_satisfaction", False),
                ("monthly_income", True), ("standard_hours", False), ("salary_scale", False),
                ("start_date", False)]


def _missing_union(select_fn) -> str:
    parts = []
    for i, (c, fl) in enumerate(CLEANED_COLS):
        miss = f"({c} is null or isnan({c}))" if fl else f"{c} is null"
        parts.append(select_fn(i, c, miss))
    return "\nunion all\n".join(parts)


_PCT = "count_if({m}) * cast(100 as double) / count(*)"

MISSING_PERCENT_SQL = WITH_CLEAN + "\n" + _missing_union(
    lambda i, c, m: f"select '{c}' as column_name, {_PCT.format(m=m)} as percent_missing from cleaned")

HIGH_MISSING_SQL = WITH_CLEAN + ", rep as (\n" + _missing_union(
    lambda i, c, m: f"select '{c}' as column_name, {_PCT.format(m=m)} as percent_missing from cleaned"
) + "\n) select * from rep where percent_missing > 50"

PROFILE_SQL = WITH_CLEAN + "\n" + _missing_union(
    lambda i, c, m: (f"select '{c}' as column_name, count(*) as n_rows, 13 as n_columns, "
                     f"count_if({m}) as n_missing, {_PCT.format(m=m)} as percent_missing from cleaned"))

MISSING_MASK_SQL = WITH_CLEAN + "\nselect employee_id, " + ", ".join(
    (f"({c} is null or isnan({c})) as {c}_missing" if fl else f"({c} is null) as {c}_missing")
    for c, fl in CLEANED_COLS) + " from cleaned"

TOTAL_MISSING_SQL = WITH_CLEAN + "\nselect cast(" + " + ".join(
    (f"count_if({c} is null or isnan({c}))" if fl else f"count_if({c} is null)")
    for c, fl in CLEANED_COLS) + " as bigint) as total_missing from cleaned"

FILL_GROUP_MODE_SQL = WITH_CLEAN + """,
counts as (select department, position, count(*) as n from cleaned
           where department is not null and position is not null group by 1, 2),
modes as (select department, position as mode from (
    select *, row_number() over (partition by department order by n desc, position) as rn
    from counts) where rn = 1)
select c.employee_id, c.department,
  case when c.department is null then null else coalesce(c.position, m.mode) end as position
from cleaned c left join modes m on c.department = m.department"""

LABEL_ENCODE_SQL = WITH_CLEAN + "\nselect " + ", ".join(
    (f"dense_rank() over (order by {c} nulls last) - 1 as {c}" if c in EMP_STRINGS else c)
    for c, _ in CLEANED_COLS) + " from cleaned"

LABEL_DICTIONARY_SQL = WITH_CLEAN + "\n" + "\nunion all\n".join(
    f"select '{c}' as column_name, {c} as value, dense_rank() over (order by {c} nulls last) - 1 as code "
    f"from (select distinct {c} from cleaned)" for c in EMP_STRINGS)

_MEAN_COLS = ["age", "education", "job_satisfaction", "monthly_income", "standard_hours"]

MEAN_IMPUTE_SQL = WITH_CLEAN + "\nselect employee_id, " + ", ".join(
    f"round(coalesce(cast({c} as double), avg(cast({c} as double)) over ()), 6) as {c}"
    for c in _MEAN_COLS) + " from cleaned"

MISSING_AFTER_IMPUTE_SQL = WITH_CLEAN + ", filled as (select " + ", ".join(
    f"coalesce(cast({c} as double), avg(cast({c} as double)) over ()) as {c}" for c in _MEAN_COLS
) + " from cleaned)\nselect cast(" + " + ".join(
    f"count_if({c} is null or isnan({c}))" for c in _MEAN_COLS) + " as bigint) as total_missing from filled"

ITERATIVE_ROUND1_SQL = WITH_CLEAN + """,
fit as (select regr_slope(monthly_income, age) as b, regr_intercept(monthly_income, age) as a from cleaned)
select employee_id, round(age, 2) as age,
  round(coalesce(monthly_income, fit.a + fit.b * age), 2) as monthly_income
from cleaned, fit"""



def _ols_step(source: str, y: str, a: str, b: str) -> str:
    """Least squares of y on a and b over the rows where y was observed; the
    missing cells of y are replaced."""
    det = "(caa * cbb - cab * cab)"
    return f"""(with m as (
    select avg({y}) as my, avg({a}) as ma, avg({b}) as mb, var_pop({a}) as caa, var_pop({b}) as cbb,
      covar_pop({a}, {b}) as cab, covar_pop({a}, {y}) as cay, covar_pop({b}, {y}) as cby
    from {source} where not {y}_gone)
  select s.* replace (case when {y}_gone
    then my + (cay * cbb - cby * cab) / {det} * ({a} - ma) + (cby * caa - cay * cab) / {det} * ({b} - mb)
    else {y} end as {y}) from {source} s, m)"""


def _ols_chain() -> str:
    steps = [f"""v0 as materialized (select employee_id, {", ".join(
        f"coalesce(cast({c} as double), avg({c}) over ()) as {c}, {c} is null as {c}_gone"
        for c in OLS_COLUMNS)} from cleaned)"""]
    for k in range(2 * OLS_ROUNDS):        # education lacks fewer cells than the income
        y, b = ("education", "monthly_income") if k % 2 == 0 else ("monthly_income", "education")
        steps.append(f"v{k + 1} as materialized {_ols_step(f'v{k}', y, 'age', b)}")
    return ", " + ",\n".join(steps) + "\nselect employee_id, " + ", ".join(
        f"round({c}, 2) as {c}" for c in OLS_COLUMNS) + f" from v{2 * OLS_ROUNDS}"


ITERATIVE_OLS_SQL = WITH_CLEAN + _ols_chain()

STANDARDIZE_SQL = WITH_CLEAN + """
select employee_id,
  round((age - avg(age) over ()) / stddev_pop(age) over (), 6) as age,
  round((monthly_income - avg(monthly_income) over ()) / stddev_pop(monthly_income) over (), 6) as monthly_income
from cleaned"""

# Observed levels of the view's categorical columns, sorted, null last.
_LEVELS = {
    "position": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None],
    "department": ["F", "O", "P", None],
    "gender": ["Female", "Male"],
    "education_field": ["Life Sciences", "Medical", "Other"],
}
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _indicator(c: str, k: int, v) -> str:
    test = f"{c} is null" if v is None else f"coalesce({c} = '{v}', false)"
    return f"cast({test} as double) as {c}_{k}"


ONE_HOT_SQL = WITH_CLEAN + "\nselect employee_id, " + ", ".join(
    _indicator(c, k, v) for c in EMP_CATEGORICAL for k, v in enumerate(_LEVELS[c])
) + " from cleaned"

ONE_HOT_WIDE_SQL = WITH_CLEAN + "\n" + "\nunion all\n".join(
    f"select employee_id, '{c}' as column_name, dense_rank() over (order by {c} nulls last) - 1 as code "
    f"from cleaned" for c in EMP_STRINGS)

ONE_HOT_LABEL_SQL = WITH_EMP + """
select employee_id, is_active, cast(is_active = 'No' as double) as is_active_0,
  cast(is_active = 'Yes' as double) as is_active_1 from emp"""

PREPARE_FEATURES_SQL = WITH_CUST + "\nselect employee_id, " + ", ".join(
    f"round((cast({c} as double) - avg(cast({c} as double)) over ()) / stddev_pop(cast({c} as double)) over (), 6) as {c}"
    for c in CUST_FEATURES) + ", " + ", ".join(
    f"round(cast(department = '{v}' as double), 6) as department_{k}" for k, v in enumerate(_SEGMENTS)
) + " from ce"

TRAIN_TEST_SPLIT_SQL = WITH_EMP + """
select employee_id,
  case when row_number() over (order by md5(cast(employee_id as varchar) || '|0'), employee_id)
            <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split
from emp"""

_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in CUST_FEATURES)

NEIGHBORS_CTE = f"""nn as (
  select employee_id, is_active, neighbor_id, d2 from (
    select a.employee_id, a.is_active, b.employee_id as neighbor_id, {_D2} as d2,
      row_number() over (partition by a.employee_id order by {_D2}, b.employee_id) as rn
    from ce a join ce b on a.is_active = b.is_active and a.employee_id <> b.employee_id)
  where rn = 1)"""

SMOTE_NEIGHBORS_SQL = WITH_CUST + ", " + NEIGHBORS_CTE + """
select employee_id, is_active, neighbor_id, round(sqrt(d2), 6) as distance from nn"""

_WIDE_EXTRA = ", ".join(f"cast((employee_id * {2 * j + 3}) % {m} as double) as f{j}"
                        for j, m in enumerate([3, 4, 5, 7, 40, 97, 1009, 2411]))
_WIDE_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in WIDE_FEATURES)

SMOTE_NEIGHBORS_WIDE_SQL = WITH_CUST + f""", w as (select *, {_WIDE_EXTRA} from ce)
select employee_id, is_active, neighbor_id, round(sqrt(d2), 6) as distance from (
  select a.employee_id, a.is_active, b.employee_id as neighbor_id, {_WIDE_D2} as d2,
    row_number() over (partition by a.employee_id order by {_WIDE_D2}, b.employee_id) as rn
  from w a join w b on a.is_active = b.is_active and a.employee_id <> b.employee_id)
where rn = 1"""

_U = ("cast(('0x' || substr(md5(cast(c.employee_id as varchar) || '|' || cast(c.copy_index as varchar)"
      " || '|42'), 1, 8))::bigint as double) / cast(4294967296 as double)")

SMOTE_BODY = """,
counts as (select is_active, count(*) as n from ce group by 1),
top as (select max(n) as m from counts),
need as (select c.is_active, c.n, t.m - c.n as need from counts c, top t where c.n < t.m),
ranked as (
  select ce.*, need.n, need.need,
    row_number() over (partition by ce.is_active
                       order by md5(cast(ce.employee_id as varchar) || '|42'), ce.employee_id) as rk
  from ce join need on ce.is_active = need.is_active),
copies as (select *, need // n + case when rk <= need % n then 1 else 0 end as n_copies from ranked),
expanded as (select *, unnest(range(0, n_copies)) as copy_index from copies where n_copies > 0),
synth as (
  select c.employee_id, c.is_active, """ + ", ".join(
    f"c.{col} + ({_U}) * (b.{col} - c.{col}) as {col}" for col in CUST_FEATURES) + """,
    true as is_synthetic, cast(c.copy_index as bigint) as copy_index
  from expanded c join nn on c.employee_id = nn.employee_id
  join ce b on b.employee_id = nn.neighbor_id),
allrows as (
  select employee_id, is_active, age, monthly_income, total_working_years,
    false as is_synthetic, cast(null as bigint) as copy_index from ce
  union all select * from synth)"""

SMOTE_SQL = WITH_CUST + ", " + NEIGHBORS_CTE + SMOTE_BODY + """
select employee_id, is_active, """ + ", ".join(f"round({c}, 6) as {c}" for c in CUST_FEATURES) + """,
  is_synthetic, copy_index from allrows"""



def _neighbors_k_cte(k: int, features: list[str]) -> str:
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in features)
    return f"""nnk as (
  select employee_id, is_active, cast(rn as integer) as rank, neighbor_id, d2 from (
    select a.employee_id, a.is_active, b.employee_id as neighbor_id, {d2} as d2,
      row_number() over (partition by a.employee_id order by {d2}, b.employee_id) as rn
    from ce a join ce b on a.is_active = b.is_active and a.employee_id <> b.employee_id)
  where rn <= {k})"""


def _smote_neighbors_k_sql(k: int, features: list[str]) -> str:
    return WITH_CUST + ", " + _neighbors_k_cte(k, features) + """
select employee_id, is_active, rank, neighbor_id, round(sqrt(d2), 6) as distance from nnk"""


# The partner of a copy: drawn from the k nearest by another seed.
_DRAWN = _U.replace("'|42'", "'|43'")
SMOTE_K3_SQL = WITH_CUST + ", " + _neighbors_k_cte(3, CUST_FEATURES) + SMOTE_BODY.replace(
    "join nn on c.employee_id = nn.employee_id",
    f"join nnk nn on c.employee_id = nn.employee_id and nn.rank = 1 + floor({_DRAWN} * least(3, c.n - 1))") + """
select employee_id, is_active, """ + ", ".join(f"round({c}, 6) as {c}" for c in CUST_FEATURES) + """,
  is_synthetic, copy_index from allrows"""

SMOTE_COUNTS_SQL = WITH_CUST + ", " + NEIGHBORS_CTE + SMOTE_BODY + """
select is_active, count(*) as n from allrows group by 1"""

_SIGNAL = f"20 + c_custkey % 45 + c_nationkey >= {SIGNAL_LIMIT}"


def _forward_sql() -> str:
    """The layers of FORWARD_NET, one query around the other."""
    query = ("select c_custkey as employee_id, [(20 + c_custkey % 45)::double / 64, c_nationkey::double / 25, "
             "c_acctbal::double / 10000] as x from customer")
    for k, (w, b) in enumerate(zip(FORWARD_NET.weights, FORWARD_NET.biases)):
        sums = []
        for j in range(len(b)):
            total = " + ".join(f"x[{i + 1}] * ({w[i, j]})::double" for i in range(len(w)))
            total = f"({total} + ({b[j]})::double)"
            sums.append(total if k + 1 == len(FORWARD_NET.weights) else f"greatest({total}, 0.0::double)")
        query = f"select employee_id, [{', '.join(sums)}] as x from ({query})"
    return (f"select employee_id, round(exp(x[1]) / (exp(x[1]) + exp(x[2])), 9) as p_no, "
            f"round(exp(x[2]) / (exp(x[1]) + exp(x[2])), 9) as p_yes from ({query})")


ORACLE_SQL: dict[str, str] = {
    "mlp_forward": _forward_sql(),
    "planted_turnover": f"""
select c_custkey as emp_identifier, {_SIGNAL} as leaves from customer
where abs(20 + c_custkey % 45 + c_nationkey - {SIGNAL_LIMIT} + 0.5) >= {SIGNAL_MARGIN}""",
    "planted_accuracy": """
select cast(ceil(0.2 * count(*)) as bigint) as n_rows, true as accurate, true as far_apart from customer""",
    "planted_importance": """
select 1 as position, 'age' as feature, true as large union all
select 2, 'total_working_years', true""",
    "require_complete": WITH_CLEAN + """,
m as (select cast(sum((age is null)::int + (education is null)::int + (job_satisfaction is null)::int
  + (monthly_income is null)::int + (employee_id is null)::int) as bigint) as n from cleaned)
select 'encoded' as stage, n as total_missing, n = 0 as complete from m
union all select 'imputed', 0, true""",
    "assemble": """
select c_custkey as employee_id, 3 as width, cast(20 + c_custkey % 45 as double) as x0,
  c_acctbal as x1, cast(c_nationkey as double) as x2 from customer""",
    "configured_scan": WITH_EMP + """
select format, employee_id, position, is_active, monthly_income, start_date
from emp, (select unnest(['csv', 'parquet', 'json', 'orc']) as format)""",
    "split_repeated_ids": """
select split, n from (
  select 'test' as split, cast(ceil(0.2 * count(*)) as bigint) as n from orders union all
  select 'train', count(*) - cast(ceil(0.2 * count(*)) as bigint) from orders)""",

    "select_datapoints": WITH_EMP + """
select employee_id, position, is_active, education, job_satisfaction, monthly_income,
  salary_scale, start_date, department, age, gender, education_field, standard_hours from emp""",
    "drop_columns": WITH_EMP + """
select employee_id, position, department, age, gender, is_active, education, education_field,
  job_satisfaction, monthly_income, start_date from emp""",
    "sentinels_to_null": WITH_EMP + f"""
select employee_id, {_str_clean('position')}, {_str_clean('department')},
  {_num_clean('age', True)}, {_str_clean('gender')}, {_str_clean('is_active')}, education,
  {_str_clean('education_field')}, job_satisfaction, {_num_clean('monthly_income', True)},
  {_num_clean('standard_hours', False)}, {_str_clean('salary_scale')},
  {_num_clean('start_date', False)} from emp""",
    "fill_null": WITH_EMP + """
select employee_id, position, department, age, gender, is_active,
  coalesce(education, 0) as education, education_field, job_satisfaction,
  coalesce(monthly_income, 0) as monthly_income, standard_hours, salary_scale,
  coalesce(start_date, 0) as start_date from emp""",
    "epoch_to_date": WITH_EMP + """
select employee_id,
  case when start_date is null or start_date = 0 then null
       else strftime(date '1970-01-01' + cast(floor(start_date / 86400.0) as integer), '%Y-%m-%d')
  end as start_date from emp""",
    "clean": WITH_CLEAN + "\nselect * from cleaned",
    "missing_percent": MISSING_PERCENT_SQL,
    "high_missing_columns": HIGH_MISSING_SQL,
    "profile": PROFILE_SQL,
    "missing_mask": MISSING_MASK_SQL,
    "total_missing": TOTAL_MISSING_SQL,
    "is_unique": WITH_EMP + """
select coalesce(max(n) <= 1, true) as is_unique from (
  select employee_id, count(*) as n from emp group by 1)""",
    "class_counts": WITH_EMP + "\nselect is_active, count(*) as n from emp group by 1",
    "fill_group_mode": FILL_GROUP_MODE_SQL,
    "label_encode": LABEL_ENCODE_SQL,
    "label_dictionary": LABEL_DICTIONARY_SQL,
    "mean_impute": MEAN_IMPUTE_SQL,
    "missing_after_impute": MISSING_AFTER_IMPUTE_SQL,
    "iterative_impute_round1": ITERATIVE_ROUND1_SQL,
    "iterative_impute_ols": ITERATIVE_OLS_SQL,
    "standardize": STANDARDIZE_SQL,
    "one_hot": ONE_HOT_SQL,
    "one_hot_wide": ONE_HOT_WIDE_SQL,
    "smote_neighbors_wide": SMOTE_NEIGHBORS_WIDE_SQL,
    "balanced_counts": """
with c as (select case when c_custkey % 5 = 0 then 0 else 1 end as is_active, count(*) as n
           from customer group by 1)
select cast(is_active as bigint) as is_active, (select max(n) from c) as n from c""",
    "turnover_check": """
select count(*) as n_rows, count(distinct c_custkey) as n_ids, cast(sum(c_custkey) as bigint) as id_sum,
  cast(0 as bigint) as n_out_of_range from customer""",
    "importance_check": """
select unnest(['age', 'employee_id', 'monthly_income', 'total_working_years', 'department']) as feature,
  true as sums_to_100, true as none_negative""",
    "accuracy_check": """
select cast(ceil(0.2 * count(*)) as bigint) as n_rows, true as at_least_majority from customer""",
    "stream_equals_batch": """
select count(*) as n_rows, cast(0 as bigint) as n_different from orders""",
    "impute_check": """
select count(*) as n_rows, cast(0 as bigint) as n_missing, cast(0 as bigint) as n_changed from orders""",
    "pipeline_check": """
select count(*) as n_rows, cast(sum(o_orderkey) as bigint) as id_sum, cast(0 as bigint) as n_out_of_range
from orders""",
    "legacy_check": """
select count(*) as n_rows, cast(sum(o_orderkey) as bigint) as id_sum, cast(0 as bigint) as n_out_of_range
from orders""",
    "one_hot_label": ONE_HOT_LABEL_SQL,
    "prepare_features": PREPARE_FEATURES_SQL,
    "split_target": WITH_EMP + """
select employee_id, position, department, age, gender, education, education_field,
  job_satisfaction, monthly_income, standard_hours, salary_scale, start_date from emp""",
    "split_label": WITH_EMP + "\nselect is_active from emp",
    "train_test_split": TRAIN_TEST_SPLIT_SQL,
    "smote_neighbors": SMOTE_NEIGHBORS_SQL,
    "smote_neighbors_k3": _smote_neighbors_k_sql(3, CUST_FEATURES),
    "smote_neighbors_k3_ties": _smote_neighbors_k_sql(3, ["total_working_years", "age"]),
    "smote_k3": SMOTE_K3_SQL,
    "smote": SMOTE_SQL,
    "smote_counts": SMOTE_COUNTS_SQL,
    "csv_multiline": WITH_CLEAN + """
select *, 'a "' || coalesce(position, 'none') || '",' || chr(10) || 'second' || chr(13) || chr(10) || chr(10)
  || '"' || coalesce(department, '') || '"' || chr(10) || 'end' as note from cleaned""",
    "csv_roundtrip": WITH_CLEAN + """
select *, ' "' || coalesce(position, 'none') || '", 0 ' as note from cleaned""",
    "stream_clean": WITH_CLEAN + "\nselect * from cleaned",
}
