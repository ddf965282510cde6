import json
import os
import tempfile

import hr_rows
import pytest

from conftest import SF_SMALL
from turnstile.operators import profile as P
from turnstile.sources import files as SRC


@pytest.fixture(scope="module")
def sample_csv(tmp_path_factory):
    return hr_rows.write(str(tmp_path_factory.mktemp("hr") / "hr.csv"))


def _bom_crlf_csv(folder):
    text = ("﻿id,flag,blank,num\r\n1,true,,5\r\n2,false,,null\r\n3,true,,7\r\n")
    path = os.path.join(folder, "t.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def test_read_csv_bom_crlf(spark):
    path = _bom_crlf_csv(tempfile.mkdtemp(prefix="turnstile-csv-"))
    df = SRC.read_csv(spark, path, infer_schema=True)
    assert df.columns == ["id", "flag", "blank", "num"]
    types = dict(df.dtypes)
    assert types["flag"] == "boolean" and types["blank"] == "string"
    assert types["num"] == "string"             # literal 'null' makes the column text
    schema = "num int, id int, flag boolean, blank string"        # not the file's order
    typed = SRC.read_csv(spark, path, schema=schema, bad_cells="null")
    assert [(r.id, r.num) for r in typed.collect()] == [(1, 5), (2, None), (3, 7)]
    assert typed.columns == ["num", "id", "flag", "blank"]
    with pytest.raises(Exception):
        SRC.read_csv(spark, path, schema=schema).collect()
    bad = SRC.read_csv(spark, path, schema=schema, bad_cells="report").where(f"{SRC.BAD_RECORD} is not null")
    assert [r.id for r in bad.cache().collect()] == [2]
    with pytest.raises(ValueError):
        SRC.read_csv(spark, path, schema="id int, absent string")
    assert SRC.read_csv(spark, path, infer_schema=True, columns=["num", "id"]).columns == ["num", "id"]


def test_write_csv_roundtrip_and_dispatch(spark):
    folder = tempfile.mkdtemp(prefix="turnstile-out-")
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "id int, s string, d double")
    assert SRC.write_csv(df, folder) is df
    back = SRC.read_table(spark, folder, "csv", schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(1, "a", 2.5), (2, None, None)]
    odd = spark.createDataFrame([(k, t) for k, t in enumerate(
        [" 0 ", "", None, 'say "hi", you', "a,b", "\ttab ", "'", "two\nlines", "back\\slash"])], "k int, t string")
    path = tempfile.mkdtemp(prefix="turnstile-out-")
    SRC.write_csv(odd, path)
    again = SRC.read_csv(spark, path, schema=odd.schema, multi_line=True)
    want = sorted((r.k, r.t or None) for r in odd.collect())     # "" is null in a CSV file
    assert sorted(map(tuple, again.collect())) == want
    pq = SRC.read_table(spark, f"{SF_SMALL}/region.parquet", "parquet")
    assert pq.count() > 0


def test_read_config(spark):
    folder = tempfile.mkdtemp(prefix="turnstile-cfg-")
    path = os.path.join(folder, "model_data.json")
    with open(path, "w") as f:
        json.dump({"config": {"data_source": "csv", "list_of_datapoint": {
            "mandatory": ["Employee_ID", "Position"], "optional": ["Age"]}}}, f, indent=3)
    cfg = SRC.read_config(spark, path)
    assert cfg.data_source == "csv" and cfg.columns == ["Employee_ID", "Position", "Age"]
    bad = os.path.join(folder, "bad.json")
    with open(bad, "w") as f:
        json.dump({"config": {"data_source": "csv"}}, f)
    with pytest.raises(Exception):
        SRC.read_config(spark, bad)


def test_sample_file_missing_report(spark, sample_csv):
    from turnstile.operators.clean import clean

    df = SRC.read_csv(spark, sample_csv, infer_schema=True)
    assert df.count() == hr_rows.N and len(df.columns) == 24
    pct = {r.column_name: round(r.percent_missing, 1)
           for r in P.missing_percent(clean(df)).collect()}
    assert pct["Salary_Scale"] == 100.0 and pct["Performance_Scale"] == 100.0
    assert pct["Standard_Hours"] == 91.7 and pct["Monthly_Rate"] == 33.3
    assert pct["Education"] == 16.7 and pct["Monthly_Income"] == 16.7
    assert pct["Years_At_Company"] == 16.7 and pct["Position"] == 8.3
    assert set(P.high_missing_names(clean(df), 50)) == {"Standard_Hours", "Performance_Scale",
                                                        "Salary_Scale"}


def test_models_by_band(spark):
    from turnstile.plans.catalog import CUST_COLUMNS, _encoded_cust
    from turnstile.plans.pipeline import Settings, train_and_score

    res = train_and_score(_encoded_cust(spark, SF_SMALL), CUST_COLUMNS,
                          Settings(forest={"numTrees": 20}, mlp_max_iter=30))
    assert res["trained"]
    imp = res["importances"].collect()
    assert sum(r.importance for r in imp) == pytest.approx(100.0, abs=1.0)
    rep = res["turnover"].collect()
    assert len(rep) == 150 and all(0.0 <= r.turnover_percent <= 100.0 for r in rep)
    acc = res["accuracy"].first()
    assert acc.n_rows == 30 and 0.0 <= acc.accuracy_percent <= 100.0
    counts = {r.is_active: r.n for r in res["balanced_counts"].collect()}
    assert len(set(counts.values())) == 1


def test_incomplete_table_skips_training(spark):
    from turnstile.plans.pipeline import Columns, train_and_score

    df = spark.createDataFrame([(1, 1.0, None), (2, 0.0, 3.0)], "Employee_ID int, is_active double, Age double")
    assert train_and_score(df, Columns(numeric=("Age",), categorical=()))["trained"] is False


def test_entry_contract(spark):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    out = E.entry(spark)
    assert out.columns == ["emp_identifier", "turnover_percent"]
    assert out.count() == 1500


def test_legacy_and_canonical_pipelines_on_sample(spark, sample_csv):
    from turnstile.defaults import HR_COLUMNS
    from turnstile.plans.pipeline import Settings, run_legacy, run_pipeline

    df = SRC.read_csv(spark, sample_csv, infer_schema=True)
    df = df.select(*HR_COLUMNS)
    s = Settings(forest={"numTrees": 10}, mlp_max_iter=10, impute_max_iter=2)
    legacy = run_legacy(df, s)
    assert legacy["dropped"] == ["Years_At_Company", "Salary_Scale", "Performance_Scale",
                                 "Standard_Hours"]
    assert "Monthly_Rate" in legacy["imputed"].columns
    assert legacy["trained"] and legacy["turnover"].count() == hr_rows.N
    canon = run_pipeline(df, s=s)
    assert set(canon["dropped"]) == {"Salary_Scale", "Performance_Scale", "Standard_Hours"}
    assert canon["trained"]
    rep = canon["turnover"].collect()
    assert sorted(r.emp_identifier for r in rep) == list(range(5001, 5001 + hr_rows.N))
    imp = canon["importances"].collect()
    assert sum(r.importance for r in imp) == pytest.approx(100.0, abs=1.0)


def test_sample_with_explicit_schema_and_config(spark, sample_csv):
    from turnstile.defaults import HR_SCHEMA

    typed = SRC.read_csv(spark, sample_csv, schema=HR_SCHEMA)
    inferred = SRC.read_csv(spark, sample_csv, infer_schema=True)
    assert typed.columns == inferred.columns
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, inferred.collect()))
    folder = tempfile.mkdtemp(prefix="turnstile-cfg-")
    cfg_path = os.path.join(folder, "model_data.json")
    with open(cfg_path, "w") as f:
        json.dump({"config": {"data_source": "csv", "list_of_datapoint": {
            "mandatory": ["Employee_ID", "Position", "is_active"],
            "optional": ["Department", "Start_Date"]}}}, f)
    cfg = SRC.read_config(spark, cfg_path)
    df = SRC.read_configured(spark, sample_csv, cfg)
    assert df.columns == ["Employee_ID", "Position", "is_active", "Department", "Start_Date"]
    assert df.count() == hr_rows.N


def test_network_needs_two_label_levels(spark):
    from turnstile.plans.pipeline import Columns, Settings, train_and_score

    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 2.0), (3, 2.0, 3.0)],
                               "Employee_ID int, is_active double, Age double")
    with pytest.raises(ValueError):
        train_and_score(df, Columns(numeric=("Age",), categorical=()), Settings())


def _hr_like(spark, n=60):
    rows = [(2**60 + i, float(i % 3 == 0), float(i), float((i * 7) % 11), float(i % 4)) for i in range(n)]
    return spark.createDataFrame(rows, "employee_id bigint, is_active double, age double, pay double, team double")


def test_balancing_runs_with_the_id_among_the_features(spark):
    from pyspark.sql import functions as F

    from turnstile.plans.pipeline import Columns, Settings, train_and_score

    cols = Columns(id="employee_id", label="is_active", numeric=("age", "pay"), categorical=("team",))
    df = _hr_like(spark).withColumn("_orig_id", F.col("employee_id"))
    for balanced in (False, True):
        out = train_and_score(df, cols, Settings(use_balanced=balanced, forest={"numTrees": 5}, mlp_max_iter=5))
        assert {r.is_active: r.n for r in out["balanced_counts"].collect()} == {0.0: 40, 1.0: 40}
        ids = [r.emp_identifier for r in out["turnover"].collect()]
        assert sorted(ids) == [2**60 + i for i in range(60)]
        assert out["accuracy"].first().n_rows == 12
    lone = df.where("is_active = 0 or employee_id = 1152921504606846976")
    with pytest.raises(ValueError):
        train_and_score(lone, cols, Settings())


def test_absent_features_and_drop_names_raise(spark):
    from turnstile.plans.pipeline import Columns, Settings, run_pipeline, train_and_score

    cols = Columns(id="employee_id", label="is_active", numeric=("age", "no_such_column"), categorical=())
    with pytest.raises(Exception):
        train_and_score(_hr_like(spark), cols, Settings())
    with pytest.raises(Exception):
        run_pipeline(_hr_like(spark), Columns(id="employee_id", label="is_active", exempt=(), dates=(),
                                              drop=("no_such_column",)))


def test_split_of_large_ids_is_exact(spark):
    from turnstile.operators.sample import train_test_split

    out = train_test_split(spark.range(2**60, 2**60 + 1000), "id")
    assert out.where("split = 'test'").count() == 200


def test_forest_grows_in_batches(spark, monkeypatch):
    from turnstile.operators import model as M

    monkeypatch.setattr(M, "TREES_PER_FIT", 4)
    forest = M.fit_forest(_hr_like(spark), ["age", "pay", "team"], "is_active", numTrees=10)
    assert [m.getNumTrees for m in forest.parts] == [4, 4, 2] and forest.numTrees == 10
    assert sum(forest.featureImportances) == pytest.approx(1.0)


def test_nothing_stays_cached(spark):
    from turnstile.plans.catalog import EMP_COLUMNS
    from turnstile.plans.pipeline import Settings, run_pipeline
    from turnstile.sources.fixtures import emp

    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    run_pipeline(emp(spark, SF_SMALL), EMP_COLUMNS, Settings(fit_forest=False, mlp_max_iter=2, impute_max_iter=1))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_stream_of_a_folder_table(spark, tmp_path):
    from turnstile.sources.fixtures import emp, emp_stream
    from turnstile.streaming.score import run_to_table

    folder = f"{tmp_path}/orders.parquet"
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(4).write.parquet(folder)
    out = run_to_table(emp_stream(spark, str(tmp_path)), f"folder-{os.path.basename(tmp_path)}")
    assert out.count() == emp(spark, str(tmp_path)).count() == 1500


def test_training_table_is_computed_once(spark):
    """However often the checks before training read it."""
    from pyspark.sql import functions as F

    from turnstile.plans.pipeline import Columns, Settings, train_and_score

    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(age):
        read.add(1)
        return age

    df = _hr_like(spark).withColumn("age", counted(F.col("age").cast("double")))
    out = train_and_score(df, Columns(id="employee_id", label="is_active", numeric=("age",), categorical=()),
                          Settings(fit_forest=False, mlp_max_iter=2, count_balanced=False))
    assert out["trained"] and out["turnover"].count() == df.count()
    assert read.value == _hr_like(spark).count()
