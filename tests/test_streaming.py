import uuid

import pytest

from conftest import SF_SMALL
from turnstile.operators import impute as I
from turnstile.plans.catalog import EMP_COLUMNS
from turnstile.plans.pipeline import Settings
from turnstile.sources.fixtures import emp, emp_stream
from turnstile.streaming.score import fit_scoring_model, run_to_table


def test_imputer_replay_equals_fit(spark):
    rows = [(i, float(i), None if i % 4 == 0 else 2.0 * i + 1, None if i % 5 == 0 else float(i % 7))
            for i in range(80)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    fitted, model = I.iterative_impute(df, exclude=["id"], return_model=True)
    replay = model.transform(df)
    f = {r.id: tuple(r) for r in fitted.collect()}
    g = {r.id: tuple(r) for r in replay.collect()}
    assert f.keys() == g.keys()
    for k in f:
        assert f[k] == pytest.approx(g[k], rel=1e-12, abs=1e-12)


def test_stream_scores_equal_batch_scores(spark):
    settings = Settings(fit_forest=False, mlp_max_iter=20, impute_max_iter=3)
    model = fit_scoring_model(emp(spark, SF_SMALL), EMP_COLUMNS, settings)
    batch = {r.emp_identifier: r.turnover_percent
             for r in model.transform(emp(spark, SF_SMALL)).collect()}
    streamed = run_to_table(model.transform(emp_stream(spark, SF_SMALL)),
                            f"test-{uuid.uuid4().hex}")
    got = {r.emp_identifier: r.turnover_percent for r in streamed.collect()}
    assert len(got) == len(batch) == emp(spark, SF_SMALL).count()
    for k, v in batch.items():
        assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9)
        assert 0.0 <= v <= 100.0


def test_stream_resumes_from_its_checkpoint(spark):
    """A second run with the same checkpoint picks up only the new files
    (file source + parquet sink: each input row lands exactly once)."""
    import os
    import tempfile

    from turnstile.operators.clean import clean
    from turnstile.sources.fixtures import ORDERS_SCHEMA, emp_from_orders, table

    src = tempfile.mkdtemp(prefix="turnstile-src-")
    orders = table(spark, SF_SMALL, "orders")
    orders.where("o_orderkey % 2 = 0").write.mode("overwrite").parquet(os.path.join(src, "a"))

    def stream():
        o = spark.readStream.schema(ORDERS_SCHEMA).parquet(os.path.join(src, "*"))
        return clean(emp_from_orders(o))

    name = f"resume-{uuid.uuid4().hex}"
    first = run_to_table(stream(), name).count()
    orders.where("o_orderkey % 2 = 1").write.mode("overwrite").parquet(os.path.join(src, "b"))
    both = run_to_table(stream(), name)
    assert first == orders.where("o_orderkey % 2 = 0").count()
    assert both.count() == orders.count()
    assert both.select("employee_id").distinct().count() == orders.count()
