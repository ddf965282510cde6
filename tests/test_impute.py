import numpy as np
import pytest
from pyspark.errors import PySparkException

from turnstile.operators import impute as I


def test_group_mode_ties_and_nulls(spark):
    rows = [(1, "D1", "B"), (2, "D1", "A"), (3, "D1", None),       # tie B/A → A
            (4, "D2", "X"), (5, "D2", "X"), (6, "D2", "Y"), (7, "D2", None),
            (8, None, "Z"), (9, None, None)]                          # null group
    df = spark.createDataFrame(rows, "id int, department string, position string")
    out = {r.id: r.position for r in I.fill_group_mode(df, "department", "position").collect()}
    assert out == {1: "B", 2: "A", 3: "A", 4: "X", 5: "X", 6: "Y", 7: "X", 8: None, 9: None}
    keep = {r.id: r.position for r in
            I.fill_group_mode(df, "department", "position", null_group="keep").collect()}
    assert keep[8] == "Z" and keep[9] is None


def test_group_without_values(spark):
    df = spark.createDataFrame([(1, "D1", "A"), (2, "D3", None)], "id int, d string, p string")
    with pytest.raises(PySparkException):
        I.fill_group_mode(df, "d", "p").collect()
    out = {r.id: r.p for r in I.fill_group_mode(df, "d", "p", empty_group="null").collect()}
    assert out == {1: "A", 2: None}


def test_mean_impute(spark):
    df = spark.createDataFrame([(1, 2.0), (None, float("nan")), (3, 4.0)], "a int, b double")
    out = I.mean_impute(df).collect()
    assert [(r.a, r.b) for r in out] == [(1.0, 2.0), (2.0, 3.0), (3.0, 4.0)]
    with pytest.raises(ValueError):
        I.mean_impute(spark.createDataFrame([(1, None)], "a int, b double"))


def _linear_rows(n=60, gaps=(5, 17, 33)):
    rows = []
    for i in range(n):
        x1, x2 = float(i), float((i * 7) % 11)
        y = 3.0 + 2.0 * x1 - 0.5 * x2
        rows.append((i, x1, x2, None if i in gaps else y))
    return rows


def test_iterative_ols_recovers_linear_relation(spark):
    df = spark.createDataFrame(_linear_rows(), "id int, x1 double, x2 double, y double")
    out = {r.id: r for r in I.iterative_impute(df, ["x1", "x2", "y"], estimator="ols").collect()}
    for i in (5, 17, 33):
        r = out[i]
        assert r.y == pytest.approx(3.0 + 2.0 * r.x1 - 0.5 * r.x2, abs=1e-6)


def test_iterative_bayes_close_and_observed_unchanged(spark):
    rows = _linear_rows()
    df = spark.createDataFrame(rows, "id int, x1 double, x2 double, y double")
    out = {r.id: r for r in I.iterative_impute(df, exclude=["id"]).collect()}
    for i, x1, x2, y in rows:
        if y is None:
            assert out[i].y == pytest.approx(3.0 + 2.0 * x1 - 0.5 * x2, abs=1e-2)
        else:
            assert out[i].y == y
    assert out[0].id == 0                        # excluded column untouched


def test_iterative_nothing_missing_and_all_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0)], "a double, b double")
    assert I.iterative_impute(df).collect() == df.collect()
    bad = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    with pytest.raises(ValueError):
        I.iterative_impute(bad)


def test_iterative_several_columns_fill_everything(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        a = float(rng.normal())
        b = 2 * a + float(rng.normal()) * 0.1
        c = -a + b + float(rng.normal()) * 0.1
        rows.append((i, None if i % 7 == 0 else a, None if i % 5 == 0 else b,
                     None if i % 3 == 0 else c))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    out = I.iterative_impute(df, exclude=["id"], max_iter=10)
    from turnstile.operators.profile import total_missing
    assert total_missing(out).first().total_missing == 0
    assert out.count() == 200


def _bayes_reference(X, y, tol=1e-3, max_iter=300):
    """Direct implementation on raw rows (SVD of centred X)."""
    Xc, yc = X - X.mean(0), y - y.mean()
    n = X.shape[0]
    U, S, Vh = np.linalg.svd(Xc, full_matrices=False)
    eig = S ** 2
    Xty = Xc.T @ yc
    alpha, lam = 1.0 / (np.var(y) + np.finfo(float).eps), 1.0
    coef_old = None
    for it in range(max_iter):
        coef = Vh.T @ ((Vh @ Xty) / (eig + lam / alpha))
        rss = np.sum((yc - Xc @ coef) ** 2)
        gamma = np.sum(alpha * eig / (lam + alpha * eig))
        lam = (gamma + 2e-6) / (np.sum(coef ** 2) + 2e-6)
        alpha = (n - gamma + 2e-6) / (rss + 2e-6)
        if it != 0 and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef.copy()
    return Vh.T @ ((Vh @ Xty) / (eig + lam / alpha))


def test_bayesian_ridge_from_moments_matches_raw():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(500, 6)) * [1, 10, 100, 0.1, 5, 2]
    y = X @ rng.normal(size=6) + rng.normal(size=500)
    Xc, yc = X - X.mean(0), y - y.mean()
    got = I.bayesian_ridge(Xc.T @ Xc, Xc.T @ yc, float(yc @ yc), 500.0)
    assert np.allclose(got, _bayes_reference(X, y), rtol=1e-8, atol=1e-10)


def _plain_chain(x, rounds):
    """Chained least squares on the raw rows."""
    gone = np.isnan(x)
    v = np.where(gone, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        for j in sorted(np.nonzero(gone.any(axis=0))[0], key=lambda j: (gone[:, j].sum(), j)):
            rest = [a for a in range(x.shape[1]) if a != j]
            fit = ~gone[:, j]
            design = np.column_stack([np.ones(len(v)), v[:, rest]])
            coef = np.linalg.lstsq(design[fit], v[fit, j], rcond=None)[0]
            v[gone[:, j], j] = (design @ coef)[gone[:, j]]
    return v


@pytest.mark.parametrize("max_patterns", [20_000, 2])
def test_pattern_moments_equal_regressions_on_rows(spark, monkeypatch, max_patterns):
    monkeypatch.setattr(I, "MAX_PATTERNS", max_patterns)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 4)) @ rng.normal(size=(4, 4)) * [1, 50, 3000, 2] + [5, 0, 9000, 1]
    x[rng.random(x.shape) < [0.0, 0.1, 0.2, 0.3]] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    out, model = I.iterative_impute(df, exclude=["id"], estimator="ols", max_iter=4, tol=0.0, return_model=True)
    got = np.array([tuple(r)[1:] for r in out.orderBy("id").collect()])
    assert len(model.rounds) == 4
    assert np.allclose(got, _plain_chain(x, 4), rtol=1e-7)
    again = np.array([tuple(r)[1:] for r in model.transform(df).orderBy("id").collect()])
    assert np.allclose(again, got)


def test_long_models_build_a_short_plan(spark):
    import time

    names = [f"x{k}" for k in range(20)]
    step = [(a, 0.01) for a in range(1, 20)]
    model = I.ImputerModel(names, [1.0] * 20, [[(0, 0.5, step)] * 6] * 10)
    df = spark.createDataFrame([tuple([None] + [2.0] * 19)], ", ".join(f"{n} double" for n in names))
    start = time.time()
    out = model.transform(df)
    out._jdf.queryExecution().executedPlan()
    assert time.time() - start < 3
    assert out.first().x0 == pytest.approx(0.5 + 0.01 * 19)


def test_rounds_stop_when_changes_are_small(spark):
    df = spark.createDataFrame(_linear_rows(), "id int, x1 double, x2 double, y double")
    _, model = I.iterative_impute(df, exclude=["id"], return_model=True)
    assert len(model.rounds) == 2             # one column lacks cells: the second round changes nothing
