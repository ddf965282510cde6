"""Property tests (hypothesis): invariants that must hold for any input."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from turnstile.operators import clean as C
from turnstile.operators import encode as E
from turnstile.operators import sample as S

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

texts = st.one_of(st.none(), st.sampled_from(["null", "0", " 0 ", "", "a", "B", "zé"]),
                  st.text(max_size=4))


@SETTINGS
@given(rows=st.lists(st.tuples(texts, st.one_of(st.none(), st.integers(-3, 3)),
                               st.one_of(st.none(), st.floats(allow_nan=True,
                                                              allow_infinity=False, width=32))),
                     max_size=12))
def test_clean_idempotent_without_dates(spark, rows):
    df = spark.createDataFrame(rows, "s string, i int, d double")
    once = C.clean(df, exempt=(), date_columns=())
    twice = C.clean(once, exempt=(), date_columns=())
    assert once.collect() == twice.collect()


@SETTINGS
@given(values=st.lists(st.text(min_size=1, max_size=5), min_size=1, max_size=15))
def test_label_codes_preserve_text_order(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    enc, _ = E.label_encode(df, ["v"])
    code = {r.id: r.v for r in enc.collect()}
    distinct = sorted(set(values), key=lambda t: t.encode("utf-8"))
    for i, v in enumerate(values):
        assert code[i] == distinct.index(v)


@SETTINGS
@given(xs=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=2, max_size=30))
def test_standardize_mean_zero_unit_sd(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    out = [r.v for r in E.standardize(df, ["v"]).collect()]
    mean = sum(xs) / len(xs)
    sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / len(xs))
    if sd < 1e-6 * max(1.0, max(abs(x) for x in xs)):
        return                                         # (near-)constant column
    assert sum(out) / len(out) == pytest.approx(0.0, abs=1e-6)
    assert math.sqrt(sum(v * v for v in out) / len(out)) == pytest.approx(1.0, rel=1e-6)


@SETTINGS
@given(n=st.integers(0, 60), size=st.sampled_from([0.1, 0.2, 0.25, 0.5]), seed=st.integers(0, 5))
def test_split_size_exact(spark, n, size, seed):
    df = spark.createDataFrame([(i * 3 + 1,) for i in range(n)], "id bigint")
    out = S.train_test_split(df, "id", test_size=size, seed=seed)
    assert out.where("split = 'test'").count() == math.ceil(size * n)
    assert out.count() == n
