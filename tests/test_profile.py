import pytest

from turnstile.operators import profile as P


def _pct(df):
    return {r.column_name: r.percent_missing for r in P.missing_percent(df).collect()}


def test_missing_percent_and_threshold(spark):
    rows = [(1, None, None, 1.0), (2, "a", None, float("nan")), (3, None, None, 2.0),
            (4, "b", 5, 3.0)]
    df = spark.createDataFrame(rows, "id int, half string, most int, d double")
    pct = _pct(df)
    assert pct == {"id": 0.0, "half": 50.0, "most": 75.0, "d": 25.0}
    high = P.high_missing_columns(df, 50).collect()
    assert [r.column_name for r in high] == ["most"]          # strict >
    assert P.high_missing_names(df, 20) == ["d", "half", "most"]
    desc = P.high_missing_columns(df, 20, ascending=False).collect()
    assert [r.column_name for r in desc] == ["most", "half", "d"]


def test_missing_percent_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert _pct(df) == {"a": None, "b": None}
    assert P.high_missing_names(df, 50) == []


def test_tie_in_percent_sorted_by_name(spark):
    df = spark.createDataFrame([(None, None), (1, 2)], "zz int, aa int")
    assert [r.column_name for r in P.high_missing_columns(df, 10).collect()] == ["aa", "zz"]


def test_profile_mask_total(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, float("nan"))], "a int, b double")
    prof = {r.column_name: (r.n_rows, r.n_columns, r.n_missing) for r in P.profile(df).collect()}
    assert prof == {"a": (3, 2, 1), "b": (3, 2, 2)}
    assert P.total_missing(df).first().total_missing == 3
    mask = P.missing_mask(df).collect()
    assert [(r.a_missing, r.b_missing) for r in mask] == [(False, True), (True, False), (False, True)]
    assert P.require_complete(df) is False
    with pytest.raises(ValueError):
        P.require_complete(df, strict=True)
    assert P.require_complete(spark.createDataFrame([(1,)], "a int")) is True


@pytest.mark.parametrize("ids,expected", [
    ([1, 2, 3], True), ([1, 2, 2], False), ([1, None, 3], True), ([None, 2, None], False), ([], True)])
def test_is_unique(spark, ids, expected):
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    assert P.is_unique(df, "id").first().is_unique is expected


def test_class_counts(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Yes",)], "is_active string")
    assert {r.is_active: r.n for r in P.class_counts(df, "is_active").collect()} == {"Yes": 2, "No": 1}
