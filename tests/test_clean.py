import pytest
from pyspark.errors import PySparkException

from turnstile.operators import clean as C


def test_sentinels_by_type(spark):
    df = spark.createDataFrame(
        [("null", 0, -0.0, False), ("0", 1, float("nan"), True), (" 0 ", 2, 0.0, None),
         ("0.0", None, 1.5, True), ("", 3, None, False), ("NULL", 4, 2.0, True)],
        "s string, i int, d double, b boolean")
    out = C.sentinels_to_null(df).collect()
    assert [r.s for r in out] == [None, None, " 0 ", "0.0", "", "NULL"]
    assert [r.i for r in out] == [None, 1, 2, None, 3, 4]
    assert [r.d for r in out] == [None, None, None, 1.5, None, 2.0]
    assert [r.b for r in out] == [None, True, None, True, None, True]
    kept = C.sentinels_to_null(df, false_is_missing=False).collect()
    assert [r.b for r in kept] == [False, True, None, True, False, True]


def test_sentinels_exempt_and_subset(spark):
    df = spark.createDataFrame([(0, 0, "0")], "Employee_ID int, a int, s string")
    r = C.sentinels_to_null(df, exempt=["employee_id"]).first()
    assert (r.Employee_ID, r.a, r.s) == (0, None, None)
    r = C.sentinels_to_null(df, cols=["s"]).first()
    assert (r.Employee_ID, r.a, r.s) == (0, 0, None)


def test_epoch_double(spark):
    vals = [None, 0.0, float("nan"), 1418804688.0, 1418774400.0, -1.0, -0.5, 86399.9]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.x for r in C.epoch_to_date(df, ["x"]).collect()]
    assert got == [None, None, None, "2014-12-17", "2014-12-17", "1969-12-31",
                   "1970-01-01", "1970-01-01"]


def test_epoch_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1418774400,)], "x bigint")
        assert C.epoch_to_date(df, ["x"]).first().x == "2014-12-17"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_string(spark):
    df = spark.createDataFrame([(v,) for v in [None, "0", "null", "1418804688", " 86400 "]],
                               "x string")
    got = [r.x for r in C.epoch_to_date(df, ["x"]).collect()]
    assert got == [None, None, None, "2014-12-17", "1970-01-02"]
    bad = spark.createDataFrame([("abc",), ("1.5",)], "x string")
    with pytest.raises(PySparkException):
        C.epoch_to_date(bad, ["x"]).collect()
    assert [r.x for r in C.epoch_to_date(bad, ["x"], errors="null").collect()] == [None, None]


def test_epoch_format(spark):
    df = spark.createDataFrame([(1418804688,)], "x bigint")
    assert C.epoch_to_date(df, ["x"], fmt="dd/MM/yyyy").first().x == "17/12/2014"


def test_fill_null(spark):
    df = spark.createDataFrame([(None, float("nan"), "a"), (2, 1.0, None)], "i int, d double, s string")
    out = C.fill_null(df, ["i", "d"]).collect()
    assert [(r.i, r.d, r.s) for r in out] == [(0, 0.0, "a"), (2, 1.0, None)]


def test_select_and_drop(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "Employee_ID int, Position string, Age double")
    assert C.select_datapoints(df, ["age", "employee_id"]).columns == ["Age", "Employee_ID"]
    with pytest.raises(KeyError):
        C.select_datapoints(df, ["Employee_ID"], ["Nope"])
    assert C.drop_columns(df, []).columns == df.columns
    assert C.drop_columns(df, ["position"]).columns == ["Employee_ID", "Age"]
    with pytest.raises(KeyError):
        C.drop_columns(df, ["Nope"])


def test_clean_dispatch_keeps_order(spark):
    df = spark.createDataFrame(
        [(1, 0, "null", 0, 0, 1418804688), (2, 3, "x", 5, None, 0)],
        "Employee_ID int, Education int, Position string, Age int, Years_At_Company int, Start_Date bigint")
    out = C.clean(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert [tuple(r) for r in rows] == [(1, 0, None, None, None, "2014-12-17"),
                                        (2, 3, "x", 5, None, None)]
    legacy = C.clean(df, date_columns=("Start_Date",)).collect()
    assert legacy[0].Years_At_Company is None and legacy[1].Years_At_Company is None


def test_clean_is_idempotent_on_non_dates(spark):
    df = spark.createDataFrame([("0", 0.0, 5), ("a", 1.0, 0)], "s string, d double, i int")
    once = C.clean(df, exempt=(), date_columns=())
    twice = C.clean(once, exempt=(), date_columns=())
    assert once.collect() == twice.collect()


def test_split_target(spark):
    df = spark.createDataFrame([(1, "Yes", 2.0)], "Employee_ID int, is_active string, Age double")
    x, y = C.split_target(df, "is_active")
    assert x.columns == ["Employee_ID", "Age"] and y.columns == ["is_active"]
    x, _ = C.split_target(df, "is_active", exclude_id="Employee_ID")
    assert x.columns == ["Age"]
