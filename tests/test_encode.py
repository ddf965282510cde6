import pytest
from pyspark.errors import PySparkException

from turnstile.operators import encode as E


def test_label_encode_order_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "B", "x"), (3, None, "x"), (4, "ä", "x"),
                                (5, "a", "x")], "id int, c string, one string")
    enc, dictionary = E.label_encode(df)
    got = {r.id: (r.c, r.one) for r in enc.collect()}
    # binary text order: 'B' < 'a' < 'b' < 'ä'; null gets the last code
    assert got == {1: (2, 0), 2: (0, 0), 3: (4, 0), 4: (3, 0), 5: (1, 0)}
    d = {(r.column_name, r.value): r.code for r in dictionary.collect()}
    assert d[("c", None)] == 4 and d[("one", "x")] == 0 and ("one", None) not in d
    assert enc.schema["c"].dataType.typeName() == "long"


def test_label_encode_missing_modes(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    enc, _ = E.label_encode(df, missing="null")
    assert [r.c for r in enc.collect()] == [0, None]
    enc, _ = E.label_encode(df, missing="error")
    with pytest.raises(PySparkException):
        enc.collect()


def test_label_dictionary_unseen_values(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    d = E.fit_label_dictionary(train)
    new = spark.createDataFrame([("b",), ("zz",), (None,)], "c string")
    assert [r.c for r in d.transform(new).collect()] == [1, 2, 2]


def test_large_dictionary_paths_agree(spark, monkeypatch):
    rows = [(i, f"v{(i * 37) % 500:04d}", f"w{i % 7}") for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    small, small_dict = E.label_encode(df)
    monkeypatch.setattr(E, "INLINE_COLUMN_MAX", 0)
    monkeypatch.setattr(E, "SINGLE_TASK_RANK_MAX", 10)
    monkeypatch.setattr(E, "RANK_PARTITIONS", 7)
    big, big_dict = E.label_encode(df)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    assert sorted(map(tuple, small_dict.collect())) == sorted(map(tuple, big_dict.collect()))
    codes = sorted(r.code for r in big_dict.where("column_name = 'a'").collect())
    assert codes == list(range(500))


def test_standardize_population_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "v double, c double")
    out = E.standardize(df, ["v", "c"]).collect()
    sd = (((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3) ** 0.5
    assert [r.v for r in out] == pytest.approx([(x - 7 / 3) / sd for x in (1, 2, 4)])
    assert sd == pytest.approx(1.247219128924647)
    assert [r.c for r in out] == [0.0, 0.0, 0.0]


def test_standardize_fit_on_train(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (100.0, "test")], "v double, split string")
    out = [r.v for r in E.standardize(df, ["v"], fit_on="train").collect()]
    assert out == pytest.approx([-1.0, 1.0, 98.0])


def test_one_hot_and_label(spark):
    df = spark.createDataFrame([(1, 2, "Yes"), (2, 0, "No"), (3, None, "Yes")],
                               "id int, code int, is_active string")
    out, names = E.one_hot(df, ["code"])
    assert names == ["code_0", "code_1", "code_2"]          # levels 0, 2, null
    assert [(r.code_0, r.code_1, r.code_2) for r in out.orderBy("id").collect()] == [
        (0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)]
    lab, levels = E.one_hot_label(df, "is_active")
    assert levels == ["No", "Yes"]
    assert [(r.is_active_0, r.is_active_1) for r in lab.orderBy("id").collect()] == [
        (0.0, 1.0), (1.0, 0.0), (0.0, 1.0)]
    three = spark.createDataFrame([("a",), ("b",), ("c",)], "y string")
    with pytest.raises(ValueError):
        E.one_hot_label(three, "y")


def test_levels_come_in_natural_order(spark):
    df = spark.createDataFrame([(i, i % 12, None if i == 7 else f"k{i % 12}") for i in range(40)],
                               "id int, n int, k string")
    rows = E.one_hot_long(df, "id", ["n", "k"]).collect()
    codes = {(r.id, r.column_name): r.code for r in rows}
    assert len(rows) == 80
    assert all(codes[i, "n"] == i % 12 for i in range(40))          # 2 before 10
    text = sorted(f"k{j}" for j in range(12))
    assert all(codes[i, "k"] == (12 if i == 7 else text.index(f"k{i % 12}")) for i in range(40))
    out, names = E.one_hot(df, ["n"])
    assert names == [f"n_{k}" for k in range(12)]
    assert out.where("id = 10").first().n_10 == 1.0


def test_features_of_many_levels_and_unseen_ones(spark):
    n = 1500                                     # the map-literal and the join path
    df = spark.createDataFrame([(i, float(i), f"v{i:05d}", i % 3) for i in range(n)],
                               "id int, x double, v string, c int")
    out, flat, model = E.prepare_features(df, ["x"], ["v", "c"], keep=["id"], return_model=True)
    assert len(flat) == 1 + n + 3
    rows = {r.id: r.features for r in out.collect()}
    assert all(v.size == 1 + n + 3 for v in rows.values())
    assert rows[1234][1 + 1234] == 1.0 and rows[1234][1 + n + 1234 % 3] == 1.0
    new = spark.createDataFrame([(0, 1.0, "unseen", None)], "id int, x double, v string, c int")
    seen = model.transform(new, keep=["id"]).first().features
    assert seen.size == 1 + n + 3 and seen.numNonzeros() <= 1


def test_dictionary_codes_survive_lost_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "SINGLE_TASK_RANK_MAX", 10)
    monkeypatch.setattr(E, "RANK_PARTITIONS", 5)
    df = spark.createDataFrame([(f"w{(i * 37) % 500:03d}",) for i in range(900)], "w string")
    d = E.fit_label_dictionary(df)
    first = sorted(map(tuple, d.frame.collect()))
    for rdd in list(spark.sparkContext._jsc.getPersistentRDDs().values()):
        rdd.unpersist(True)
    assert sorted(map(tuple, d.frame.collect())) == first
    assert [c for _, _, c in sorted(first, key=lambda r: r[1])] == list(range(500))


def test_prepare_features(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 4.0, "a")], "id int, x double, c string")
    out, flat = E.prepare_features(df, ["x"], ["c"], keep=["id"])
    assert flat == ["x", "c_0", "c_1"]
    row = out.orderBy("id").first()
    assert out.columns == ["id", "features"]
    assert len(row.features) == 3 and row.features[1] == 1.0
    wide, _ = E.prepare_features(df, ["x"], ["c"], keep=["id"], assemble=False)
    assert wide.orderBy("id").first().c_0 == 1.0
    with pytest.raises(Exception):
        E.prepare_features(df, ["x", "absent"], ["c"])
