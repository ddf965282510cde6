"""The network: gradients, training on a planted signal, forward pass in columns."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from turnstile.operators import network as N
from turnstile.operators.model import evaluate_accuracy, fit_mlp, turnover_report


def planted(spark, n=2000):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(n, 3))
    label = (x[:, 0] + np.abs(x[:, 1]) > 0.8).astype(int)
    rows = [(i, [float(v) for v in r], float(k)) for i, (r, k) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "id bigint, features array<double>, label double").repartition(4, "id").cache()


@pytest.mark.parametrize("activation", ["relu", "sigmoid"])
def test_gradient_equals_differences(activation):
    rnd = np.random.default_rng(1)
    layers = [4, 6, 5, 3]
    theta = N.flat(N.start(layers, 3))
    x, label = rnd.normal(size=(20, 4)), rnd.integers(0, 3, 20)
    _, got = N.gradient(N.from_flat(theta, layers, activation), x, label)
    for k in range(len(theta)):
        step = np.zeros_like(theta)
        step[k] = 1e-6
        up, _ = N.gradient(N.from_flat(theta + step, layers, activation), x, label)
        down, _ = N.gradient(N.from_flat(theta - step, layers, activation), x, label)
        assert abs((up - down) / 2e-6 - got[k]) < 1e-6


def test_planted_signal_is_learnt_and_repeats(spark):
    df = planted(spark)
    net = N.fit_relu(df, "features", "label", 3, passes=30)
    assert evaluate_accuracy(net, df, "label").first().accuracy_percent >= 95
    again = N.fit_relu(df, "features", "label", 3, passes=2)
    assert np.array_equal(N.flat(again), N.flat(N.fit_relu(df, "features", "label", 3, passes=2)))
    means = {r.label: r.m for r in turnover_report(net, df, "id").join(df, F.col("emp_identifier") == df.id)
             .groupBy("label").agg(F.avg("turnover_percent").alias("m")).collect()}
    assert means[0.0] > 85 and means[1.0] < 15


def test_forward_equals_numpy_and_spark_ml(spark, monkeypatch):
    df = planted(spark, 200)
    net = N.start([3, 6, 6, 2], 9)
    x = np.array([r.features for r in df.orderBy("id").collect()])
    want = N.probabilities(net, x)[1]
    for unrolled in (256, 2):
        monkeypatch.setattr(N, "UNROLLED", unrolled)
        got = [r.probability for r in net.transform(df).orderBy("id").collect()]
        assert np.abs(np.array(got) - want).max() < 1e-12
    vectors = df.withColumn("v", array_to_vector("features"))
    model = fit_mlp(vectors, "v", "label", 3, max_iter=15)
    theirs = {r.id: (r.probability.toArray()[0], r.prediction) for r in model.transform(vectors).collect()}
    mine = N.Network.from_spark_ml(model).transform(vectors, "v")
    assert "ML" not in mine._jdf.queryExecution().toString().replace("UDF", "")
    for r in mine.collect():
        assert abs(r.probability[0] - theirs[r.id][0]) < 1e-9 and r.prediction == theirs[r.id][1]
    assert N.Network.from_spark_ml(model).layers == [3, 6, 6, 6, 2]


def test_odd_tables(spark):
    df = planted(spark, 50)
    none = N.fit_relu(df.where("false"), "features", "label", 3, passes=2)
    assert np.array_equal(N.flat(none), N.flat(N.start([3, 6, 6, 6, 2], 0)))
    for bad in (None, 7.0):
        with pytest.raises(Exception, match="is no class"):
            N.fit_relu(df.withColumn("label", F.lit(bad).cast("double")), "features", "label", 3, passes=1)


def test_steps_equal_plain_ones():
    """The buffered steps against Adam as written down, over whole and odd batches."""
    rnd = np.random.default_rng(8)
    layers, x, label = [5, 6, 4, 3], rnd.normal(size=(75, 5)), rnd.integers(0, 3, 75)
    theta = N.flat(N.start(layers, 2))
    state = np.concatenate([theta, np.zeros(2 * len(theta))])
    assert N._adam(state, 0, x, label, layers, 32, np.random.default_rng(6)) == 3
    mean = square = 0.0
    rows = np.random.default_rng(6).permutation(75)
    for k, at in enumerate(range(0, 75, 32), 1):
        some = rows[at:at + 32]
        _, g = N.gradient(N.from_flat(theta, layers), x[some], label[some])
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        theta = theta - 0.005 * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.999 ** k)) + 1e-8)
    assert np.abs(np.concatenate([theta, mean, square]) - state).max() < 1e-12


def test_rows_are_read_once(spark):
    """However many passes there are."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(label):
        read.add(1)
        return label

    df = planted(spark, 100).withColumn("label", counted("label"))
    N.fit_relu(df, "features", "label", 3, passes=5)
    assert read.value == 100


def test_lanes_equal_plain_steps(monkeypatch):
    """Stacked steps against those of every lane by itself; the rows left over follow."""
    monkeypatch.setattr(N, "LANE_ROWS", 40)
    rnd = np.random.default_rng(8)
    layers, x, label = [5, 6, 4, 3], rnd.normal(size=(143, 5)), rnd.integers(0, 3, 143)
    theta = N.flat(N.start(layers, 2))
    state = np.concatenate([theta, np.full(len(theta), 0.01), np.full(len(theta), 0.02)])
    got = state.copy()
    assert N._adam_lanes(got, 5, x, label, layers, 32, np.random.default_rng(6)) == 5 + 2 + 1

    def plain(theta, mean, square, k, some):
        _, g = N.gradient(N.from_flat(theta, layers), x[some], label[some])
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        return theta - 0.005 * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.999 ** k)) + 1e-8), mean, square

    rows, lanes = np.random.default_rng(6).permutation(143), []
    for lane in rows[:141].reshape(3, 47):
        now = np.split(state, 3)
        for k, at in ((6, 0), (7, 32)):
            now = plain(*now, k, lane[at:at + 32])
        lanes.append(now)
    want = plain(*np.mean(lanes, axis=0), 8, rows[141:])
    assert np.abs(np.concatenate(want) - got).max() < 1e-12


def test_large_partition_is_learnt_in_lanes(spark):
    rows = spark.range(0, 3 * N.LANE_ROWS + 5, numPartitions=1).select(
        "id", F.array(F.randn(1), F.randn(2), F.randn(3)).alias("features"))
    df = rows.withColumn("label", F.expr("features[0] + abs(features[1]) > 0.8").cast("double")).cache()
    net = N.fit_relu(df, "features", "label", 3, passes=12)
    assert evaluate_accuracy(net, df, "label").first().accuracy_percent >= 95
    df.unpersist()


def test_packed_rows_come_back():
    import pyarrow as pa
    x = np.array([[0.0, 0.5, 255.0, 256.0, np.nan, -1.0, np.inf], [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]])
    data = N._packed(x)
    assert len(data) == 2 * (5 * 8 + 2) + 7
    back = np.empty_like(x)
    N._unpack(pa.py_buffer(data), back)
    assert np.array_equal(back, x, equal_nan=True)
