"""The histogram forest: sums and splits against plain ones, importances against Spark's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.operators import forest as H
from turnstile.operators import model as M


def plain_sums(weight, bins, label, forest, t, node, column):
    """Counts (class, bin) of the rows of a tree's node, row by row."""
    out = np.zeros((2, H.BINS))
    for r in range(len(label)):
        at = 0
        while at < node and forest.column[t, at] >= 0:
            at = 2 * at + 1 + int(bins[forest.column[t, at], r] > forest.bin[t, at])
        if at == node:
            out[label[r], bins[column, r]] += weight[r]
    return out


def test_sums_equal_plain_ones():
    rnd = np.random.default_rng(3)
    p, n, trees = 5, 300, 3
    bins, label = rnd.integers(0, 7, (p, n)).astype(np.uint8), rnd.integers(0, 2, n).astype(np.uint8)
    forest = H.HistogramForest([np.arange(6.0)] * p, rnd.integers(0, p, (trees, 15)), rnd.integers(1, 5, (trees, 15)),
                               np.zeros((trees, 15)), np.zeros((trees, 15, 2)))
    forest.column[1, 2] = -1
    for level, k in ((0, 3), (1, 2), (2, 3)):
        first, nodes = 2 ** level - 1, 2 ** level
        mine = np.sort(rnd.permuted(np.tile(np.arange(p), (trees, nodes, 1)), axis=2)[:, :, :k], axis=2)
        two = np.concatenate([mine, mine[:, :, -1:]], axis=2) if k % 2 else mine
        place = {c: i for i, c in enumerate(H._pairs(p))}
        pair = np.array([[[place[tuple(c)] for c in node.reshape(-1, 2)] for node in tree] for tree in two])
        sums = np.zeros((trees, nodes, k, 2, H.BINS))
        H._add_block(sums, bins, label, forest.column, forest.bin, pair, np.ones((trees, nodes), bool),
                     np.random.default_rng(5))
        order = np.random.default_rng(5)
        for t in range(trees):
            weight = H.POISSON[np.frombuffer(order.bytes(2 * n), np.uint16)]
            for node in range(nodes):
                for j in range(k):
                    want = plain_sums(weight, bins, label, forest, t, first + node, mine[t, node, j])
                    assert np.array_equal(sums[t, node, j], want)


def test_best_split_equals_search():
    rnd = np.random.default_rng(4)
    seen = rnd.integers(0, 5, (3, 8, 2)).astype(float)
    seen[1:] = [rnd.permutation(seen[0]) for _ in range(2)]
    whole = seen[0].sum(axis=0)

    def impurity(c):
        return 1 - sum((v / sum(c)) ** 2 for v in c)

    gains = {}
    for k in range(3):
        for b in range(7):
            left = seen[k, :b + 1].sum(axis=0)
            right = whole - left
            if min(left.sum(), right.sum()) >= 2:
                gains[10 + k, b] = impurity(whole) - sum(c.sum() * impurity(c) for c in (left, right)) / whole.sum()
    column, cut, gain, counts = H.best_split(seen, np.arange(10, 13), 2)
    assert gain == pytest.approx(max(gains.values())) and gain == pytest.approx(gains[column, cut])
    assert counts[:2] == whole.tolist() and np.allclose(np.array(counts[2:4]) + counts[4:], whole)
    assert H.best_split(np.array([[[3.0, 0.0], [4.0, 0.0]]]), np.arange(1), 2)[0] == -1


def test_limits_and_weights():
    assert H.bin_limits(np.array([1.0, 3.0, 3.0, 9.0])).tolist() == [2.0, 6.0]
    cut = H.bin_limits(np.arange(1000.0))
    assert len(cut) == 31 and np.abs(np.diff(cut) - 1000 / 32).max() <= 1
    assert len(H.bin_limits(np.zeros(5))) == 0
    share = np.bincount(H.POISSON) / len(H.POISSON)
    assert abs(H.POISSON.mean() - 1) < 1e-3 and abs(share[0] - np.exp(-1)) < 2e-5


def rows(spark, n=12_000):
    x = [F.rand(k).alias(c) for k, c in enumerate("abcdef")]
    return (spark.range(0, n, numPartitions=4).select("id", *x, (F.col("id") % 3).alias("g"))
            .withColumn("label", F.expr("a + 0.5 * g + 0.1 * b > 1").cast("double")).cache())


def test_large_tables_take_histograms(spark, monkeypatch):
    df, names = rows(spark), [*"abcdef", "g"]
    theirs = M.fit_forest(df, names, "label", numTrees=60)
    monkeypatch.setattr(M, "HISTOGRAM_ROWS", 10_000)
    mine = M.fit_forest(df, names, "label", numTrees=60)
    assert not isinstance(theirs.parts[0], H.HistogramForest) and isinstance(mine.parts[0], H.HistogramForest)
    assert mine.numTrees == 60 and mine.featureImportances.sum() == pytest.approx(1)
    assert np.abs(mine.featureImportances - theirs.featureImportances).max() < 0.06
    again = M.fit_forest(df, names, "label", numTrees=60)
    assert np.array_equal(mine.featureImportances, again.featureImportances)
    x = df.limit(2000).toPandas()
    guess = mine.parts[0].probabilities(x[names].to_numpy(float)).argmax(axis=1)
    assert (guess == x["label"]).mean() > 0.9
    with pytest.raises(Exception, match="missing value"):
        M.fit_forest(df.withColumn("b", F.when(F.col("id") != 7, F.col("b"))), names, "label", numTrees=2)
    # What histograms aren't made for goes to Spark's forest.
    assert not isinstance(M.fit_forest(df, names, "label", numTrees=2, impurity="entropy").parts[0], H.HistogramForest)
    df.unpersist()
