import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from turnstile.operators import sample as S


def _brute_test_ids(ids, test_size=0.2, seed=0):
    keyed = sorted(ids, key=lambda i: (hashlib.md5(f"{i}|{seed}".encode()).hexdigest(), i))
    return set(keyed[: math.ceil(test_size * len(ids))])


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 137])
def test_split_exact_size_and_rows(spark, n):
    df = spark.createDataFrame([(i,) for i in range(n)], "id bigint")
    out = S.train_test_split(df, "id").collect()
    test = {r.id for r in out if r.split == "test"}
    assert len(test) == math.ceil(0.2 * n)
    assert test == _brute_test_ids(range(n))


def test_split_multilevel_histogram(spark, monkeypatch):
    monkeypatch.setattr(S, "BOUNDARY_SORT_MAX", 3)
    monkeypatch.setattr(S, "PREFIX_STEP", 1)
    ids = list(range(0, 3000, 3))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    out = S.train_test_split(df, "id", test_size=0.37, seed=7).collect()
    assert {r.id for r in out if r.split == "test"} == _brute_test_ids(ids, 0.37, 7)


def test_split_not_exact_is_deterministic(spark):
    df = spark.createDataFrame([(i,) for i in range(2000)], "id bigint")
    a = S.train_test_split(df, "id", exact=False).where("split = 'test'").count()
    b = S.train_test_split(df, "id", exact=False).where("split = 'test'").count()
    assert a == b and 300 < a < 500


def _brute_nn(rows):
    out = {}
    for i, c, *x in rows:
        best = None
        for j, c2, *y in rows:
            if j == i or c2 != c:
                continue
            d2 = sum((a - b) * (a - b) for a, b in zip(x, y))
            if best is None or (d2, j) < best:
                best = (d2, j)
        out[i] = None if best is None else best[1]
    return out


def _random_rows(seed, n=300, d=4, classes=("a", "b", "c")):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        pt = [round(rnd.gauss(0, 1) * (10 ** k), 2) for k in range(d)]
        if i % 17 == 0 and rows:                     # exact duplicates
            pt = list(rows[-1][2:])
            cls = rows[-1][1]
        else:
            cls = rnd.choice(classes)
        rows.append((i, cls, *pt))
    rows.append((n, "lonely", 0.0, 0.0, 0.0, 0.0))   # single-member class
    return rows


@pytest.mark.parametrize("leaf_points", [2, 10, 512])
def test_neighbors_exact_against_brute_force(spark, leaf_points):
    rows = _random_rows(1)
    df = spark.createDataFrame(rows, "id bigint, cls string, x0 double, x1 double, x2 double, x3 double")
    got = S.smote_neighbors(df, "id", ["x0", "x1", "x2", "x3"], "cls",
                            leaf_points=leaf_points).collect()
    assert len(got) == len(rows)
    assert {r.id: r.neighbor_id for r in got} == _brute_nn(rows)


@pytest.mark.parametrize("leaf_points, k", [(2, 3), (10, 5), (512, 4)])
def test_k_neighbors_exact_against_brute_force(spark, leaf_points, k):
    rows = _random_rows(4)
    # A point with far more rows than k, and a class of two.
    rows += [(1000 - i, "a", 1.0, 2.0, 3.0, 4.0) for i in range(40)]
    rows += [(2000, "two", 0.0, 0.0, 0.0, 0.0), (2001, "two", 1.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id bigint, cls string, x0 double, x1 double, x2 double, x3 double")
    got = S.smote_neighbors(df, "id", ["x0", "x1", "x2", "x3"], "cls", leaf_points=leaf_points, k=k)
    assert got.columns == ["id", "cls", "rank", "neighbor_id", "distance"]
    want = set()
    for r in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(r[2:], o[2:])), o[0])
                      for o in rows if o[1] == r[1] and o[0] != r[0])[:k]
        want |= {(r[0], n + 1, o) for n, (_, o) in enumerate(near)} or {(r[0], 1, None)}
    got = got.collect()
    assert {(r.id, r.rank, r.neighbor_id) for r in got} == want and len(got) == len(want)


def test_k_nearest_by_tree_equals_comparing_all():
    import numpy as np

    from turnstile.operators import neighbors as NB

    rnd = np.random.default_rng(8)
    for points in (rnd.normal(size=(1500, 3)), rnd.integers(0, 6, (1200, 4)).astype(float)):
        ids = np.arange(len(points)) * 3 + 1
        some = rnd.integers(0, len(points), 300)
        for k in (1, 2, 7):
            got = NB.k_nearest(points[some], ids[some], points, ids, k)
            want = NB.k_nearest_of_all(points[some], ids[some], points, ids, k)
            assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_smote_counts_and_segments(spark):
    rows = [(i, "Yes" if i % 4 else "No", float(i), float(i % 3)) for i in range(1, 23)]
    rows += [(100, "Maybe", 0.0, 0.0), (101, "Maybe", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id bigint, y string, f1 double, f2 double")
    out = S.smote(df, "id", ["f1", "f2"], "y")
    counts = {r.y: r.n for r in out.groupBy("y").count().withColumnRenamed("count", "n").collect()}
    assert counts == {"Yes": 17, "No": 17, "Maybe": 17}
    nn = {r.id: r.neighbor_id for r in S.smote_neighbors(df, "id", ["f1", "f2"], "y").collect()}
    base = {r[0]: (r[2], r[3]) for r in rows}
    for r in out.where("is_synthetic").collect():
        (x1, x2), (y1, y2) = base[r.id], base[nn[r.id]]
        t = None
        for a, b, v in ((x1, y1, r.f1), (x2, y2, r.f2)):
            if a != b:
                t2 = (v - a) / (b - a)
                assert 0.0 <= t2 < 1.0
                t = t2 if t is None else t
                assert t2 == pytest.approx(t)
    # original rows are all kept
    assert out.where("not is_synthetic").count() == len(rows)


def test_smote_extra_copies_follow_hash_order(spark):
    rows = [(i, "Yes", float(i)) for i in range(10)] + [(10 + i, "No", float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "id bigint, y string, f double")
    out = S.smote(df, "id", ["f"], "y").where("is_synthetic").collect()
    per = {}
    for r in out:
        per[r.id] = per.get(r.id, 0) + 1
    # need 6 = 4*1 + 2 → every row once, the first two by md5(id|42) twice
    keyed = sorted(range(10, 14), key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))
    assert per == {i: (2 if i in keyed[:2] else 1) for i in range(10, 14)}


def test_smote_balanced_and_too_small(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id bigint, y string, f double")
    assert S.smote(df, "id", ["f"], "y").count() == 2
    small = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 0.0)],
                                  "id bigint, y string, f double")
    with pytest.raises(ValueError):
        S.smote(small, "id", ["f"], "y")


def test_neighbors_exact_with_dense_cluster(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        if i < 300:                                    # tight cluster, all distinct
            pt = [1000.0 + rnd.random() * 1e-3 for _ in range(3)]
        else:
            pt = [rnd.uniform(-1e4, 1e4) for _ in range(3)]
        rows.append((i, "a" if i % 3 else "b", *pt))
    df = spark.createDataFrame(rows, "id bigint, cls string, x0 double, x1 double, x2 double")
    got = S.smote_neighbors(df, "id", ["x0", "x1", "x2"], "cls", leaf_points=20).collect()
    assert {r.id: r.neighbor_id for r in got} == _brute_nn(rows)


def _examined(n, leaf_points):
    """Pairs examined per row of an HR-like table: 14 features of very unequal
    scale, the search run here as the operator runs it."""
    import numpy as np

    from turnstile.operators.neighbors import Boxes, Tree, examined_pairs, nearest

    rng = np.random.default_rng(3)
    x = np.column_stack([rng.permutation(n) * 1.0, rng.gamma(2, 3000, n).round(), rng.integers(0, 2400, n),
                         rng.integers(30, 100, n), rng.gamma(2, 7000, n).round(), rng.integers(18, 65, n),
                         rng.integers(0, 40, n), *[rng.integers(0, 5, n) for _ in range(7)]]).astype(float)
    tree = Tree(x[rng.permutation(n)[:n // leaf_points * 8]], n // leaf_points)
    leaf = tree.leaf_of(x)
    members = {int(k): np.nonzero(leaf == k)[0] for k in np.unique(leaf)}
    boxes = Boxes({k: (x[r].min(axis=0), x[r].max(axis=0)) for k, r in members.items()})
    visits = {k: 0 for k in members}
    for k, rows in members.items():
        d2, _ = nearest(x[rows], rows, x[rows], rows)
        for other, who in boxes.reached(x[rows], d2, k):
            visits[other] += len(who)
    return examined_pairs({k: len(r) for k, r in members.items()}, visits) / n


def test_few_pairs_are_examined():
    small, large = _examined(4_000, 128), _examined(16_000, 128)
    assert large < 16_000 / 10
    assert large < 2 * small


def test_busy_leaves_are_searched_in_parts(spark, monkeypatch):
    from turnstile.operators import neighbors as N

    monkeypatch.setattr(N, "VISITS_PER_TASK", 3)
    rows = _random_rows(9, n=200)
    df = spark.createDataFrame(rows, "id bigint, cls string, x0 double, x1 double, x2 double, x3 double")
    got = S.smote_neighbors(df, "id", ["x0", "x1", "x2", "x3"], "cls", leaf_points=5).collect()
    assert {r.id: r.neighbor_id for r in got} == _brute_nn(rows)


def test_class_values_are_bounded(spark):
    from turnstile.operators.neighbors import MAX_CLASSES, class_values

    with pytest.raises(ValueError):
        class_values(spark.range(MAX_CLASSES + 1), "id")


@pytest.mark.parametrize("n, ids", [(1000, 3), (1000, 1), (7, 1)])
def test_exact_split_with_repeated_ids(spark, n, ids):
    rows = [(i % ids, i // 50) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, v bigint").repartition(5)
    out = S.train_test_split(df, "id")
    assert out.columns == ["id", "v", "split"]
    assert out.where("split = 'test'").count() == -(-n // 5)
    assert sorted((r.id, r.v) for r in out.collect()) == sorted(rows)


def test_exact_split_with_more_equal_ids_than_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(S, "BOUNDARY_SORT_MAX", 100)
    df = spark.range(3000).select(F.lit(7).alias("id"), F.lit("x").alias("v")).union(
        spark.range(30).select((F.col("id") + 100).cast("int"), F.lit("y")))
    out = S.train_test_split(df, "id")
    assert out.count() == 3030 and out.where("split = 'test'").count() == 606
    # The same rows for the same seed where rows differ.
    different = spark.range(3000).select(F.lit(7).alias("id"), "id")
    different = different.toDF("id", "v")
    a, b = (S.train_test_split(different.repartition(k), "id").where("split = 'test'") for k in (3, 8))
    assert {r.v for r in a.collect()} == {r.v for r in b.collect()} and a.count() == 600


def test_local_tree_equals_comparing_all():
    import numpy as np

    from turnstile.operators import neighbors as NB

    rnd = np.random.default_rng(7)
    for points in (rnd.normal(size=(1500, 3)), rnd.integers(0, 6, (1200, 4)).astype(float),
                   np.repeat(rnd.normal(size=(400, 2)), 3, axis=0)):
        ids = np.arange(len(points)) * 3 + 1
        some = rnd.integers(0, len(points), 300)
        got = NB.nearest(points[some], ids[some], points, ids)
        want = NB.nearest_of_all(points[some], ids[some], points, ids)
        assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_work_per_query_does_not_grow_with_the_leaf(monkeypatch):
    import numpy as np

    from turnstile.operators import neighbors as NB

    plain, work = NB.nearest_of_all, []
    monkeypatch.setattr(NB, "nearest_of_all",
                        lambda q, qi, p, pi: (work.append(len(q) * len(p)), plain(q, qi, p, pi))[1])
    per_query = []
    for n in (2_000, 32_000):
        work.clear()
        x = np.random.default_rng(n).normal(size=(n, 3))
        NB.nearest(x, np.arange(n), x, np.arange(n))
        per_query.append(sum(work) / n)
    assert per_query[1] < 1.5 * per_query[0] < 2_000
