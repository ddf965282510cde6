"""Nearest neighbours and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnstile.llm import block_join, rtree_negatives, vector_grid

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, tag string"


def frame(spark, rows):
    """Two more columns have names used inside the operators."""
    return spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], SCHEMA)


def rows_of(n, dim, seed, values=None):
    """Vectors with many ties: copies, and few different components."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        v = [rnd.choice(values) if values else rnd.gauss(0, 1) for _ in range(dim)]
        if out and rnd.random() < 0.4:
            v = rnd.choice(out[:5])[1]
        out.append((i, v, rnd.randrange(3)))
    return out


ODD = [(None, [1.0, 2.0], 1), (900, None, 1), (901, [], 1), (902, [None, 1.0], 1), (903, [math.nan, 1.0], 1),
       (904, [math.inf, 1.0], 1), (905, [0.0, 0.0], 1), (906, [1.0, 2.0, 3.0], 1), (907, [3.0, 2.0, 3.0], 0),
       (908, [2.0, 1.0], None), (909, [1e-310, 0.0], 1), (910, [5.0], 2)]


def usable(v, zero):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and (
        zero or any(x != 0 for x in v))


def plain_nearest(queries, rows, k):
    out = {}
    different = {(i, tuple(v)) for i, v, _ in rows if i is not None and usable(v, False)}
    for q, x in {(i, tuple(v)) for i, v, _ in queries if i is not None and usable(v, False)}:
        best = []
        for i, v in different:
            if i != q and len(v) == len(x):
                s = 0.0
                for a, b in zip(x, v):
                    s += a * b
                best.append((-s, i))
        out.setdefault(q, []).append([(n, i, -s) for n, (s, i) in enumerate(sorted(best)[:k], 1)])
    return {q: sorted(lists) for q, lists in out.items() if any(lists)}


def nearest(spark, queries, rows, k):
    got = {}
    for r in block_join.nearest(frame(spark, queries), frame(spark, rows), k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [sorted(x)] for q, x in got.items()}


@pytest.mark.parametrize("values", [None, [0.0, 1.0, -1.0], [0.25, 1e4]])
def test_nearest_equals_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(block_join, "TILE_QUERIES", 7)
    monkeypatch.setattr(vector_grid, "CHUNK_ROWS", 64)
    rows = rows_of(400, 5, 11, values)
    queries = [r for r in rows if r[0] % 20 == 0]
    assert nearest(spark, queries, rows, 6) == plain_nearest(queries, rows, 6)


def test_nearest_in_several_rows_of_cells(spark, monkeypatch):
    monkeypatch.setattr(vector_grid, "FEW_PER_CELL", 10)
    rows = rows_of(300, 9, 5)
    assert nearest(spark, rows[:60], rows, 20) == plain_nearest(rows[:60], rows, 20)


def test_nearest_takes_odd_rows(spark):
    rows = rows_of(30, 2, 8) + ODD + [ODD[-1]] * 3 + [(5, [0.5, 0.5], 0)]
    queries = ODD + rows[:3]
    assert nearest(spark, queries, rows, 4) == plain_nearest(queries, rows, 4)
    assert nearest(spark, [], rows, 4) == {} == nearest(spark, queries, [], 4)


def test_a_vector_on_most_rows(spark):
    """Copies are left out only where ids before them are as near."""
    rows = [(i, [0.6, 0.8], 0) for i in range(3000)] + rows_of(100, 2, 3)
    rows = [(i, v, lab) for i, (_, v, lab) in enumerate(rows)]
    queries = [rows[0], rows[7], rows[2999], rows[3050]]
    assert nearest(spark, queries, rows, 20) == plain_nearest(queries, rows, 20)


def test_bounds_hold_and_codes_add_up_exactly():
    rnd = np.random.default_rng(2)
    x, y = rnd.normal(size=(40, 2500)), rnd.normal(size=(50, 2500)) * 10.0 ** rnd.integers(-3, 4, (50, 1))
    near, bound = block_join.tile(block_join.Codes(x), block_join.Codes(y))
    assert (np.abs(near - x @ y.T) <= bound).all()
    assert (bound < 0.1 * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)).all()


def plain_negatives(rows, anchors, k=5, m=10):
    pts = [(i, [math.floor(256 * c) for c in v], lab) for i, v, lab in rows
           if i is not None and lab is not None and usable(v, True)]
    out = set()
    for a, x, lab in pts:
        if not anchors(a):
            continue
        scored = [(-sum(p * q for p, q in zip(x, v)), i, other) for i, v, other in pts
                  if i != a and len(v) == len(x)]
        for s, pos, _ in sorted(t for t in scored if t[2] == lab)[:k]:
            ps = -s
            fit = sorted((s, i) for s, i, other in scored
                         if other != lab and 30 * ps <= -100 * s <= 90 * ps)[:m]
            out |= {(a, pos, n, i, ps, -s) for n, (s, i) in enumerate(fit, 1)}
    return out


def negatives(spark, rows, every=10):
    got = rtree_negatives.hard_negatives(frame(spark, rows), F.col("id") % every == 0).collect()
    out = {tuple(r) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("values", [None, [0.0, 0.5, -0.5, 1.0]])
def test_negatives_equal_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(rtree_negatives, "LEAF_ROWS", 4)
    monkeypatch.setattr(rtree_negatives, "FANOUT", 3)
    rows = rows_of(400, 6, 21, values)
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert negatives(spark, rows) == want


def test_negatives_of_few_and_odd_rows(spark):
    rows = rows_of(60, 2, 9) + ODD
    assert negatives(spark, rows) == plain_negatives(rows, lambda i: i % 10 == 0)
    assert negatives(spark, []) == set()
    assert negatives(spark, [(0, [1.0], 1)]) == set()


def test_negatives_with_large_components(spark):
    """Beyond what doubles add up exactly: Python's integers."""
    rows = [(i, [v * (1 << 20) for v in vec], lab) for i, vec, lab in rows_of(80, 3, 4)]
    assert negatives(spark, rows) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_boxes_bound_scores_and_search_prunes(monkeypatch):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(20, 8)) * 200
    codes = np.rint(centres[rnd.integers(0, 20, 4000)] + rnd.normal(size=(4000, 8)))
    label, ids = rnd.integers(0, 4, 4000), np.arange(4000)
    tree = rtree_negatives.Tree(codes, label, ids)
    search = rtree_negatives.Search(codes[0], int(label[0]), 0, 5, True)
    for level in range(len(tree.levels)):
        upper, lower, first, last = tree.nodes(level, slice(None), search.parts)
        step = rtree_negatives.FANOUT ** level
        for n in range(len(upper)):
            a, b = tree.at[n * step], tree.at[min((n + 1) * step, len(tree.at) - 1)]
            scores = tree.codes[a:b] @ search.code
            assert lower[n] <= scores.min() and scores.max() <= upper[n]
            assert first[n] == tree.label[a:b].min() and last[n] == tree.label[a:b].max()
    looked = []
    plain = rtree_negatives.Search.rows
    monkeypatch.setattr(rtree_negatives.Search, "rows", lambda s, t, leaf: (looked.append(leaf), plain(s, t, leaf)))
    search.run(tree)
    scores = codes @ codes[0]
    want = sorted((-scores[i], i) for i in range(1, 4000) if label[i] == label[0])[:5]
    assert sorted((-s, -i) for s, i in search.heaps[0]) == want
    assert len(looked) < len(tree.levels[0][0]) / 4
