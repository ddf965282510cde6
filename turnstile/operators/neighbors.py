"""Exact nearest neighbours within a class, without comparing all pairs (M8).

The distinct points of a class are divided into leaves by a k-d tree whose
medians come from a bounded sample; every leaf's bounding box is then taken
from all its points.  A query first searches its own leaf, which gives it a
distance; after that only leaves whose box reaches into that distance can hold
anything nearer, and each of them is searched once.  The number of leaves is
bounded, so they grow with the data; a task therefore searches its points by a
k-d tree of its own.  For k neighbours the distance is that of the k-th, and the
lists of all leaves are merged by a ranking that keeps k rows in every task
before the shuffle.  Boxes adapt to features of
any scale, and a leaf that very many queries visit is searched in several
tasks, so no task holds an unbounded group.

Only the sample, the boxes and the class values reach the driver; all three are
bounded by parameters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.session import cut_lineage

# Points per leaf, and the largest number of leaves of all classes together.
LEAF_POINTS = 512
MAX_LEAVES = 32_768
# Sampled points per leaf, from which the medians are taken.
SAMPLE_PER_LEAF = 8
MAX_CLASSES = 1_000
# Points per leaf of the tree that a task makes of its points.
LOCAL_POINTS = 64
# Queries that search one leaf in one task.
VISITS_PER_TASK = 20_000
# Pairs whose distances are in memory at a time.
BLOCK_PAIRS = 1 << 21
# A box counts as reached a little early, against rounding.
SLACK = 1 + 1e-9


class Tree:
    """Splits of one class.  Node k has the children 2k + 1 and 2k + 2; a node
    without a split is a leaf."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.axis: dict[int, int] = {}
        self.cut: dict[int, float] = {}
        work = [(0, sample, leaves)]
        while work:
            node, pts, n = work.pop()
            if n < 2 or len(pts) < 2:
                continue
            axis = int(np.argmax(pts.max(axis=0) - pts.min(axis=0)))
            cut = float(np.median(pts[:, axis]))
            low = pts[:, axis] < cut
            if not low.any():  # the median is the least value
                cut = float(np.min(pts[:, axis][pts[:, axis] > cut], initial=np.inf))
                low = pts[:, axis] < cut
                if not np.isfinite(cut):
                    continue
            self.axis[node], self.cut[node] = axis, cut
            work += [(2 * node + 1, pts[low], n // 2), (2 * node + 2, pts[~low], n - n // 2)]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if node not in self.axis or not len(rows):
                out[rows] = node
                continue
            low = x[rows, self.axis[node]] < self.cut[node]
            work += [(2 * node + 1, rows[low]), (2 * node + 2, rows[~low])]
        return out


class Boxes:
    """Bounding boxes of the leaves of one class and of the nodes above."""

    def __init__(self, leaves: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.low = {k: v[0] for k, v in leaves.items()}
        self.high = {k: v[1] for k, v in leaves.items()}
        self.leaves = set(leaves)
        for k in sorted(leaves, reverse=True):
            lo, hi = leaves[k]
            while k:
                k = (k - 1) // 2
                self.low[k] = np.minimum(lo, self.low.get(k, lo))
                self.high[k] = np.maximum(hi, self.high.get(k, hi))

    def reached(self, x: np.ndarray, d2: np.ndarray, own: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``x``) for every other leaf within the rows' ``d2``."""
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if node not in self.low or not len(rows):
                continue
            gap = np.maximum(np.maximum(self.low[node] - x[rows], x[rows] - self.high[node]), 0.0)
            rows = rows[np.einsum("ij,ij->i", gap, gap) <= d2[rows] * SLACK]
            if node in self.leaves:
                if node != own and len(rows):
                    yield node, rows
            else:
                work += [(2 * node + 1, rows), (2 * node + 2, rows)]


def nearest(q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """(squared distance, position in ``p``) of the nearest other point; equal
    distances go to the smaller id, in whose order ``p`` comes.  Infinity and
    -1 where there is none.  Many points are searched by a tree of their own, so
    that the work for a query doesn't grow with the leaf it is in."""
    if len(p) <= 4 * LOCAL_POINTS:
        return nearest_of_all(q, q_ids, p, p_ids)
    tree = Tree(p, math.ceil(len(p) / LOCAL_POINTS))
    sides = _by_leaf(tree.leaf_of(p))
    boxes = Boxes({k: (p[rows].min(axis=0), p[rows].max(axis=0)) for k, rows in sides.items()})
    best, where = np.full(len(q), np.inf), np.full(len(q), -1)

    def search(rows: np.ndarray, leaf: int) -> None:
        side = sides[leaf]
        d2, at = nearest_of_all(q[rows], q_ids[rows], p[side], p_ids[side])
        place = side[at]
        better = (at >= 0) & ((d2 < best[rows]) | ((d2 == best[rows]) & (place < where[rows])))
        best[rows[better]], where[rows[better]] = d2[better], place[better]

    home = tree.leaf_of(q)
    for leaf, rows in _by_leaf(home).items():
        if leaf in sides:
            search(rows, leaf)
    for leaf, rows in list(boxes.reached(q, best.copy(), -1)):
        search(rows[home[rows] != leaf], leaf)
    return best, where


def _by_leaf(leaf: np.ndarray) -> dict[int, np.ndarray]:
    """The rows of every leaf, in ascending order."""
    order = np.argsort(leaf, kind="stable")
    cuts = np.nonzero(np.diff(leaf[order]))[0] + 1
    return {int(leaf[rows[0]]): rows for rows in np.split(order, cuts) if len(rows)}


def nearest_of_all(q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, by comparing all."""
    best, where = np.full(len(q), np.inf), np.full(len(q), -1)
    if not len(p):
        return best, where
    step = max(1, BLOCK_PAIRS // len(p))
    for i in range(0, len(q), step):
        block = q[i:i + step]
        d2 = np.zeros((len(block), len(p)))
        for a in range(q.shape[1]):  # in the order of the features, as a plain sum
            diff = block[:, a, None] - p[None, :, a]
            d2 += diff * diff
        d2[q_ids[i:i + step, None] == p_ids[None, :]] = np.inf
        at = d2.argmin(axis=1)
        found = d2[np.arange(len(block)), at]
        best[i:i + step] = found
        where[i:i + step] = np.where(np.isfinite(found), at, -1)
    return best, where


def k_nearest(q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray, k: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, with a row of the k nearest per query, nearest first."""
    if k == 1:
        d2, at = nearest(q, q_ids, p, p_ids)
        return d2[:, None], at[:, None]
    size = max(LOCAL_POINTS, 4 * k)  # a leaf should hold k other points
    if len(p) <= 4 * size:
        return k_nearest_of_all(q, q_ids, p, p_ids, k)
    tree = Tree(p, math.ceil(len(p) / size))
    sides = _by_leaf(tree.leaf_of(p))
    boxes = Boxes({n: (p[rows].min(axis=0), p[rows].max(axis=0)) for n, rows in sides.items()})
    best, where = np.full((len(q), k), np.inf), np.full((len(q), k), -1)

    def search(rows: np.ndarray, leaf: int) -> None:
        side = sides[leaf]
        d2, at = k_nearest_of_all(q[rows], q_ids[rows], p[side], p_ids[side], k)
        d2 = np.hstack([best[rows], d2])
        place = np.hstack([where[rows], np.where(at >= 0, side[at], -1)])
        order = np.lexsort((place, d2), axis=-1)[:, :k]
        best[rows] = np.take_along_axis(d2, order, axis=1)
        where[rows] = np.take_along_axis(place, order, axis=1)

    home = tree.leaf_of(q)
    for leaf, rows in _by_leaf(home).items():
        if leaf in sides:
            search(rows, leaf)
    for leaf, rows in list(boxes.reached(q, best[:, -1].copy(), -1)):
        search(rows[home[rows] != leaf], leaf)
    return best, where


def k_nearest_of_all(q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray, k: int
                     ) -> tuple[np.ndarray, np.ndarray]:
    """As ``k_nearest``, by comparing all."""
    best, where = np.full((len(q), k), np.inf), np.full((len(q), k), -1)
    if not len(p):
        return best, where
    step, m = max(1, BLOCK_PAIRS // len(p)), min(k, len(p))
    for i in range(0, len(q), step):
        block = q[i:i + step]
        d2 = np.zeros((len(block), len(p)))
        for a in range(q.shape[1]):  # in the order of the features, as a plain sum
            diff = block[:, a, None] - p[None, :, a]
            d2 += diff * diff
        d2[q_ids[i:i + step, None] == p_ids[None, :]] = np.inf
        at = np.argsort(d2, axis=1, kind="stable")[:, :m]
        found = np.take_along_axis(d2, at, axis=1)
        best[i:i + step, :m] = found
        where[i:i + step, :m] = np.where(np.isfinite(found), at, -1)
    return best, where


def class_values(df: DataFrame, cls: str) -> list:
    """The class values, after a check of their number."""
    rows = df.select(cls).where(F.col(cls).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"'{cls}' has more than {MAX_CLASSES} values; it is no class label")
    return sorted(r[0] for r in rows)


def nearest_points(points: DataFrame, id_col: str, cls: str, xs: Sequence[str],
                   leaf_points: int = LEAF_POINTS, k: int = 1) -> DataFrame:
    """``(id, class, _nn, _d2)``: for every row of ``points`` (distinct points
    with distinct ids) the k nearest others of its class (all, if fewer), a row
    for each; one row with nulls if there is none."""
    schema = points.schema
    out_schema = T.StructType([T.StructField("_id", schema[id_col].dataType),
                               T.StructField("_cls", schema[cls].dataType),
                               T.StructField("_nn", schema[id_col].dataType),
                               T.StructField("_d2", T.DoubleType())])
    pts = points.select(F.col(id_col).alias("_id"), F.col(cls).alias("_cls"),
                        F.array(*[F.col(x) for x in xs]).alias("_x")).where(F.col("_cls").isNotNull())
    values = class_values(pts, "_cls")
    counts = {r[0]: r[1] for r in pts.groupBy("_cls").agg(F.count(F.lit(1))).collect()}
    number = {v: n for n, v in enumerate(values)}
    trees = _trees(pts, values, counts, leaf_points)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.vstack(b["_x"].to_numpy()) if len(b) else np.empty((0, len(xs)))
            leaf, part = np.zeros(len(b), np.int64), b["_cls"].map(number).to_numpy()
            for n in np.unique(part):
                rows = np.nonzero(part == n)[0]
                leaf[rows] = trees[n].leaf_of(x[rows])
            b["_part"], b["_leaf"] = part.astype(np.int32), leaf
            yield b

    placed_schema = T.StructType([*pts.schema.fields, T.StructField("_part", T.IntegerType()),
                                  T.StructField("_leaf", T.LongType())])
    placed = cut_lineage(pts.mapInPandas(assign, placed_schema))
    # One row per leaf; their number is bounded by MAX_LEAVES.
    corners = placed.groupBy("_part", "_leaf").agg(
        *[F.min(F.col("_x")[a]).alias(f"l{a}") for a in range(len(xs))],
        *[F.max(F.col("_x")[a]).alias(f"h{a}") for a in range(len(xs))]).collect()
    by_part: dict[int, dict] = {}
    for r in corners:
        low, high = (np.array([r[f"{s}{a}"] for a in range(len(xs))]) for s in "lh")
        by_part.setdefault(r["_part"], {})[r["_leaf"]] = (low, high)
    boxes = points.sparkSession.sparkContext.broadcast({part: Boxes(v) for part, v in by_part.items()})

    def at_home(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_id", ignore_index=True)
        x, ids = np.vstack(group["_x"].to_numpy()), group["_id"].to_numpy()
        d2, at = k_nearest(x, ids, x, ids, k)
        group["_d2"] = [d[a >= 0] for d, a in zip(d2, at)]
        group["_nn"] = [ids[a[a >= 0]] for a in at]
        box, own = boxes.value[group["_part"].iloc[0]], group["_leaf"].iloc[0]
        targets: list[list[int]] = [[] for _ in range(len(group))]
        for leaf, rows in box.reached(x, d2[:, -1], own):
            for r in rows:
                targets[r].append(leaf)
        group["_visit"] = targets
        return group

    home_schema = T.StructType([*placed_schema.fields, T.StructField("_d2", T.ArrayType(T.DoubleType())),
                                T.StructField("_nn", T.ArrayType(schema[id_col].dataType)),
                                T.StructField("_visit", T.ArrayType(T.LongType()))])
    home = cut_lineage(placed.groupBy("_part", "_leaf").applyInPandas(at_home, home_schema))
    visits = home.select("_part", F.explode("_visit").alias("_leaf"), "_id", "_x")
    # A leaf that many queries visit is searched in several tasks.
    busy = visits.groupBy("_part", "_leaf").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(VISITS_PER_TASK)).cast("int").alias("_tasks"))
    sides = placed.join(F.broadcast(busy), ["_part", "_leaf"]).select(
        "_part", "_leaf", "_id", "_x", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)).alias("_task"))
    asked = visits.join(F.broadcast(busy), ["_part", "_leaf"]).select(
        "_part", "_leaf", "_id", "_x", F.pmod(F.xxhash64("_id"), F.col("_tasks")).cast("int").alias("_task"))

    def abroad(queries: pd.DataFrame, side: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(side):
            return pd.DataFrame({"_id": [], "_d2": [], "_nn": []})
        side = side.sort_values("_id", ignore_index=True)
        ids = side["_id"].to_numpy()
        d2, at = k_nearest(np.vstack(queries["_x"].to_numpy()), queries["_id"].to_numpy(),
                           np.vstack(side["_x"].to_numpy()), ids, k)
        row, place = np.nonzero(at >= 0)
        return pd.DataFrame({"_id": queries["_id"].to_numpy()[row], "_d2": d2[row, place],
                             "_nn": ids[at[row, place]]})

    key = ["_part", "_leaf", "_task"]
    more = asked.groupBy(*key).cogroup(sides.groupBy(*key)).applyInPandas(
        abroad, T.StructType([out_schema["_id"], out_schema["_d2"], out_schema["_nn"]]))
    near = F.arrays_zip("_d2", "_nn")
    at_home_found = home.select("_id", F.explode(near).alias("_n")).select("_id", "_n._d2", "_n._nn")
    found = more.unionByName(at_home_found)
    if k == 1:
        best = found.groupBy("_id").agg(F.min(F.struct("_d2", "_nn")).alias("_b")).select("_id", "_b.*")
    else:
        rank = F.row_number().over(Window.partitionBy("_id").orderBy("_d2", "_nn"))
        best = found.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return home.select("_id", "_cls").join(best, "_id", "left").select("_id", "_cls", "_nn", "_d2")


def _trees(pts: DataFrame, values: list, counts: dict, leaf_points: int) -> list[Tree]:
    """One tree per class from a sample of a bounded number of points: those
    with the smallest hashes."""
    total = sum(counts.values())
    per_leaf = max(leaf_points, -(-total // MAX_LEAVES))
    out = []
    for v in values:
        leaves = max(1, counts[v] // per_leaf)
        rows = []
        if leaves > 1:
            rows = (pts.where(F.col("_cls") == F.lit(v)).orderBy(F.xxhash64("_id"), "_id")
                    .limit(leaves * SAMPLE_PER_LEAF).select("_x").collect())
        out.append(Tree(np.array([r[0] for r in rows]) if rows else np.empty((0, 1)), leaves))
    return out


def examined_pairs(placed_sizes: dict[int, int], visits: dict[int, int]) -> int:
    """Pairs whose distance is taken: leaf by leaf its size times the queries
    that search it (its own points and the visitors)."""
    return sum(n * (n + visits.get(leaf, 0)) for leaf, n in placed_sizes.items())
