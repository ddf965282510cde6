"""Operator 13: hard negatives by an STR-packed R-tree.

The score of two rows is the inner product of their integer codes.  An anchor's
positives are its best rows of the same label; for each positive, the hard
negatives are the best rows of other labels whose score lies in a window under
the positive's.

Rows are packed by sort-tile-recurse: over the whole table into tiles, by splits
of a bounded sample, which order the rows of each cell of a grid; and within a
cell, chunk by chunk, into leaves and levels above them.  The label is the first
coordinate.  A node keeps its minimum bounding box.  For an anchor a, the box
bounds each product a_j * x_j, and the sum of these intervals bounds the scores
of all rows in the node.  A best-first queue takes the node with the highest
bound; nodes outside all windows, without a row of a wanted label, or strictly
below the k-th best are pruned.  Anchors meet each cell twice, for positives and
then for negatives; lists of k from each cell are merged.

Higher scores come first, ties by smaller id.  Codes are floor(256 * x), and
scores are exact: sums that a double may round are made in Python's integers,
without pruning, and shown as the nearest 64-bit integer.  Defined cases: rows
with a null id or label, a null or empty vector, or a component that is null or
isn't finite take no part; only vectors of one dimension meet; no row is a
partner of its own id; rows that repeat an id count as rows of their own, equal
anchors as one; an anchor without a positive, and a positive without a negative,
give no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require, written
from turnstile.llm.vector_grid import CHUNK_ROWS, Cell, matrix, meet, valid

CODE_SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# Least and greatest score of a negative in percent of its positive's.
WINDOW = (30, 90)
LEAF_ROWS, FANOUT = 128, 8
# Rows by whose coordinates the tiles are split: a bound of what the driver sees.
SAMPLE_ROWS, TILE_LEVELS = 20_000, 10
EXACT = 1 << 53
ANCHOR_COLUMNS = "anchor_id bigint, tag bigint"
FOUND = "found array<struct<less: bigint, id: bigint>>"


def str_order(codes: np.ndarray, label: np.ndarray, leaf: int = LEAF_ROWS) -> list[np.ndarray]:
    """The leaves of a packed tree, in order.  A label with a leaf's worth of rows
    has leaves of its own, the others share; then slabs by one coordinate after
    the other, as many as the leaves left need over the coordinates left."""
    dim = codes.shape[1]
    out: list[np.ndarray] = []

    def pack(rows: np.ndarray, j: int) -> None:
        leaves = math.ceil(len(rows) / leaf)
        if leaves <= 1 or j >= dim:
            out.extend(rows[a:a + leaf] for a in range(0, len(rows), leaf))
            return
        slabs = math.ceil(leaves ** (1 / (dim - j)))
        rows = rows[np.argsort(codes[rows, j], kind="stable")]
        size = math.ceil(leaves / slabs) * leaf
        for a in range(0, len(rows), size):
            pack(rows[a:a + size], j + 1)

    order = np.argsort(label, kind="stable")
    few: list[np.ndarray] = []
    for rows in np.split(order, np.nonzero(np.diff(label[order]))[0] + 1):
        few.append(rows) if len(rows) < leaf else pack(rows, 0)
    if few:
        pack(np.concatenate(few), 0)
    return out


class Tree:
    """A packed R-tree of one chunk.  Nodes of a level follow each other, and so
    do their children; level 0 are the leaves."""

    def __init__(self, codes: np.ndarray, label: np.ndarray, ids: np.ndarray):
        leaves = str_order(codes, label)
        order = np.concatenate(leaves)
        self.codes, self.label, self.ids = codes[order], label[order], ids[order]
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        starts = self.at[:-1]
        boxes = [self._boxes(self.codes, self.codes, self.label, self.label, starts)]
        while len(boxes[-1][0]) > 1:
            low, high, first, last = boxes[-1]
            boxes.append(self._boxes(low, high, first, last, np.arange(0, len(low), FANOUT)))
        # For an anchor split in its positive and negative part, one product with
        # these gives the upper end of the interval sum, one the lower.
        self.levels = [(np.hstack([high, -low]), np.hstack([low, -high]), first, last)
                       for low, high, first, last in boxes]

    @staticmethod
    def _boxes(low, high, first, last, starts):
        return (np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
                np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts))

    def nodes(self, level: int, rows: slice, parts: np.ndarray):
        """(upper, lower, first label, last label) of some nodes of a level."""
        up, down, first, last = self.levels[level]
        return up[rows] @ parts, down[rows] @ parts, first[rows], last[rows]


class Search:
    """What one anchor looks for: up to ``k`` rows in each of some windows of
    scores, of its own label or of others, and the best found so far."""

    def __init__(self, code: np.ndarray, label: int, own: int, k: int, same: bool,
                 windows: list[tuple[int, int]] | None = None):
        self.code, self.label, self.own, self.k, self.same = code, label, own, k, same
        self.parts = np.concatenate([np.maximum(code, 0), np.maximum(-code, 0)])
        self.windows = [(-math.inf, math.inf)] if windows is None else windows
        # Min-heaps of (score, -id): their first entry is the worst kept.
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in self.windows]
        self.needs = [low for low, _ in self.windows]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rows of wanted labels."""
        for w, (low, high) in enumerate(self.windows):
            heap = self.heaps[w]
            hit = np.nonzero((scores >= self.needs[w]) & (scores <= high))[0]
            if len(hit) > self.k:
                hit = np.array(sorted(hit.tolist(), key=lambda i: (-scores[i], ids[i]))[:self.k])
            for entry in zip(scores[hit].tolist(), (-ids[hit]).tolist()):
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.needs[w] = max(low, heap[0][0])

    def wants(self, upper: float, lower: float) -> bool:
        """Whether some row with a score in this interval could be taken: it is
        in a window and not strictly below the k-th best."""
        return any(upper >= need and lower <= high
                   for need, (_, high) in zip(self.needs, self.windows))

    def rows(self, tree: Tree, leaf: int) -> None:
        rows = slice(tree.at[leaf], tree.at[leaf + 1])
        scores = tree.codes[rows] @ self.code
        if scores.max() < min(self.needs):
            return
        mask = ((tree.label[rows] == self.label) == self.same) & (tree.ids[rows] != self.own)
        self.add(scores[mask].astype(np.int64), tree.ids[rows][mask])

    def run(self, tree: Tree) -> None:
        queue: list[tuple[float, int, int, float]] = []

        def push(level: int, a: int, b: int) -> None:
            upper, lower, first, last = tree.nodes(level, slice(a, b), self.parts)
            held = ((first <= self.label) & (self.label <= last) if self.same
                    else (first != self.label) | (last != self.label))
            floor = min(self.needs)
            for n in np.nonzero(held & (upper >= floor))[0].tolist():
                if self.wants(upper[n], lower[n]):
                    heapq.heappush(queue, (-upper[n], level, a + n, lower[n]))

        top = len(tree.levels) - 1
        push(top, 0, len(tree.levels[top][0]))
        while queue:
            upper, level, node, lower = heapq.heappop(queue)
            if -upper < min(self.needs):
                return
            if not self.wants(-upper, lower):
                continue
            if level == 0:
                self.rows(tree, node)
            else:
                below = len(tree.levels[level - 1][0])
                push(level - 1, node * FANOUT, min((node + 1) * FANOUT, below))

    def run_exactly(self, codes: np.ndarray, label: np.ndarray, ids: np.ndarray) -> None:
        """All rows, in Python's integers."""
        mine = [int(v) for v in self.code]
        rows = np.nonzero(((label == self.label) == self.same) & (ids != self.own))[0]
        scores = [sum(a * int(b) for a, b in zip(mine, codes[i])) for i in rows]
        self.add(np.array(scores, object), ids[rows])


class _Searches(Cell):
    """The anchors of a cell against its rows, chunk by chunk."""

    def __init__(self, dim: int, k: int, same: bool):
        self.dim, self.k, self.same, self.top = dim, k, same, 0.0
        self.anchors: list[tuple[int, int, list, Search]] = []

    def few(self, batch: pa.RecordBatch) -> None:
        codes = matrix(batch.column(2), self.dim)
        self.top = max(self.top, float(np.abs(codes).max()))
        columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 5)]
        for code, own, tag, label, positives in zip(codes, *columns):
            if self.same:
                self.anchors.append((own, tag, [None], Search(code, label, own, self.k, True)))
            else:
                windows = [window(p["score"]) for p in positives]
                self.anchors.append((own, tag, positives, Search(code, label, own, self.k, False, windows)))

    def many(self, batch: pa.RecordBatch) -> None:
        if not self.anchors:
            return
        codes, ids, label = matrix(batch.column(2), self.dim), batch.column(0).to_numpy(), batch.column(3).to_numpy()
        if self.dim * self.top * float(np.abs(codes).max()) >= EXACT:
            for *_, search in self.anchors:
                search.run_exactly(codes, label, ids)
            return
        tree = Tree(codes, label, ids)
        for *_, search in self.anchors:
            search.run(tree)

    def results(self) -> Iterator[pa.RecordBatch]:
        rows = [(own, tag, p and p["id"], p and p["score"],
                 [{"less": _long(-s), "id": -i} for s, i in sorted(heap, reverse=True)])
                for own, tag, positives, search in self.anchors
                for p, heap in zip(positives, search.heaps) if heap]
        types = [pa.int64()] * 4 + [pa.list_(pa.struct([("less", pa.int64()), ("id", pa.int64())]))]
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["anchor_id", "tag", "positive_id", "positive_score", "found"])


def window(score: int) -> tuple[int, int]:
    """The scores a negative of such a positive may have; nothing if low > high."""
    low, high = -(-WINDOW[0] * score // 100), WINDOW[1] * score // 100
    return (low, high) if low <= high else (math.inf, -math.inf)


def _long(x: int) -> int:
    return max(-(1 << 63) + 1, min((1 << 63) - 1, x))


def _codes(rows: DataFrame, keep_label: Column) -> DataFrame:
    require(rows, ["vec_id", "embedding", "label"])
    x = F.col("embedding").cast("array<double>")
    usable = rows.select(F.col("vec_id").cast("bigint").alias("id"), x.alias("x"),
                         keep_label.cast("bigint").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & valid(F.col("x")))
    # floor() gives a long; doubles that may not fit one are whole numbers as they are.
    code = F.transform("x", lambda v: F.when(F.abs(v * CODE_SCALE) < EXACT, F.floor(v * CODE_SCALE).cast("double"))
                       .otherwise(v * CODE_SCALE))
    return usable.select("id", F.xxhash64("x", "label").alias("tag"), code.alias("vector"), "label")


def tile_splits(points: DataFrame) -> list[np.ndarray]:
    """Medians of successive coordinates that part a bounded sample into tiles: a
    tree in heap order, level by level."""
    rows = points.orderBy(F.xxhash64("id", F.lit(29)), "id").limit(SAMPLE_ROWS)
    vectors = [r[0] for r in rows.select(F.slice("vector", 1, TILE_LEVELS)).collect()]
    dim = min(map(len, vectors), default=0)
    sample = np.array([v[:dim] for v in vectors]).reshape(len(vectors), dim)
    tile, levels = np.zeros(len(sample), np.int64), []
    for j in range(dim):
        medians = pd.Series(sample[:, j]).groupby(tile).median().reindex(range(1 << j), fill_value=0.0)
        levels.append(medians.to_numpy())
        tile = 2 * tile + (sample[:, j] > levels[j][tile])
    return levels


def with_tiles(points: DataFrame, levels: list[np.ndarray]) -> DataFrame:
    """``points`` with the number of their ``tile``."""

    @F.pandas_udf("bigint")
    def tile_of(vectors: pd.Series) -> pd.Series:
        tile = np.zeros(len(vectors), np.int64)
        for j, medians in enumerate(levels):
            x = np.fromiter((v[j] if j < len(v) else 0.0 for v in vectors), np.float64, len(vectors))
            tile = 2 * tile + (x > medians[tile])
        return pd.Series(tile)

    return points.withColumn("tile", tile_of("vector"))


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column | None = None,
                   positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    among ``rows(vec_id, embedding, label)``; ``is_anchor`` is a condition on ``id``,
    ``label`` may replace the label."""
    points = _codes(rows, F.col("label") if label is None else label)
    points = written(with_tiles(points, tile_splits(points)), "points")
    none = F.lit(None).cast("array<struct<score: bigint, id: bigint>>")
    many = points.withColumn("positives", none)
    few = written(many.where(is_anchor).dropDuplicates(["id", "tag", "vector"]), "anchors")
    n = few.count()
    columns = f"{ANCHOR_COLUMNS}, positive_id bigint, positive_score bigint, {FOUND}"
    order = ["label", "tile", "id"]

    def search(anchors: DataFrame, k: int, same: bool, keys: list[str]) -> DataFrame:
        lists = meet(anchors, many, lambda dim: _Searches(dim, k, same), columns, n, order=order)
        # A list of at most k from each column of the grid.
        return lists.groupBy(*keys).agg(
            F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))

    best = search(few, positives, True, ["anchor_id", "tag"]).select(
        F.col("anchor_id").alias("id"), "tag",
        F.transform("found", lambda f: F.struct((-f["less"]).alias("score"), f["id"].alias("id")))
        .alias("positives"))
    asked = written(few.drop("positives").join(best, ["id", "tag"]).select(many.columns), "asked")
    found = search(asked, negatives, False, ["anchor_id", "tag", "positive_id", "positive_score"])
    return found.select("anchor_id", "positive_id", "positive_score", F.posexplode("found").alias("nth", "f")).select(
        "anchor_id", "positive_id", (F.col("nth") + 1).cast("int").alias("rank"),
        F.col("f.id").alias("negative_id"), "positive_score", (-F.col("f.less")).alias("negative_score"))
