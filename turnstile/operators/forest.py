"""A random forest of binned columns for many rows (M10, M11): the trees of Spark's
forest (Poisson bootstrap, √p columns a node, Gini gain, at most BINS bins a column)
from histograms made in numpy, for all trees in one pass per level.

The table is read once and kept as blocks of bins, a byte a value, in the cache.  A
pass is one Spark job: a task takes its blocks one after the other and, tree by tree,
draws the rows' weights (again the same ones in every pass), sends the rows down the
tree as far as it is grown and adds them up by node, bin and class, two columns in one
count.  The sums of a tree meet in one place, where its splits are chosen; the driver
gets the splits.  A task holds a block and the sums of all trees, which don't depend
on the rows.  The result depends only on the seed and on the rows of each partition in
their order, so fit on a materialised table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
# Rows of a block, about: enough for numpy, few enough for a core's cache.
BLOCK_ROWS = 32_768
# Columns up to which every two of them have a common code, and classes below.
MAX_COLUMNS, MAX_CLASSES = 32, 16
# Levels up to which a task holds the sums of a level of all trees.
MAX_DEPTH = 6
# Rows from which the bins' limits are taken, about.
SAMPLE_ROWS = 10_000
BLOCK_SCHEMA = "bins binary, label binary"
SUM_SCHEMA = "tree int, sums binary"
SPLIT_SCHEMA = "tree int, node int, column int, bin int, gain double, counts array<double>"
# The weight of a row by a number of 16 bits: Poisson with mean 1.
POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]),
                          (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


@dataclass
class HistogramForest:
    """Trees as arrays (tree, node); node k has the children 2k + 1 and 2k + 2, and a
    row goes left if its bin is at most ``bin``.  ``column`` is -1 at a leaf.
    ``counts`` are the weights of the node's rows by class."""
    limits: list[np.ndarray]
    column: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    counts: np.ndarray

    @property
    def getNumTrees(self) -> int:
        return len(self.column)

    @property
    def featureImportances(self) -> np.ndarray:
        """Gain times weight by column, normalised by tree and then to 1."""
        worth = np.where(self.column >= 0, self.gain * self.counts.sum(axis=2), 0.0)
        by_tree = np.zeros((len(worth), len(self.limits)))
        np.add.at(by_tree, (np.arange(len(worth))[:, None], np.maximum(self.column, 0)), worth)
        total = by_tree.sum(axis=1, keepdims=True)
        out = np.divide(by_tree, total, out=np.zeros_like(by_tree), where=total > 0).sum(axis=0)
        return out / out.sum() if out.sum() else out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of some rows: the mean of their leaves' shares."""
        bins, out = _binned(x, self.limits), np.zeros((len(x), self.counts.shape[2]))
        for column, cut, counts in zip(self.column, self.bin, self.counts):
            node = np.zeros(len(x), np.int64)
            while (inner := column[node] >= 0).any():
                right = bins[np.maximum(column[node], 0), np.arange(len(x))] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += counts[node] / counts[node].sum(axis=1, keepdims=True)
        return out / len(self.column)


def bin_limits(values: np.ndarray) -> np.ndarray:
    """Limits of the bins of a column: between all its values if they are few, else
    those that part the rows most evenly."""
    seen, n = np.unique(values, return_counts=True)
    middle = (seen[:-1] + seen[1:]) / 2
    if len(middle) < BINS:
        return middle
    stride, upto, target, out = len(values) / BINS, np.cumsum(n), len(values) / BINS, []
    for k in range(1, len(seen)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out[:BINS - 1])


def _binned(x: np.ndarray, limits: Sequence[np.ndarray]) -> np.ndarray:
    """Bins (column, row)."""
    return np.array([np.searchsorted(lim, x[:, k]) for k, lim in enumerate(limits)], np.uint8).reshape(len(limits), -1)


def fit_histogram_forest(df: DataFrame, columns: Sequence[str], label: str, n_classes: int, n_rows: int,
                         trees: int, depth: int, least: int, seed: int) -> HistogramForest:
    """``trees`` trees of ``depth`` levels at most with ``least`` rows in a child, from
    ``df`` of ``n_rows`` rows; ``label`` holds the classes 0, 1, ...  A null or NaN
    raises."""
    values = [F.col(c).cast("double") for c in columns]
    checked = [F.when(v.isNull() | F.isnan(v), F.raise_error(F.lit(f"column {c} has a missing value"))).otherwise(v)
               for c, v in zip(columns, values)]
    rows = df.select(F.array(*checked).alias("x"), F.col(label).cast("int").alias("label"))
    share = min(1.0, SAMPLE_ROWS / max(n_rows, 1))
    sample = np.array([r.x for r in rows.select("x").sample(share, seed).collect()], float).reshape(-1, len(columns))
    limits = [bin_limits(sample[:, k]) for k in range(len(columns))]
    k, width = math.ceil(math.sqrt(len(columns))), 2 ** (depth + 1) - 1
    rnd = np.random.default_rng(seed)
    # The columns that a node may split by.
    chosen = np.sort(rnd.permuted(np.tile(np.arange(len(columns)), (trees, width, 1)), axis=2)[:, :, :k], axis=2)
    out = HistogramForest(limits, np.full((trees, width), -1), np.zeros((trees, width), int),
                          np.zeros((trees, width)), np.zeros((trees, width, n_classes)))
    blocks = _blocks(rows, limits).persist()
    try:
        for level in range(depth):
            if level and (out.column[:, 2 ** (level - 1) - 1:2 ** level - 1] < 0).all():
                break
            for r in _splits(blocks, out, chosen, level, n_classes, least, seed):
                counts = np.array(r["counts"]).reshape(3, n_classes)
                out.counts[r["tree"], r["node"]] = counts[0]
                if r["column"] >= 0:
                    t, node = r["tree"], r["node"]
                    out.column[t, node], out.bin[t, node], out.gain[t, node] = r["column"], r["bin"], r["gain"]
                    out.counts[t, 2 * node + 1], out.counts[t, 2 * node + 2] = counts[1], counts[2]
    finally:
        blocks.unpersist()
    return out


def _blocks(rows: DataFrame, limits: Sequence[np.ndarray]) -> DataFrame:
    """``rows`` (x, label) in blocks as bytes: bins column by column, classes."""
    def block(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bins, label = (np.concatenate(v, axis=-1) for v in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary()),
                                           pa.array([label.tobytes()], pa.binary())], names=["bins", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(limits))
            held.append((_binned(x, limits), b.column(1).to_numpy().astype(np.uint8)))
            n += b.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def _splits(blocks: DataFrame, forest: HistogramForest, chosen: np.ndarray, level: int, n_classes: int,
            least: int, seed: int) -> list:
    """The splits of all nodes of a level, a row for each."""
    trees, first, nodes = len(forest.column), 2 ** level - 1, 2 ** level
    column, cut = forest.column, forest.bin
    mine = chosen[:, first:first + nodes]
    k, p = mine.shape[2], len(forest.limits)
    # Two columns are counted at once; an odd one with itself.
    two = np.concatenate([mine, mine[:, :, -1:]], axis=2) if k % 2 else mine
    place = {c: i for i, c in enumerate(_pairs(p))}
    number = np.array([[place.get((a, b), -1) for b in range(p)] for a in range(p)])
    pair = number[two[:, :, 0::2], two[:, :, 1::2]]
    live = np.ones((trees, nodes), bool) if not level else column[:, (first - 1) // 2:first].repeat(2, axis=1) >= 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        sums = np.zeros((trees, nodes, k, n_classes, BINS))
        for b in batches:
            for data, labels in zip(b.column(0), b.column(1)):
                label = np.frombuffer(labels.as_buffer(), np.uint8)
                bins = np.frombuffer(data.as_buffer(), np.uint8).reshape(p, len(label))
                order = np.random.default_rng([seed, part, done])
                _add_block(sums, bins, label, column, cut, pair, live, order)
                done += 1
        if done:
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([sums[t].tobytes()], pa.binary())],
                                                 names=["tree", "sums"])

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        t = int(group["tree"].iloc[0])
        # In any order: the sums are whole numbers.
        total = sum(np.frombuffer(s) for s in group["sums"]).reshape(nodes, k, n_classes, BINS)
        total = total.swapaxes(2, 3)
        found = [(t, first + n, *best_split(total[n], mine[t, n], least)) for n in range(nodes) if live[t, n]]
        return pd.DataFrame(found, columns=["tree", "node", "column", "bin", "gain", "counts"])

    return blocks.mapInArrow(run, SUM_SCHEMA).groupBy("tree").applyInPandas(choose, SPLIT_SCHEMA).collect()


def _add_block(sums: np.ndarray, bins: np.ndarray, label: np.ndarray, column: np.ndarray, cut: np.ndarray,
               pair: np.ndarray, live: np.ndarray, order: np.random.Generator) -> None:
    """Add a block's rows to ``sums`` (tree, node, column of the node, class, bin)."""
    trees, nodes, k, n_classes, _ = sums.shape
    p, n = bins.shape
    first, cells = nodes - 1, n_classes * BINS * BINS
    # The bins of two columns and the class as one number, pair by pair.
    low = bins + label * np.uint16(BINS * BINS)
    high = bins * np.uint16(BINS)
    codes = np.array([high[a] + low[b] for a, b in _pairs(p)]).ravel()
    flat, at, steps = bins.ravel(), pair * n, nodes.bit_length() - 1
    for t in range(trees):
        weight = POISSON.take(np.frombuffer(order.bytes(2 * n), np.uint16))
        if not live[t].any():
            continue
        rows = np.flatnonzero(weight)
        weight, node = weight.take(rows).astype(float), np.zeros(len(rows), np.int64)
        start, limit, leaves = column[t] * n, cut[t], (column[t, :first] < 0).any()
        for _ in range(steps):
            if leaves:
                stay = np.flatnonzero(start.take(node) >= 0)
                rows, weight, node = rows.take(stay), weight.take(stay), node.take(stay)
            right = flat.take(start.take(node) + rows) > limit.take(node)
            node += node
            node += 1
            node += right
        node -= first
        inside = node * cells
        for j in range(pair.shape[2]):
            key = codes.take(at[t, :, j].take(node) + rows) + inside
            seen = np.bincount(key, weight, nodes * cells).reshape(nodes, n_classes, BINS, BINS)
            sums[t, :, 2 * j] += seen.sum(axis=3)
            if 2 * j + 1 < k:
                sums[t, :, 2 * j + 1] += seen.sum(axis=2)


def _pairs(p: int) -> list[tuple[int, int]]:
    """Every two of p columns, and each with itself."""
    return [(a, b) for a in range(p) for b in range(a, p)]


def gini(counts: np.ndarray) -> np.ndarray:
    """Gini impurity by the counts of the last axis."""
    total = counts.sum(axis=-1)
    share = counts / np.maximum(total, 1e-300)[..., None]
    return np.where(total > 0, 1.0 - (share * share).sum(axis=-1), 0.0)


def best_split(seen: np.ndarray, columns: np.ndarray, least: int) -> tuple[int, int, float, list[float]]:
    """(column or -1, bin, gain, counts of the node and of its children) of a node with
    the counts ``seen`` (column, bin, class)."""
    whole = seen[0].sum(axis=0)
    left = seen.cumsum(axis=1)[:, :-1]
    right = whole - left
    a, b, total = left.sum(axis=2), right.sum(axis=2), whole.sum()
    gain = gini(whole) - (a * gini(left) + b * gini(right)) / max(total, 1.0)
    gain[(a < least) | (b < least)] = -1.0
    at, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[at, cut] <= 0:
        return -1, 0, 0.0, [*whole.tolist(), *[0.0] * (2 * len(whole))]
    return (int(columns[at]), int(cut), float(gain[at, cut]),
            [*whole.tolist(), *left[at, cut].tolist(), *right[at, cut].tolist()])
