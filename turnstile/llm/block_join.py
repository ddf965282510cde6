"""Operator 11: nearest neighbours by inner product, as a block matrix join.

Queries and candidates meet in the cells of a grid.  A cell multiplies blocks of
int8 codes: a vector x is s * c + e with codes c of at most 127, so
<x, y> = s_x s_y <c_x, c_y> up to |e_x| |y| + |s_x c_x| |e_y|.  With these bounds a
pair is left out only if it is sure to score below the query's k-th best so far
(at the start: below the k-th best lower bound of the block).  The other pairs
are computed again from the vectors themselves, in double precision, and the
cells' lists of each query are merged by a heap.  The result is exact.

Equal vectors are next to each other in a cell; of those in one block only the
first k + 1 ids can be among the k nearest, and the others aren't tried.

Nearest first, ties to the smaller id.  The products of a pair are added up in
the order of the components, so equal vectors score equally.  Defined cases:
vectors that are null, empty, all zero, or hold a null or a component that isn't
finite take no part, nor do rows with a null id; only vectors of one dimension
meet; no row is a neighbour of its own id; rows equal in id and vector count as
one, rows that repeat an id with another vector as rows of their own; with fewer than k candidates all are
returned, with none no row; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require
from turnstile.llm.vector_grid import Cell, matrix, meet, valid

K = 20
TOP_CODE = 127
# Vectors of a tile; pairs computed again at a time.
TILE_QUERIES, TILE_ROWS, PAIRS_AT_ONCE = 1024, 2048, 1 << 16
# Up to so many products of codes add up exactly in single precision.
EXACT_DIM = (1 << 24) // TOP_CODE ** 2
# Rounding of sums, relative to the product of the norms.
ROUNDING = 1e-9
CELL_SCHEMA = "query_id bigint, tag bigint, scores array<double>, ids array<bigint>"
RESULT_SCHEMA = "query_id bigint, rank int, vec_id bigint, score double"


class Codes:
    """int8 codes of vectors, with what their bounds need."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(axis=1) / TOP_CODE
        codes = np.rint(x / self.scale[:, None])
        back = codes * self.scale[:, None]
        self.codes = codes.astype(np.int8)
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.back = np.sqrt((back * back).sum(axis=1))
        self.error = np.sqrt(((x - back) ** 2).sum(axis=1))

    def part(self, rows: slice) -> Codes:
        out = object.__new__(Codes)
        for name, value in vars(self).items():
            setattr(out, name, value[rows])
        return out


def tile(a: Codes, b: Codes) -> tuple[np.ndarray, np.ndarray]:
    """(approximation, bound of its error) of all inner products of two blocks."""
    total = 0.0
    for at in range(0, a.codes.shape[1], EXACT_DIM):
        total = total + (a.codes[:, at:at + EXACT_DIM].astype(np.float32)
                         @ b.codes[:, at:at + EXACT_DIM].astype(np.float32).T).astype(np.float64)
    near = total * a.scale[:, None] * b.scale
    left = np.stack([a.error, a.back, ROUNDING * a.norm], axis=1)
    right = np.stack([b.norm, b.error, b.norm])
    return near, left @ right * (1 + ROUNDING)


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, added in the order of the components."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


class Best:
    """The k best (score, id) of every query, nearest first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        stay = score >= self.score[row, -1]
        row, score, ids = row[stay], score[stay], ids[stay]
        if not len(row):
            return
        old = np.unique(row)
        every = np.concatenate([np.repeat(old, self.k), row])
        scores = np.concatenate([self.score[old].ravel(), score])
        named = np.concatenate([self.id[old].ravel(), ids])
        order = np.lexsort((named, -scores, every))
        every = every[order]
        first = np.searchsorted(every, old)
        nth = np.arange(len(every)) - np.repeat(first, np.diff([*first.tolist(), len(every)]))
        keep = order[nth < self.k]
        self.score[old], self.id[old] = scores[keep].reshape(-1, self.k), named[keep].reshape(-1, self.k)


class _Tiles(Cell):
    def __init__(self, dim: int, k: int):
        self.dim, self.k, self.batches, self.best, self.last = dim, k, [], None, None

    def few(self, batch: pa.RecordBatch) -> None:
        self.batches.append(batch)

    def _start(self) -> None:
        rows = pa.Table.from_batches(self.batches)
        self.query, self.tag = (rows.column(c).to_numpy() for c in (0, 1))
        self.x = np.concatenate([matrix(b.column(2), self.dim) for b in self.batches])
        self.codes, self.best = Codes(self.x), Best(len(self.x), self.k)

    def many(self, batch: pa.RecordBatch) -> None:
        if not self.batches:
            return
        if self.best is None:
            self._start()
        y, ids = self._different(matrix(batch.column(2), self.dim), batch.column(0).to_numpy())
        # Of a run of equal vectors the first k + 1 rows: one at most is the query's own.
        back = self.k + 1
        run = np.concatenate([[0], np.cumsum((y[1:] != y[:-1]).any(axis=1))])
        stay = np.concatenate([np.ones(min(back, len(y)), bool), run[back:len(y)] != run[:max(len(y) - back, 0)]])
        y, ids = y[stay], ids[stay]
        codes = Codes(y) if len(y) else None
        for b in range(0, len(y), TILE_ROWS):
            cols = slice(b, b + TILE_ROWS)
            part = codes.part(cols)
            for a in range(0, len(self.x), TILE_QUERIES):
                self._tile(slice(a, a + TILE_QUERIES), cols, part, y, ids)

    def _different(self, y: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without rows that equal the one before, also before this chunk."""
        new = np.ones(len(y), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (y[1:] != y[:-1]).any(axis=1)
        new[0] = self.last is None or self.last[0] != ids[0] or bool((self.last[1] != y[0]).any())
        self.last = ids[-1], y[-1].copy()
        return y[new], ids[new]

    def _tile(self, rows: slice, cols: slice, part: Codes, y: np.ndarray, ids: np.ndarray) -> None:
        near, bound = tile(self.codes.part(rows), part)
        near[self.query[rows, None] == ids[cols]] = -np.inf
        least = self.best.score[rows, -1]
        if near.shape[1] >= self.k and np.isneginf(least).any():
            low = near - bound
            low.partition(low.shape[1] - self.k, axis=1)
            least = np.maximum(least, low[:, -self.k])
        near += bound
        r, c = np.nonzero((near >= least[:, None]) & (near > -np.inf))
        r, c = r + rows.start, c + cols.start
        for at in range(0, len(r), PAIRS_AT_ONCE):
            i, j = r[at:at + PAIRS_AT_ONCE], c[at:at + PAIRS_AT_ONCE]
            self.best.add(i, inner(self.x[i], y[j]), ids[j])

    def results(self) -> Iterator[pa.RecordBatch]:
        if self.best is None:
            return
        full = self.best.score > -np.inf
        ends = pa.array(np.concatenate([[0], np.cumsum(full.sum(axis=1))]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(self.query), pa.array(self.tag),
             pa.ListArray.from_arrays(ends, pa.array(self.best.score[full])),
             pa.ListArray.from_arrays(ends, pa.array(self.best.id[full]))],
            names=["query_id", "tag", "scores", "ids"])


def _merged(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, rank, ids, scores = [], [], [], []
            for q, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ordered = [[(-s, i) for s, i in zip(x["scores"], x["ids"])] for x in lists]
                for n, (s, i) in enumerate(heapq.merge(*ordered), 1):
                    if n > k:
                        break
                    query.append(q)
                    rank.append(n)
                    ids.append(i)
                    scores.append(-s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(rank, pa.int32()), pa.array(ids, pa.int64()),
                 pa.array(scores, pa.float64())], names=["query_id", "rank", "vec_id", "score"])

    return run


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest ``candidates(vec_id, embedding)``
    of every one of ``queries(vec_id, embedding)``."""
    few, many = (_usable(x) for x in (queries, candidates))
    # Read twice, and once to count: a filter and a projection on the scan.
    few = few.dropDuplicates(["id", "vector"])
    lists = meet(few, many, lambda dim: _Tiles(dim, k), CELL_SCHEMA, few.count(), order=["tag", "id"])
    # A list of at most k from each column of the grid.
    of_query = lists.groupBy("query_id", "tag").agg(F.collect_list(F.struct("scores", "ids")).alias("lists"))
    return of_query.select("query_id", "lists").mapInArrow(_merged(k), RESULT_SCHEMA)


def _usable(vectors: DataFrame) -> DataFrame:
    require(vectors, ["vec_id", "embedding"])
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), F.xxhash64(x).alias("tag"),
                          x.alias("vector"))
    return rows.where(F.col("id").isNotNull() & valid(F.col("vector"))).where(
        F.exists("vector", lambda v: v != 0))
