"""A grid of cells in which some vectors meet all vectors, in blocks.

The few (queries or anchors) are dealt into ROWS by a hash, the many into
COLUMNS; a cell gets one row's few and one column's many, and streams the many
past the few in Arrow batches.  Each few is sent to every column and each of the
many to every row, so the shuffle is n_many * rows + n_few * columns vectors.
The rows follow from ``FEW_PER_CELL``, the columns from the cluster's size; the
results don't depend on either.  Both hashes include the id, so copies of one
vector are spread out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require

# The few in a cell: all that a task holds of them.
FEW_PER_CELL = 32_768
CELLS_PER_CORE = 3
# Of the many taken at a time.
CHUNK_ROWS = 16_384


def valid(vector: Column) -> Column:
    """Not null, not empty, and all components are finite numbers."""
    x = vector.cast("array<double>")
    return F.coalesce((F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


class Cell:
    """What a task does with one cell and one dimension."""

    def few(self, batch: pa.RecordBatch) -> None:
        """Rows of the few, before all of the many."""

    def many(self, batch: pa.RecordBatch) -> None:
        """Up to CHUNK_ROWS of the many."""

    def results(self) -> Iterator[pa.RecordBatch]:
        """After the last row."""
        raise NotImplementedError


def matrix(vectors: pa.ListArray, dim: int, kind: type = np.float64) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)


def meet(few: DataFrame, many: DataFrame, make: Callable[[int], Cell], schema: str,
         n_few: int, order: Sequence[str] = ()) -> DataFrame:
    """The results of ``make(dimension)`` for all cells.  ``few`` and ``many`` have
    the same columns, with ``id`` and ``vector`` among them; only vectors of one
    dimension meet.  A cell's many arrive in the ``order`` of some columns."""
    require(few, ["id", "vector"])
    spark = few.sparkSession
    rows = max(1, math.ceil(n_few / FEW_PER_CELL))
    columns = max(1, math.ceil(CELLS_PER_CORE * spark.sparkContext.defaultParallelism / rows))
    names = few.columns
    row = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(rows)).cast("int")
    column = F.pmod(F.xxhash64("id", "vector", F.lit(13)), F.lit(columns)).cast("int")
    a = few.select(*names, F.lit(0).alias("side"), row.alias("row"),
                   F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("column"))
    b = many.select(*names, F.lit(1).alias("side"),
                    F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row"), column.alias("column"))
    cells = a.unionByName(b).withColumn("cell", F.col("row") * columns + F.col("column"))
    cells = cells.withColumn("dim", F.size("vector"))
    dealt = cells.repartitionById(rows * columns, F.col("cell")).sortWithinPartitions(
        "cell", "dim", "side", *order)
    return dealt.select("cell", "dim", "side", *names).mapInArrow(_by_cell(make), schema)


def _by_cell(make: Callable[[int], Cell]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None
        held: list[pa.RecordBatch] = []

        def pass_on() -> None:
            if held:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()
                for batch in rows:
                    cell.many(batch)
                held.clear()

        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                at, side = tuple(key[a, :2].tolist()), key[a, 2]
                if at != now:
                    if cell is not None:
                        pass_on()
                        yield from cell.results()
                    now, cell = at, make(at[1])
                for c in range(a, b, CHUNK_ROWS):
                    part = batch.slice(c, min(CHUNK_ROWS, b - c))
                    part = pa.RecordBatch.from_arrays(part.columns[3:], names=part.schema.names[3:])
                    if side == 0:
                        cell.few(part)
                        continue
                    if sum(x.num_rows for x in held) + part.num_rows > CHUNK_ROWS:
                        pass_on()
                    held.append(part)
        if cell is not None:
            pass_on()
            yield from cell.results()

    return run
