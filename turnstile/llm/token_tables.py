"""Documents to token ids inside Arrow batches, with running offsets."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.token_ids import encoder

# Rows encoded at a time, so that an Arrow batch of long texts isn't held as
# ids all at once.
SLICE_ROWS = 1000

TOKEN_SCHEMA = ("doc_id bigint, part int, local_start bigint, n_tokens bigint, "
                "ids array<int>")


def tokenize(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int) -> DataFrame:
    """(doc_id, part, local_start, n_tokens, ids): each document's ids with
    ``end_id`` appended, in the order of the rows of its partition ``part``;
    ``local_start`` counts the ids before it there.  A null text counts as
    empty.  Narrow: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, keeps_space, special=True)
        end = int(end_id).to_bytes(4, "little")
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                ids = [x + end for x in enc.encode(rows.column(1).to_pylist())]
                sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                ends = np.cumsum(sizes)
                flat = pa.Array.from_buffers(
                    pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(ids), part, np.int32)),
                     pa.array(total + ends - sizes), pa.array(sizes),
                     pa.ListArray.from_arrays(offsets, flat)],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"])
                total += int(ends[-1])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, TOKEN_SCHEMA)


def part_offsets(tokens: DataFrame) -> DataFrame:
    """(part, part_start): ids in all lower parts.  One row per written part, so
    its size is bounded by the number of tasks, not by documents."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    rows, start = [], 0
    for part, n in sorted(map(tuple, totals)):
        rows.append((part, start))
        start += n
    return tokens.sparkSession.createDataFrame(rows, "part int, part_start bigint")


def list_bytes(ids: pa.ListArray) -> tuple[memoryview, np.ndarray]:
    """The little-endian bytes of all ids of a list<int32> column, and the row
    offsets into them, counted in ids."""
    flat = ids.flatten()
    offsets = ids.offsets.to_numpy()
    offsets = offsets - offsets[0]
    view = memoryview(flat.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B") \
        if len(flat) else memoryview(b"")
    return view, offsets


def crc32_of(ids: pa.ListArray) -> pa.Array:
    view, at = list_bytes(ids)
    return pa.array([zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())],
                    pa.int64())
