"""Operator 3: concatenate all documents' ids and cut fixed windows.

Pass one writes each document's ids with its offset inside its partition and
sums the partitions.  The prefix sums over those totals (one number per
partition) give every document its place in one long id sequence; pass two cuts
that sequence every ``window`` ids.  A document that crosses a boundary gives
one piece per window it touches.  Only the last sequence is padded.  No row is
shuffled in either pass.

Defined cases: null or empty text: the end id alone; null doc_id: kept as null;
repeated rows: packed once each; empty table: no pieces; other columns, whatever
their names, are ignored; a very long text is encoded whole, its ids are one row
until they are cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require, written
from turnstile.llm.token_tables import SLICE_ROWS, list_bytes, part_offsets, tokenize

PIECE_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, "
                "doc_tokens bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, keeps_space: bool = False, end_id: int = 1,
         window: int = 2048, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``start`` ids of its document precede it, it is
    ``length`` long and stands at ``offset`` of sequence ``sequence_id``.
    ``with_ids`` adds the ids themselves (``ids array<int>``)."""
    require(docs, ["doc_id", "text"])
    tokens = written(tokenize(docs, tokenizer, keeps_space, end_id), "tokens")
    placed = tokens.join(F.broadcast(part_offsets(tokens)), "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("place"), "ids")
    return placed.mapInArrow(_cutter(window, with_ids),
                             PIECE_SCHEMA + (", ids array<int>" if with_ids else ""))


def _cutter(window: int, with_ids: bool):
    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        view, at = list_bytes(rows.column(2))
        sizes = np.diff(at).astype(np.int64)
        place = rows.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        first, last = place // window, (place + sizes - 1) // window
        pieces = last - first + 1
        row = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        seq = first[row] + nth
        begin = np.maximum(place[row], seq * window)
        end = np.minimum(place[row] + sizes[row], (seq + 1) * window)
        start, length = begin - place[row], end - begin
        a = at[:-1][row] + start
        crc = [zlib.crc32(view[4 * x:4 * (x + n)]) for x, n in zip(a.tolist(), length.tolist())]
        cols = [rows.column(0).take(pa.array(row)), pa.array(start), pa.array(length),
                pa.array(crc, pa.int64()), pa.array(sizes[row]), pa.array(seq),
                pa.array(begin - seq * window)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:  # the pieces of a row follow each other, so the ids stay as they are
            ends = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
            cols.append(pa.ListArray.from_arrays(ends, rows.column(2).flatten()))
            names.append("ids")
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                yield cut(batch.slice(i, SLICE_ROWS))

    return run
