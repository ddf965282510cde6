"""Operator 10: token ids in ORC files, and back.

Documents are range-partitioned and sorted by doc_id, encoded, and written as
ORC: integer run-length encoding for the ids, a row index every few thousand
rows and a Bloom filter on ``doc_id``.  Stripes are the unit of parallel reads;
file, stripe and row-group statistics prune reads by id.

Defined cases: null or empty text: the end id alone; null doc_id: first in the
order; repeated doc_ids: ordered among themselves by text, so a retried task
writes the same file; empty table: an empty file set and result; other columns
are ignored; a very long text is encoded whole and is one row of its stripe.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import require
from turnstile.llm.token_tables import TOKEN_SCHEMA, crc32_of, part_offsets, tokenize

STRIPE_BYTES = 64 << 20
ROW_INDEX_STRIDE = 2_000
BLOOM_FALSE_POSITIVES = 0.01


def write_token_orc(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool = True,
                    end_id: int = 2) -> None:
    """Write (doc_id, part, local_start, n_tokens, ids) in ascending doc_id order
    over all files: file order is ``part`` order."""
    require(docs, ["doc_id", "text"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # The hash of the text only splits a doc_id that very many rows share.
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    (tokenize(rows, tokenizer, keeps_space, end_id).write
     .option("compression", "zstd")
     .option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.create.index", "true")
     .option("orc.row.index.stride", ROW_INDEX_STRIDE)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", BLOOM_FALSE_POSITIVES)
     .orc(path))


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The files as written, with ``start``: the ids of all documents before.
    A filter on ``doc_id`` is pushed into the scan."""
    tokens = spark.read.schema(TOKEN_SCHEMA).orc(path)
    offsets = part_offsets(tokens)
    return tokens.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"),
        "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of a table with ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), crc32_of(b.column(3))],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
