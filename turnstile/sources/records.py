"""Delimited files with line ends inside quoted cells, read by many tasks (S1).

Whether a line begins inside a quoted cell depends on all quotes before it.  A
first pass counts the quotes of every split of every file; a prefix sum of their
parity over the splits of a file says which splits begin inside a cell.  A second
pass puts the lines of a split together to records from that state.  A record
that crosses a split comes as fragments, at most two from a split, which are
joined by file and place; if no split begins inside a cell there are none.

A quoted cell begins and ends with a quote and doubles those inside; a quote in an
unquoted cell, or a file that ends in an open cell, raises.  Line ends in cells stay
as they are.  A task holds one
record; a record that goes over many splits is put together in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnstile.session import cut_lineage

SPLIT = ["_file", "_start", "_length"]
RECORDS = "_file bigint, _start bigint, _place int, _first boolean, record string"
# Places of what comes from a split: the end of a record that began before it,
# whole records, the beginning of one that ends after it.
END, WHOLE, BEGINNING = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(meta["file_path"]).alias("_file"), meta["file_block_start"].alias("_start"),
        meta["file_block_length"].alias("_length"), "value")


def _quotes(value) -> F.Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def split_states(lines: DataFrame) -> DataFrame:
    """(_file, _start, _length, inside): one row per split."""
    odd = lines.groupBy(*SPLIT).agg((F.sum(_quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return odd.withColumn("inside", inside)


def check_record(record: str, shape: re.Pattern) -> None:
    if '"' in record and not shape.fullmatch(record):
        raise ValueError("a quote outside a quoted cell: such a file can't be read in parts "
                         f"(multi_line='serial' reads it): {record[:200]!r}")


def record_shape(delimiter: str) -> re.Pattern:
    """What a record with quotes looks like: cells in quotes, or without any."""
    sep = re.escape(delimiter)
    cell = f'(?:[ \\t]*+"(?:[^"]++|"")*+"[ \\t]*+|(?:(?!{sep})[^"])*+)'
    return re.compile(f"{cell}(?:{sep}{cell})*+", re.DOTALL)


def _assemble(shape: re.Pattern):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, inside, first = None, False, False
        place, parts = WHOLE, []

        def close(out: list, place: int) -> None:
            record = "\n".join(parts)
            parts.clear()
            if place == WHOLE:
                record = record.removesuffix("\r")
                check_record(record, shape)
            out.append((*at, place, first, record))

        for b in batches:
            out: list[tuple] = []
            for file, start, began, line in zip(b["_file"], b["_start"], b["inside"], b["value"]):
                if (file, start) != at:
                    if at is not None and parts:
                        close(out, place if place == END else BEGINNING)
                    if began is None or began != began:
                        raise RuntimeError("the splits of the files changed between two passes")
                    at, inside, first = (file, start), bool(began), start == 0
                    place = END if inside else WHOLE
                parts.append(line)
                if '"' in line and line.count('"') % 2:
                    inside = not inside
                if not inside:
                    close(out, place)
                    place, first = WHOLE, False
            yield pd.DataFrame(out, columns=["_file", "_start", "_place", "_first", "record"])
        if parts:
            out = []
            close(out, place if place == END else BEGINNING)
            yield pd.DataFrame(out, columns=["_file", "_start", "_place", "_first", "record"])
    return run


def read_records(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """(record, _first): every record of the files as one text without its line
    end, empty ones left out; ``_first`` marks the first of a file."""
    shape = record_shape(delimiter)
    states = cut_lineage(split_states(_lines(spark, path)))
    total = states.groupBy("_file").agg((F.sum("odd") % 2).alias("odd")).agg(F.max("odd")).first()[0]
    if total:
        raise ValueError(f"a file of {path} ends inside a quoted cell")
    # One row of fixed width per split: a millionth of the files' size.
    known = F.broadcast(states.select(*SPLIT, "inside"))
    lines = _lines(spark, path).join(known, SPLIT, "left").select("_file", "_start", "inside", "value")
    pieces = lines.mapInPandas(_assemble(shape), RECORDS)
    records = pieces.where(F.col("_place") == WHOLE).select("record", "_first")
    if not states.where("inside").isEmpty():
        # Every beginning is followed by the ends in the splits after it.
        order = Window.partitionBy("_file").orderBy("_start", "_place")
        parts = pieces.where(F.col("_place") != WHOLE).withColumn(
            "_number", F.sum((F.col("_place") == BEGINNING).cast("int")).over(order))
        crossing = parts.groupBy("_file", "_number").agg(
            F.array_sort(F.collect_list(F.struct("_start", "_place", "record"))).alias("parts"),
            F.max("_first").alias("_first"))
        crossing = crossing.select(
            F.regexp_replace(F.array_join("parts.record", "\n"), "\r$", "").alias("record"), "_first")

        def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for record in b["record"]:
                    check_record(record, shape)
                yield b

        records = records.unionByName(crossing.mapInPandas(checked, "record string, _first boolean"))
    bom = F.col("_first") & F.startswith("record", F.lit("﻿"))
    return records.select(F.when(bom, F.substring("record", 2, 2**31 - 1)).otherwise(F.col("record")).alias("record"),
                          "_first").where("record != ''")
