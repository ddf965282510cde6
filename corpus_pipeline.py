"""A training-data pipeline of five operators over ``documents``.

Every stage takes all that its predecessor kept, and is written as Parquet and
read again before the next.  All but the last return the columns of documents.

Defined cases, of every stage: null or empty texts are documents without words or
lines (the rules reject them); very long texts are taken whole; a null doc_id is
an id of its own, ordered last; rows equal in id and text are treated alike, and
one of them stays in the SimHash stage; an empty table gives an empty result; other
columns are kept, whatever their names, up to packing, which ignores them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnstile.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from turnstile.llm.common import table, written
from turnstile.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, of hosts that pass them."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence stays of every group of similar lines."""
    return line_dedup.dedup_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of every group of near-duplicates."""
    return simhash.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", simhash_stage),
    ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]

# MinHash bands, SimHash fingerprints and tokenizers aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
