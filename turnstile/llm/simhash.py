"""Operator 4: SimHash near-duplicates by pigeonring filtering.

Each text gets a 64-bit fingerprint.  Equal fingerprints are one class at once;
classes whose fingerprints differ in ``max_bits`` bits or fewer are linked, and
a component of linked classes is a group of near-duplicates.

Candidates come from the pigeonring principle.  The 64 bits are a ring of
SEGMENTS segments with b_0, b_1, ... differing bits.  If they sum to at most t,
some segment starts a chain in which every prefix of l segments differs in at
most l*t/SEGMENTS bits.  As long as l*t/SEGMENTS is under 1 those segments are
equal, so the first segments of the chain are an equi-join key, one per start;
the longer prefixes are tested on the joined pair before the Hamming distance.

A key shared by more than BUCKET_MAX fingerprints would emit a number of pairs
quadratic in its size.  Its fingerprints are linked without pairs instead:
two fingerprints differ in at most two bits exactly if some value is within one
bit of both, so each sends itself and its 64 one-bit neighbours, and those that
meet at a value are linked to the smallest there (at most 65 meet).  This gives
the same components.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased.  Defined
cases: a null, empty or blank text has fingerprint zero and is linked like any
other; a text with fewer words than a shingle is one shingle; repeated rows
belong to one component; an empty table gives an empty result; of a group the
smallest doc_id stays (a null id only if the group has no other); if several
rows share that id the text with the smallest hash, and of rows with equal id
and text one of them; a very long text is fingerprinted whole, its shingles' bits
block by block; other columns, whatever their names, are kept.  Large buckets are
linked without pairs for ``max_bits`` of two only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from turnstile.llm.common import lookup, require, written
from turnstile.llm.components import components

SEED = 42
BITS = 64
MAX_BITS = 2
SEGMENTS = 16
BUCKET_MAX = 32
# Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint_of(text: str | None, shingle: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    hashes = [xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED) for i in range(n)]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        block = np.array(hashes[i:i + BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        out = np.fromiter((fingerprint_of(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(out.view(np.int64))

    return run(text)


def _ring(fp: Column, start: int) -> Column:
    """``fp`` rotated so that segment ``start`` comes lowest."""
    width = BITS // SEGMENTS
    k = start * width
    if not k:
        return fp
    return F.shiftrightunsigned(fp, k).bitwiseOR(F.shiftleft(fp, BITS - k))


def _low(x: Column, segments: int) -> Column:
    bits = segments * BITS // SEGMENTS
    return x if bits >= BITS else x.bitwiseAND(F.lit((1 << bits) - 1))


def chain_keys(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, start, key): the chain of equal segments from every start."""
    equal = (SEGMENTS - 1) // max_bits if max_bits else SEGMENTS
    keys = F.array(*[F.struct(F.lit(s).alias("start"), _low(_ring(F.col("fp"), s), equal).alias("key"))
                     for s in range(SEGMENTS)])
    return fps.select("fp", F.inline(keys))


def _chain_holds(diff: Column, max_bits: int) -> Column:
    """Every prefix of the chain is within its proportional budget; the whole
    ring last, which is the Hamming distance."""
    test = F.lit(True)
    for length in range(1, SEGMENTS + 1):
        budget = length * max_bits // SEGMENTS
        if length == SEGMENTS or budget != (length + 1) * max_bits // SEGMENTS:
            test = test & (F.bit_count(_low(diff, length)) <= budget)
    return test


def _pairs(keys: DataFrame, max_bits: int) -> DataFrame:
    """Linked pairs (u > v) among fingerprints of the same key."""
    a = keys.select("start", "key", F.col("fp").alias("u"))
    b = keys.select("start", "key", F.col("fp").alias("v"))
    diff = F.col("u").bitwiseXOR(F.col("v"))
    ring = F.coalesce(*[F.when(F.col("start") == s, _ring(diff, s)) for s in range(SEGMENTS)])
    return (a.join(b, ["start", "key"]).where(F.col("u") > F.col("v"))
            .withColumn("ring", ring).where(_chain_holds(F.col("ring"), max_bits))
            .select("u", "v"))


def _meeting(fps: DataFrame) -> DataFrame:
    """Links among fingerprints at most two bits apart, without pairs."""
    one_off = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)))
                                     for i in range(BITS)])
    at = fps.select("fp", F.explode(one_off).alias("value"))
    least = at.groupBy("value").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"))
    return at.join(least.where("n > 1").drop("n"), "value").where("fp > v").select(
        F.col("fp").alias("u"), "v").distinct()


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): edges among the distinct fingerprints ``fps(fp)`` that give the
    same components as all pairs within ``max_bits`` bits."""
    keys = chain_keys(fps, max_bits)
    sizes = keys.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(keys.join(sizes, ["start", "key"]), "chains")
    if max_bits == 2:
        few = shared.where(F.col("n") <= BUCKET_MAX)
        many = shared.where(F.col("n") > BUCKET_MAX).select("fp").distinct()
        return _pairs(few, max_bits).union(_meeting(many))
    return _pairs(shared, max_bits)


def classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, least) per distinct fingerprint of ``fps(fp, first, n)``: the least
    ``first`` of its component."""
    linked = written(components(links(fps.select("fp"), max_bits)), "classes")
    named = written(fps.join(linked, fps.fp == linked.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("first").alias("least"),
                                           F.count(F.lit(1)).alias("n"))
    return lookup(named, least, "component", "n", how="inner").select("fp", "least")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, least) per row; ``least`` holds the smallest
    doc_id of its component and the smallest hash of that document's texts."""
    require(docs, ["doc_id", "text"])
    prints = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                 F.xxhash64("text").alias("text_hash"),
                                 fingerprint(F.col("text"), shingle).alias("fp")), "prints")
    # Null ids come last.
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    fps = written(prints.groupBy("fp").agg(F.min(first).alias("first"),
                                           F.count(F.lit(1)).alias("n")), "fps")
    of = classes(fps, max_bits)
    return lookup(prints, fps.select("fp", "n").join(of, "fp"), "fp", "n", how="inner")


def keep_first(docs: DataFrame, shingle: int = 5, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row per group of near-duplicates, all its columns."""
    require(docs, ["doc_id", "text"])
    groups = near_duplicates(docs, shingle, max_bits)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    stays = written(groups.where(first == F.col("least")).groupBy("doc_id", "text_hash")
                    .agg(F.count(F.lit(1)).alias("_copies")), "stays")
    # The columns travel in one struct, so their names can't clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.col("doc_id").cast("bigint").alias("_id"),
                       F.xxhash64("text").alias("_hash"))
    kept = rows.join(stays, F.col("_id").eqNullSafe(F.col("doc_id"))
                     & (F.col("_hash") == F.col("text_hash")))
    once = kept.where("_copies = 1").select("_doc")
    again = kept.where("_copies > 1").dropDuplicates(["_id", "_hash"]).select("_doc")
    return once.union(again).select("_doc.*")
