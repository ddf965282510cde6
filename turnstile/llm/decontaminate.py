"""Operator 9: benchmark items inside documents, by containment search.

Items are partitioned by size, as in LSH Ensemble (Zhu et al., 2016): class c
holds those with 2^(c-1) < shingles <= 2^c.  A document is cut, per class, into
windows of two adjacent blocks of 2^c shingles, so a passage as long as an item
lies whole in some window, and the window's size is at most four times the
item's.  That bounds the Jaccard similarity that a containment of ``contained``
implies from below, and with it the number of MinHash values needed: HASHES
values, each a band of its own, miss a passage with exactly that containment
with a probability under 1e-4.  A document is a candidate for an item if one of
its windows has one of the item's minima.

Candidates are verified exactly: the share of the item's different 5-word
shingles that occur anywhere in the whole document.

Windows are matched against the items' minima through a fixed-size bit table
first (it only saves rows) and then by a join.  Words are ``[^\\x20\\x09-\\x0D]+``
with A-Z lower-cased.

Defined cases: a null or empty text contains nothing; an item with fewer words
than a shingle can't be told from ordinary language and matches nothing; items
with equal words are searched once, and reported by the smallest item_id in
``contaminated`` and by every item_id in ``contaminated_items``; rows equal in
id and text give one result; null ids are kept; empty tables give empty results;
other columns are kept.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from turnstile.llm.common import require, written
from turnstile.session import maybe_broadcast

SHINGLE = 5
CONTAINED = 0.8
HASHES = 48
_RANDOM = random.Random(90_001)
MASKS = np.array([_RANDOM.getrandbits(64) for _ in range(HASHES)], np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so that multiplying is a permutation
SLOT_BITS = 22
SLICE_ROWS = 500

_WORDS: dict[bytes, int] = {}
_WORDS_MAX = 500_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per 5-word shingle, in order."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.empty(0, np.uint64)
    if len(_WORDS) > _WORDS_MAX:
        _WORDS.clear()
    known = _WORDS
    for w in set(words).difference(known):
        known[w] = xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = out * MIX + h[k:n + k]
    out ^= out >> np.uint64(31)
    return out * MIX


def _key(minima: np.ndarray, hash_no: int, size_class: int) -> np.ndarray:
    """Minima of one hash function and class as join keys."""
    x = (minima ^ np.uint64((hash_no << 8) | size_class)) * MIX
    return x ^ (x >> np.uint64(29))


def class_of(shingles: int) -> int:
    return max(shingles - 1, 0).bit_length()


def item_keys(hashes: np.ndarray) -> tuple[int, list[int]]:
    """(class, the HASHES join keys) of an item."""
    different = np.unique(hashes)
    c = class_of(len(different))
    keys = [_key(np.min(different ^ m, keepdims=True), j, c)[0] for j, m in enumerate(MASKS)]
    return c, [int(k) - (1 << 64) if k >> np.uint64(63) else int(k) for k in keys]


def window_hits(hashes: list[np.ndarray], classes: list[int], slots: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """(document number, join key) of the windows' minima that may be an
    item's: those whose bit in ``slots`` is set."""
    sizes = np.array([len(h) for h in hashes])
    docs = np.nonzero(sizes)[0]
    if not len(docs):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sizes, flat = sizes[docs], np.concatenate([hashes[i] for i in docs])
    grids = []  # per class: starts of the blocks in the finer level, their documents
    finer, finer_sizes = np.arange(len(flat)), sizes
    width = 1
    for c in classes:
        step = (1 << c) // width
        per_doc = -(-finer_sizes // step)
        doc = np.repeat(np.arange(len(docs)), per_doc)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        starts = (np.cumsum(finer_sizes) - finer_sizes)[doc] + nth * step
        grids.append((c, starts, doc))
        finer_sizes, width = per_doc, 1 << c
    out_docs, out_keys = [], []
    shift = np.uint64(64 - SLOT_BITS)
    for j, mask in enumerate(MASKS):
        level = flat ^ mask
        for c, starts, doc in grids:
            level = np.minimum.reduceat(level, starts)
            window = level.copy()
            same = doc[1:] == doc[:-1]
            window[:-1][same] = np.minimum(level[:-1][same], level[1:][same])
            keys = _key(window, j, c)
            hit = np.nonzero(slots[(keys >> shift).astype(np.int64)])[0]
            out_docs.append(docs[doc[hit]])
            out_keys.append(keys[hit])
    return np.concatenate(out_docs), np.concatenate(out_keys)


def prepared_items(items: DataFrame) -> DataFrame:
    """(item_key, text, item_id, size_class, keys) of the items with a
    shingle; (item_key, item_id) says which ids share a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                hashes = shingle_hashes(words)
                if len(hashes):
                    c, keys = item_keys(hashes)
                    norm = b" ".join(words).decode("utf-8", "surrogatepass")
                    rows.append({"item_id": item_id, "text": norm, "size_class": c, "keys": keys})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("item_id", pa.int64()), ("text", pa.string()), ("size_class", pa.int32()),
                ("keys", pa.list_(pa.int64()))]))

    found = items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(
        run, "item_id bigint, text string, size_class int, keys array<bigint>")
    return found.select(F.xxhash64("text").alias("item_key"), "text", "item_id", "size_class", "keys")


def different_items(items: DataFrame) -> DataFrame:
    """(item_key, text, size_class, keys) of ``items`` as prepared; equal items
    once."""
    return items.groupBy("item_key", "text").agg(
        F.first("size_class").alias("size_class"), F.first("keys").alias("keys"))


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_key) of the pairs to verify; ``items`` are the
    different ones."""
    spark = docs.sparkSession
    keys = items.select("item_key", F.explode("keys").alias("key"))
    # At most one row per class and per slot reaches the driver.
    classes = sorted(r[0] for r in items.select("size_class").distinct().collect())
    slot = F.shiftrightunsigned("key", 64 - SLOT_BITS)
    slots = np.zeros(1 << SLOT_BITS, bool)
    slots[[r[0] for r in keys.select(slot).distinct().collect()]] = True
    table = spark.sparkContext.broadcast(np.packbits(slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(table.value).astype(bool)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(i, SLICE_ROWS)
                hashes = [shingle_hashes(words_of(t)) for t in rows.column(2).to_pylist()]
                doc, key = window_hits(hashes, classes, known)
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(at), rows.column(1).take(at), pa.array(key.view(np.int64))],
                    names=["doc_id", "text_hash", "key"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    hits = rows.mapInArrow(run, "doc_id bigint, text_hash bigint, key bigint")
    return hits.join(keys, "key").select("doc_id", "text_hash", "item_key").distinct()


def verified(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, text_hash, item_key, n_shingles, n_found); ``items`` as
    prepared."""
    require(docs, ["doc_id", "text"])
    items = written(different_items(items), "different")
    pairs = written(candidates(docs, items), "candidates")
    # The items of one document together, so that its text is cut once.
    wanted = pairs.join(items.select("item_key", F.col("text").alias("item")), "item_key").groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
            F.collect_list(F.struct("item_key", "item")).alias("items"))
    wanted = written(wanted, "wanted")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64("text").alias("text_hash"), "text")
    found = rows.join(maybe_broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("text_hash") == F.col("_hash"))).select(
                          "doc_id", "text_hash", "text", "items")
    per_mille = round(contained * 1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64()) for n in
                            ("doc_id", "text_hash", "item_key", "n_shingles", "n_found")])
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                doc_id, text_hash, text, its = (c[i].as_py() for c in batch.columns)
                have = _shingles(words_of(text))
                for it in its:
                    need = _shingles(words_of(it["item"]))
                    n = len(need & have)
                    if 1000 * n >= per_mille * len(need):
                        rows.append({"doc_id": doc_id, "text_hash": text_hash, "item_key": it["item_key"],
                                     "n_shingles": len(need), "n_found": n})
            yield pa.RecordBatch.from_pylist(rows, schema)

    result = found.mapInArrow(run, "doc_id bigint, text_hash bigint, item_key bigint, "
                                   "n_shingles bigint, n_found bigint")
    return result.distinct()


def _prepared(items: DataFrame) -> DataFrame:
    require(items, ["item_id", "text"])
    return written(prepared_items(items), "items")


def _with_ids(found: DataFrame, ids: DataFrame) -> DataFrame:
    return found.join(maybe_broadcast(ids), "item_key").select(
        "doc_id", "text_hash", "item_id", "n_shingles", "n_found")


def contaminated(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, n_found): the verified pairs,
    equal items by their smallest id."""
    items = _prepared(items)
    return _with_ids(verified(docs, items, contained),
                     items.groupBy("item_key").agg(F.min("item_id").alias("item_id")))


def contaminated_items(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """As ``contaminated``, with every item_id of equal items."""
    items = _prepared(items)
    return _with_ids(verified(docs, items, contained), items.select("item_key", "item_id").distinct())


def _shingles(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def keep_clean(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """``docs`` without the documents that contain an item, all columns."""
    bad = written(verified(docs, _prepared(items), contained).select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "bad")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_hash"))
    kept = rows.join(maybe_broadcast(bad), F.col("_id").eqNullSafe(F.col("_bad_id"))
                     & (F.col("_hash") == F.col("_bad_hash")), "left_anti")
    return kept.select("_doc.*")
