"""Operator 12: periodic runs of words, by the branching-tandem test on an
enhanced suffix array.

A run is a stretch of words with smallest period q (words q apart are equal), of
length at least max(MIN_LENGTH, MIN_EXPONENT * q), that no neighbouring word
extends with that period.

The texts of a batch become one sequence of numbers with a separator of its own
after each, and get one suffix array, inverse (ISA) and table of longest common
prefixes (LCP).  Every LCP entry k, of depth l, parts its interval in the
suffixes left and right of it.  For each suffix i on the smaller side, ISA[i + l]
and ISA[i - l] tell whether that suffix is on the other side; if so, the two
agree in exactly l words, so a square of period l stands there that can't be
moved right.  The interval bounds are all that is needed of the suffix tree; no
node of it is built.  Squares are rotated left as far as they go, and those with
one end whose periods are multiples of another's merge into its run.

Words that can't be in a run are left out before: a run holds each of its words
MIN_EXPONENT times, so a word with fewer occurrences in its stretch parts it, and
stretches of under MIN_LENGTH words hold no run.  That loses nothing.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: a null, empty or blank text has
no words and no run; a null doc_id is kept; repeated rows give equal results; an
empty table gives an empty result; other columns are ignored.  A text is taken
whole however long it is: its memory and time are linear in its words but for a
logarithm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require

MIN_LENGTH, MIN_EXPONENT = 6, 4
# Bytes of text taken together (a longer text alone), and suffixes tested at a time.
BATCH_BYTES = 1 << 21
TEST_AT_ONCE = 1 << 21
# Rounds of leaving out words; more would leave out little.
ROUNDS = 4
RUNS_SCHEMA = ("doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
               "collapsed string")


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per element the number of its value and how often that occurs."""
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    return number.reshape(-1), count[number.reshape(-1)]


def stretches(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, stretch, symbol) of the words that may be in a run; a symbol
    is a word of one stretch."""
    at, part = np.arange(len(words)), doc
    symbol = words
    for _ in range(ROUNDS):
        symbol, count = _groups(part * (int(words.max(initial=0)) + 1) + words[at])
        stays = count >= MIN_EXPONENT
        was = len(at)
        at, part = at[stays], part[stays]
        if not len(at):
            break
        starts = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(part) != 0)])
        part = np.cumsum(starts) - 1
        long = np.bincount(part)[part] >= MIN_LENGTH
        at, part = at[long], part[long]
        if len(at) == was:
            break
    if len(at):
        symbol = _groups(part * (int(words.max()) + 1) + words[at])[0]
    return at, part, symbol[:len(at)]


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(SA, ISA) of a sequence that ends with a number found nowhere else, by
    prefix doubling on the suffixes that aren't alone yet."""
    n = len(text)
    sa = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    slots, width, key = np.arange(n), 0, text[sa]
    while True:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        begin = np.nonzero(first)[0]
        # A suffix has the number of the first slot of its group.
        rank[sa[slots]] = slots[begin[np.cumsum(first) - 1]]
        sizes = np.diff(np.concatenate([begin, [len(slots)]]))
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots):
            return sa, rank
        width = 2 * width or 1
        i = sa[slots]
        key = rank[i] * n + rank[i + width]
        order = np.argsort(key, kind="stable")
        sa[slots], key = i[order], key[order]


def common_prefixes(text: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> list[int]:
    """LCP[k]: how many numbers suffixes SA[k - 1] and SA[k] share (LCP[0] = 0)."""
    n = len(text)
    s, before = text.tolist(), np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n - 1  # the separator at the end: nothing in common but itself
    lcp, slot, size = [0] * n, rank.tolist(), 0
    for i, j in enumerate(before.tolist()):
        if i == j:
            size = 0
            continue
        while s[i + size] == s[j + size]:
            size += 1
        lcp[slot[i]] = size
        if size:
            size -= 1
    return lcp


def intervals(lcp: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Per LCP entry k the slots [left[k], k) and [k, right[k]) that meet there:
    of equal entries the first parts first."""
    n = len(lcp)
    left, right = [0] * n, [n] * n
    open_: list[int] = []
    for k, depth in enumerate(lcp):
        while open_ and lcp[open_[-1]] > depth:
            right[open_.pop()] = k
        left[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.array(left), np.array(right)


def squares(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that can't be moved right."""
    sa, rank = suffix_array(text)
    lcp = common_prefixes(text, sa, rank)
    left, right = intervals(lcp)
    depth = np.array(lcp)
    k = np.nonzero(depth)[0]
    size = np.minimum(k - left[k], right[k] - k)
    found = []
    # Entries in blocks of about TEST_AT_ONCE suffixes.
    blocks = np.cumsum(size) // TEST_AT_ONCE
    for block in np.split(np.arange(len(k)), np.nonzero(np.diff(blocks))[0] + 1):
        kk, n = k[block], size[block]
        small_left = kk - left[kk] <= right[kk] - kk
        begin = np.where(small_left, left[kk], kk)
        low = np.repeat(np.where(small_left, kk, left[kk]), n)
        high = np.repeat(np.where(small_left, right[kk], kk), n)
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i, l = sa[np.repeat(begin, n) + nth], np.repeat(depth[kk], n)
        for j, start in ((i + l, i), (i - l, i - l)):
            inside = (j >= 0) & (j < len(text))
            other = rank[np.where(inside, j, 0)]
            hit = inside & (other >= low) & (other < high)
            found.append((start[hit], l[hit]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _rotations(text: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far each square can be moved left.  ``text`` begins with a separator."""
    out = np.zeros(len(start), np.int64)
    todo, width = np.arange(len(start)), 16
    while len(todo):
        again = []
        for some in np.split(todo, range(TEST_AT_ONCE // width, len(todo), TEST_AT_ONCE // width)):
            at = (start - out)[some, None] - np.arange(1, width + 1)
            same = text[np.maximum(at, 0)] == text[np.maximum(at + period[some, None], 0)]
            steps = np.where(same.all(axis=1), width, same.argmin(axis=1))
            out[some] += steps
            again.append(some[steps == width])
        todo, width = np.concatenate(again), min(2 * width, 1 << 14)
    return out


def runs_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of a sequence that begins and ends
    with separators."""
    start, period = squares(text)
    end = start + 2 * period
    order = np.lexsort((period, end))
    start, period, end = start[order], period[order], end[order]
    out = []
    while len(start):
        # The least period of each end is that of a run; what it explains goes.
        first = np.concatenate([[True], end[1:] != end[:-1]])
        begin = start[first] - _rotations(text, start[first], period[first])
        q, e = period[first], end[first]
        good = e - begin >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)
        out.append((begin[good], (e - begin)[good], q[good]))
        of = np.cumsum(first) - 1
        rest = (period % q[of] != 0) | (start < begin[of])
        start, period, end = start[rest], period[rest], end[rest]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def find_runs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, length, period) of the runs in documents' words, which are
    numbers; ``doc`` says whose each is, in ascending order.  By first word and
    period."""
    at, part, symbol = stretches(words, doc)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    # A separator before each stretch and one at the end, all different.
    place = np.arange(len(at)) + part_number(part) + 1
    text = int(symbol.max()) + 1 + np.arange(place[-1] + 2)
    text[place] = symbol
    origin = np.zeros(len(text), np.int64)
    origin[place] = at
    start, length, period = runs_of(text)
    start = origin[start]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def part_number(part: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the values of an ascending array."""
    return np.concatenate([[0], np.cumsum(np.diff(part) != 0)])


def _analysed(doc_ids: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
    split = [(t or b"").split() for t in texts]  # of bytes: by ASCII white space only
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    every = [w for words in split for w in words]
    number = {w: i for i, w in enumerate(dict.fromkeys(every))}
    words = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
    doc = np.repeat(np.arange(len(split)), sizes)
    start, length, period = find_runs(words, doc)
    # Words that some run holds after its first period.
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    begins = np.cumsum(sizes) - sizes
    of = doc[start] if len(start) else np.zeros(0, np.int64)
    for d in np.unique(of).tolist():
        keep = ~gone[begins[d]:begins[d] + sizes[d]]
        split[d] = [w for w, k in zip(split[d], keep.tolist()) if k]
    runs = pa.StructArray.from_arrays(
        [pa.array(start - begins[of]), pa.array(length), pa.array(period)], ["start", "length", "period"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(split)))])
    collapsed = pa.array([b" ".join(w) for w in split], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), collapsed],
        names=["doc_id", "runs", "collapsed"])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            so_far = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, so_far + BATCH_BYTES, side="right")))
            yield _analysed(batch.column(0).slice(at, to - at), texts.slice(at, to - at).to_pylist())
            at = to


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document its ``runs`` (start in words from 0, length, period; by start
    and period) and its text ``collapsed`` to the first period of every run,
    words joined by one space.  Narrow: nothing is shuffled."""
    require(docs, ["doc_id", "text"])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_run, RUNS_SCHEMA)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a tail of repeated words in every tenth document or so:
    with h = crc32 of the decimal doc_id, g = h div 10 and n words, if h % 10 = 0
    and n > 0, every word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) div (3 + g % 8).  Other texts stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    words = F.filter(F.split(F.when(F.col("g").isNotNull(), F.col("text")), r"[\x20\x09-\x0D]+"),
                     lambda w: w != "")
    n = F.size("words")
    chosen = chosen.withColumn("words", words).withColumn(
        "a", F.when(n > 0, F.expr("g % size(words)")))
    chosen = chosen.withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    tail = F.expr("transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)]))")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(tail, " "))
                         .otherwise(F.col("text")).alias("text"))


def run_digests(runs: DataFrame) -> DataFrame:
    """Of the rows of ``periodic_runs``: their number, the run of the greatest
    exact length / period (the first of equals; nulls if there is none), and
    SHA-256 digests of all runs and of the collapsed text."""
    best = F.expr("aggregate(runs, runs[0], (b, r) -> "
                  "if(r.length * b.period > b.length * r.period, r, b))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    one = runs.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, best).alias("b"))
    return one.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("b.start").alias("start"),
        F.col("b.length").alias("length"), F.col("b.period").alias("period"),
        F.expr("1000 * b.length div b.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
