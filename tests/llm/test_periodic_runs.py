"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnstile.llm import periodic_runs as pr
from turnstile.llm.queries import op12_periodic_runs


def plain_runs(words):
    """All maximal stretches by comparing words q apart, of least period."""
    n, found = len(words), {}
    for q in range(1, n // pr.MIN_EXPONENT + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(pr.MIN_LENGTH, pr.MIN_EXPONENT * q):
                found.setdefault((i, length), q)  # the least q comes first
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def found(texts):
    """The runs of several word lists in one batch."""
    words = np.array([w for t in texts for w in t], np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    out = [[] for _ in texts]
    for s, m, q in zip(*map(np.ndarray.tolist, pr.find_runs(words, doc))):
        out[doc[s]].append((s - int(begins[doc[s]]), m, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=5))
def test_small_alphabets(texts):
    assert [sorted(x) for x in found(texts)] == [plain_runs(t) for t in texts]


def test_nested_and_long_runs():
    rnd = random.Random(12)
    texts = []
    for _ in range(60):
        text = []
        while len(text) < 300:
            block = [rnd.randrange(4) for _ in range(rnd.choice([1, 2, 3, 7, 12]))]
            if rnd.random() < 0.5:
                block = block * rnd.randrange(4, 7)  # a run inside a repeated block
            text += block * rnd.choice([1, 1, 4, 6]) + block[:rnd.randrange(len(block) + 1)]
        texts.append(text)
    assert [sorted(x) for x in found(texts)] == [plain_runs(t) for t in texts]
    assert sum(map(len, map(plain_runs, texts))) > 200


def test_suffix_array_and_prefixes():
    rnd = random.Random(3)
    for n in (1, 2, 40, 300):
        text = np.array([rnd.randrange(3) for _ in range(n)] + [9])
        sa, rank = pr.suffix_array(text)
        s = text.tolist()
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: s[i:])
        assert rank[sa].tolist() == list(range(n + 1))
        lcp = pr.common_prefixes(text, sa, rank)
        for k in range(1, n + 1):
            a, b = s[sa[k - 1]:], s[sa[k]:]
            assert lcp[k] == next(i for i in range(n + 1) if a[i] != b[i])


@pytest.mark.parametrize("period", [1, 2, 777])
def test_one_long_run(period):
    """Linear but for a logarithm: 200,000 words of one run."""
    words = np.arange(200_000) % period
    got = pr.find_runs(words, np.zeros(200_000, np.int64))
    assert [x.tolist() for x in got] == [[0], [200_000], [period]]


def test_query_against_brute_force(spark, texts, tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = texts + [(10**9 + i, " ".join(random.Random(i).choices(["a", "b", "über"], k=i))) for i in range(120)]
    os.makedirs(tmp_path / "in", exist_ok=True)
    pq.write_table(pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()),
                             "text": pa.array([r[1] for r in rows])}), tmp_path / "in" / "documents.parquet")
    got = op12_periodic_runs(spark, str(tmp_path / "in")).collect()
    want = {r[0]: r for r in (plain_row(*x) for x in rows)}
    assert len(got) == len(rows)
    assert {r.doc_id: tuple(r) for r in got} == want
    assert sum(r.n_runs > 0 for r in got) > 50


def test_odd_rows(spark, frame, odd_rows):
    got = pr.run_digests(pr.periodic_runs(pr.with_periodic_tails(frame(odd_rows)))).collect()
    want = [plain_row(i, t) for i, t, _ in odd_rows if t is None or len(t) < 50_000]
    have = [tuple(r) for r in got if r.doc_id != 4]
    assert sorted(map(str, have)) == sorted(map(str, want))
    assert len(got) == len(odd_rows)
    empty = pr.run_digests(pr.periodic_runs(pr.with_periodic_tails(frame([]))))
    assert empty.collect() == []
