"""SimHash groups, fuzzy lines and components against brute force."""

import random
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.llm import line_dedup, simhash
from turnstile.llm.components import components


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    for n, m in ((30, 20), (200, 180), (60, 300)):
        edges = [(rnd.randrange(n) * 7 - 90, rnd.randrange(n) * 7 - 90) for _ in range(m)]
        chain = [(10_000 + i, 10_001 + i) for i in range(40)]
        star = [(20_000, 20_001 + i) for i in range(300)]
        every = edges + chain + star + [(None, 5), (5, None)]
        u = Union()
        for a, b in edges + chain + star:
            if a != b:
                u.join(a, b)
        got = components(spark.createDataFrame(every, "u bigint, v bigint")).collect()
        assert len(got) == len({r.node for r in got})
        assert {r.node: r.component for r in got} == {x: u.find(x) for x in u.parent}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []
    assert components(spark.createDataFrame([(3, 3)], "u bigint, v bigint")).collect() == []


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(len(words) - k + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(rows, k=3, bits=2):
    """Smallest doc_id per row by comparing all fingerprints."""
    fp = [plain_fingerprint(t, k) for _, t in rows]
    u = Union()
    different = sorted(set(fp))
    for i, a in enumerate(different):
        u.find(a)
        for b in different[:i]:
            if (a ^ b).bit_count() <= bits:
                u.join(a, b)
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[u.find(f)] = min(i, least.get(u.find(f), i))
    return [(i, f"{f:016x}", least.get(u.find(f))) for (i, _), f in zip(rows, fp)]


def groups(docs, k=3, bits=2):
    got = simhash.near_duplicates(docs, k, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), F.col("least.doc_id")).collect()
    return sorted(map(tuple, got), key=str)


def test_simhash_groups_of_documents(documents, texts):
    assert groups(documents) == sorted(plain_groups(texts), key=str)
    assert groups(documents, 5, 3) == sorted(plain_groups(texts, 5, 3), key=str)


def test_simhash_odd_rows(frame, odd_rows):
    rows = [(i, t) for i, t, _ in odd_rows]
    assert groups(frame(odd_rows)) == sorted(plain_groups(rows), key=str)
    assert groups(frame([])) == []
    kept = simhash.keep_first(frame(odd_rows))
    assert kept.columns == frame([]).columns
    # Of the blank texts the smallest id stays; of the repeated row one.
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 5, 6]


@pytest.mark.parametrize("bucket_max", [0, 3, simhash.BUCKET_MAX])
def test_links_in_small_and_large_buckets(spark, monkeypatch, bucket_max):
    """A dense neighbourhood, so that the same components come from pairs and
    from meeting values."""
    monkeypatch.setattr(simhash, "BUCKET_MAX", bucket_max)
    rnd = random.Random(bucket_max)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rnd.randrange(5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    u = Union()
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2:
                u.join(a, b)
    got = components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint"))).collect()
    assert {r.node: r.component for r in got} == {x: u.find(x) for x in u.parent}


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=2))
def test_a_chain_starts_somewhere(x, flips):
    """The principle: within the budget, some start has all its prefixes within theirs."""
    y = x
    for f in flips:
        y ^= 1 << f
    width = 64 // simhash.SEGMENTS
    diff = [((x ^ y) >> (i * width) & ((1 << width) - 1)).bit_count() for i in range(simhash.SEGMENTS)]
    assert any(all(sum(diff[(s + k) % simhash.SEGMENTS] for k in range(n)) * simhash.SEGMENTS <= n * 2
                   for n in range(1, simhash.SEGMENTS + 1)) for s in range(simhash.SEGMENTS))


def shingles(line, k=line_dedup.SHINGLE):
    units = line.encode("utf-16-be")
    return {units[2 * i:2 * (i + k)] for i in range(max(len(units) // 2 - k + 1, 1))}


def plain_drops(rows, similarity=0.8):
    """{(doc_id, text): (lines, dropped)} by comparing all pairs of lines."""
    lines = defaultdict(list)
    for i, t in set(rows):
        h = xxhash.xxh64_intdigest(t.encode(), 42) if t is not None else 0
        h = h - (1 << 64) if h >> 63 else h
        for n, line in enumerate((t or "").split("\n")):
            if x := line.strip(line_dedup.EDGE_SPACE):
                lines[x].append((i is None, i or 0, h, n, (i, t)))
    u, every = Union(), sorted(lines)
    sets = {x: shingles(x) for x in every}
    for i, a in enumerate(every):
        u.find(a)
        for b in every[:i]:
            if len(sets[a] & sets[b]) * 10 >= 8 * len(sets[a] | sets[b]):
                u.join(a, b)
    groups, out = defaultdict(list), {}
    for x, places in lines.items():
        groups[u.find(x)] += places
    for places in groups.values():
        for p in sorted(places, key=lambda p: p[:4]):
            n, gone = out.get(p[4], (0, []))
            out[p[4]] = n + 1, gone + ([p[3]] if p[:4] != min(q[:4] for q in places) else [])
    return {k: (n, sorted(g)) for k, (n, g) in out.items()}


def check_lines(docs, rows):
    got = line_dedup.dropped_lines(docs).collect()
    want = plain_drops(rows)
    assert Counter((r.doc_id, r.n_lines, tuple(r.dropped)) for r in got) == Counter(
        (i, n, tuple(g)) for (i, _), (n, g) in want.items())
    kept = line_dedup.dedup_lines(docs).collect()
    left = Counter()
    for i, t in rows:
        n, gone = want.get((i, t), (0, []))
        if not gone:
            left[i, t] += 1
        elif len(gone) < n:
            left[i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)] += 1
    assert Counter((r.doc_id, r.text) for r in kept) == left
    assert all(r.n_chars == len(r.text) for r in kept if r.text is not None)


def test_fuzzy_lines_of_documents(documents, texts):
    check_lines(documents, texts)


def test_fuzzy_lines_odd_rows(frame, odd_rows):
    rnd = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    base = " ".join(rnd.choice(words) for _ in range(60))
    near = [base.replace("zeta", "ZETA", 1), base + " more", base[30:], "  " + base + "\t"]
    extra = [(20 + k, "\n".join([x, "", "own line number %d is here" % k, x]), "s") for k, x in enumerate(near)]
    rows = odd_rows + extra + [(30, base + "\n\nother", "s"), (31, "ü🙂" * 40, "s"), (32, "ü🙂" * 41, "s")]
    check_lines(frame(rows), [(i, t) for i, t, _ in rows])
    assert line_dedup.dropped_lines(frame([])).collect() == []
    assert line_dedup.dedup_lines(frame([])).columns == frame([]).columns


def test_chains_of_similar_lines_share_bands(spark, frame):
    """Each line is like the next, the ends are not: several leaders and the
    last round are needed, and nothing is lost."""
    rnd = random.Random(5)
    words = ["w%d" % rnd.randrange(10**6) for _ in range(140)]
    lines = [" ".join(words[k:k + 60]) for k in range(0, 80, 2)]
    rows = [(k, x, "s") for k, x in enumerate(lines)]
    check_lines(frame(rows), [(i, t) for i, t, _ in rows])


def test_line_dedup_is_native(spark, documents):
    plan = line_dedup.dedup_lines(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
