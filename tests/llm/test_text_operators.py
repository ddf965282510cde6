"""Quality rules, secrets, the line field and decontamination."""

import base64
import gzip
import hashlib
import itertools
import random
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnstile.llm import crf_quality, decontaminate, quality_rules, secret_scan
from turnstile.llm.common import lookup, table


# --- quality rules -----------------------------------------------------------

def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = [windows[w] > 1 for w in zip(words, words[1:], words[2:])]
    covered = {i + k for i, a in enumerate(again) if a for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 500 else None
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(lines))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c#", "é|", " ", "\n", "\t", "\xa0", "\x1c", "  ", "\r"]), max_size=60))
def test_measures(parts):
    text = "".join(p + " " if p.isalpha() else p for p in parts)
    assert quality_rules.measure_text(text) == plain_measures(text)


def test_measures_of_documents(texts):
    for _, t in texts:
        got, want = quality_rules.measure_text(t), plain_measures(t)
        assert [g for g, w in zip(got, want) if w is not None] == [w for w in want if w is not None]


def test_hosts_are_judged_by_shrunk_rates(frame):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, good, "fine") for i in range(60)] + [(100 + i, "bad", "awful") for i in range(40)]
    rows += [(200, good, "awful"), (201, "bad", "tiny"), (202, good, "tiny"), (203, good, None), (204, "x", None)]
    rows += [(300 + 3 * h + i, good, f"h{h}") for h in range(20) for i in range(3)]
    report = {r.doc_id: r for r in quality_rules.quality_report(frame(rows)).collect()}
    assert not report[200].base_failed and not report[200].kept  # its host is rejected
    assert report[202].kept and report[203].kept and not report[201].kept and not report[204].kept
    kept = quality_rules.keep_good(frame(rows))
    assert kept.columns == frame([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in report.items() if r.kept)


def test_quality_odd_rows(frame, odd_rows):
    got = quality_rules.quality_report(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in got if r.doc_id in (1, 2, 3))
    assert quality_rules.quality_report(frame([])).collect() == []
    assert quality_rules.keep_good(frame([])).collect() == []


def test_beta_prior():
    assert quality_rules.beta_prior(0, 0, 0, 0.0) == (0.0, quality_rules.PRIOR_MIN)
    mean, strength = quality_rules.beta_prior(1000, 10, 100, 1000 * 0.01)
    assert mean == 0.1 and strength == quality_rules.PRIOR_MAX  # hosts don't differ
    mean, strength = quality_rules.beta_prior(1000, 10, 500, 500.0)
    assert strength == quality_rules.PRIOR_MIN  # hosts are all or nothing


def test_lookup_of_hot_cold_and_null_keys(spark):
    left = spark.createDataFrame([("hot", i) for i in range(5000)] + [(f"k{i}", i) for i in range(300)]
                                 + [(None, i) for i in range(50)], "k string, x int")
    right = spark.createDataFrame([("hot", 5000, 1), *[(f"k{i}", 1, 2) for i in range(0, 300, 2)]],
                                  "k string, n bigint, y int")
    got = Counter((r.k, r.x, r.y) for r in lookup(left, right, "k", "n").collect())
    assert got == Counter([("hot", i, 1) for i in range(5000)]
                          + [(f"k{i}", i, 2 if i % 2 == 0 else None) for i in range(300)]
                          + [(None, i, None) for i in range(50)])
    assert lookup(left, right, "k", "n", how="inner").count() == 5150


# --- secrets -----------------------------------------------------------------

def plain_base(text):
    patterns = (secret_scan.ASSIGN.pattern, r"AKIA[A-Z0-9]+", r"[0-9a-f]+")
    spans = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text or "", re.A | re.I if kind == 0 else re.A):
            if (len(m[2]) >= 8) if kind == 0 else (m.end() - m.start() >= (16, 32)[kind - 1]):
                spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], s[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWD", "ſecret", "token", "api_key", "apikey", " ", "=", ": ", "\"",
                                 "abcdef12", "0123456789abcdef", "AKIA", "ABCDEFGHIJKL", "X", "é", "deadbeef", "\n"]),
                max_size=25))
def test_base_spans(parts):
    text = "".join(parts)
    assert secret_scan.scan(text)[0] == plain_base(text)


def test_base_spans_of_documents(documents, texts):
    want = {i: (plain_base(t), t) for i, t in texts}
    for r in secret_scan.secret_digests(documents).collect():
        spans = want[r.doc_id][0]
        kinds = Counter(k for _, _, k in spans)
        text = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, b, k in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds[0], kinds[1], kinds[2])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


SECRET = "password=hunter2hunter2"


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


LAYERS = {
    "url": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "base64": b64,
    "gzip": lambda s: b64(gzip.compress(s.encode())),
    "zlib": lambda s: b64(zlib.compress(s.encode())),
}


@pytest.mark.parametrize("names", [c for n in (1, 2, 3) for c in itertools.product(LAYERS, repeat=n)][:80])
def test_nested_layers_are_unwrapped(names):
    hidden = f"x {SECRET} y"
    for n in names:
        hidden = LAYERS[n](hidden)
    text = f"né {hidden} end"
    spans = secret_scan.scan(text)[1]
    assert any(k == 0 and 3 <= a < b <= 3 + len(hidden) for a, b, k in spans), names
    if names[-1] in ("base64", "gzip", "zlib"):
        assert (3, 3 + len(hidden), 0) in spans


def test_url_spans_point_into_the_run():
    text = "go to token%3Dabcdefgh%2541 now"
    base, every, _ = secret_scan.scan(text)
    assert base == []
    assert (6, 22, 0) in every and text[6:22] == "token%3Dabcdefgh"


def test_same_layer_twice_is_reported_twice():
    run = b64(f"x {SECRET} y")
    spans = secret_scan.scan(f"{run} and {run}")[1]
    assert [(a, b) for a, b, _ in spans] == [(0, len(run)), (len(run) + 5, 2 * len(run) + 5)]


def test_bombs_and_odd_texts(frame, odd_rows, monkeypatch):
    bomb = b64(zlib.compress(b"0" * (secret_scan.INFLATE_MAX + 5)))
    assert secret_scan.scan(f"a {bomb} {SECRET}")[2] == 1
    assert secret_scan.scan(None) == ([], [], 0) == secret_scan.scan("")
    for t in ("%zz%4", "\\u12", "====", b64(b"\x1f\x8b broken gzip data"), "%ff%fe" * 9, "\\u{110000}"):
        secret_scan.scan(t)
    got = secret_scan.secret_digests(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" for r in got if r.doc_id in (1, 2, 3))
    assert secret_scan.secret_digests(frame([])).collect() == []


def test_quoted_url_text():
    text = urllib.parse.quote(f"q={SECRET}&é", safe="")
    assert any(k == 0 for _, _, k in secret_scan.scan(text)[1])


# --- line field --------------------------------------------------------------

def brute_marginals(score, trans):
    n, weights = len(score), {}
    for y in itertools.product((0, 1), repeat=n):
        weights[y] = np.exp(sum(s for s, k in zip(score, y) if k) + sum(trans[a, b] for a, b in zip(y, y[1:])))
    total = sum(weights.values())
    return [sum(w for y, w in weights.items() if y[t]) / total for t in range(n)]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 5, 3, 8, 1])
    score, trans = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    p = crf_quality._sigmoid(np.add(*crf_quality.chain(score, sizes, trans)))
    at = 0
    for n in sizes:
        assert np.allclose(p[at:at + n], brute_marginals(score[at:at + n], trans))
        at += n


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    sizes, good = np.array([3, 1, 4]), np.array([1, 0, 1])
    x = rng.normal(size=(sizes.sum(), 4))
    weights, trans = rng.normal(size=4), rng.normal(size=(2, 2))

    def value(weights, trans):
        total, at = 0.0, 0
        for n, g in zip(sizes, good):
            s = x[at:at + n] @ weights
            z = sum(np.exp(sum(v for v, k in zip(s, y) if k) + sum(trans[a, b] for a, b in zip(y, y[1:])))
                    for y in itertools.product((0, 1), repeat=int(n)))
            total += (g * s.sum() + (n - 1) * trans[g, g] - np.log(z)) / (n * len(sizes))
            at += n
        return total

    by_weight, by_trans = crf_quality.gradient(x, sizes, good, weights, trans)
    e = 1e-6
    for i in range(4):
        step = e * np.eye(4)[i]
        assert np.isclose(by_weight[i], (value(weights + step, trans) - value(weights - step, trans)) / (2 * e), atol=1e-6)
    for i, j in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[i, j] = e
        assert np.isclose(by_trans[i, j], (value(weights, trans + step) - value(weights, trans - step)) / (2 * e), atol=1e-6)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = table(spark, d, "labels")
    got = crf_quality.quality(table(spark, d, "documents"), labels)
    rows = got.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)


def test_field_odd_rows(spark, frame, odd_rows):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (None, 1, 0), (4, None, 0), (4, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = crf_quality.quality(frame(odd_rows), labels).collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r.score <= 1 for r in got)
    none = labels.where("false")
    assert {r.score for r in crf_quality.quality(frame(odd_rows), none).collect()} == {0.5}
    assert crf_quality.quality(frame([]), labels).collect() == []


# --- decontamination ---------------------------------------------------------

def plain_contained(docs, items, share=0.8):
    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}, b" ".join(w)
    first = {}
    for i, t in items:
        s, norm = shingles(t)
        if s and (norm not in first or (i is not None and i < first[norm][0])):
            first[norm] = i, s
    out = set()
    for d, t in set(docs):
        have = shingles(t)[0]
        out |= {(d, i, len(s), len(s & have)) for i, s in first.values() if 10 * len(s & have) >= 8 * len(s)}
    return out


def contained(docs, items):
    return {(r.doc_id, r.item_id, r.n_shingles, r.n_found)
            for r in decontaminate.contaminated(docs, items).collect()}


def test_containment_in_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = plain_contained(rows, wanted)
    assert contained(docs, items) == want and want
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {w[0] for w in want}


def test_short_items_in_long_documents(spark, frame):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(7))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([4, 5, 6, 9, 20, 21, 35, 70, 133, 400])]
    docs = []
    for k, (_, t) in enumerate(items):
        w = t.split()
        for copy in range(6):  # whole, and with a word changed towards the end
            if copy % 2 and len(w) > 60:
                w = w[:-3] + [word()] + w[-2:]
            body = [word() for _ in range(rnd.randrange(3000))]
            at = rnd.randrange(len(body) + 1)
            docs.append((100 * k + copy, " ".join(body[:at] + w + body[at:]).upper(), "s"))
    clean = [(9000 + k, " ".join(word() for _ in range(500)), "s") for k in range(20)]
    got = contained(frame(docs + clean), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == plain_contained([(i, t) for i, t, _ in docs + clean], items)
    assert {g[0] for g in got} == {i for i, _, _ in docs if i >= 100}


def test_containment_odd_rows(spark, frame, odd_rows):
    items = [(7, "same row same row same row same row"), (8, "Same  row same row same row same\nrow"),
             (None, "null id text null id text"), (9, None), (10, ""), (11, "one")]
    its = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id bigint, text string, text_hash int")
    rows = [(i, t) for i, t, _ in odd_rows]
    assert contained(frame(odd_rows), its) == plain_contained(rows, items)
    assert contained(frame([]), its) == set()
    assert contained(frame(odd_rows), its.where("false")) == set()
    kept = decontaminate.keep_clean(frame(odd_rows), its).collect()
    assert len(kept) == len(odd_rows) - 3  # the two equal rows and the null id


def test_training_takes_whole_texts(spark):
    """What tells the labels apart stands after thousands of lines."""
    from turnstile.llm import crf_quality

    plain = "an ordinary line of ordinary words.\n" * 600
    docs = spark.createDataFrame([(i, plain + ("#### $$$$ ||||\n" * 600 if i % 2 else plain)) for i in (1, 3, 4, 6)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in (1, 3, 4, 6)], "doc_id bigint, quality int")
    field = crf_quality.train(docs, labels)
    if field.constant is None:
        good, bad = field.scores(["an ordinary line of ordinary words.\n" * 50, "#### $$$$ ||||\n" * 50])
        assert good > bad
