"""Token ids, packing, ORC and word-piece counts against plain versions."""

import random
import zlib
from array import array
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.llm import packing, token_orc, wordpiece_counts
from turnstile.llm.common import shared_path
from turnstile.llm.queries import tokenizer_path
from turnstile.llm.token_ids import encoder

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
PARTS = list("ab'sSét  \n\t.,!0²ⅣÿİḰ\xa0　\x1c中文ſ🙂é") + ["<|endoftext|>", "'ll", "  ", "<|startoftext|>"]


def plain_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name, keeps_space", FILES)
def test_ids_equal_the_library_on_whole_texts(name, keeps_space, texts):
    rnd = random.Random(3)
    odd = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(50))) for _ in range(4000)]
    every = [t for _, t in texts] + odd + [None, ""]
    got = encoder(tokenizer_path(name), keeps_space).encode(every)
    assert [list(array("I", g)) for g in got] == plain_ids(name, every)


@pytest.mark.parametrize("name, keeps_space", FILES)
@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_ids_equal_the_library_on_any_text(name, keeps_space, text):
    got = encoder(tokenizer_path(name), keeps_space).encode([text])
    assert list(array("I", got[0])) == plain_ids(name, [text])[0]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def check_packing(docs, rows, window):
    pieces = [r.asDict() for r in packing.pack(docs, tokenizer_path("word_bpe_49k.json"), window=window).collect()]
    want = defaultdict(list)
    for (i, _), ids in zip(rows, plain_ids("word_bpe_49k.json", [t for _, t in rows])):
        want[i].append(ids + [1])
    by_seq = defaultdict(list)
    by_doc = defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) > 0 and p["ids_crc32"] == crc(p["ids"])
        by_seq[p["sequence_id"]].append(p)
        by_doc[p["doc_id"]].append(p)
    last = max(by_seq, default=0)
    assert sorted(by_seq) == list(range(last + 1)) if by_seq else not rows
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or (s == last and 0 < at <= window)
    assert set(by_doc) == set(want)
    for i, ps in by_doc.items():
        if len(want[i]) == 1:
            assert sum((p["ids"] for p in sorted(ps, key=lambda p: p["start"])), []) == want[i][0]
        assert sum(p["length"] for p in ps) == sum(map(len, want[i]))


def test_packing_covers_every_id_once(documents, texts):
    check_packing(documents, texts, 2048)
    check_packing(documents.repartition(5), texts, 100)


def test_packing_odd_rows(frame, odd_rows):
    check_packing(frame(odd_rows).repartition(3), [(i, t) for i, t, _ in odd_rows], 512)
    check_packing(frame([]), [], 512)


def orc_rows(spark, docs):
    path = shared_path(spark, "test-orc")
    token_orc.write_token_orc(docs, path, tokenizer_path("byte_bpe_50k.json"))
    return path, token_orc.checksums(token_orc.read_token_orc(spark, path)).collect()


def test_orc_round_trip(spark, documents, texts):
    path, got = orc_rows(spark, documents)
    at, want = 0, []
    rows = sorted(texts)
    for (i, _), ids in zip(rows, plain_ids("byte_bpe_50k.json", [t for _, t in rows])):
        want.append((i, at, len(ids) + 1, crc(ids + [2])))
        at += len(ids) + 1
    assert sorted(map(tuple, got)) == want
    one = token_orc.read_token_orc(spark, path).where("doc_id = 17")
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)" in plan or "EqualTo(doc_id,17)" in plan
    assert one.count() == 1


def test_orc_files_have_bloom_filters_and_order(spark, documents):
    from pyarrow import orc

    path, _ = orc_rows(spark, documents.repartition(6))
    files = sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").collect())
    last = -1
    for f in files:
        t = orc.ORCFile(f.removeprefix("file:"))
        ids = t.read(columns=["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
        assert t.row_index_stride == token_orc.ROW_INDEX_STRIDE


def test_orc_odd_rows(spark, frame, odd_rows):
    _, got = orc_rows(spark, frame(odd_rows))
    rows = [(i, t) for i, t, _ in odd_rows]
    want = sorted((len(ids) + 1, crc(ids + [2])) for ids in plain_ids("byte_bpe_50k.json", [t for _, t in rows]))
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert orc_rows(spark, frame([]))[1] == []


def greedy(word, starting, continuing):
    """Longest entry first, piece by piece; None if it can't be cut."""
    at, n, entries = 0, 0, starting
    text = wordpiece_counts.START + word
    while at < len(text):
        end = next((e for e in range(len(text), at, -1) if text[at:e] in entries), None)
        if end is None:
            return None
        at, n, entries = end, n + 1, continuing
    return n


def split_vocabulary(pieces):
    s = wordpiece_counts.START
    return ({p for p in pieces if p.startswith(s)}, {p for p in pieces if s not in p})


def test_automaton_equals_greedy_cutting_on_documents(documents, texts):
    path = tokenizer_path("piece_bpe_32k.model")
    starting, continuing = split_vocabulary(wordpiece_counts.load_pieces(path))
    memo, want = {}, {}
    for i, t in texts:
        words = (t or "").encode().split()
        for w in set(words) - set(memo):
            memo[w] = greedy(w.decode(), starting, continuing)
        cut = [memo[w] for w in words]
        want[i] = (len(words), sum(c or 1 for c in cut), sum(c is None for c in cut))
    got = wordpiece_counts.wordpiece_counts(documents, path).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


@settings(max_examples=300, deadline=None)
@given(pieces=st.sets(st.text("ab", min_size=1, max_size=5), max_size=12),
       starts=st.sets(st.text("ab", max_size=4), max_size=6),
       words=st.lists(st.text("abc" + wordpiece_counts.START, min_size=1, max_size=12), max_size=20))
def test_automaton_equals_greedy_cutting(pieces, starts, words):
    vocabulary = pieces | {wordpiece_counts.START + s for s in starts}
    automaton = wordpiece_counts.Automaton(sorted(vocabulary))
    starting, continuing = split_vocabulary(vocabulary)
    for w in words:
        assert automaton.count(w) == (greedy(w, starting, continuing) or 0), w


def test_wordpiece_odd_rows(frame, odd_rows):
    path = tokenizer_path("piece_bpe_32k.model")
    got = wordpiece_counts.wordpiece_counts(frame(odd_rows), path).collect()
    assert len(got) == len(odd_rows)
    assert {tuple(r)[1:] for r in got if r.doc_id in (1, 2, 3)} == {(0, 0, 0)}
    assert next(r.n_words for r in got if r.doc_id == 4) == 60_000
    assert wordpiece_counts.wordpiece_counts(frame([]), path).collect() == []
    word = frame([(1, "a" * 300_000, "s")])
    assert wordpiece_counts.wordpiece_counts(word, path).first().n_words == 1


def test_part_offsets_are_prefix_sums(spark):
    from turnstile.llm.token_tables import part_offsets

    t = spark.createDataFrame([(0, 5), (2, 7), (0, 1), (9, 4)], "part int, n_tokens bigint")
    assert {tuple(r) for r in part_offsets(t).collect()} == {(0, 0), (2, 6), (9, 13)}
    assert part_offsets(t.where(F.lit(False))).count() == 0
