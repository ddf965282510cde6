"""Token ids as the tokenizer files have them, special tokens included."""

import random
from array import array

import pytest
from llm.test_token_operators import FILES, PARTS, crc, orc_rows

from turnstile.llm import packing
from turnstile.llm.queries import tokenizer_path
from turnstile.llm.token_ids import TokenIds

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|><|endoftext|>\n\n y", "<|ENDOFTEXT|> <|end"]


def default_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name, keeps_space", FILES)
@pytest.mark.parametrize("remember", [20, 600_000])
def test_ids_equal_the_library_as_it_comes(name, keeps_space, remember):
    rnd = random.Random(9)
    parts = PARTS + ["<|endoftext|>", "<|startoftext|>"] * 4
    every = TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    got = TokenIds(tokenizer_path(name), keeps_space, remember, special=True).encode(every)
    assert [list(array("I", g)) for g in got] == default_ids(name, every)


def test_operators_keep_special_tokens(spark, frame):
    docs = frame([(i, t, "s") for i, t in enumerate(TEXTS)])
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json")).collect()
    assert {p.doc_id: p.ids for p in pieces} == {
        i: ids + [1] for i, ids in enumerate(default_ids("word_bpe_49k.json", TEXTS))}
    _, got = orc_rows(spark, docs)
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {
        i: (len(ids) + 1, crc(ids + [2])) for i, ids in enumerate(default_ids("byte_bpe_50k.json", TEXTS))}
