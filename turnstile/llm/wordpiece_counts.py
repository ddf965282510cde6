"""Operator 2: word-piece counts by a linear longest-match automaton.

Greedy word-piece cutting takes, again and again, the longest vocabulary entry
that the rest of a word starts with.  The automaton (Song et al., "Fast
WordPiece Tokenization", 2021) does it in one pass: a trie of the vocabulary
where each node also has a failure link, to the node that stands for what is
left once the pieces that are sure by then are taken off, and the number of
those pieces.  Counting needs no piece to be built.

The vocabulary is that of a SentencePiece model: an entry that starts with
``START`` begins a word, the others continue one.  A word that can't be cut
counts as one unknown token.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: a null or empty text has no
words; ``START`` inside a word matches no entry; very long words take linear
time; repeated rows are counted alike; null ids are kept; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import require

START = "▁"
ROOT = 0
NONE = -1
# Longer words are counted each time and not remembered.
REMEMBER_CHARS, REMEMBER_WORDS = 64, 500_000
UNKNOWN = 1 << 40  # added to the count of an unknown word


class Automaton:
    def __init__(self, pieces: Iterable[str]):
        self.step: list[dict[str, int]] = [{}]
        ends = set()
        for piece in pieces:
            node = ROOT
            for c in piece:
                nxt = self.step[node].get(c)
                if nxt is None:
                    nxt = len(self.step)
                    self.step[node][c] = nxt
                    self.step.append({})
                node = nxt
            if node != ROOT:
                ends.add(node)
        self.fail = [NONE] * len(self.step)
        self.popped = [0] * len(self.step)
        self._link(ends)
        # A word starts behind START; continuing entries never hold it.
        self.start = self.step[ROOT].pop(START, NONE)

    def _link(self, ends: set[int]) -> None:
        """Failure links and popped counts, shorter strings first."""
        step, fail, popped = self.step, self.fail, self.popped
        queue = deque([ROOT])
        while queue:
            u = queue.popleft()
            for c, v in step[u].items():
                queue.append(v)
                if v in ends:
                    fail[v], popped[v] = ROOT, 1
                    continue
                z, n = fail[u], popped[u]
                # What is left of a string never starts a word.
                while z != NONE and (c == START or c not in step[z]):
                    n += popped[z]
                    z = fail[z]
                if z != NONE:
                    fail[v], popped[v] = step[z][c], n

    def count(self, word: str) -> int:
        """The number of pieces of one word; 0 if it can't be cut."""
        step, fail, popped = self.step, self.fail, self.popped
        u, n = self.start, 0
        if u == NONE:
            return 0
        for c in word:
            while c not in step[u]:
                n += popped[u]
                u = fail[u]
                if u == NONE:
                    return 0
            u = step[u][c]
        while u != ROOT:
            n += popped[u]
            u = fail[u]
            if u == NONE:
                return 0
        return n


def load_pieces(path: str) -> list[str]:
    """The ordinary entries of a SentencePiece model."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


_AUTOMATA: dict[str, tuple[Automaton, dict[bytes, int]]] = {}


def _automaton(path: str) -> tuple[Automaton, dict[bytes, int]]:
    """One automaton per Python worker, with the words it has counted."""
    if path not in _AUTOMATA:
        _AUTOMATA[path] = Automaton(load_pieces(path)), {}
    return _AUTOMATA[path]


def count_text(text: str | None, automaton: Automaton, known: dict[bytes, int]) -> tuple[int, int, int]:
    """(words, tokens, unknown words) of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    new = set(words).difference(known)
    extra = {}
    if len(known) + len(new) > REMEMBER_WORDS:
        known.clear()
        new = set(words)
    for w in new:
        n = automaton.count(w.decode("utf-8", "surrogatepass")) or UNKNOWN + 1
        if len(w) <= REMEMBER_CHARS:
            known[w] = n
        else:
            extra[w] = n
    look = known if not extra else known | extra
    total = sum(map(look.__getitem__, words))
    return len(words), total % UNKNOWN, total // UNKNOWN


def wordpiece_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every document; narrow."""
    require(docs, ["doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _automaton(vocabulary)
        for batch in batches:
            counts = [count_text(t.as_py(), automaton, known) for t in batch.column(1)]
            columns = zip(*counts) if counts else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), pa.int64()) for c in columns]],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
