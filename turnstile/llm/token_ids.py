"""Token ids by the tokenizers library, for texts that arrive in batches.

The public byte-level tokenizers cut a text into pieces first and encode every
piece for itself.  So a text may be cut at places where the tokenizer is sure
to cut as well, and each different chunk is encoded once and remembered.  The
result equals ``Tokenizer.encode(text, add_special_tokens=False).ids`` on the
whole text; the tests compare the two.  With ``special`` the tokenizer is as its
file has it: the strings of its special tokens get their own ids, and the texts
between them are cut.  Without, ``encode_special_tokens`` is set: they are
ordinary text.
"""

from __future__ import annotations

import gc
import os
import re
from array import array

# Unicode white space; Latin letters that keep one code point in
# NFC and lower case; ASCII punctuation without the apostrophe (contractions).
SPACE = "\t-\r \x85\xa0  -     　"
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCT = re.escape('!"#$%&()*+,-./:;<=>?@[]^_`{|}~')

# One alternative each for: a whole run of letters, a whole run of punctuation
# (both single pieces), any other run without white space, white space as the
# byte-level pattern cuts it.
WITH_SPACE = re.compile(
    f" ?[{LETTER}]++(?=[{SPACE}{PUNCT}]|$)| ?[{PUNCT}]++(?=[{SPACE}{LETTER}]|$)"
    f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WITHOUT_SPACE = re.compile(
    f"[{LETTER}]++(?=[{SPACE}{PUNCT}]|$)|[{PUNCT}]++(?=[{SPACE}{LETTER}]|$)|[^{SPACE}]+")
SINGLE = re.compile(f" ?(?:[{LETTER}]+|[{PUNCT}]+)")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE: itself where it
    is printable Latin-1, else the next code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(extra)) for b in range(256)]


class TokenIds:
    """Encoder for one tokenizer file.  ``keeps_space``: white space is part of
    the pieces (byte-level); else it is dropped and letters are lower-cased.
    At most ``remember`` chunks are kept in memory."""

    def __init__(self, path: str, keeps_space: bool, remember: int = 600_000, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder() if special else {}
        for t in added.values():
            if not t.special or t.normalized or t.single_word or t.lstrip or t.rstrip:
                raise ValueError(f"{path}: the flags of {t.content!r} aren't handled")
        # The ids of special tokens stand for themselves among the chunks.
        self.own = {t.content: i.to_bytes(4, "little") for i, t in added.items()}
        longest_first = sorted(map(re.escape, self.own), key=len, reverse=True)
        self.at_own = re.compile(f"({'|'.join(longest_first)})").split
        # None of their strings is left in a chunk.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.cut = WITH_SPACE.findall if keeps_space else (
            lambda text: WITHOUT_SPACE.findall(text.lower() if text.isascii() else text))
        self.lower = not keeps_space
        self.letters = dict(enumerate(_byte_letters()))
        self.known: dict[str | bytes, bytes] = {}
        self._forget()
        self.remember = remember

    def _forget(self) -> None:
        self.known.clear()
        self.known.update((i, i) for i in self.own.values())

    def _chunks(self, text: str) -> list[str | bytes]:
        if not any(s in text for s in self.own):
            return self.cut(text)
        out = []
        for k, part in enumerate(self.at_own(text)):
            out += [self.own[part]] if k % 2 else self.cut(part)
        return out

    def _learn(self, chunks: list[str]) -> None:
        known, letters, tokenize = self.known, self.letters, self.model.tokenize
        rest = []
        for c in chunks:
            if SINGLE.fullmatch(c):
                plain = c.lower() if self.lower else c
                piece = plain.encode().decode("latin-1").translate(letters)
                known[c] = array("I", [t.id for t in tokenize(piece)]).tobytes()
            else:
                rest.append(c)
        for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            known[c] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers; a null
        or empty text has none."""
        on = gc.isenabled()
        gc.disable()  # nothing here makes cycles
        try:
            out, known = [], self.known
            for t in texts:
                chunks = self._chunks(t) if t else []
                new = set(chunks).difference(known)
                if new:
                    if len(known) + len(new) > self.remember:
                        self._forget()
                        new = set(chunks).difference(known)
                    self._learn(list(new))
                out.append(b"".join(map(known.__getitem__, chunks)))
            return out
        finally:
            if on:
                gc.enable()


_ENCODERS: dict[tuple[str, bool, bool], TokenIds] = {}


def encoder(path: str, keeps_space: bool, special: bool = False) -> TokenIds:
    """One encoder per Python worker, kept between batches and tasks."""
    key = (path, keeps_space, special)
    if key not in _ENCODERS:
        _ENCODERS[key] = TokenIds(path, keeps_space, special=special)
    return _ENCODERS[key]
