"""Operator 7: secrets, also in encoded layers.

A worklist starts with the text itself.  Each layer is scanned for secrets, and
its encoded runs (URL escapes, Unicode escapes, base64, and base64 of gzip or
zlib data) are decoded into new layers until none is left.  A layer with the
text and the origin of an earlier one isn't opened again, so cycles end.  Every layer carries,
per character, the span of the original text it came from; a secret found in a
layer is reported at the original span of the run that hid it.

Spans are in code points, end exclusive.  Defined cases: a null or empty text
has no spans; repeated rows are scanned alike; nothing depends on other rows; an
empty table gives an empty result; other columns are ignored; a very long text is
scanned whole.  Decoded data over
INFLATE_MAX bytes is scanned and unwrapped block by block, in bounded memory;
``overflow`` counts such runs, whose cost is out of proportion.
"""

from __future__ import annotations

import base64
import codecs
import re
import string
import zlib
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from turnstile.llm.common import require

# The patterns of secrets, and their kinds in order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # maximal runs of 16 or more
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_VALUE_MIN = 8
# Each word of ASSIGN has one of these in it.
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")

# All that secrets, escapes and encoded runs consist of.  No match crosses
# another character, so escapes are decoded in place in maximal runs of these.
RUN_CHARS = string.ascii_letters + string.digits + "+/_.=:\"'%\\{}- \t\r\n"
RUN = re.compile(f"[{re.escape(RUN_CHARS)}]+")
URL_BYTE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
FORM_PART = re.compile(r"\+|(?:%[0-9A-Fa-f]{2})+")
UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})")
BASE64_MIN = 16
BASE64_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{BASE64_MIN},}}={{0,2}}")
BASE64_MORE = re.compile(r"(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
BASE64_SEPARATOR = re.compile(r"[/+_-]")
# What gzip and zlib data begin with in base64.
GZIP_LETTERS, ZLIB_LETTERS = re.compile("H4sI"), ("eA", "eF", "eJ", "eN")
GZIP, ZLIB = b"\x1f\x8b", (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
BASE64_CHARS = string.ascii_letters + string.digits + "+/_-\r\n"
BASE64_WRAPPED = re.compile(r"[A-Za-z0-9+/_\r\n-]*")
# Memory: CHUNK bytes are inflated at a time into blocks of BLOCK; data up to
# INFLATE_MAX is kept between its readings, longer data is inflated again.
CHUNK, BLOCK = 1 << 16, 1 << 20
INFLATE_MAX = RUN_MAX = 16 << 20
OVERLAP = 1 << 16


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the secrets of one layer."""
    out = []
    if not text:
        return out
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text)
                if len(m[2]) >= ASSIGN_VALUE_MIN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return out


def _inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Decompressed gzip or zlib data, of all members and as far as it goes, in
    blocks of at most BLOCK bytes; nothing if it is neither."""
    unpack, rest = None, b""
    for chunk in chunks:
        for at in range(0, len(chunk), CHUNK):
            rest += chunk[at:at + CHUNK]
            while rest:
                if unpack is None:
                    if len(rest) < 2:
                        break
                    if not rest.startswith((GZIP, *ZLIB)):
                        return
                    unpack = zlib.decompressobj(wbits=47)
                try:
                    out = unpack.decompress(rest, BLOCK)
                    while out:
                        yield out
                        out = unpack.decompress(unpack.unconsumed_tail, BLOCK)
                except zlib.error:
                    return
                rest = b""
                if unpack.eof:
                    rest, unpack = unpack.unused_data.lstrip(b"\0"), None


def _decoded(blocks: Iterator[bytes], codec: str) -> Iterator[str]:
    """What isn't text becomes replacement characters and hides nothing."""
    decoder = codecs.getincrementaldecoder(codec)("replace")
    for block in blocks:
        yield decoder.decode(block)
    yield decoder.decode(b"", True)


def _run_bytes(parts: Iterator[str], start: int) -> Iterator[bytes]:
    """The data of the base64 run, wrapped or not, at ``start`` of a text."""
    rest = ""
    for part in parts:
        if start >= len(part):
            start -= len(part)
            continue
        m = BASE64_WRAPPED.match(part, start)
        body = rest + "".join(m[0].split())
        cut = len(body) // 4 * 4
        yield _unbase64(body[:cut])
        start, rest = 0, body[cut:]
        if m.end() < len(part):
            break
    yield _unbase64(rest)


def _unbase64(run: str) -> bytes:
    body = "".join(run.split()).rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:
        body = body[:-1]
    return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)


def _alignments(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Where base64 may begin in a run of its letters, since letters of something
    else may stand before it: of each of the four ways to group letters by four,
    the first place behind a separator that is grouped so, or else the first place
    at all (what stands before the data becomes noise); and where compressed data
    seems to begin, which can't be read from anywhere else."""
    begins = {0: start}
    places = [m.end() for m in BASE64_SEPARATOR.finditer(text, start, end - BASE64_MIN)]
    for at in [*places, *range(start, start + 4)]:
        begins.setdefault((at - start) % 4, at)
    packed = {m.start() for m in GZIP_LETTERS.finditer(text, start, end)}
    packed |= {at for at in places if text[at:at + 2] in ZLIB_LETTERS}
    yield from ((at, end) for at in sorted({*begins.values(), *packed}) if end - at >= BASE64_MIN)


def _base64_runs(text: str) -> Iterator[tuple[int, int]]:
    """Spans that may be base64: runs within a line, and runs wrapped over
    lines.  A wrapped run is a block of lines of equal length, the next line
    (its short end) and maybe the line before (begun behind a name)."""
    joined = 0
    for m in BASE64_RUN.finditer(text):
        yield from _alignments(text, *m.span())
        more = BASE64_MORE.match(text, m.end()) if m.start() >= joined and m[0][-1] != "=" else None
        if more is None:
            continue
        joined = more.end()
        lines = [m.span()] + [p.span() for p in BASE64_LINE.finditer(text, m.end(), joined)]
        spans, i = {(m.start(), joined)}, 0
        while i < len(lines):
            j, size = i + 1, lines[i][1] - lines[i][0]
            while j < len(lines) and lines[j][1] - lines[j][0] == size:
                j += 1
            if size >= BASE64_MIN and j - i < len(lines):
                end = lines[min(j, len(lines) - 1)][1]
                spans |= {(lines[i][0], end), (lines[max(i - 1, 0)][0], end)}
            i = j
        yield from sorted(spans)


class Layer:
    """A text and, per character, the span of the original it stands for.
    ``spans`` None: the original itself; a tuple: all stand for that span."""

    def __init__(self, text: str, spans: list[tuple[int, int]] | tuple[int, int] | None):
        self.text, self.spans = text, spans

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.spans is None:
            return start, end
        if isinstance(self.spans, tuple):
            return self.spans
        return self.spans[start][0], self.spans[end - 1][1]  # they are in order


class Stream:
    """Decoded data as layers that all stand for the span ``whole``, made one
    by one.  ``chunks()`` gives the data anew, from its start.

    Long text is cut where no match crosses.  A run without such a place is
    cut at RUN_MAX, with an overlap that holds any secret but one with more
    spaces in it; base64 that is open there is a stream of its own."""

    def __init__(self, chunks: Callable[[], Iterator[bytes]], whole: tuple[int, int]):
        self.whole, self.large, self.scoped = whole, False, False
        self.items = self._items(chunks)

    def _items(self, chunks: Callable[[], Iterator[bytes]]) -> Iterator[Layer | Stream]:
        # The data as it stands, too: plain text may begin like zlib data.
        for source in (lambda: _inflated(chunks()), chunks):
            head, size = [], 0
            for block in source():
                head.append(block)
                size += len(block)
                if size > INFLATE_MAX:
                    self.large = True
                    break
            else:
                data = b"".join(head)
                source = lambda data=data: iter([data])
            # ASCII in UTF-16 has zero bytes.
            both = size > INFLATE_MAX or any(b"\0" in block for block in head)
            del head
            for codec in ("utf-8", "utf-16-le", "utf-16-be") if both else ("utf-8",):
                yield from self._pieces(lambda codec=codec, source=source: _decoded(source(), codec))

    def _pieces(self, parts: Callable[[], Iterator[str]]) -> Iterator[Layer | Stream]:
        held, before, enough, goes_on = "", 0, BLOCK, False
        for part in parts():
            if len(held) >= enough:
                cut = len(held.rstrip(RUN_CHARS))
                if cut:
                    yield Layer(held[:cut], self.whole)
                    goes_on = False
                elif len(held) >= RUN_MAX:
                    yield Layer(held, self.whole)
                    cut = len(held) - OVERLAP
                    at = len(held.rstrip(BASE64_CHARS))
                    if at < cut and not (goes_on and at == 0):
                        # Also from the next line: the first may be a word.
                        for start in {at, held.find("\n", at) + 1 or at}:
                            yield Stream(lambda start=before + start: _run_bytes(parts(), start), self.whole)
                    goes_on = at < cut
                enough = BLOCK if cut else 2 * enough
                held, before = held[cut:], before + cut
            held += part
        if held:
            yield Layer(held, self.whole)


def _in_place(layer: Layer, start: int, end: int,
              escapes: Iterator[tuple[int, int, str]]) -> Layer | None:
    """The run with its ``escapes`` (start, end, decoded) replaced; all else
    keeps its place.  None if there are none."""
    text, spans, at = [], [], start
    for a, b, c in escapes:
        text += layer.text[at:a], c
        spans += [layer.origin(i, i + 1) for i in range(at, a)]
        spans.append(layer.origin(a, b))
        at = b
    if not text:
        return None
    text.append(layer.text[at:end])
    if isinstance(layer.spans, tuple):
        return Layer("".join(text), layer.spans)
    spans += [layer.origin(i, i + 1) for i in range(at, end)]
    return Layer("".join(text), spans)


def _url_escapes(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Bytes that aren't UTF-8 become replacement characters."""
    for e in URL_BYTE.finditer(text, start, end):
        place = e.start()
        for c in bytes.fromhex(e[0].replace("%", "")).decode("utf-8", "surrogateescape"):
            lost = "\udc80" <= c <= "\udcff"
            after = place + (3 if lost else 3 * len(c.encode("utf-8")))
            yield place, after, "\ufffd" if lost else c
            place = after


def _unicode_escapes(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    for e in UNICODE_ONE.finditer(text, start, end):
        code = int(e[1] or e[2] or e[3], 16)
        if code <= 0x10FFFF:  # others stay as they stand
            yield e.start(), e.end(), chr(code)


def _form_escapes(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """As in a form: ``+`` is a space, too."""
    for e in FORM_PART.finditer(text, start, end):
        if e[0] == "+":
            yield *e.span(), " "
        else:
            yield from _url_escapes(text, *e.span())


# The signs that a run must have for a way to decode it in place.
ESCAPES = (("%", _url_escapes), ("\\", _unicode_escapes), ("%+", _form_escapes))


def _mark(text: str) -> str | bytes:
    return text if len(text) < CHUNK else blake2b(text.encode("utf-8", "surrogatepass")).digest()


def scan(text: str | None) -> tuple[list, list, int]:
    """(base spans, all spans, overflows): lists of (start, end, kind) in order
    of start, kind, end, and the number of runs over INFLATE_MAX bytes."""
    text = text or ""
    base = sorted(find(text), key=lambda s: (s[0], s[2], s[1]))
    every, overflow = set(), 0
    # What was opened, in all and within the current block of each large
    # stream: memory doesn't grow with a stream's length.
    seen: list[set] = [set()]

    def new(kind: str, text: str, whole: tuple[int, int]) -> bool:
        mark = (kind, _mark(text), *whole)
        if any(mark in s for s in seen):
            return False
        seen[-1].add(mark)
        return True

    work: list[Layer | Stream] = [Layer(text, None)]
    while work:
        layer = work.pop()
        if isinstance(layer, Stream):
            stream = layer
            if stream.scoped:
                seen.pop()
            layer = next(stream.items, None)
            if layer is None:
                overflow += stream.large
                continue
            stream.scoped = stream.large
            if stream.scoped:
                seen.append(set())
            work += stream, layer
            continue
        if not layer.text or not new("layer", layer.text, layer.origin(0, len(layer.text))):
            continue
        every.update((*layer.origin(a, b), kind) for a, b, kind in find(layer.text))
        for signs, escapes in ESCAPES:
            if all(sign in layer.text for sign in signs):
                for m in RUN.finditer(layer.text):
                    if all(sign in m[0] for sign in signs):
                        decoded = _in_place(layer, *m.span(), escapes(layer.text, *m.span()))
                        if decoded is not None:
                            work.append(decoded)
        for a, b in _base64_runs(layer.text):
            run, whole = layer.text[a:b], layer.origin(a, b)
            if new("run", run, whole):
                data = _unbase64(run)
                work.append(Stream(lambda data=data: iter([data]), whole))
    return base, sorted(every, key=lambda s: (s[0], s[2], s[1])), overflow


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


RESULT = StructType([StructField(f"n_{k}", LongType()) for k in KINDS]
                    + [StructField(n, StringType()) for n in ("base", "spans")]
                    + [StructField("overflow", LongType())])


@F.pandas_udf(RESULT)
def scanned(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        base, every, overflow = scan(t)
        kinds = [k for _, _, k in base]
        rows.append((*map(kinds.count, range(len(KINDS))), digest(base), digest(every), overflow))
    return pd.DataFrame(rows, columns=RESULT.names)


def secrets(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """Per document: the counts of base spans by kind, the base spans and all
    spans as ``kind:start:end`` joined by commas, and ``overflow``."""
    require(docs, ["doc_id", "text"])
    found = docs.select("doc_id", scanned(F.col("text") if text is None else text).alias("s"))
    return found.select("doc_id", "s.*")


def secret_digests(docs: DataFrame) -> DataFrame:
    return secrets(docs).select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base"), 256).alias("base_sha256"),
        "spans", "overflow")

