"""Secrets that are only partly, or unusually, encoded."""

import base64
import gzip
import random
import zlib

import pytest

from turnstile.llm import secret_scan

U = "\\" + "u"  # how a Unicode escape begins


def found(text):
    """The texts of the assignments among all spans."""
    return {text[a:b] for a, b, k in secret_scan.scan(text)[1] if k == 0}


@pytest.mark.parametrize("hidden", [
    f"password{U}003dhunter2hunter2",
    f"password{U}{{3d}}hunter2hunter2",
    "password\\x3dhunter2hunter2",
    f"password {U}003d 'hunter2hunter2",
    f"pass{U}0077ord=hunter2hunter2",
    f"password{U}0022:{U}0022hunter2hunter2",
])
def test_partly_unicode_escaped(hidden):
    assert hidden in found(f"né, {hidden}, end")
    assert hidden in found(f"{U}{{110000}} {hidden}" + "\\")


def test_unicode_and_url_escapes_together():
    hidden = f"password{U}003dhunter2%41bc"
    assert hidden in found(hidden)


@pytest.mark.parametrize("text, hidden", [
    ("x=%FF&password%3Dhunter2hunter2", "password%3Dhunter2hunter2"),
    ("caf%E9+password%3Dhunter2hunter2", "password%3Dhunter2hunter2"),
    ("%E9%70assword%3Dhunter2hunter2%E9", "%70assword%3Dhunter2hunter2"),
    ("password%3D'hunter2hunter2'", "password%3D'hunter2hunter2"),
    ('"password"%3A "hunter2hunter2"', 'password"%3A "hunter2hunter2'),
    ("password = %22hunter2hunter2%22", "password = %22hunter2hunter2"),
])
def test_partly_url_escaped(text, hidden):
    assert hidden in found(text)


SECRET = "password=hunter2hunter2"


def b64(data):
    return base64.b64encode(data).decode()


def wrap(run, width, end="\n"):
    return end.join(run[i:i + width] for i in range(0, len(run), width))


def whole(text, run):
    """Whether a secret is reported at the span of the run."""
    a = text.index(run)
    return (a, a + len(run), 0) in secret_scan.scan(text)[1]


@pytest.mark.parametrize("odd", ["\xa0", "\u3000", "\u200d", "\xad", "\ufeff", "\f", "\0"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_layers_with_unprintable_characters(odd, pack):
    run = b64(pack(f"é{odd} {SECRET} {odd}".encode()))
    assert whole(f"a {run} b", run)


@pytest.mark.parametrize("codec", ["utf-16", "utf-16-le", "utf-16-be", "latin-1"])
def test_layers_in_other_encodings(codec):
    run = b64(f"é {SECRET} é".encode(codec))
    assert whole(f"a {run} b", run)


NOISE = " ".join(f"{i * 7919 % 1000003}," for i in range(300))


@pytest.mark.parametrize("width", [19, 64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
@pytest.mark.parametrize("before, after", [
    ("", ""), ("key: ", "\n"), ("-----BEGIN-----\n", "\n-----END-----\n"), ("a\nlonglonglonglongword\n", "\nword\nend")])
def test_wrapped_base64(width, end, pack, before, after):
    run = wrap(b64(pack(f"{NOISE} {SECRET} {NOISE}".encode())), width, end)
    spans = secret_scan.scan(before + run + after)[1]
    assert any(k == 0 and a <= len(before) and b >= len(before) + len(run) for a, b, k in spans)


def test_secret_across_a_line_end():
    run = wrap(b64(f"{'x' * 50} {SECRET}".encode()), 76)
    assert whole(f"é\n{run}\n", run)


@pytest.mark.parametrize("data", [
    gzip.compress(b"one") + gzip.compress(SECRET.encode()),
    gzip.compress(b"one") + b"\0" * 9 + gzip.compress(SECRET.encode()) + b"\0\0",
    gzip.compress(f"{SECRET} {NOISE}".encode())[:-20],
])
def test_members_and_cut_gzip(data):
    run = b64(data)
    assert whole(f"a {run} b", run)


def noise(n):
    return b"".join(b"line %d, with text; " % (i % 1000) for i in range(n // 20 + 1))


@pytest.mark.parametrize("at", ["start", "middle", "end"])
def test_secrets_in_large_layers(at):
    size, n = secret_scan.INFLATE_MAX, {"start": 0, "middle": 1, "end": 2}[at]
    data = noise(n * size // 2 + 99) + SECRET.encode() + b", " + noise((2 - n) * size // 2 + 99)
    run = b64(gzip.compress(data + noise(200)))
    base, every, overflow = secret_scan.scan(f"é {run} .")
    assert base == [] and overflow == 1
    assert (2, 2 + len(run), 0) in every


@pytest.fixture
def small_blocks(monkeypatch):
    for name, n in {"CHUNK": 64, "BLOCK": 100, "INFLATE_MAX": 300, "RUN_MAX": 1600, "OVERLAP": 100}.items():
        monkeypatch.setattr(secret_scan, name, n)


def random_text(n):
    return "".join(random.Random(5).choices("abcdefghi ,\n", k=n))


HIDDEN = {
    "plain": SECRET.encode(),
    "run": b"0" * 5000 + b" " + SECRET.encode() + b" " + b"0" * 5000,
    "url": f"password%3Dhunter2hunter2{U}003d".encode(),
    "base64": b64(f"{random_text(3000)} {SECRET} {random_text(3000)}".encode()).encode(),
    "gzip": b64(gzip.compress(f"{random_text(9000)} {SECRET} {random_text(5000)}".encode())).encode(),
    "wrapped": wrap(b64(zlib.compress(f"{random_text(9000)} {SECRET}".encode())), 64).encode(),
    "word above": b"word\n" + wrap(b64(gzip.compress(f"{random_text(9000)} {SECRET}".encode())), 64).encode(),
    "utf-16": f"é {SECRET}".encode("utf-16"),
}


@pytest.mark.parametrize("hidden", HIDDEN)
@pytest.mark.parametrize("before", [0, 1, 96, 98, 99, 100, 555, 3000])
def test_blocks_lose_nothing(small_blocks, hidden, before):
    lead = noise(before)[:before // 2 * 2]
    for data in (lead + b"; " + HIDDEN[hidden] + b"; " + noise(700), HIDDEN[hidden]):
        run = b64(gzip.compress(data))
        base, every, overflow = secret_scan.scan(f"é {run} .")
        assert (2, 2 + len(run), 0) in every
    # The same without a cut in sight, and as text that isn't compressed.
    assert whole(f"a {b64(data)} b", b64(data))


@pytest.mark.parametrize("before", ["", "a", "ab", "abc", "abcd", "abcde", "abcdef", "abcdefg", "x/", "/ab/", "/abc/",
                                    "/abcd/", "data-", "https://h.example/a/", "k=v_w/", "a/b-c/d_"])
@pytest.mark.parametrize("packed", [lambda b: b, gzip.compress, zlib.compress])
def test_base64_behind_letters_of_base64(before, packed):
    """Compressed data is found behind letters, too, where its start can be told."""
    data = packed(f"{SECRET} and more".encode())
    if packed is zlib.compress and before and before[-1].isalnum():
        return  # zlib's two letters are too common to be looked for inside a word
    text = f"see {before}{b64(data)} there"
    spans = [(a, b) for a, b, kind in secret_scan.scan(text)[1] if kind == 0]
    end = len(text) - len(" there")
    assert spans and all(4 <= a <= 4 + len(before) + 3 and end - 2 <= b <= end for a, b in spans)


def test_form_encoding():
    text = "q=1&x=password+%3D+hunter2hunter2&y=2"
    spans = [text[a:b] for a, b, _ in secret_scan.scan(text)[1]]
    assert spans == ["password+%3D+hunter2hunter2"]
