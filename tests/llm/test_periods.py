"""Runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairn.llm import periods

SCHEMA = "doc_id bigint, text string, runs int, body string"


def brute(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, n_, q) for (s, n_), q in out.items())


def fibonacci(n: int) -> list[int]:
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def periodic(rnd: random.Random) -> list[int]:
    """Texts rich in runs: few symbols, powers, Fibonacci and Thue-Morse words, progressions that touch."""
    kind, n = rnd.randrange(7), rnd.randrange(0, 160)
    if kind < 2:
        return [rnd.randrange(2 + kind) for _ in range(n)]
    if kind == 2:
        return fibonacci(n + 1)
    if kind == 3:
        return [bin(i).count("1") % 2 for i in range(n)]
    if kind == 4:
        d = [rnd.randrange(2) for _ in range(rnd.randrange(1, 6))] * 40
        return (d[: rnd.randrange(4, 60)] + d[rnd.randrange(3) :][: rnd.randrange(4, 60)]) * rnd.randrange(1, 4)
    b = [rnd.randrange(4) for _ in range(rnd.randrange(1, 40))]
    return [rnd.randrange(4) for _ in range(9)] + b * rnd.randrange(2, 8) + b[: rnd.randrange(len(b))] + [0] * (kind - 5) * 30


@pytest.mark.parametrize("seed", range(4))
def test_runs(seed):
    rnd = random.Random(seed)
    texts = [periodic(rnd) for _ in range(80)] + [[], [5] * 11, [5] * 12]
    text, start, length, period = periods.runs(np.array([len(t) for t in texts]), np.array([x for t in texts for x in t], np.int64))
    got = list(zip(text.tolist(), start.tolist(), length.tolist(), period.tolist()))
    assert got == [(k, *r) for k, t in enumerate(texts) for r in brute(t)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5), st.integers(12, 20))
def test_any_runs(texts, least):
    text, *rest = periods.runs(np.array([len(t) for t in texts]), np.array([x for t in texts for x in t], np.int64), least)
    got = list(zip(text.tolist(), *[x.tolist() for x in rest]))
    assert got == [(k, *r) for k, t in enumerate(texts) for r in brute(t, least)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=50), st.data())
def test_range_successor(values, data):
    tree = periods.Wavelet(np.array(values), 5)
    lo = data.draw(st.integers(0, len(values)))
    hi = data.draw(st.integers(lo, len(values)))
    least = data.draw(st.integers(0, 31))
    got = tree.successor(np.array([lo]), np.array([hi]), np.array([least]), 99)
    assert got[0] == min([x for x in values[lo:hi] if x >= least], default=99)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *top, digest("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()), digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(150):
        text = rnd.choice([" ", "\n", " \t\x0b"]).join("éab cd x yy".split(" ")[x] for x in periodic(rnd))
        rows.append((i, text, 1, "x"))
    rows += [(None, rows[3][1], 1, "x"), (200, None, None, None), (201, "", 1, "x"), (202, " \n ", 1, "x"), rows[5], rows[5], (203, " lone ", 1, "x"), (204, "a " * 5000, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for size in (300, periods.PIECE_BYTES):
        got = periods.report(periods.find_runs(df, change=periods.planted, piece_bytes=size)).collect()
        assert sorted(map(tuple, got), key=str) == sorted((expected(*r[:2]) for r in rows), key=str)
    assert got[0].__fields__ == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_a_very_long_text(spark):
    """Half a million words of one period, and as many of none."""
    rnd = random.Random(3)
    plain = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(500_000))
    df = spark.createDataFrame([(1, "a b c d e f g " * 70_000), (2, plain)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in periods.find_runs(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 490_000, 7)] and got[1]["collapsed"] == "a b c d e f g"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == plain


def test_empty_table(spark):
    assert periods.report(periods.find_runs(spark.createDataFrame([], SCHEMA))).count() == 0
