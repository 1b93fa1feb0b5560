"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairn.llm import spelling

SCHEMA = "doc_id bigint, text string, word int, n string"


def apart_by_one(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, least_chars=6, least_count=5, change=False):
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if change and h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_chars and c >= least_count}
    near = {w: sorted((x for x in n if apart_by_one(w, x)), key=lambda x: (-n[x], x)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= 5 * n[w] else None for w in n}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed: int):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice("abcdéÿ") for _ in range(rnd.randrange(5, 10))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "aaaaaab", "ababababab", "bababababab"]

    def variant(w):
        for _ in range(rnd.randrange(0, 3)):
            k, c = rnd.randrange(len(w)), rnd.choice("abcdé×")
            w = rnd.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]]) or "x"
        return w

    pool = [v for s in stems for v in [s] * 40 + [variant(s) for _ in range(12)] * rnd.randrange(1, 4)]
    rows = []
    for i in range(400):
        words = [rnd.choice(pool) for _ in range(rnd.randrange(0, 40))]
        rows.append((i, rnd.choice([" ", "-", ". ", " Ā", "9"]).join(w.upper() if rnd.random() < 0.1 and w.isascii() else w for w in words), 1, "x"))
    return rows + [(None, rows[0][1], None, None), (7, None, 1, "x"), (8, "", 1, "x"), rows[1], rows[1], (401, "ÀÁÉ×÷ß " * 9, 1, "x"), (402, "b" * 70 + " 日本語é " + "B" * 70, 1, "x")]


@pytest.mark.parametrize("share", [spelling.SHARE, 25], ids=["plain", "halves in shares"])
@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed, share):
    rows = corpus(seed)
    got = spelling.variants(spark.createDataFrame(rows, SCHEMA).repartition(3), share=share, change=spelling.dropped)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(rows, change=True)


def test_forms_lead_on(spark):
    """Chains of forms end at one root; ties go by code point."""
    text = " ".join(["chainaa"] * 5 + ["chainab"] * 25 + ["chainbb"] * 125 + ["chainbc"] * 625 + ["tiedxa"] * 5 + ["tiedxb"] * 25 + ["tiedxc"] * 25 + ["alonexx"] * 9)
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in spelling.variants(df).collect()}
    assert got == {
        "chainaa": ("chainab", "chainbc", 1), "chainab": ("chainbb", "chainbc", 2), "chainbb": ("chainbc", "chainbc", 2), "chainbc": (None, "chainbc", 1),
        "tiedxa": ("tiedxb", "tiedxb", 2), "tiedxb": (None, "tiedxb", 2), "tiedxc": (None, "tiedxc", 2), "alonexx": (None, "alonexx", 0),
    }


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abc", min_size=2, max_size=9), min_size=1, max_size=40))
def test_search(words):
    items = sorted(w.encode() for w in words)
    codes, size = spelling._matrix(items)
    q, x = spelling.search(spelling.Index(codes, size), codes, size, size // 2)
    got = list(zip(q.tolist(), x.tolist()))
    assert len(set(got)) == len(got)
    words_ = [w.decode() for w in items]
    assert set(got) == {(i, k) for i, a in enumerate(words_) for k, b in enumerate(words_) if apart_by_one(a, b) and b.startswith(a[: len(a) // 2])}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 10**18)), st.text("aéÿ", min_size=1, max_size=90)), min_size=1, max_size=60))
def test_checksums_are_composed(rows):
    names = sorted({w.encode() for _, w in rows})
    which = np.array([names.index(w.encode()) for _, w in rows])
    hit, new = spelling.dropped([i for i, _ in rows], np.arange(len(rows)), names, which)
    want = {}
    for k, (i, w) in enumerate(rows):
        h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
        if h % 199 == 0:
            want[k] = (w[: h % len(w)] + w[h % len(w) + 1 :]).encode()
    assert dict(zip(hit.tolist(), new)) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_letter_runs(texts):
    size, names, which = spelling.letter_runs(pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.binary()))
    flat = [names[int(k)].as_py() for k in which]
    want = [[re.sub("[A-Z]", lambda m: m[0].lower(), r) for r in re.findall("[A-Za-zÀ-ÿ]+", t)] for t in texts]
    assert flat == [w for x in want for w in x] and size.tolist() == [len(x) for x in want]


def test_empty_tables(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "", 1, "x"), (2, None, 1, "x")], SCHEMA)).count() == 0
