"""Substring and suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.llm import substrings, suffixes
from cairn.llm.common import in_blocks, texts
from cairn.llm.repeats import _name, _settle, _stretches, pack, pack_keys, radix_order, unpack, unpack_keys

SCHEMA = "doc_id bigint, text string, kept_0 int, block string"


def corpus(seed: int, n: int = 60):
    """Documents that share passages, with copies, repeated rows, nulls and empty texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 6)))
    shared = [" ".join(word() for _ in range(rnd.randrange(30, 60))) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rnd.randrange(0, 30)))]
        for _ in range(rnd.randrange(0, 3)):
            parts += [rnd.choice(shared), word()]
        rows.append((i * 3 % 101, rnd.choice((" ", "\n", "  ")).join(parts)))
    rows += [rows[0], rows[1], (500, rows[2][1]), (501, None), (502, ""), (503, " \t\n "), (None, rows[3][1]), (504, "x " * 90), (505, "a" * 120)]
    return [(a, b, 1, "x") for a, b in rows]


def words_brute(rows, w=35):
    docs = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    starts = Counter(tuple(ws[k : k + w]) for _, ws in docs for k in range(len(ws) - w + 1))
    out = []
    for i, ws in docs:
        gone = [False] * len(ws)
        for k in range(len(ws) - w + 1):
            if starts[tuple(ws[k : k + w])] > 1:
                gone[k : k + w] = [True] * w
        out.append((i, len(ws), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(ws, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def bytes_brute(rows, w=50):
    docs = [(i, (t or "").encode()) for i, t, *_ in rows]
    late = 2**63
    least = {}
    for i, b in docs:
        for k in range(len(b) - w + 1):
            x = b[k : k + w]
            least[x] = min(least.get(x, late), late if i is None else i)
    out = []
    for i, b in docs:
        gone = [False] * len(b)
        for k in range(len(b) - w + 1):
            if least[b[k : k + w]] < (late if i is None else i):
                gone[k : k + w] = [True] * w
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


SIZES = [{}, {"hot": 3, "block_bytes": 900, "segment": 16}, {"hot": 1, "block_bytes": 4000, "segment": 64}, {"hot": 40, "block_bytes": 2000}]


@pytest.mark.parametrize("sizes", SIZES, ids=["plain", "small", "hot", "heavy"])
@pytest.mark.parametrize("seed", [1, 2])
def test_substrings(spark, seed, sizes):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = substrings.report(substrings.dedup_substrings(df, **sizes)).collect()
    assert sorted(map(tuple, got), key=str) == words_brute(rows)


@pytest.mark.parametrize("sizes", SIZES, ids=["plain", "small", "hot", "heavy"])
@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes(spark, seed, sizes):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffixes.report(suffixes.dedup_suffixes(df, **sizes)).collect()
    assert sorted(map(tuple, got), key=str) == bytes_brute(rows)


def test_long_texts_of_one_letter(spark):
    """All windows of a document alike: they are hot on every level, and go as one row a block."""
    rows = [(3, "a" * 200_000, 1, "x"), (4, "b" + "a" * 1000, 1, "x"), (2, "a" * 60, 1, "x"), (9, "a b " * 30_000, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffixes.report(suffixes.dedup_suffixes(df)).collect()}
    assert got == {3: (200_000, 200_000, 1), 4: (1001, 1000, 1), 2: (60, 0, 0), 9: (120_000, 0, 0)}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.report(substrings.dedup_substrings(df)).collect()}
    assert got == {3: (1, 0), 4: (1, 0), 2: (1, 0), 9: (60_000, 60_000)}


def plain(n: int, prefix: str) -> str:
    return " ".join(f"{prefix}{k}" for k in range(n))


NO_REPEATS = [
    [(1, f"{plain(34, 'w')} {plain(9, 'a')}"), (2, f"{plain(9, 'b')} {plain(34, 'w')} end")],  # 34 words in common
    [(1, "x" * 3 + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWX"[:49] + "1 one"), (2, "y" * 3 + "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWX"[:49] + "2 two")],  # 49 bytes
    [(1, f"{plain(80, 'w')} {plain(80, 'w')}")],  # a document that repeats itself
]


@pytest.mark.parametrize("rows", NO_REPEATS, ids=["34 words", "49 bytes", "itself"])
def test_shared_anchors_without_a_repeat(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, substrings.report(substrings.dedup_substrings(df)).collect()), key=str) == words_brute(rows)
    assert sorted(map(tuple, suffixes.report(suffixes.dedup_suffixes(df)).collect()), key=str) == bytes_brute(rows)


def test_on_their_own_output(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, SCHEMA)
    for dedup, brute, name in ((substrings.dedup_substrings, words_brute, substrings.report), (suffixes.dedup_suffixes, bytes_brute, suffixes.report)):
        once = dedup(df).select("doc_id", F.col("kept").cast("string").alias("text")).collect()
        again = [(r["doc_id"], r["text"]) for r in once if r["text"].isprintable()]
        got = name(dedup(spark.createDataFrame(again, "doc_id bigint, text string"))).collect()
        assert sorted(map(tuple, got), key=str) == brute(again)


def test_rows_with_one_id_are_dealt_out(spark):
    df = spark.createDataFrame([(None, f"text {i}") for i in range(200)], "doc_id bigint, text string")
    assert in_blocks(texts(df), 8).groupBy("block").count().count() == 8


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab", min_size=4, max_size=30), min_size=1, max_size=8))
def test_nodes_are_those_of_the_suffix_tree(stretches):
    """Inner nodes are the strings that go on in two ways, once for each tree; deep ones are the repeated windows."""
    window = 4
    at, words, tree = [], [], []
    for k, t in enumerate(stretches):
        at += [len(words) + i for i in range(len(t) - window + 1)]
        words += map(ord, t)
    suffixes_ = ["".join(map(chr, words[a : a + window])) for a in at]
    built = substrings.Subtrees(np.array(words), np.array(at), np.array([a % 2 for a in at]), window)
    nodes = {}
    for a, x in zip(at, suffixes_):
        for d in range(window):
            nodes.setdefault((a % 2, x[:d]), set()).add(x[d])
    want = sorted((len(p), len(c)) for (_, p), c in nodes.items() if len(c) > 1)
    assert sorted(zip(built.depth, built.degree)) == want
    for i in range(len(at)):
        for j in range(i):
            assert (built.deep[i] == built.deep[j]) == (suffixes_[i] == suffixes_[j] and at[i] % 2 == at[j] % 2)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**40), st.integers(0, 2**63)), min_size=1, max_size=40))
def test_radix_order(rows):
    g, label = np.array([x for x, _ in rows]), np.array([x for _, x in rows], np.uint64)
    assert [rows[i] for i in radix_order(g, label)] == sorted(rows)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**48 - 1), max_size=400, unique=True), st.binary(max_size=3000))
def test_packing(keys, data):
    keys = np.array(sorted(keys), np.uint64)
    assert unpack_keys(pack_keys(keys)).tolist() == keys.tolist()
    got = unpack(pack(keys, data, np.arange(5, dtype=np.int32)))
    assert got[0].tolist() == keys.tolist() and got[1] == data and got[2].tolist() == [0, 1, 2, 3, 4]
    assert len(pack(keys[:3])) <= 8 + 8 * 3  # short arrays cost little more than their numbers


def test_rows_are_no_more_than_anchors():
    """Blocks times buckets would be 100 times as many rows for 10 times the input; there are no more than anchors."""
    unit = substrings.Unit(5, (2, 4, 5), bytes.split, substrings._hashes, substrings._join, b" ", None, True)
    rnd = random.Random(1)
    for n_buckets in (10, 100, 100_000):
        docs = pa.table({"doc_id": [1], "body": [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(400)).encode()], "block": pa.array([0], pa.int32())})
        named = _name(unit, n_buckets)(docs, None)
        keys = sum(len(unpack_keys(x)) for x in named["keys"].to_pylist())
        assert named.num_rows <= min(n_buckets, keys) and sum(map(len, named["keys"].to_pylist())) <= 6 * keys + 8 * named.num_rows


@pytest.mark.parametrize("module", [substrings, suffixes], ids=["words", "bytes"])
def test_equal_stretches_are_ordered_once(module):
    """Two hundred copies in ten blocks are one stretch for the order; every copy is settled by its own document."""
    asked, order = [], substrings.subtrees if module is substrings else suffixes.radix_groups

    def counted(texts_, *rest):
        asked.append(len(texts_))
        return order(texts_, *rest)

    unit = substrings.Unit(4, (2, 3, 4), None, None, None, b"", counted, module is substrings)
    text, other = (b"a b c d e f", b"z b c d e y") if module is substrings else (b"abcdef", b"zbcdey")

    def blob(docs, t):
        n = len(docs)
        return pack(np.full(n, 7, np.uint64), np.array(docs, np.int64), np.arange(n, dtype=np.int32), np.full(n, 5, np.int64), np.full(n, 2, np.int32), np.full(n, len(t), np.int64), t * n)

    blobs = [blob(range(20 * b + 1, 20 * b + 21), text) for b in range(10)] + [blob([0], other)]
    table = pa.table({"grp": [0] * 11, "block": pa.array(range(11), pa.int32()), "blob": pa.array(blobs, pa.binary()), "text": pa.array([None] * 11, pa.binary()), "n": pa.array([None] * 11, pa.int64()), "first": pa.array([None] * 11, pa.int64())})
    found = _settle(unit)(table)
    assert asked == [2]
    got = {}
    for b, x in zip(found["block"].to_pylist(), found["blob"].to_pylist()):
        for row, lo, hi in zip(*unpack(x)):
            got.setdefault((b, int(row)), set()).update(range(int(lo), int(hi) + 1))
    if module is substrings:  # windows "b c d e" of all, the others of the copies
        assert got == {(b, r): {5, 6, 7} for b in range(10) for r in range(20)} | {(10, 0): {6}}
    else:  # the first copy keeps what document 0 doesn't have
        assert got == {(b, r): {5, 6, 7} for b in range(10) for r in range(20)} | {(0, 0): {6}}


def test_hot_windows_go_in_the_same_pass():
    """Stretches and the rows of hot windows come from one reading of a block."""
    unit = suffixes.Unit(50, (50,), suffixes._split, suffixes._hashes, suffixes._join, b"", suffixes.radix_groups, False)
    docs = pa.table({"doc_id": [3, 1, 2], "body": [b"x" * 60, b"x" * 52, bytes(range(60))], "block": pa.array([4] * 3, pa.int32())})
    named = _name(unit, 1)(docs, None)
    keys, counts = unpack_keys(named["keys"][0].as_py()), unpack(named["counts"][0].as_py())[0]
    hot = np.where(counts > 3, 2, 0).astype(np.int8)  # all others occur again in some other block
    flags = pa.table({"level": pa.array([0], pa.int32()), "block": pa.array([4], pa.int32()), "keys": pa.array([pack_keys(keys)], pa.binary()), "hot": pa.array([pack(hot)], pa.binary()), "n_hot": [int((hot == 2).sum())]})
    rows = _stretches(unit, 8, 1)(docs, flags).to_pylist()
    crowded = [r for r in rows if r["text"] is not None]
    assert [(r["text"], r["first"], r["block"]) for r in crowded] == [(b"x" * 50, 1, 4)] and crowded[0]["grp"] < 0
    assert [x.tolist() for x in unpack(crowded[0]["blob"])] == [[0, 2], [0, 0], [2, 10], [1, 3]]
    assert sum(len(unpack(r["blob"])[0]) for r in rows if r["text"] is None) == 11  # the windows of document 2


@pytest.mark.parametrize("hot", [3, 100_000])
def test_documents_are_not_exchanged_again(spark, hot):
    """The passes read the documents in buckets by block; only what is told about them is exchanged."""
    df = spark.createDataFrame(corpus(4), SCHEMA)
    plan = suffixes.dedup_suffixes(df, hot=hot)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning(block" in x]
    assert len(exchanges) == 1 and "Bucketed: true" in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substrings.report(substrings.dedup_substrings(none)).count() == 0
    assert suffixes.report(suffixes.dedup_suffixes(none)).count() == 0


def test_spans_and_kept_text(spark):
    passage = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, f"one {passage} two"), (2, f"three {passage}")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in substrings.dedup_substrings(df).collect()}
    assert got[1]["kept"] == "one two" and [tuple(x) for x in got[1]["spans"]] == [(1, 41)]
    assert got[2]["kept"] == "three" and got[2]["n_words"] == 41
