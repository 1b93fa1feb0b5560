"""The corpus operators against brute force, libraries and planted cases."""

import bz2
import hashlib
import random
import re
import zlib
from collections import Counter
from math import log, log2, log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.llm import decontaminate, language, media, pieces, quality, queries, secrets, simhash, trees
from cairn.llm.common import fold
from cairn.llm.common import texts as texts_of

#: Extra columns whose names the operators use themselves.
SCHEMA = "doc_id bigint, text string, lang string, body string, kept_0 int, score double, block int, spans string"
EDGES = [None, "", " \n\t", "x", "é" * 300, "a b c d " * 3000, "1234 5678 !!"]


def table(spark, texts, lang="en"):
    rows = [(i, t, lang, "b", 1, 0.5, 2, "s") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0], (None, "null id", lang, "b", 1, 0.5, 2, "s")], SCHEMA).repartition(3)


def prose(seed, n, words=60, vocab=200):
    rnd = random.Random(seed)
    known = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 8))) for _ in range(vocab)]
    return [" ".join(rnd.choice(known) for _ in range(rnd.randrange(1, words))) for _ in range(n)]


# ---- SimHash


def brute_fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("hot", [4096, 2])
def test_simhash_components(spark, hot):
    base = prose(3, 40, 200)
    rnd = random.Random(5)
    near = []
    for t in base[:15]:
        for _ in range(4):
            w = t.split()
            w[rnd.randrange(len(w))] = "changed"
            near.append(" ".join(w))
    texts = [*base, *near, *base[:5], *EDGES]
    got = simhash.report(simhash.near_duplicates(table(spark, texts), hot=hot)).collect()
    rows = [*enumerate(texts), (0, texts[0]), (None, "null id")]
    fps = [brute_fp(t) for _, t in rows]
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(i), f"{f:016x}") for (i, _), f in zip(rows, fps))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = Counter((d, least.get(find(i))) for i, (d, _) in enumerate(rows))
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == want


def test_simhash_random_links(spark):
    rnd = random.Random(9)
    points = {rnd.getrandbits(64) for _ in range(60)}
    for p in list(points):
        for _ in range(6):
            q = p
            for b in rnd.sample(range(64), rnd.randrange(1, 6)):
                q ^= 1 << b
            points.add(q)
    points = sorted(points)
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(points):
        for q in points[:i]:
            if (p ^ q).bit_count() <= 4:
                root[find(p)] = find(q)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in points], "fp bigint")
    for hot in (4096, 3):
        got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, hot=hot)).collect()}
        groups: dict = {}
        for p in points:
            groups.setdefault(got.get(signed(p), signed(p)), set()).add(p)
        want: dict = {}
        for p in points:
            want.setdefault(find(p), set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


# ---- quality, language


def test_quality(spark):
    good, bad = prose(1, 120), [" ".join(w.upper() + "!!" for w in t.split()) for t in prose(2, 120)]
    texts = [x for p in zip(good, bad) for x in p]
    docs = table(spark, [*texts, *EDGES])
    labels = spark.createDataFrame([(i, 1 - i % 2, "x") for i in range(len(texts))] + [(3, 1, "x"), (None, 1, "x"), (5, None, "x")], "doc_id bigint, quality int, text string")
    rows = quality.sample(docs, labels, n=40, allowed=fold(F.col("doc_id"), 3) != 1)
    assert 0 < len(rows) <= 80 and all(zlib.crc32(str(i).encode()) % 3 != 1 and i != 3 for i, _, _ in rows)
    got = quality.score(docs, quality.fit(rows)).collect()
    assert len(got) == len(texts) + len(EDGES) + 2 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < len(texts) and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 2 == 0) for r in held]) > 0.8
    none = quality.fit([])
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}


def test_language(spark):
    make = lambda seed, letters: [" ".join("".join(random.Random(seed * 999 + i * 31 + k).choices(letters, k=5)) for k in range(30)) for i in range(60)]
    rows = [(i, t, "aa", 1) for i, t in enumerate(make(1, "abcde"))] + [(100 + i, t, "bb", 1) for i, t in enumerate(make(2, "defgh"))]
    rows += [(200, None, "aa", 1), (201, "", "aa", 1), (202, "12 !?", "bb", 1), (203, "abcde", None, 1), (None, "dfg hhh", "bb", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    got = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs.where(fold(F.col("doc_id"), 4) != 2)), keep=["lang", "text"]).collect()}
    assert len(got) == len(rows) and all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (200, 201, 202))
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _ in rows[:120]]) > 0.95 and got[203]["lang_pred"] == "aa"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    blank = docs.where("doc_id = 200")
    assert language.identify(docs, language.fit(blank)).where("lang_pred <> 'und'").count() == 0


# ---- decontamination


def test_many_equal_items_and_a_long_one(spark):
    """A million rows of one item are one; an item of 20 MB goes in pieces, and passes are few."""
    rnd = random.Random(6)
    long = " ".join(f"v{rnd.randrange(10**7)}" for _ in range(2_300_000))
    ws = long.split()
    same = spark.range(1_000_000).select(F.lit("same").alias("item_id"), F.lit(" ".join(f"u{k}" for k in range(20))).alias("text"))
    bench = same.unionByName(spark.createDataFrame([("long", long)], "item_id string, text string"))
    cuts = [0, 5000, 900_001, 2_299_987]
    docs = spark.createDataFrame([(k, f"x {' '.join(ws[c : c + 13])} y") for k, c in enumerate(cuts)] + [(10, " ".join(f"u{k}" for k in range(3, 16))), (11, " ".join(ws[:12]))], "doc_id bigint, text string")
    got = {r["doc_id"]: ([tuple(x) for x in r["spans"]], r["items"]) for r in decontaminate.contamination(docs.coalesce(1), bench).collect()}
    assert got == {**{k: ([(1, 14)], ["long"]) for k in range(len(cuts))}, 10: ([(0, 13)], ["same"]), 11: ([], [])}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(1, 9)), max_size=30))
def test_spans_join(spans):
    rows, start, end = (np.array(x, np.int64) for x in (zip(*[(r, a, a + n) for r, a, n in spans]) if spans else ([], [], [])))
    want = []
    for r in range(4):
        cover = {k for q, a, n in spans if q == r for k in range(a, a + n)}
        want += [(r, a, next(b for b in range(a, 99) if b not in cover)) for a in sorted(cover) if a - 1 not in cover]
    assert list(zip(*(x.tolist() for x in decontaminate.join_spans(rows, start, end)))) == want


def test_contamination(spark):
    items = prose(7, 30, 40, 60)
    items += ["only five words in here", "", None, items[0]]
    texts = prose(8, 60, 80, 60)
    for k in range(0, 40, 2):
        texts[k] += ", " + items[k % 30].upper().replace(" ", " - ", 2) + " tail"
    texts += ["x only five, words IN here", *EDGES]
    docs = table(spark, texts)
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)] + [(0, items[0], 1)], "item_id bigint, text string, body int")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows: dict = {}
    for i, t in enumerate(items):
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    sizes = {len(w) for w in windows}

    def brute(t):
        w = words(t)
        hit, of = [False] * len(w), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit[k : k + n] = [True] * n
                    of |= windows[tuple(w[k : k + n])]
        return len(w), sum(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(w)

    want = sorted(((i, *brute(t)) for i, t in [*enumerate(texts), (0, texts[0]), (None, "null id")]), key=str)
    for limit, at_once in ((decontaminate.ITEM_BYTES, 2), (500, 2), (500, 1000), (60, 3)):
        got = decontaminate.verdicts(decontaminate.contamination(docs, bench, item_bytes=limit, at_once=at_once)).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert sum(r[2] > 0 for r in want) > 15
    assert decontaminate.contamination(docs, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_index_search(seq, phrase):
    seq = np.array([*seq, 0])
    index = decontaminate.ShardIndex(seq, 4, sample=3)
    row = np.array([[0] * (4 - len(phrase)) + phrase])
    lo, hi = index.search(row, np.array([len(phrase)]))
    got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
    assert got == [i for i in range(len(seq)) if seq[i : i + len(phrase)].tolist() == phrase]


def plain_hits(bodies, items):
    """(words, hit places, items) of each document by a dict of windows."""
    windows: dict = {}
    for k, b in enumerate(items):
        w = decontaminate.words(b)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(k)
    out = []
    for b in bodies:
        w, hit, of = decontaminate.words(b), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    of |= windows[tuple(w[i : i + n])]
        out.append((len(w), hit, sorted(of)))
    return out


@pytest.mark.parametrize("shard", [20, 1 << 18])
def test_hits_of_long_runs(monkeypatch, shard):
    """Runs of benchmark words over a shard are cut with an overlap; nothing is lost where they are cut."""
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    items = [t.encode() for t in [*prose(21, 12, 40, 12), "one two", "one", "a b c " * 9]]
    rnd = random.Random(5)
    bodies = [" ".join(rnd.choice(items).decode() for _ in range(rnd.randrange(6))).encode() for _ in range(25)] + [b"", b"x", b"a b c " * 400]
    got = decontaminate.hits(bodies, decontaminate.Phrases([(str(k), b) for k, b in enumerate(items)], 13))
    assert [(n, {i for a, b in spans for i in range(a, b)}, of) for n, spans, of in got] == plain_hits(bodies, items)


def test_phrases_are_small():
    """Windows are rows of a matrix: some 80 bytes each, not Python objects."""
    import tracemalloc

    rnd = random.Random(3)
    body = " ".join(f"w{rnd.randrange(5000)}" for _ in range(200_000)).encode()
    tracemalloc.start()
    known = decontaminate.Phrases([("a", body), ("b", body[:5000].rsplit(b" ", 1)[0])], 13)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(known.rows) == 200_000 - 12 and held < 25e6 and most < 90e6
    assert known.of(int(np.flatnonzero(known.count > 1)[0])).tolist() == [0, 1]


# ---- suffix tree


def brute_tree(docs, train, depth, support, divergence, mass):
    """(tokens, known, base, score) of each document by dicts of whole contexts."""
    toks = lambda t: ["<"] + [w.decode() for w in (t or "").encode().lower().split()] + [None]
    rows = [toks(t) for t in docs]
    learned = [r for r, yes in zip(rows, train) if yes]
    c = Counter(w for r in learned for w in r[1:])
    n, v = sum(c.values()), len(c)
    nexts: dict = {}
    for r in learned:
        for i in range(1, len(r)):
            for k in range(1, min(depth, i) + 1):
                nexts.setdefault(tuple(r[i - k : i]), Counter())[r[i]] += 1
    kept: dict = {}

    def prob(before, w):
        for k in range(min(depth, len(before)), 0, -1):
            ctx = tuple(before[-k:])
            if kept.get(ctx):
                own = nexts[ctx]
                return (own[w] + mass * prob(before[len(before) - k + 1 :], w)) / (sum(own.values()) + mass)
        return (c[w] + 0.1) / (n + 0.1 * (v + 1))

    for ctx in sorted(nexts, key=len):
        own, size = nexts[ctx], sum(nexts[ctx].values())
        if size >= support:
            gain = 0.0
            for w, m in own.items():
                p = prob(list(ctx[1:]), w)
                gain += m * (log((m - 1 + mass * p) / (size - 1 + mass)) - log(p))
            kept[ctx] = gain >= divergence * size
    out = []
    for r in rows:
        base = sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in r[1:])
        out.append((len(r) - 1, sum(c[w] > 0 for w in r[1:]), n, base, sum(log10(prob(r[:i], r[i])) for i in range(1, len(r)))))
    return out, kept


@pytest.mark.parametrize(("support", "sizes"), [(2, {}), (4, {"block_bytes": 500}), (1, {"hot": 10**9}), (2, {"hot": 1, "block_bytes": 700}), (2, {"hot": 6, "block_bytes": 2000})], ids=["plain", "small blocks", "single places", "all hot", "some hot"])
def test_tree_scores(spark, support, sizes):
    rnd = random.Random(2)
    texts = [*prose(11, 60, 40, 25), *EDGES]
    texts += [texts[k] + " extra" for k in range(0, 40, 3)] + [" ".join(rnd.choice(("red fox", "blue sea", "x")) for _ in range(30)) for _ in range(10)]
    docs = table(spark, texts)
    got = trees.score_documents(docs, fold(F.col("doc_id"), 10) != 0, support=support, depth=3, **sizes).collect()
    rows = [*enumerate(texts), (0, texts[0]), (None, "null id")]
    want, kept = brute_tree([t for _, t in rows], [zlib.crc32(str(i if i is not None else "").encode()) % 10 != 0 for i, _ in rows], 3, support, trees.DIVERGENCE, trees.MASS)
    plain = lambda i, x: (i, *x[:3], round(x[3], 4), round(x[4], 3))
    assert sorted((plain(r["doc_id"], (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])) for r in got), key=str) == sorted((plain(i, x) for (i, _), x in zip(rows, want)), key=str)
    assert 10 < sum(kept.values()) < len(kept) and {len(k) for k, yes in kept.items() if yes} == {1, 2, 3}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=30), st.text("aB \t\n\x0b\x0c\r\x1c\xa0é", max_size=30).map(str.encode)), min_size=1, max_size=5))
def test_tokens_as_split(bodies):
    size, words, ids = trees.tokenize(pa.chunked_array([pa.array([b"skipped", *bodies], pa.binary())[1:]]))
    want = [b.lower().split() for b in bodies]
    assert size.tolist() == [len(w) for w in want] and [words[i] for i in ids] == [x for w in want for x in w] and len(set(words)) == len(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2000), max_size=50), st.lists(st.integers(0, 2**56 - 1), max_size=20), st.lists(st.integers(0, 9), max_size=60))
def test_rows_of_pairs_are_packed_whole(n, tokens, keys):
    assert trees.counts_in(*trees.counts_out(np.array(n, np.int64))).tolist() == n
    assert trees.tokens_in(trees.tokens_out(np.array(tokens, np.uint64))).tolist() == tokens
    once, first, number = trees.distinct(np.array(keys, np.uint64))
    assert once.tolist() == sorted(set(keys)) and [keys[i] for i in first] == once.tolist() and [int(once[i]) for i in number] == keys


def test_contexts_are_distributions():
    """The shares of all known tokens and of one unknown token sum up to 1 in the root, and so, by the smoothing's form, in every context."""
    rnd = random.Random(4)
    counts = np.array([rnd.randrange(1, 50) for _ in range(30)])
    root = np.append(counts + 0.1, 0.1) / (counts.sum() + 0.1 * 31)
    own = np.append(np.array([rnd.randrange(3) for _ in range(30)]), 0)
    assert np.isclose(root.sum(), 1) and np.isclose(((own + trees.MASS * root) / (own.sum() + trees.MASS)).sum(), 1)


def test_tree_beats_the_base(spark):
    """On documents that it hasn't learned from, at sf0.01."""
    got = queries.op6_suffix_tree_scores(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# ---- SentencePiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = pieces.PieceModel(open(PATH, "rb").read())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab  ▁\n\tetin.,!ouséçTh字😀", max_size=80), st.text("aaabbet  ", max_size=60)))
def test_pieces_as_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = LIBRARY.encode(text)
    assert MODEL.encode(text) == ids and MODEL.decode(ids) == LIBRARY.decode(ids) == MODEL.both(text)[1]


def test_unsupported_pieces_and_full_caches(monkeypatch):
    data = open(PATH, "rb").read()
    user = b"\n\x0b\n\x02ab\x15\x00\x00\x00\x00\x18\x04"  # a piece "ab" of kind 4
    with pytest.raises(ValueError):
        pieces.PieceModel(data + user)
    monkeypatch.setattr(pieces, "BYTES_KEPT", 2000)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 5)
    model = pieces.PieceModel(data)
    for text in prose(19, 20):
        assert model.encode(text) == LIBRARY.encode(text) and len(model.known) < 20 and len(model.pairs) <= 5


def test_pieces_of_documents(spark):
    texts = [*prose(13, 30), *EDGES, "x" * 5000]
    got = pieces.digests(pieces.encode_documents(table(spark, texts), PATH)).collect()
    rows = [*enumerate(texts), (0, texts[0]), (None, "null id")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(x := LIBRARY.encode(t or "")), sha(",".join(map(str, x))), sha(LIBRARY.decode(x))) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# ---- media


def test_media(spark, monkeypatch):
    texts = [*prose(14, 20), *EDGES, "".join(prose(15, 400)), "".join(prose(15, 401))]
    texts += [texts[0], texts[-2] + "tail"]
    want = Counter()
    for i, t in [*enumerate(texts), (0, texts[0]), (None, "null id")]:
        b = (t or "").encode()
        p = b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))
        want[(i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))] += 1
    for hot, copy, rounds in ((256, 256, 2), (1, 256, 1), (1, 1, 3)):
        monkeypatch.setattr(media, "COPY", copy)
        got = media.media_columns(table(spark, texts), hot=hot, rounds=rounds).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
        by = {}
        for r in got:
            by.setdefault(r["payload_sha256"], set()).add((r["media_bytes"], r["media_sha256"], r["feature"]))
        assert all(len(x) == 1 for x in by.values())


def brute_cuts(data):
    """Ends of chunks, the hash summed anew for each place."""
    gear, out, at = media.GEAR.tolist(), [], 0
    for i in range(len(data)):
        size = i + 1 - at
        h = sum(gear[data[i - k]] << k for k in range(min(32, i + 1))) & 0xFFFFFFFF
        if size == media.MOST or (size >= media.LEAST and h >> (32 - media.CUT_BITS) == 0):
            out.append(i + 1)
            at = i + 1
    return out if out and out[-1] == len(data) else [*out, len(data)]


def test_cuts_by_hand(monkeypatch):
    rnd = random.Random(6)
    texts = [rnd.randbytes(n) for n in (1, 255, 256, 257, 5000)] + [b"\xff" * 3000, " ".join(prose(17, 60)).encode()]
    assert all(media.cuts(t) == brute_cuts(t) for t in texts)
    monkeypatch.setattr(media, "MOST", 700)
    assert all(media.cuts(t) == brute_cuts(t) for t in texts) and max(len(x) for x in media.chunks(texts[4])) <= 700


def test_media_columns_by_hand(spark):
    texts = ["abc", " ".join(prose(16, 90)), None, "é" * 4000]
    got = {r["doc_id"]: r for r in media.media_columns(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        p = b + b"\xff" * (max(1, -(-len(b) // 576)) * 576 - len(b))
        ends = brute_cuts(p)
        stored = b""
        for x in (p[a:c] for a, c in zip([0, *ends], ends)):
            packed = bz2.compress(x, 1)
            stored += hashlib.sha256(x).digest()[:16] + len(x).to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
        share = [p.count(v) / len(p) for v in set(p)]
        feature = f"chunks={len(ends)};mean={sum(p) / len(p):.2f};entropy={abs(-sum(x * log2(x) for x in share)):.3f}"
        assert (got[i]["media_bytes"], got[i]["media_sha256"], got[i]["feature"]) == (len(stored), hashlib.sha256(stored).hexdigest(), feature)


def test_near_copies_share_chunks(spark):
    base = [" ".join(prose(18 + k, 8, 600, 2000)) for k in range(15)]
    docs = spark.createDataFrame([(2 * i + k, t if not k else t[:50] + "changed" + t[50:]) for i, t in enumerate(base) for k in (0, 1)], "doc_id bigint, text string")
    whole = sum(len(media.payload(r["text"].encode())) for r in docs.collect())
    kept = media.store(texts_of(docs))
    bodies = [bz2.decompress(bytes(r["stored"])) for r in kept.collect()]
    assert kept.select("digest").distinct().count() == len(bodies) and sum(map(len, bodies)) < 0.8 * whole
    other = kept.select("digest").withColumnRenamed("digest", "d2").hint("merge")
    plan = kept.join(other, F.col("digest") == F.col("d2"))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_chunks_move_with_content():
    data = random.Random(1).randbytes(300_000)
    a, b = media.chunks(data), media.chunks(b"inserted" + data)
    assert b"".join(a) == data and len(set(a) & set(b)) >= len(a) - 2
    assert all(len(x) <= media.MOST for x in a) and all(len(x) >= media.LEAST for x in a[:-1])


def test_empty_tables(spark):
    none = table(spark, ["x"]).limit(0)
    assert simhash.near_duplicates(none).count() == 0
    assert pieces.encode_documents(none, PATH).count() == 0
    assert media.media_columns(none).count() == 0
    assert secrets.scan(none).count() == 0
    assert language.identify(none, language.fit(none)).count() == 0
    assert trees.score_documents(none, F.col("doc_id") > 0).count() == 0
    assert quality.score(none, quality.fit([])).count() == 0
