"""Language ID and quality scores against plain versions, and their held-out accuracy."""

import random
import zlib
from collections import Counter
from math import exp, log

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from cairn.llm import language, quality, queries
from cairn.llm.common import add_blobs, pack_counts, unpack_counts

DIR = "/root/testdata/sf0.01"


def bucket(chars, bits):
    """The bucket of an n-gram, one number after another."""
    h = len(chars) * 0x9E3779B1 & 0xFFFFFFFF
    for c in chars:
        h = (h ^ ord(c)) * 0x85EBCA6B & 0xFFFFFFFF
        h ^= h >> 15
    return h >> (32 - bits)


def ngrams(text, bits):
    t = " " + " ".join(text.lower().split()) + " "
    return [bucket(t[i : i + n], bits) for n in (1, 2, 3) for i in range(len(t) - n + 1)]


def naive_bayes(train, texts, bits):
    counts = {}
    for t, lang in train:
        if t is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(ngrams(t, bits))
    logs = {k: (c, log(sum(c.values()) + 0.5 * (1 << bits))) for k, c in counts.items()}
    out = []
    for t in texts:
        if t is None or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        got = {k: sum(log(c[b] + 0.5) - total for b in ngrams(t, bits)) for k, (c, total) in logs.items()}
        best = min(got, key=lambda k: (-got[k], k))
        out.append((best, 1 / sum(exp(x - got[best]) for x in got.values())))
    return out


@pytest.mark.parametrize("bits", [16, 8])
def test_language_as_naive_bayes(spark, monkeypatch, bits):
    monkeypatch.setattr(language, "LEAST_BITS", 8)
    monkeypatch.setattr(language, "ENTRIES", 4 << bits)
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        lang = rnd.choice(("aa", "bb", "cc", "dd"))
        letters = {"aa": "abcde é", "bb": "cdefg ü", "cc": "efghi", "dd": "abghi 字"}[lang]
        rows.append((i // 2, "".join(rnd.choices(letters, k=rnd.randrange(1, 60))), lang))
    rows += [(900, None, "aa"), (901, "", "bb"), (902, " 12 ", "cc"), (None, "abc", None), (903, "abc de", None), rows[0], rows[0], (904, "é字 " * 9000, "dd")]
    df = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id bigint, text string, lang string, score int, blob string").repartition(3)
    model = language.fit(df)
    assert model[0] == ["aa", "bb", "cc", "dd"] and model[1].shape == (1 << bits, 4)
    got = sorted(((r["doc_id"], r["text"], r["lang_pred"], round(r["score"], 3)) for r in language.identify(df, model, keep=["text"]).collect()), key=str)
    want = naive_bayes([r[1:] for r in rows], [r[1] for r in rows], bits)
    assert got == sorted(((r[0], r[1], lang, round(s, 3)) for r, (lang, s) in zip(rows, want)), key=str)


def test_language_of_only_long_texts(spark):
    rows = [(i, "abc " * 10, "aa") for i in range(20)] + [(50 + i, "xyz " * 20_000, "bb") for i in range(3)] + [(90, "zyx", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, language.fit(df)).collect()}
    assert got[51] == got[90] == "bb" and got[3] == "aa"


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "ENTRIES", 2 << language.LEAST_BITS)
    df = spark.createDataFrame([(i, "a", f"l{i}") for i in range(3)], "doc_id bigint, text string, lang string")
    assert language.fit(df.where("doc_id < 2"))[1].shape == (1 << language.LEAST_BITS, 2)
    with pytest.raises(ValueError):
        language.fit(df)


def test_counts_are_sent_when_they_are_many(spark):
    rows = [pa_batch(["ab", "cd", "ef", "ab"], ["x", "y", "z", "x"]), pa_batch(["gh"], ["w"])]
    sent = list(language._count(16, held=2 << 16)(iter(rows)))
    total = Counter()
    for b in sent:
        for lang, blob in zip(b["lang"].to_pylist(), b["blob"].to_pylist()):
            total[lang] += int(unpack_counts(blob).sum())
    assert len(sent) == 2 and total == {k: len(ngrams("ab", 16)) * n for k, n in (("x", 2), ("y", 1), ("z", 1), ("w", 1))}


def pa_batch(texts, langs):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"text": texts, "lang": langs})


def test_add_blobs(spark):
    rows = [(k, pack_counts(np.arange(4) * i)) for i in range(30) for k in ("p", "q")]
    df = spark.createDataFrame(rows, "k string, blob binary").repartition(7)
    got = {r["k"]: unpack_counts(bytes(r["blob"])).tolist() for r in add_blobs(df, "k string", (4, 2, 1)).collect()}
    assert got == {k: (np.arange(4) * sum(range(30))).tolist() for k in ("p", "q")}


# ---- quality


def test_features_as_zstandard():
    bad, good = b"junk junk CLICK here 123 " * 40, b"calm prose about rivers and hills " * 40
    shape = lambda x: "".join("a" if "a" <= c <= "z" or c > "\x7f" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in x.decode("latin-1")).encode("latin-1")

    def size(known, x):
        d = zstandard.ZstdCompressionDict(known, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(x)) - 7

    got = quality.Compressors(bad, good)
    for x in (b"CLICK here now 55", b"hills and rivers, calm", "é ü Ä 字".encode(), b"x" * 50_000):
        b, g = size(bad, x), size(good, x)
        sb, sg = size(shape(bad), shape(x)), size(shape(good), shape(x))
        assert np.allclose(got.features(x), [(b - g) / max(1, b + g), (sb - sg) / max(1, sb + sg), (b + g) / 2 / len(x)])
    assert got.features(b"") == [0.0, 0.0, 0.0]


def test_sample_keeps_long_texts_and_one_row_of_each_id(spark):
    rows = [(i, "good prose " * 8) for i in range(30)] + [(100 + i, "BUY NOW!! " * 9000 + str(i)) for i in range(30)] + [(3, "twice"), (3, "twice"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows[:60]] + [(None, 1)], "doc_id bigint, quality int")
    got = quality.sample(docs, labels, n=20)
    assert Counter(k for _, _, k in got) == {0: 20, 1: 20} and len({i for i, _, _ in got}) == 40
    assert all(len(b) == quality.SAMPLE_BYTES and b"BUY" in b for _, b, k in got if not k)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, quality.fit(got)).collect()}
    assert scored[129] < 0.5 < scored[29]


# ---- accuracy on documents that were held out


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    got = queries.op9_language_id(spark, DIR).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99
    rows = queries.op2_quality_compression(spark, DIR).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    for k in (0, 1):
        assert np.mean([r["predicted"] == k for r in rows if r["quality"] == k]) > 0.85
