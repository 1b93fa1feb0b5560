"""The pipeline against a plain version of its stages."""

import hashlib
import os
import re

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

from cairn.llm import common, simhash

from .test_operators import PATH
from .test_secrets import redacted

DIR = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    kept = [r for r in docs if any(c.isalpha() for c in r["text"] or "")]
    prints = {r["doc_id"]: simhash.fingerprint((r["text"] or "").encode()) for r in kept}
    group = {i: i for i in prints}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    kept = [r for r in kept if find(r["doc_id"]) == r["doc_id"]]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))
    windows = set()
    for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(x) for x in windows}

    def dirty(t):
        w = words(t)
        hit = [False] * len(w)
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit[k : k + n] = [True] * n
        return sum(hit) > 0 and 20 * sum(hit) >= len(w)

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = []
    for r in kept:
        if not dirty(r["text"]):
            x = library.encode(redacted(r["text"]))
            want.append((r["doc_id"], len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(library.decode(x).encode()).hexdigest(), x))
    got = corpus_pipeline.run(spark, DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert 0 < len(want) < len(docs)


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, "word " * 30, "en", "s", 150, 9), (1, "word " * 30, "en", "s", 150, 9), (2, None, None, None, None, None), (3, "", "en", "s", 0, 1), (4, "12 34", "en", "s", 5, 1), (None, "another text with words in it", "en", None, 28, 1), (5, "password=abcdefgh here", "en", "s", 22, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept_0 int")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, DIR)
        assert out.columns == docs.columns, name
    got = {r["doc_id"]: r for r in out.collect()}
    assert set(got) == {1, None, 5} and out.count() == 3
    assert got[5]["text"] == "[REDACTED] here" and got[5]["n_chars"] == 15
    empty = docs.where(F.col("doc_id") < 0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DIR)
    assert empty.count() == 0


def test_language_stage_names_languages(spark):
    rows = [(i, "der hund und die katze " * 3, "de", 1) for i in range(8)] + [(20 + i, "the dog and the cat " * 3, "en", 2) for i in range(8)]
    rows += [(40, "die hund", None, 3), (40, "the dog", None, 4), (None, "dog the", None, 5), (41, "12", "en", 6), (42, None, None, 7), (43, "the cat", "xx", 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int").withColumn("lang_pred", F.lit("mine"))
    got = {r["score"]: r for r in corpus_pipeline.keep_languages(spark, docs, DIR).where("score > 2").collect()}
    assert {k: (r["doc_id"], r["lang"], r["lang_pred"]) for k, r in got.items()} == {3: (40, "de", "mine"), 4: (40, "en", "mine"), 5: (None, "en", "mine"), 8: (43, "xx", "mine")}


def test_hard_texts_in_the_secret_stage(spark):
    rows = [(1, "ab-" * 8000 + "1"), (2, "see a" + "-" * 60 + "1b end"), (1, "other row, same id, token=abcdefgh")]
    got = corpus_pipeline.redact_secrets(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), DIR).collect()
    assert sorted(r["text"] for r in got) == sorted([rows[0][1], rows[1][1], "other row, same id, [REDACTED]"])


def test_rows_with_the_same_id_stay_apart(spark):
    bench = spark.read.parquet(f"{DIR}/benchmark.parquet").first()["text"]
    rows = [(1, "clean text of its own, some words long"), (1, bench), (None, "another text without any id at all"), (None, bench + " " + bench)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.drop_contaminated(spark, docs, DIR).collect()
    assert sorted(r["text"] for r in got) == sorted(t for _, t in rows if t.startswith(("clean", "another")))
    assert corpus_pipeline.encode(spark, docs, DIR).groupBy("doc_id").count().where("count = 2").count() == 2


def test_one_row_of_each_group(spark):
    a, b, c, d, e = (" ".join(hashlib.sha256(f"{k} {i}".encode()).hexdigest()[:6] for i in range(80)) for k in "abcde")
    near = d + " tail"
    assert (simhash.fingerprint(d.encode()) ^ simhash.fingerprint(near.encode())).bit_count() <= 4
    rows = [(None, a), (None, b), (None, c), (None, a), (7, d), (9, near), (9, e), (9, e), (8, a + "!"), (12, b), (20, c[::-1]), (20, e[::-1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, DIR).collect()), key=str)
    linked = (simhash.fingerprint(a.encode()) ^ simhash.fingerprint((a + "!").encode())).bit_count() <= 4
    assert linked
    assert got == sorted([(None, c), (7, d), (9, e), (8, a + "!"), (12, b), (20, c[::-1]), (20, e[::-1])], key=str)


def test_columns_of_any_kind(spark):
    docs = spark.createDataFrame([(1, "some words of a text", {"a": 1}), (2, "some words of a text", None), (3, "quite another text here", {"b": 2})], "doc_id bigint, text string, m map<string,int>")
    docs = docs.withColumn("n", F.array(F.struct("m"))).withColumn("v", F.parse_json(F.lit("[1]")))
    got = corpus_pipeline.drop_near_duplicates(spark, docs, DIR)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]


def test_nothing_is_left_behind(spark):
    at = common.shared_dir(spark).removeprefix("file://")
    common.clear_staged(spark)
    before = set(os.listdir(at))
    out = corpus_pipeline.run(spark, DIR)
    left = set(os.listdir(at)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-sentencepiece") and out.count() > 0
    common.clear_staged(spark)
    assert set(os.listdir(at)) == before
