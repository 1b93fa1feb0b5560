"""Mixtures against a plain computation."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from cairn.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, kept_0 int, size string"


def brute_targets(sizes: list[tuple[int, int]], most: int = 3) -> list[Fraction]:
    """(size, weight) of each source."""
    capped: set[int] = set()
    while True:
        left = sum(n for n, _ in sizes) - sum(most * sizes[i][0] for i in capped)
        weight = sum(w for i, (_, w) in enumerate(sizes) if i not in capped)
        got = [Fraction(most * n) if i in capped else Fraction(left * w, weight) for i, (n, w) in enumerate(sizes)]
        over = {i for i, (n, _) in enumerate(sizes) if got[i] > most * n}
        if not over:
            return got
        capped |= over


def corpus(seed: int):
    rnd = random.Random(seed)
    rows = []
    for i in range(300):
        source = rnd.choice(["a", "a", "a", "a", "é", "z", "Z", "", None, "rare" if i % 40 == 0 else "b"])
        text = rnd.choice([" ", "\n", "\t\x0b"]).join(f"w{k} x" for k in range(rnd.randrange(0, 40)))
        rows.append((i, text, source, 1, "x"))
    return rows + [rows[0], rows[0], (None, None, "a", None, None), (None, "one", None, None, None), (900, "", "empty", 1, "y")]


def test_plan(spark):
    rows = corpus(1)
    got = mixing.report(mixing.plan(spark.createDataFrame(rows, SCHEMA).repartition(5))).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = Counter()
    for _, t, s, *_ in rows:
        totals[s] += size(t)
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, brute_targets([(totals[s], k % 3 + 1) for k, s in enumerate(order)])))
    want = []
    for i, t, s, *_ in rows:
        rate = target[s] / totals[s] if totals[s] else Fraction(0)
        name = f"11:{'' if i is None else i}:{t or ''}".encode()
        u = int(hashlib.md5(name).hexdigest()[:13], 16) / 2**52
        want.append((i, size(t), totals[s], round(float(target[s]), 6), size(t) * (int(rate) + (u < rate - int(rate)))))
    assert sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got), key=str) == sorted(want, key=str)
    assert max(r["taken"] / r["size"] for r in got if r["size"]) <= 3
    assert got and sum(Fraction(x) for x in target.values()) == sum(totals.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 3)), min_size=1, max_size=12))
def test_brute_targets_are_whole(sizes):
    got = brute_targets(sizes)
    assert sum(got) == sum(n for n, _ in sizes) and all(g <= 3 * n for g, (n, _) in zip(got, sizes))


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rnd = random.Random(seed)
    sizes = [(rnd.choice([0, 1, rnd.randrange(1, 1000), 10**12]), rnd.randrange(1, 4)) for _ in range(40)]
    df = spark.createDataFrame([(str(i), n, w) for i, (n, w) in enumerate(sizes)], "source string, source_size bigint, weight int")
    got = {int(r["source"]): r["target"] for r in mixing.targets(df).collect()}
    for i, want in enumerate(brute_targets(sizes)):
        assert got[i] == pytest.approx(float(want), rel=1e-12)


def test_many_sources_are_numbered_in_order(spark):
    names = [f"s{i:05d}" for i in range(5000)]
    df = spark.createDataFrame([(n,) for n in random.Random(2).sample(names, len(names))] + [(None,)], "source string").repartition(7)
    got = {r["source"]: r["nth"] for r in mixing.numbered(df, [F.col("source").isNull(), F.col("source")]).collect()}
    assert got == {**{n: i for i, n in enumerate(names)}, None: 5000}


def test_mixture_has_the_planned_copies(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, SCHEMA)
    planned = mixing.plan(df, keep=df.columns)
    want = Counter()
    for r in planned.collect():
        want[(r["kept_0"], r["kept_1"], r["kept_2"])] += r["copies"]
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect()) == Counter({k: v for k, v in want.items() if v})


def test_words_come_near_the_target(spark):
    """Draws are independent: the deviation is that of Bernoulli copies."""
    rows = [(i, "w " * 20, "big" if i % 3 else f"s{i % 7}", 1, "x") for i in range(6000)]
    got = mixing.plan(spark.createDataFrame(rows, SCHEMA), keep=["source"]).collect()
    taken, given_ = Counter(), {}
    for r in got:
        taken[r["kept_0"]] += r["size"] * r["copies"]
        given_[r["kept_0"]] = r["source_size"], r["target"]
    for k, (size, target) in given_.items():
        assert abs(taken[k] - target) <= 5 * (20 * size * 0.25) ** 0.5 + 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.report(mixing.plan(none)).count() == 0 and mixing.mix(none).count() == 0
