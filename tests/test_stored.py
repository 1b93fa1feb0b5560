"""Stored tables: changes by key, versions, columns that come and widen."""

import glob

import pytest
from pyspark.sql import functions as F

from cairn.sources.stored import Conflict, StoredTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    t = StoredTable(spark, f"file://{tmp_path}/t")
    t.create(spark.createDataFrame([(f"k{i}", i, f"text {i}") for i in range(400)] + [(None, -1, "no key")], "id string, n int, text string"), "id", 40)
    return t


def files(t):
    return set(glob.glob(t.path.removeprefix("file://") + "/data/**/*.parquet", recursive=True))


def test_changes_touch_their_buckets_only(spark, table):
    before, old = files(table), table.read()
    assert table.merge(spark.createDataFrame([("k1", "new", 7), ("k2", None, None), ("gone", "x", 1), (None, "x", 1)], "id string, text string, n int"), ["text", "n"]) <= 2
    new = files(table) - before
    assert len(new) <= 2 and before <= files(table)  # nothing is changed in place
    want = [(f"k{i}", *{1: (7, "new"), 2: (None, None)}.get(i, (i, f"text {i}"))) for i in range(400)] + [(None, -1, "no key")]
    assert rows(table.read()) == sorted(want, key=str)
    assert rows(old) == rows(table.read(1)) == sorted([(f"k{i}", i, f"text {i}") for i in range(400)] + [(None, -1, "no key")], key=str)
    one_percent = spark.createDataFrame([(f"k{i}", "again") for i in range(4)], "id string, text string")
    before = files(table)
    assert len(files(table) - before) <= table.merge(one_percent, ["text"]) <= 4


def test_no_match_writes_nothing(spark, table):
    before = files(table)
    assert table.merge(spark.createDataFrame([("zzz", "x"), (None, "x")], "id string, text string"), ["text"]) == 0
    assert table.merge(spark.createDataFrame([], "id string, text string"), ["text"]) == 0
    assert files(table) == before and table.versions() == [1]


def test_insert_and_repeated_changes(spark, table):
    changes = spark.createDataFrame([("new", "a"), ("new", "b"), ("k5", "a"), ("k5", "b"), ("k5", None)], "id string, text string")
    table.merge(changes, ["text"], insert=True)
    got = {r["id"]: (r["n"], r["text"]) for r in table.read().collect()}
    assert got["new"] == (None, "b") and got["k5"] == (5, "b") and len(got) == 402
    with pytest.raises(ValueError):
        table.merge(changes, ["id"])


def test_one_of_two_writers_wins(spark, table):
    other = StoredTable(spark, table.path)
    stale = other.manifest()
    table.merge(spark.createDataFrame([("k1", "first")], "id string, text string"), ["text"])
    other.manifest = lambda version=None: stale
    with pytest.raises(Conflict):
        other.merge(spark.createDataFrame([("k1", "second")], "id string, text string"), ["text"])
    del other.manifest
    assert {r["text"] for r in other.read().where("id = 'k1'").collect()} == {"first"}
    other.merge(spark.createDataFrame([("k1", "third")], "id string, text string"), ["text"])  # what the loser left is no hindrance
    assert {r["text"] for r in table.read().where("id = 'k1'").collect()} == {"third"} and table.versions() == [1, 2, 3]


def test_a_writer_that_dies_leaves_the_table(spark, table):
    def dies(new):
        raise RuntimeError("lost")

    broken = StoredTable(spark, table.path)
    broken._commit = dies
    with pytest.raises(RuntimeError):
        broken.merge(spark.createDataFrame([("k1", "half")], "id string, text string"), ["text"])
    assert table.versions() == [1] and table.read().where("text = 'half'").count() == 0
    assert table.vacuum() == 1 and table.read().count() == 401


def test_columns_come_and_widen(spark, table):
    """Files of three schemas are read as one, in the order of the columns."""
    assert table.add_columns({"description": "string", "TEXT": "string", "score": "double"}) == ["description", "score"]
    table.merge(spark.createDataFrame([("k1", "d1", 0.5)], "id string, description string, score double"), ["description", "score"])
    assert table.widen("n", "bigint") and not table.widen("n", "bigint")
    table.merge(spark.createDataFrame([("k2", 2**40)], "id string, n bigint"), ["n"])
    got = table.read()
    assert got.dtypes == [("id", "string"), ("n", "bigint"), ("text", "string"), ("description", "string"), ("score", "double")]
    by = {r["id"]: tuple(r)[1:] for r in got.collect()}
    assert by["k1"] == (1, "text 1", "d1", 0.5) and by["k2"] == (2**40, "text 2", None, None) and by["k3"] == (3, "text 3", None, None)
    for column, kind in (("n", "int"), ("text", "int"), ("id", "int"), ("score", "string")):
        with pytest.raises(TypeError):
            table.widen(column, kind)
    with pytest.raises(ValueError):
        table.widen("absent", "int")
    assert table.read(1).columns == ["id", "n", "text"]


def test_every_widening_reads_older_files(spark, tmp_path):
    from cairn.sources.stored import WIDER

    for kind, wider in WIDER.items():
        for k, to in enumerate(wider):
            t = StoredTable(spark, f"file://{tmp_path}/{kind}{k}")
            v = "date '2024-02-29'" if kind == "date" else f"cast(7 as {kind})"
            t.create(spark.range(4).select(F.col("id"), F.expr(v).alias("v")), "id", 2)
            t.widen("v", to)
            assert {r["v"] for r in t.read().collect()} == {spark.range(1).select(F.expr(v).cast(to)).first()[0]}


def test_vacuum(spark, table):
    for k in range(3):
        table.merge(spark.createDataFrame([("k1", f"v{k}")], "id string, text string"), ["text"])
    assert table.vacuum(2) == 1 and table.versions() == [3, 4]
    assert table.read().count() == 401 and table.read(3).where("text = 'v1'").count() == 1
    with pytest.raises(FileNotFoundError):
        table.read(1)


def test_empty_and_absent(spark, tmp_path):
    t = StoredTable(spark, f"file://{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.create(spark.createDataFrame([], "id string, n int"), "id", 4)
    assert t.read().count() == 0 and t.merge(spark.createDataFrame([("a", 1)], "id string, n int"), ["n"]) == 0
    assert t.merge(spark.createDataFrame([("a", 1)], "id string, n int"), ["n"], insert=True) == 1 and rows(t.read()) == [("a", 1)]
    with pytest.raises(FileExistsError):
        t.create(spark.createDataFrame([], "id string, n int"), "id", 4)
