"""Mixing sources to target weights.

Tokens are summed up by source. Each source's target is its weight's share of all tokens, at most `most` times
what it has; what is over goes to the others by weight. The repetition rate is target / tokens: each document is
taken floor(rate) times, and once more if a hash of seed, id and text falls below the rate's fraction.

The sources are a table of their own and may be many: they are numbered by partitions, and what the driver learns
of them is a few sums. Documents meet their source's rate in a join that Spark plans by the table's real size, so
a source with most of the documents is broadcast to or split, never gathered.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 11
HASH_BITS = 52  # of the md5 that a draw takes: exact as a double


def words(text: Column) -> Column:
    """Number of words, by one pass over the text that keeps no list of them."""
    marks = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[^\\x20\\x09-\\x0D]+", "x")
    return F.length(F.translate(marks, " \t\n\x0b\f\r", "")).cast("bigint")


def draw(id_: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1), the same for the same id, text and seed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint") / F.lit(float(2**HASH_BITS))


def numbered(sources: DataFrame, order: list) -> DataFrame:
    """Adds nth, 0 for the first by the order, without gathering the rows: places in range partitions behind the partitions' sizes."""
    dealt = staged(sources.orderBy(*order).withColumn("part", F.spark_partition_id()), "mix-order")
    ahead = dealt.groupBy("part").count()
    ahead = ahead.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("ahead"))  # a row for each partition
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return dealt.withColumn("place", place).join(F.broadcast(ahead), "part").withColumn("nth", F.col("ahead") + F.col("place")).drop("part", "place", "ahead")


def targets(totals: DataFrame, most: int = MOST) -> DataFrame:
    """totals: source, source_size bigint, weight int. Adds target: weight's share of all sizes, up to most times the size.

    Sources above it stop there, and the rest is shared anew, until none is above. Each round is one aggregate; in
    exact numbers, a source stops if most * size * (weights left) < (size left) * weight."""
    num = lambda c: F.col(c).cast("decimal(38,0)")
    one = totals.agg(F.coalesce(F.sum(num("source_size")), F.lit(0)).alias("size"), F.coalesce(F.sum(num("weight")), F.lit(0)).alias("weight")).first()
    left, weight = Decimal(one["size"]), Decimal(one["weight"])

    def stops() -> Column:
        return num("source_size") * F.lit(most * weight).cast("decimal(38,0)") < num("weight") * F.lit(left).cast("decimal(38,0)")

    while True:
        out = stops()
        got = totals.agg(F.coalesce(F.sum(F.when(out, num("source_size"))), F.lit(0)).alias("size"), F.coalesce(F.sum(F.when(out, num("weight"))), F.lit(0)).alias("weight")).first()
        new = Decimal(one["size"]) - most * Decimal(got["size"]), Decimal(one["weight"]) - Decimal(got["weight"])
        if new == (left, weight):  # those that stop have been left out already
            break
        left, weight = new
    share = F.lit(float(left) / float(weight) if weight else 0.0)
    return totals.withColumn("target", F.when(stops(), (F.lit(most) * F.col("source_size")).cast("double")).otherwise(share * F.col("weight")))


def rates(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, source_size, weight, target) of every source: by code point, null last, they weigh as the weights say, repeating."""
    sized = docs.select(F.col(f"`{source_col}`").cast("string").alias("source"), words(F.col(f"`{text_col}`")).alias("size"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    order = [F.col("source").isNull(), F.col("source")]
    return staged(targets(staged(numbered(totals, order).withColumn("weight", weight).drop("nth"), "mix-totals"), most), "mix-targets")


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, copies) of every row, then the columns `keep` as kept_0, kept_1, ….

    Null texts have no words; a null source is a source, the last. A source without words has the target 0 and no
    copies. Rows with the same id and text share their draw, so repeated rows are taken equally often; ties don't
    arise. Very long texts are counted by one replacement. An empty table gives none; extra columns aren't read
    unless they are kept, whatever their names."""
    given = rates(docs, weights, most, source_col, text_col)
    text, id_ = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    rows = docs.select(id_.cast("bigint").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), words(text).alias("size"), draw(id_, text, seed).alias("draw"), *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)])
    given = given.select(F.col("source").alias("of"), "source_size", "target")
    joined = rows.join(given, F.col("source").eqNullSafe(F.col("of")))
    rate = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    copies = F.floor(rate).cast("bigint") + (F.col("draw") < rate - F.floor(rate)).cast("bigint")
    return joined.select("doc_id", "size", "source_size", "target", copies.alias("copies"), *[f"kept_{i}" for i in range(len(keep))])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: the rows of docs with their columns, each as often as plan says."""
    got = plan(docs, weights, most, seed, id_col, text_col, source_col, keep=docs.columns).where("copies > 0")
    got = got.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return got.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(planned: DataFrame) -> DataFrame:
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
