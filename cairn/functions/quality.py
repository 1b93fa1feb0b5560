"""Visibility, disclaimers, detail and condition of parsed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import DISCLAIMERS, strip

#: Patterns and hints.
HIDDEN = r"(?iuU)\bEj synlig\b|\bundermark\b|\bunder mark\b|\bövertäckt\b"
VISIBLE = r"(?iuU)\bSynlig ovan mark\b|\bTydligt synlig\b"
MEASURE = r"(?iuU)\b\d+(?:[\.,]\d+)?\s*(?:m|meter|cm|mm)\b"
HINTS = ("kantkedja", "rest sten", "stenkista", "mittgrop", "kerb", "cist", "skyttevärn", "häll", "hällrist", "älvkvarn", "kantställd", "vall", "röse", "stensättning", "tomtning")


def visibility(placement: Column) -> Column:
    """0 not visible, 2 visible, 1 unknown; null counts as unknown."""
    low = F.lower(F.coalesce(placement, F.lit("")))
    return F.when(low.rlike(HIDDEN), 0).when(low.rlike(VISIBLE), 2).otherwise(1)


def disclaimer_present(original: Column, description: Column) -> Column:
    return F.coalesce(original, F.lit("")).rlike(DISCLAIMERS) | F.coalesce(description, F.lit("")).rlike(DISCLAIMERS)


def detail_score(description: Column) -> Column:
    """Measurements, five at most, and the hints that occur."""
    c = F.coalesce(description, F.lit(""))
    hints = sum((F.contains(F.lower(c), F.lit(h)).cast("int") for h in HINTS), F.lit(0))
    return F.least(F.lit(5), F.regexp_count(c, F.lit(MEASURE))) + hints


def condition(original: Column, description: Column) -> Column:
    """0 without description or with a disclaimer, 2 with a detail score of four and more, else 1."""
    bare = strip(F.coalesce(description, F.lit(""))) == ""
    return F.when(bare | disclaimer_present(original, description), 0).when(detail_score(description) >= 4, 2).otherwise(1)


def result_rows(df: DataFrame) -> DataFrame:
    """The result row of each site, from k, description, given (the caption's input), placement, description_sv, reply and error.

    Without usable input the caption is missing and both scores are 0; where the client failed it tells the
    error, both scores are 1 and what was parsed counts for nothing."""
    none, failed = F.col("given") == "", F.col("error").isNotNull()
    plain = ~none & ~failed
    score = lambda c: F.when(none, 0).when(failed, 1).otherwise(c)
    caption = F.when(none, "missing").when(failed, F.concat(F.lit("ERROR: "), "error")).otherwise(F.col("reply"))
    return df.select(
        "k", F.col("description").alias("original_description"), F.when(failed, "").otherwise(F.col("given")).alias("desc_input"), caption.alias("description"),
        score(visibility(F.col("placement"))).alias("visibility"), score(condition(F.col("description"), F.col("description_sv"))).alias("condition_known"), F.when(plain, F.coalesce("placement", F.lit(""))).alias("placement"),
        F.when(plain, disclaimer_present(F.col("description"), F.col("description_sv"))).alias("disclaimer_present"), F.when(plain, detail_score(F.col("description_sv"))).alias("detail_score"),
        F.when(none, "no_usable_description").alias("reason"), "error",
    )
