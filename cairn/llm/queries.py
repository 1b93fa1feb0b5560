"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, media, mixing, oracles, periods, pieces, quality, secrets, simhash, spelling, substrings, suffixes, trees
from .common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op2_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(quality.sample(docs, labels, allowed=fold(F.col("doc_id"), 3) != 1))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "feature")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(substrings.dedup_substrings(table(spark, sf_dir, "documents")))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(suffixes.dedup_suffixes(table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trees.score_documents(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 10) != 0)
    return found.select("doc_id", (fold(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


def op8_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs.where(fold(F.col("doc_id"), 4) != 2)))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, sf_dir, "documents")))


def op11_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(mixing.plan(table(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(periods.find_runs(table(spark, sf_dir, "documents"), change=periods.planted))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), change=spelling.dropped)


QUERIES = {f.__name__: f for f in (op1_simhash_near_duplicates, op2_quality_compression, op3_substring_dedup, op4_suffix_array_dedup, op5_decontamination, op6_suffix_tree_scores, op7_sentencepiece, op8_media_chunks, op9_language_id, op10_secret_scan, op11_source_mixture, op12_periodic_runs, op13_spelling_variants)}
ORACLES = {"op3_substring_dedup": oracles.SUBSTRINGS, "op4_suffix_array_dedup": oracles.SUFFIXES, "op5_decontamination": oracles.CONTAMINATION, "op11_source_mixture": oracles.MIXTURE}
