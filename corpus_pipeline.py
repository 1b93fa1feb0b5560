"""Training-data pipeline over documents: five stages, each written as Parquet and read by the next.

Language ID drops documents without any letter and names the language where none is given; SimHash keeps one document of each near-duplicate group;
documents that benchmark phrases contaminate go; secrets are replaced by a mark; SentencePiece encodes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import decontaminate, language, pieces, secrets, simhash
from cairn.llm.common import clear_staged, fold, staged, staged_so_far


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; null texts and texts without any letter are rejected. A null lang becomes the predicted one."""
    found = language.identify(docs, language.fit(docs.where(fold(F.col("doc_id"), 4) != 2)), keep=docs.columns)
    # kept columns may be called as the prediction is, so they are told apart by their place
    found = found.toDF("id", *[f"kept_{i}" for i in range(len(docs.columns))], "lang_pred", "score").where(F.col("lang_pred") != language.UNKNOWN)
    return found.select(*[(F.coalesce(f"kept_{i}", "lang_pred") if c == "lang" else F.col(f"kept_{i}")).alias(c) for i, c in enumerate(docs.columns)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that with the smallest id, null last."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the rule's share of benchmark words; null and empty texts stay, and repeated rows are judged each."""
    others = [c for c in docs.columns if c != "doc_id"]
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=others)
    judged = decontaminate.verdicts(found, keep=others)
    return judged.where(~F.col("contaminated")).select("doc_id", *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(others)]).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated rows too; each secret in a text becomes a mark, and n_chars follows. Null texts stay null, and texts without secrets as they are."""
    found = secrets.scan(docs, keep=[c for c in docs.columns if c != "doc_id"])
    clean = secrets.redact("coalesce(text, '')", "spans")
    changed = F.size("spans") > 0
    out = found.withColumn("text", F.when(changed, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their digests of every document left, a row for each row; null texts have no ids."""
    coded = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(coded, ids=True)


STAGES = [("language_id", keep_languages), ("simhash_near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("secret_scan", redact_secrets), ("sentencepiece", encode)]
#: Fitted models, components and merge-type encoding have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table. What stages wrote before it is gone; it stays until clear_staged."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = staged_so_far()
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear_staged(spark, before, last=True)  # the stage's input, and what it wrote for itself
    return docs
