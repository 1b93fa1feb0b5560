"""Helpers that the corpus operators share: reading documents, shared scratch tables, document blocks."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []  # the folder of a local session without a setting
_made: list[str] = []  # tables that this session has staged: their folders
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, body binary): whole texts as UTF-8 bytes, a null text as no bytes.

    Only the two named columns are read, so further columns of any name do no harm."""
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))


def fold(col: Column, n: int) -> Column:
    """crc32 of the id's text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a new local one only where none is set and Spark is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="cairn-"))
        at = _local[0]
    return at.rstrip("/")


@contextmanager
def _tidy(spark: SparkSession):
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it again: cuts the lineage, survives lost executors.

    The shuffle files of the job that wrote it go at once; the table itself stays until the folder is cleared."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    with _tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, n: int | None = None, compression: str = "none") -> DataFrame:
    """df as a staged table in n buckets by a key: joins and groups on the key read it without an exchange."""
    spark = df.sparkSession
    table, n = f"{name}_{uuid.uuid4().hex}", n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/{table}"
    _made.append(path)
    with _tidy(spark):
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).option("compression", compression).saveAsTable(table)
    return spark.table(table)


def staged_so_far() -> int:
    return len(_made)


def clear_staged(spark: SparkSession, keep: int = 0, last: bool = False) -> None:
    """Delete the tables that this session has staged, but for the first `keep` and, if so asked, the last; results that read them must have been written before."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    spared = [_made.pop()] if last and len(_made) > keep else []
    gone = [_made.pop() for _ in range(len(_made) - keep)]
    _made.extend(spared)
    for name in gone:
        spark.sql(f"DROP TABLE IF EXISTS `{name.rsplit('/', 1)[-1]}`")  # of those in buckets
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def total_bytes(docs: DataFrame) -> int:
    """Bytes of all bodies (one row reaches the driver)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("n")).first()["n"]


def block_count(spark: SparkSession, n_bytes: int, block_bytes: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // block_bytes), 1)


def in_blocks(docs: DataFrame, n_blocks: int) -> DataFrame:
    """Adds block, by a hash of id and text: the same row lies in the same block in every job, and rows that share an id don't crowd one."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "body"), F.lit(n_blocks)).cast("int"))


def pack_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(counts, "<i8").tobytes())


def unpack_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i8")


def add_blobs(rows: DataFrame, keys: str, levels: tuple[int, ...] = (4096, 64, 1)) -> DataFrame:
    """rows: columns keys (name and type) and blob, counts of equal length for the same keys; their sums by keys.

    Tasks are added up in levels, so no group holds the blobs of all tasks."""
    names = [x.split()[0] for x in keys.split(",")]

    def add(table: pa.Table) -> pa.Table:
        total = None
        for x in table["blob"]:
            one = unpack_counts(x.as_py())
            total = one.copy() if total is None else total + one
        return pa.table({**{c: table[c][:1] for c in (*names, "salt")}, "blob": pa.array([pack_counts(total)], pa.binary())})

    rows = rows.withColumn("salt", F.spark_partition_id())
    for n in levels:
        rows = rows.withColumn("salt", F.col("salt") % n).groupBy(*names, "salt").applyInArrow(add, f"{keys}, salt int, blob binary")
    return rows.drop("salt")
