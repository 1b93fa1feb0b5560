"""Stored tables that are updated by key: rows in buckets by a hash of the key, and manifests that say which files count.

    path/data/<version>/bucket=<n>/…   rows, written once and never changed
    path/manifests/<version>.json      key, number of buckets, columns, and each bucket's version

A writer reads the latest manifest, writes the buckets that it changes as a new version, and makes the next manifest
appear under its number in one step, which fails if another writer was faster. Readers take the latest manifest, so they see
the table before or after a change. Columns are kept with the table: older files are read with the columns of
today, those that they lack as nulls, those that have been widened in the new type.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import filesystem

#: Types that a column may be given in place of its own, which readers of older files can convert.
WIDER = {"tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp_ntz",)}
NONE = 0  # version of a bucket without rows


class Conflict(Exception):
    """Another writer has changed the table since it was read."""


@dataclass(frozen=True)
class Manifest:
    version: int
    key: str
    columns: str  # the schema as JSON
    buckets: tuple[int, ...]  # the version that holds each bucket's rows

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))


def _bucket(key: str, n: int):
    """A null key is a key like others here: its rows are kept, though no change meets them."""
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(n)).cast("int")


class StoredTable:
    """A table at a path that driver and executors share. Changes return how many buckets they wrote."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- manifests

    def versions(self) -> list[int]:
        fs, at = filesystem(self.spark, f"{self.path}/manifests")
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The latest one, or that of a version; FileNotFoundError if there is none."""
        there = self.versions()
        if not there or (version is not None and version not in there):
            raise FileNotFoundError(f"{self.path}: no manifest{'' if version is None else f' {version}'}")
        number = there[-1] if version is None else version
        fs, at = filesystem(self.spark, f"{self.path}/manifests/{number:010d}.json")
        stream = fs.open(at)
        try:
            data = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return Manifest(number, data["key"], data["columns"], tuple(data["buckets"]))

    def _commit(self, new: Manifest) -> None:
        """The manifest is written aside and renamed to its number, unless that is taken."""
        jvm = self.spark.sparkContext._jvm
        fs, aside = filesystem(self.spark, f"{self.path}/manifests/_{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        try:
            out.write(json.dumps({"key": new.key, "columns": new.columns, "buckets": list(new.buckets)}).encode())
        finally:
            out.close()
        final = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{new.version:010d}.json")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(aside, final, options)
        except Exception as e:
            fs.delete(aside, False)
            if fs.exists(final):
                raise Conflict(f"{self.path}: version {new.version} is there already") from e
            raise

    # ---- reading

    def _read(self, m: Manifest, buckets: list[int] | None = None) -> DataFrame:
        """Rows with their bucket, of all buckets or some; only their folders are listed."""
        own = range(len(m.buckets)) if buckets is None else buckets
        folders = [f"{self.path}/data/{m.buckets[b]:010d}/_bucket={b}" for b in own if m.buckets[b] != NONE]
        rows = self.spark.read.schema(m.schema).parquet(*folders) if folders else self.spark.createDataFrame([], m.schema)
        return rows.withColumn("_bucket", _bucket(m.key, len(m.buckets)))

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of its latest version, or an earlier one."""
        return self._read(self.manifest(version)).drop("_bucket")

    # ---- writing

    def _write(self, rows: DataFrame, version: int, n: int) -> list[int]:
        """Writes rows with _bucket as a version; the buckets that have any. One file for each bucket."""
        folder = f"{self.path}/data/{version:010d}"
        rows.repartition(max(1, n), "_bucket").write.partitionBy("_bucket").mode("errorifexists").parquet(folder)
        fs, at = filesystem(self.spark, folder)
        return [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(at) if f.isDirectory() and "=" in f.getPath().getName()]

    def _free(self, version: int) -> int:
        """A data version that no folder has: a writer that failed may have left its own."""
        fs, _ = filesystem(self.spark, self.path)
        at = lambda v: self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{v:010d}")
        while fs.exists(at(version)):
            version += 1
        return version

    def create(self, df: DataFrame, key: str, buckets: int) -> int:
        """Writes df as the first version; the folder must hold no table."""
        if self.versions():
            raise FileExistsError(self.path)
        version = self._free(1)
        there = self._write(df.withColumn("_bucket", _bucket(key, buckets)), version, buckets)
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        self._commit(Manifest(1, key, plain.json(), tuple(version if b in set(there) else NONE for b in range(buckets))))
        return len(there)

    def merge(self, changes: DataFrame, columns: list[str], insert: bool = False, only_present: bool = False) -> int:
        """Sets columns where the key matches, to null too, or with only_present where a change has a value; with insert,
        other keys are added, with nulls elsewhere.

        Of several changes of a key the largest by value holds; null keys match nothing and add nothing. Only buckets
        with a matching key, or an added one, are read and written anew; without any the table stays as it is."""
        m = self.manifest()
        key, n = m.key, len(m.buckets)
        kinds = {f.name: f.dataType for f in m.schema.fields}
        lost = [c for c in columns if c not in kinds or c == key]
        if lost:
            raise ValueError(f"not columns to set: {lost}")
        new = changes.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").cast(kinds[key]).alias("_key"))
        new = new.agg(F.max(F.struct(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in columns])).alias("_new")).withColumn("_place", F.pmod(F.xxhash64("_key"), F.lit(n)).cast("int"))
        new = new.persist()
        try:
            asked = sorted(r["_place"] for r in new.select("_place").distinct().collect())  # bucket numbers, n at most
            if not insert and asked:  # buckets where a key is there at all
                keys = self._read(m, asked).select(F.col(f"`{key}`").alias("_key"), F.col("_bucket"))
                asked = sorted(r["_bucket"] for r in keys.join(new.select("_key"), "_key", "left_semi").select("_bucket").distinct().collect())
            if not asked:
                return 0
            old = self._read(m, asked)
            here = new.where(F.col("_place").isin(asked))
            joined = old.join(here, F.col(f"`{key}`") == F.col("_key"), "full" if insert else "left")
            hit = F.col("_key").isNotNull()
            set_ = lambda c: F.coalesce(F.col("_new")[c], F.col(f"`{c}`")) if only_present else F.col("_new")[c]
            out = [F.when(hit, set_(c)).otherwise(F.col(f"`{c}`")).alias(c) if c in columns else F.coalesce(F.col(f"`{key}`"), F.col("_key")).alias(c) if c == key else F.col(f"`{c}`") for c in kinds]
            version = self._free(m.version + 1)
            there = set(self._write(joined.select(*out, F.coalesce("_bucket", "_place").alias("_bucket")), version, len(asked)))
            self._commit(replace(m, version=m.version + 1, buckets=tuple(version if b in there else v for b, v in enumerate(m.buckets))))
            return len(there)
        finally:
            new.unpersist()

    # ---- columns

    def add_columns(self, columns: dict[str, str]) -> list[str]:
        """Adds the columns that aren't there, behind the others and null in all rows; no file is touched. Their names."""
        m = self.manifest()
        there = {f.name.lower() for f in m.schema.fields}
        new = {c: t for c, t in columns.items() if c.lower() not in there}
        if new:
            fields = [*m.schema.fields, *[T.StructField(c, T.DataType.fromDDL(t)) for c, t in new.items()]]
            self._commit(replace(m, version=m.version + 1, columns=T.StructType(fields).json()))
        return list(new)

    def widen(self, column: str, kind: str) -> bool:
        """Gives a column a wider type; False if it has it. Narrower and other types are refused with TypeError."""
        m = self.manifest()
        wanted = T.DataType.fromDDL(kind)
        found = {f.name: f.dataType for f in m.schema.fields}
        if column not in found:
            raise ValueError(f"no column {column}")
        if found[column] == wanted:
            return False
        if column == m.key or wanted.simpleString() not in WIDER.get(found[column].simpleString(), ()):
            raise TypeError(f"{column}: {found[column].simpleString()} can't become {wanted.simpleString()}")
        fields = [T.StructField(f.name, wanted if f.name == column else f.dataType) for f in m.schema.fields]
        self._commit(replace(m, version=m.version + 1, columns=T.StructType(fields).json()))
        return True

    def vacuum(self, keep: int = 1) -> int:
        """Deletes manifests but the last `keep`, and data that none of these names; the number of data versions deleted.

        Not beside a writer: what it has written isn't named yet."""
        fs, at = filesystem(self.spark, f"{self.path}/data")
        there = self.versions()
        kept = {v for n in there[-keep:] for v in self.manifest(n).buckets}
        for n in there[:-keep]:
            fs.delete(filesystem(self.spark, f"{self.path}/manifests/{n:010d}.json")[1], False)
        gone = [f.getPath() for f in fs.listStatus(at) if int(f.getPath().getName()) not in kept]
        for p in gone:
            fs.delete(p, True)
        return len(gone)
