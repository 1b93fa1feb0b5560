"""Media columns: payloads cut into content-defined chunks, each chunk stored once.

A gear hash rolls over the payload; a chunk ends where its top bits are zero, so equal stretches are cut
alike wherever they lie. Half of a chunk's SHA-256 is its key, and half of a payload's. The store is a
written table with one row for each digest, in buckets by digest; the manifest has each distinct payload's
ordered digests. What is read back from the store, joined and put in order gives the payload again, which is
checked chunk by chunk and as a whole.
"""

from __future__ import annotations

import bz2
import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, staged, texts

FRAME = 576  # payloads are padded to a positive multiple
PAD = b"\xff"
LEAST, MOST, CUT_BITS = 256, 16384, 10  # bytes of a chunk; an end every 2**CUT_BITS bytes
HOT = 256  # references to one chunk that make a pack
COPY = 256  # packs for which one copy of a chunk is made
ROUNDS = 2  # chunks are stored and read back in so many parts, so only a part of their bodies is in flight
GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)).astype(np.uint32)


def key_of(data: bytes) -> bytes:
    """128 bits of the SHA-256."""
    return hashlib.sha256(data).digest()[:16]


def payload(body: bytes) -> bytes:
    return body + PAD * (max(1, -(-len(body) // FRAME)) * FRAME - len(body))


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks. The hash of a place is the sum of gear[b] << age over the last 32 bytes."""
    n, out, at = len(data), [], 0
    if n > LEAST:
        h = GEAR[np.frombuffer(data, np.uint8)]
        for k in (1, 2, 4, 8, 16):
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
        ends = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
        while n - at > LEAST:
            k = int(np.searchsorted(ends, at + LEAST))
            at = min(int(ends[k]) if k < len(ends) else n, at + MOST, n)
            out.append(at)
    if at < n:
        out.append(n)
    return out


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _names(batches):
    """Each document's payload key, and its ordered chunk keys."""
    for b in batches:
        out = []
        for body in b["body"].to_pylist():
            data = payload(body)
            out.append((len(body), key_of(data), [key_of(x) for x in chunks(data)]))
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.list_(pa.binary()))], ["doc_id", "n_bytes", "pay", "digests"])


def _bodies(part: int, rounds: int):
    """Stored form of a part's chunks; a chunk that the task has just sent isn't sent again."""

    def run(batches):
        sent: set[bytes] = set()
        for b in batches:
            keys, stored = [], []
            for body in b["body"].to_pylist():
                for x in chunks(payload(body)):
                    key = key_of(x)
                    if key[0] % rounds == part and key not in sent:
                        if len(sent) > 200_000:
                            sent.clear()
                        sent.add(key)
                        keys.append(key)
                        stored.append(bz2.compress(x, 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(stored, pa.binary())], ["digest", "stored"])

    return run


def feature(data: bytes, n_chunks: int) -> str:
    """Number of chunks, mean and entropy of the samples."""
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    p = n[n > 0] / len(data)
    return f"chunks={n_chunks};mean={(n * np.arange(256)).sum() / len(data):.2f};entropy={abs(-(p * np.log2(p)).sum()):.3f}"


RESULT = "pay binary, payload_bytes bigint, payload_sha256 binary, tail_crc32 bigint, media_bytes bigint, media_sha256 binary, feature string"


def _rebuild(batches):
    """Payloads from their chunks, which come in order."""
    names = ["pay", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    out: list[list] = []
    now, parts, form = None, [], None

    def close():
        data = b"".join(parts)
        whole = hashlib.sha256(data).digest()
        if whole[:16] != now:
            raise ValueError("a payload doesn't come back as it was")
        out.append([now, len(data), whole, zlib.crc32(data[-32:]), size, form.digest(), feature(data, len(parts))])

    def batch():
        cols = list(zip(*out)) if out else [[]] * 7
        kinds = [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    size = 0
    for b in batches:
        for pay, digest, stored in zip(b["pay"].to_pylist(), b["digest"].to_pylist(), b["stored"].to_pylist()):
            if pay != now:
                if now is not None:
                    close()
                now, parts, form, size = pay, [], hashlib.sha256(), 0
            x = bz2.decompress(stored)
            if key_of(x) != digest:
                raise ValueError("a chunk doesn't have its key")
            record = digest + struct.pack("<II", len(x), len(stored)) + stored
            form.update(record)
            size += len(record)
            parts.append(x)
        if out:
            yield batch()
            out.clear()
    if now is not None:
        close()
        yield batch()


def in_part(key: str, part: int, rounds: int):
    """Condition on a key: its first byte tells its part."""
    return F.expr(f"cast(conv(hex(substring({key}, 1, 1)), 16, 10) as int) % {rounds} = {part}")


def store(docs: DataFrame, part: int = 0, rounds: int = 1) -> DataFrame:
    """(digest, stored): each distinct chunk of a part of the payloads' chunks once, written as a table in buckets by digest."""
    found = docs.select("body").mapInArrow(_bodies(part, rounds), "digest binary, stored binary").groupBy("digest").agg(F.first("stored").alias("stored"))
    return bucketed(found, "media_chunks", "digest")


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_bytes and what is read back from the chunk store for every document.

    Null and empty texts are one frame of padding. Documents with equal texts share one rebuilt payload.
    A chunk with more than `hot` references is joined in packs of about that many, by copies of the chunk that
    serve COPY packs each, and the packs are then dealt out; so no task makes or joins all of its copies. Rows
    with the same or a null doc_id stay as many rows; an empty table gives none; extra columns aren't read."""
    docs = texts(docs, id_col, text_col)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = staged(docs.mapInArrow(_names, "doc_id bigint, n_bytes bigint, pay binary, digests array<binary>"), "media-names")
    manifest = named.groupBy("pay").agg(F.first("digests").alias("digests")).select("pay", F.posexplode("digests").alias("ord", "digest"))
    manifest = staged(manifest, "media-manifest")
    crowded = staged(manifest.groupBy("digest").agg(F.count("*").alias("refs")).where(F.col("refs") > hot), "media-crowded")
    marked = manifest.join(crowded, "digest", "left").withColumn("pack", F.when(F.col("refs").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("pay", "ord"), F.ceil(F.col("refs") / hot))))
    place = [F.col("place.pay").alias("pay"), F.col("place.ord").alias("ord"), "digest", "stored"]
    stores = [store(docs, k, rounds) for k in range(rounds)]
    rebuilt = None
    for r in range(rounds):
        packs = marked.where(in_part("pay", r, rounds)).groupBy("digest", "pack").agg(F.collect_list(F.struct("pay", "ord")).alias("places"))
        parts = None
        for k, kept in enumerate(stores):
            own = packs.where(in_part("digest", k, rounds))
            few = kept.join(own.where("pack = 0"), "digest").withColumn("place", F.explode("places")).select(*place)
            copies = kept.join(crowded, "digest").withColumn("copy", F.explode(F.sequence(F.lit(0), F.floor((1 + F.col("refs") / hot) / COPY).cast("int")))).drop("refs")
            shared = own.where("pack > 0").withColumn("copy", F.floor(F.col("pack") / COPY).cast("int"))
            many = copies.join(shared, ["digest", "copy"]).repartition(n, "digest", "pack").withColumn("place", F.explode("places")).select(*place)
            both = few.unionByName(many)
            parts = both if parts is None else parts.unionByName(both)
        back = staged(parts.repartition(n, "pay").sortWithinPartitions("pay", "ord").mapInArrow(_rebuild, RESULT), "media-rebuilt")
        rebuilt = back if rebuilt is None else rebuilt.unionByName(back)
    out = named.select("doc_id", "n_bytes", "pay").join(rebuilt, "pay").drop("pay")
    hexed = lambda c: F.lower(F.hex(c))
    return out.withColumns({c: hexed(c) for c in ("payload_sha256", "media_sha256")})
