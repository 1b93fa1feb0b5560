"""Suffix-array dedup by depth-limited radix sort, over the bytes of texts.

Suffixes are ordered only through the threshold: most-significant-digit passes of eight bytes split groups
of suffixes that still agree, each by counting passes of 16 bits, and a suffix that is alone is left where it
is. The groups that are left after the last digit are exactly the repeated windows; the smallest document of
each keeps its bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import BLOCK_BYTES, HOT, MULT, SEGMENT, Unit, descend, grams_of, remove_repeats

WINDOW = 50
GRAM = 16
DIGIT = 8
_TABLE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(MULT)) ^ (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(7))


def _split(body: bytes) -> bytes:
    return body


def _hashes(body: bytes) -> np.ndarray:
    return _TABLE[np.frombuffer(body, np.uint8)]


def _join(body: bytes, a: int, b: int) -> bytes:
    return body[a:b]


def radix_groups(texts: list[bytes], anchors: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, start, group) of every suffix that has `window` bytes; equal windows share a group.

    The first pass's digit is what the suffixes are grouped by: anchor and place in the window."""
    size = np.array([len(t) for t in texts], np.int64)
    n = size - window + 1
    whole = b"".join(texts) + bytes(DIGIT)
    digits = np.ndarray((len(whole) - DIGIT + 1,), ">u8", whole, strides=(1,))
    cls = np.repeat(np.arange(len(texts)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(size) - size)[cls] + start

    def digit(own: np.ndarray, step: int) -> np.ndarray:
        found = digits[at[own] + step * DIGIT].astype(np.uint64)
        left = window - step * DIGIT
        return found if left >= DIGIT else found >> np.uint64(8 * (DIGIT - left))

    return cls, start, descend(anchors[cls] * (2 * window) + (offsets[cls] - start), digit, -(-window // DIGIT))


def dedup_suffixes(docs: DataFrame, window: int = WINDOW, hot: int = HOT, block_bytes: int = BLOCK_BYTES, segment: int = SEGMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept binary): each byte goes that a window of `window` bytes covers which also starts in a document with a smaller doc_id.

    Null texts are empty. Rows with the same doc_id are one document as to order: neither removes the
    other. A null doc_id comes after all others. kept may break a character, so it is binary. An empty table
    gives none; extra columns aren't read."""
    unit = Unit(window, grams_of(window, GRAM), _split, _hashes, _join, b"", radix_groups, False, segment)
    out = remove_repeats(docs, unit, "suffixes", hot, block_bytes, id_col, text_col)
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "spans", "kept")


def report(found: DataFrame) -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
