"""Substring dedup by prefix-partitioned suffix trees.

Suffixes that begin alike form a group: those that start at an anchor are dealt out by their first 8 words,
and where these words are too frequent for a group, by their first 22 or all 35 (see repeats). For each
place of the anchor in a window a subtree is built top-down, word by word: where all suffixes below a node
go on with the same word the edge grows, where they don't the node branches, and a suffix alone below a node
is a leaf and left at once. Inner nodes that are as deep as the window are maximal repeats of at least its
length; the leaves below them are the places to remove.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import BLOCK_BYTES, HOT, SEGMENT, Unit, descend, grams_of, remove_repeats

WINDOW = 35
GRAM = 8


def _split(body: bytes) -> list[bytes]:
    return body.split()


def _hashes(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.array([h(w) for w in words], np.uint64)


def _join(words: list[bytes], a: int, b: int) -> bytes:
    return b" ".join(words[a:b])


class Subtrees:
    """Suffix trees over the suffixes of stretches that have `window` words, down to that depth.

    roots: each suffix's tree. depth and degree: of the inner nodes above the window's depth; deep: for each
    suffix the number of its inner node at that depth, or of its leaf."""

    def __init__(self, words: np.ndarray, at: np.ndarray, roots: np.ndarray, window: int):
        self.depth, self.degree = [], []

        def branch(step: int, sizes: np.ndarray, parts: np.ndarray, degree: np.ndarray) -> None:
            self.depth += [step] * len(sizes)
            self.degree += degree.tolist()

        self.deep = descend(roots, lambda own, step: words[at[own] + step], window, branch)


def subtrees(texts: list[bytes], anchors: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, start, node) of every suffix that has `window` words; those of a deep inner node share its number.

    A tree holds the suffixes with the same anchor at the same place."""
    number: dict[bytes, int] = {}
    ids = [[number.setdefault(w, len(number)) for w in t.split()] for t in texts]
    size = np.array([len(x) for x in ids], np.int64)
    n = size - window + 1
    words = np.fromiter((x for y in ids for x in y), np.int64, int(size.sum()))
    cls = np.repeat(np.arange(len(texts)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    roots = anchors[cls] * (2 * window) + (offsets[cls] - start)
    return cls, start, Subtrees(words, (np.cumsum(size) - size)[cls] + start, roots, window).deep


def dedup_substrings(docs: DataFrame, window: int = WINDOW, hot: int = HOT, block_bytes: int = BLOCK_BYTES, segment: int = SEGMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, kept): each word goes that a window of `window` words covers which starts anywhere else too.

    spans are runs of removed words, kept the rest joined by single spaces. Null and empty texts have no
    words. Rows with the same doc_id are separate places, so repeated rows remove each other; a null
    doc_id is a document like any other. An empty table gives none; extra columns aren't read."""
    unit = Unit(window, grams_of(window, GRAM), _split, _hashes, _join, b" ", subtrees, True, segment)
    out = remove_repeats(docs, unit, "substrings", hot, block_bytes, id_col, text_col)
    return out.select("doc_id", F.col("n_units").alias("n_words"), "spans", F.col("kept").cast("string").alias("kept"))


def report(found: DataFrame) -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
