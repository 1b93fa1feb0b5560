"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every labelled document counts: each task sums its n-grams in 2**bits buckets for each language, Spark adds
the tasks' sums up, and their smoothed log-probabilities form a matrix that is broadcast. Documents are
scored in batches: the n-grams' rows of the matrix are summed by document in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_blobs, pack_counts, unpack_counts

BITS = 16
LEAST_BITS = 10
ENTRIES = 1 << 24  # numbers in the matrix at most (64 MB): with over 256 languages there are fewer buckets
ORDERS = (1, 2, 3)
SMOOTH = 0.5
SLICE = 4096  # buckets whose counts are added up together
UNKNOWN = "und"


def grams(codes: np.ndarray, order: int, bits: int = BITS) -> np.ndarray:
    """Bucket of the n-gram that starts at each place of a UTF-32 text."""
    n = len(codes) - order + 1
    h = np.full(max(n, 0), order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def codes_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text between blanks; runs of white space as one blank."""
    return np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), np.uint32)


def _buckets(texts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every n-gram, one order after another."""
    parts = [codes_of(x) for x in texts]
    codes = np.concatenate(parts)
    doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    for o in ORDERS:
        inside = doc[: len(codes) - o + 1] == doc[o - 1 :]  # not over the border of two texts
        yield grams(codes, o, bits)[inside], doc[: len(codes) - o + 1][inside]


def _batched(texts: list[str], limit: int = 1 << 20) -> Iterator[slice]:
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= limit):
            size += len(texts[hi])
            hi += 1
        yield slice(lo, hi)
        lo = hi


def _count(bits: int, held: int = 1 << 22):
    """Each task's counts by language and slice; at most about `held` numbers are kept before they are sent."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}

        def send():
            rows = [(lang, k // SLICE, pack_counts(c[k : k + SLICE])) for lang, c in counts.items() for k in range(0, 1 << bits, SLICE) if c[k : k + SLICE].any()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.binary()))], ["lang", "part", "blob"])

        for batch in batches:
            texts, langs = batch["text"].to_pylist(), batch["lang"].to_pylist()
            for part in _batched(texts):
                names = sorted(set(langs[part]))
                if counts and (len(counts.keys() | names) << bits) > held:
                    yield send()
                number = np.array([names.index(x) for x in langs[part]])
                for name in names:
                    counts.setdefault(name, np.zeros(1 << bits, np.int64))
                for bucket, doc in _buckets(texts[part], bits):
                    of = number[doc]
                    for k, name in enumerate(names):
                        counts[name] += np.bincount(bucket[of == k], minlength=1 << bits)
        yield send()

    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """(languages, matrix of log-probabilities, buckets x languages) from the whole texts of all labelled rows.

    Rows without language or text teach nothing; repeated rows count as often as they occur. There are
    2**bits buckets, or fewer, down to 2**LEAST_BITS, if the matrix would have over ENTRIES numbers; labels
    for which even that is too many are refused. id_col isn't read."""
    known = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().limit((ENTRIES >> LEAST_BITS) + 1).collect())
    while bits > LEAST_BITS and len(langs) << bits > ENTRIES:
        bits -= 1
    if len(langs) << bits > ENTRIES:
        raise ValueError(f"more than {ENTRIES >> LEAST_BITS} languages")
    counts = np.full((1 << bits, max(1, len(langs))), SMOOTH)
    if langs:
        place = {x: i for i, x in enumerate(langs)}
        got = add_blobs(known.mapInArrow(_count(bits), "lang string, part int, blob binary"), "lang string, part int")
        for r in got.collect():  # no more numbers than the matrix has
            part = unpack_counts(bytes(r["blob"]))
            counts[r["part"] * SLICE : r["part"] * SLICE + len(part), place[r["lang"]]] += part
    return langs, np.log(counts / counts.sum(0)).astype(np.float32)


def _scores(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """Sum of the n-grams' log-probabilities, by document and language."""
    out = np.zeros((len(texts), matrix.shape[1]))
    for bucket, doc in _buckets(texts, len(matrix).bit_length() - 1):
        for j in range(matrix.shape[1]):
            out[:, j] += np.bincount(doc, matrix[:, j][bucket], len(texts))
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text, with the columns in keep; no shuffle.

    score: the language's posterior probability; of equal ones the first in order is taken. A text that is null or has no letter is `und` with score
    0; so is every text if nothing was learned. Rows with the same or a null id stay as many rows, each judged by
    its text. An empty table gives none; kept columns may have any names, those of the result too."""
    langs, matrix = model
    shared = docs.sparkSession.sparkContext.broadcast(matrix)

    def run(batches):
        table = shared.value
        for batch in batches:
            letters = pc.fill_null(pc.match_substring_regex(batch["text"], r"\p{L}"), False).to_pylist()
            texts = batch["text"].to_pylist()
            preds, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            todo = [i for i, x in enumerate(letters) if x and langs]
            for part in _batched([texts[i] for i in todo]):
                got = _scores([texts[i] for i in todo[part]], table)
                best = got.argmax(1)
                p = 1 / np.exp(got - got[np.arange(len(best)), best][:, None]).sum(1)
                for i, b, s in zip(todo[part], best.tolist(), p.tolist()):
                    preds[i], scores[i] = langs[b], s
            rest = [batch[c] for c in batch.schema.names if c not in ("text",)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [*[c for c in batch.schema.names if c != "text"], "lang_pred", "score"])

    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep or [])])
    kinds = ", ".join(f"kept_{i} {plain.schema[f'kept_{i}'].dataType.simpleString()}" for i in range(len(keep or [])))
    out = plain.mapInArrow(run, "doc_id bigint, " + (kinds + ", " if kinds else "") + "lang_pred string, score double")
    return out.select("doc_id", *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep or [])], "lang_pred", "score")
