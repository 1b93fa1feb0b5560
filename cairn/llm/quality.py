"""Quality classifier by compression: how much shorter a text gets with a dictionary of good than of bad texts.

Zstandard dictionaries hold raw text of each class, once as it is and once as its shape (letters, capitals
and digits each as one sign), which all languages share. The difference of the two compressed sizes, divided
by their sum, is a feature of the text and one of its shape; a third is the mean compressed size by byte,
which is low for text that repeats itself. A logistic curve fitted on labelled documents outside the
dictionaries turns them into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

SAMPLE = 1200  # labelled documents of each class that are looked at, the first by a hash of the id
SAMPLE_BYTES = 32_768  # of a longer text, so much from its middle is taken for training
DICT_BYTES = 160_000  # of text in each dictionary
PIECE = 2000  # bytes from the middle of a document that go into a dictionary
LEVEL = 3


def sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality", n: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", allowed=None) -> list[tuple[int, bytes, int]]:
    """(id, text, label) of at most n labelled documents of each class, in a fixed order: at most 2 n rows reach the driver.

    allowed: a condition on the column doc_id. Documents with contradictory or null labels are left out. Of
    a text over SAMPLE_BYTES its middle stands for it, so no class loses its long texts; of rows with the same
    doc_id the smallest text stands for all. Extra columns of either table aren't read."""
    marks = labels.select(F.col("`doc_id`").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    if allowed is not None:
        marks = marks.where(allowed)
    marks = marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("doc_id", "label")
    picked = None
    for k in (0, 1):
        own = marks.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = own if picked is None else picked.unionByName(own)
    middle = F.expr(f"substring(body, cast(greatest(0, octet_length(body) - {SAMPLE_BYTES}) div 2 as int) + 1, {SAMPLE_BYTES})")
    rows = texts(docs, id_col, text_col).select("doc_id", middle.alias("body")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("body").alias("body")).collect()
    return sorted(((r["doc_id"], bytes(r["body"]), r["label"]) for r in rows), key=lambda r: (r[0] * 2654435761 % (1 << 32), r[0]))


#: Shape of a text: lower-case and other letters, capitals, digits; the rest stays.
SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)


class Compressors:
    """Features of a text from its sizes under the dictionaries."""

    def __init__(self, bad: bytes, good: bytes):
        self.plain = _compressor(bad), _compressor(good)
        self.shape = _compressor(bad.translate(SHAPE)), _compressor(good.translate(SHAPE))

    def features(self, body: bytes) -> list[float]:
        """Normalised size difference of the text and of its shape, and the text's mean size by byte; zeros if empty."""
        if not body:
            return [0.0, 0.0, 0.0]
        out = []
        for both, x in ((self.plain, body), (self.shape, body.translate(SHAPE))):
            b, g = (len(c.compress(x)) - 7 for c in both)  # without what every frame has
            out.append((b - g) / max(1, b + g))
            if x is body:
                rate = (b + g) / 2 / len(body)
        return [*out, rate]


def curve(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[list[float], float]:
    """Weights and offset of a logistic curve by Newton's method, with a small ridge."""
    if not len(x):
        return [0.0] * 3, 0.0
    mean, scale = x.mean(0), x.std(0) + 1e-9
    rows = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    w = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        grad = rows.T @ (p - y) + 1e-2 * w
        hess = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(hess, grad), -3, 3)
    weights = w[:-1] / scale
    return weights.tolist(), float(w[-1] - weights @ mean)


def fit(rows: list[tuple[int, bytes, int]], dict_bytes: int = DICT_BYTES, piece: int = PIECE) -> dict:
    """Dictionaries from every other document of each class, a stretch from each one's middle; the curve from the rest."""
    own = {k: [b for _, b, label in rows if label == k] for k in (0, 1)}
    cut = lambda x: x[max(0, len(x) - piece) // 2 :][:piece]
    bad, good = (b"\n".join(cut(x) for x in own[k][::2])[:dict_bytes] for k in (0, 1))
    n = min(len(bad), len(good)) or dict_bytes  # equally long, if there are both
    model = {"bad": bad[:n], "good": good[:n]}
    sizes = Compressors(model["bad"], model["good"])
    held = [(b, k) for k in (0, 1) for b in own[k][1::2]]
    weights, offset = curve(np.array([sizes.features(b) for b, _ in held]), np.array([k for _, k in held], float))
    return model | {"weights": weights, "offset": offset}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, feature, score) of every whole text; no shuffle. feature: the text's normalised size difference.

    Null and empty texts have all features 0, so the curve's offset decides. Without any training rows every
    score is 0.5. Rows stay as they are: equal texts have equal scores, rows with the same or a null doc_id
    are scored each, and extra columns of any name aren't read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        sizes = Compressors(m["bad"], m["good"])
        for batch in batches:
            x = np.array([sizes.features(b) for b in batch["body"].to_pylist()]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(x @ np.array(m["weights"]) + m["offset"], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(x[:, 0]), pa.array(p)], ["doc_id", "feature", "score"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, feature double, score double")
