"""SentencePiece merge models: exact encoding by backtracking, and decoding.

Instead of merging pair by pair from single characters, a chunk is covered from left to right by the
longest known pieces (found by one Aho-Corasick pass). A piece may follow its neighbour only if merging
the two pieces' text anew gives just these two again; if none may follow, the last piece is taken back
for the next shorter one, and a bitfield remembers positions from which no way leads on. A sequence whose
neighbours are all compatible is the one that merging gives.
"""

from __future__ import annotations

import re
import struct
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
MODEL_LIMIT = 32 << 20  # a model file above this isn't sent to the executors
LETTER = re.compile(r"[^\W\d_]")
BYTES_KEPT = 96 << 20  # of chunks with their encodings, about, that a Python worker remembers; then it starts anew
LONG = 64  # characters of a chunk that is remembered at most
PAIRS_KEPT = 500_000  # pairs of pieces, some 200 bytes each


def _fields(data: bytes):
    """(number, value) of a protobuf message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(wire) or number()
            yield tag >> 3, data[at : at + n]
            at += n


class PieceModel:
    """Encoder and decoder of one model file (type BPE, identity normaliser)."""

    def __init__(self, data: bytes):
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.text: list[str | int] = []  # a piece, or the byte of a byte piece
        self.bytes = [0] * 256
        self.unknown, self.fallback, self.prefix = 0, False, True
        for field, value in _fields(data):
            if field == 1:
                self._piece(dict(_fields(value)))
            elif field == 2:
                spec = dict(_fields(value))
                self.fallback = bool(spec.get(35, 0))
                if spec.get(3, 1) != 2:
                    raise ValueError("not a BPE model")
            elif field == 3:
                spec = dict(_fields(value))
                self.prefix = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1):
                    raise ValueError("only the identity normaliser that keeps white space is supported")
        if any(SPACE in x.lstrip(SPACE) for x in self.id):
            self.chunks = re.compile(r"[\s\S]+")
        elif any("\n" in x for x in self.id):
            self.chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        elif any(bool(LETTER.match(a)) != bool(LETTER.match(b)) for x in self.id for a, b in zip(x, x[1:]) if SPACE not in (a, b)):
            self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        else:  # no piece goes over a line end, from a letter to something else or back, or from something to a space
            self.chunks = re.compile(rf"{SPACE}*[^\W\d_]+|{SPACE}*(?:(?![{SPACE}\n])[\W\d_])+|{SPACE}+|\n")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple] = {}
        self.held = 0  # bytes of known, about
        self.shorter: dict[str, str | None] = {}
        self.find = ahocorasick.Automaton()
        for x in self.id:
            if self.merged(x) == [x]:  # others never come out of merging
                self.find.add_word(x, x)
        self.find.make_automaton()
        for x in self.find.keys():
            self.shorter[x] = next((x[:n] for n in range(len(x) - 1, 0, -1) if x[:n] in self.find), None)

    def _piece(self, spec: dict) -> None:
        text, kind, at = spec[1].decode(), spec.get(3, 1), len(self.text)
        self.text.append(text)
        if kind in (4, 5):
            raise ValueError("user-defined and unused pieces aren't supported")
        if kind == 1:
            self.id[text] = at
            self.score[text] = struct.unpack("<f", spec[2])[0]
        elif kind == 6:
            self.bytes[int(text[3:5], 16)] = at
            self.text[at] = int(text[3:5], 16)
        elif kind == 2:
            self.unknown = at

    def merged(self, text: str) -> list[str]:
        """The pieces by merging: the best pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _fits(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[(left, right)] = self.merged(left + right) == [left, right]
        return known

    def cover(self, chunk: str) -> list[str]:
        """The pieces of a chunk; characters that are no piece stand alone.

        Longest matches that all fit their neighbours are the answer at once; else it takes backtracking."""
        out = [x for _, x in self.find.iter_long(chunk)]
        if "".join(out) == chunk:
            pairs, last = self.pairs, None
            for x in out:
                if last is not None and not (pairs[last, x] if (last, x) in pairs else self._fits(last, x)):
                    break
                last = x
            else:
                return out
        return self._backtrack(chunk)

    def _backtrack(self, chunk: str) -> list[str]:
        # a later match with the same start is longer
        longest = {end - len(x): x for end, x in self.find.iter(chunk)}
        n, out, at, failed = len(chunk), [], 0, False
        dead = bytearray((n >> 3) + 1)
        pairs, shorter, get = self.pairs, self.shorter, longest.get
        piece, last = get(-1, chunk[:1]), None
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not (failed and dead[end >> 3] >> (end & 7) & 1):
                    if last is None or (pairs[last, piece] if (last, piece) in pairs else self._fits(last, piece)):
                        break
                piece = shorter.get(piece)
            if piece is not None:
                out.append(piece)
                at, last = end, piece
                piece = get(at - 1, chunk[at : at + 1])
            else:
                failed = True
                dead[at >> 3] |= 1 << (at & 7)
                gone = out.pop()  # the way by merging exists, so there is a piece to take back
                at -= len(gone)
                last = out[-1] if out else None
                piece = shorter.get(gone)
        return out

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        """(ids as 32-bit numbers, decoded text); remembered."""
        if chunk in self.known:
            return self.known[chunk]
        if self.held > BYTES_KEPT:
            self.known.clear()
            self.held = 0
        parts, known = self.cover(chunk), self.id
        try:
            out = array("i", [known[x] for x in parts]).tobytes(), "".join(parts).replace(SPACE, " ")
        except KeyError:
            ids: list[int] = []
            for x in parts:
                if x in known:
                    ids.append(known[x])
                elif self.fallback:
                    ids.extend(self.bytes[b] for b in x.encode())
                else:
                    ids.append(self.unknown)
            out = array("i", ids).tobytes(), self._plain(ids)
        if len(chunk) <= LONG:
            self.known[chunk] = out
            self.held += 300 + 6 * len(chunk)
        return out

    def _plain(self, ids: list[int]) -> str:
        parts: list[str] = []
        raw = bytearray()
        for i in ids:
            x = self.text[i]
            if isinstance(x, int):
                raw.append(x)
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            parts.append(" ⁇ " if i == self.unknown else x.replace(SPACE, " "))
        return "".join(parts) + raw.decode("utf-8", "replace")

    def encode(self, text: str) -> list[int]:
        return self.both(text)[0]

    def decode(self, ids: list[int]) -> str:
        out = self._plain(ids)
        return out[1:] if self.prefix and out[:1] == " " else out

    def both(self, text: str) -> tuple[list[int], str]:
        """(ids, decoded text)."""
        ids, plain = self.raw(text)
        return array("i", ids).tolist(), plain

    def raw(self, text: str) -> tuple[bytes, str]:
        """(ids as 32-bit numbers, decoded text)."""
        if not text:
            return b"", ""
        parts = self.chunks.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))
        got = list(map(self.known.get, parts))
        if None in got:
            got = [g or self._chunk(c) for g, c in zip(got, parts)]
        out = "".join([g[1] for g in got])
        return b"".join([g[0] for g in got]), out[1:] if self.prefix and out[:1] == " " else out


_models: dict[bytes, PieceModel] = {}


def _model(data: bytes) -> PieceModel:
    if data not in _models:
        _models.clear()
        _models[data] = PieceModel(data)
    return _models[data]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids array<int>, decoded string) of every whole text; no shuffle.

    Null and empty texts have no ids and decode to ''. Rows with the same or a null id stay as many rows. A very
    long text is encoded chunk by chunk. An empty table gives none; extra columns aren't read. The model
    file is read on the driver (at most MODEL_LIMIT bytes) and sent to the workers, so its path need not
    exist there."""
    with open(model_path, "rb") as f:
        data = f.read()
    if len(data) > MODEL_LIMIT:
        raise ValueError("the model file is too large to broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        model = _model(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = [model.raw(x) for x in part["text"].to_pylist()]
                ends = np.cumsum([0, *[len(x[0]) // 4 for x in out]]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join([x[0] for x in out]), np.int32)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids, pa.array([x[1] for x in out], pa.string())], ["doc_id", "token_ids", "decoded"])

    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, token_ids array<int>, decoded string")


def digests(encoded: DataFrame, ids: bool = False) -> DataFrame:
    """n_tokens and the two digests of encode_documents' rows, with ids also token_ids."""
    more = ["token_ids"] if ids else []
    return encoded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *more)
