"""Exact repeated windows of a corpus: what substring and suffix-array dedup share.

Documents lie in blocks by a hash of id and text, written once in buckets by block, so that no later pass
exchanges them. Every window of W units is known by an anchor, the n-gram
in it that hashes smallest, so equal windows have equal anchors at equal places: of all suffixes only those
that start at anchors are dealt out, by their first units, and each brings the few units before it.

1. Each block names its distinct anchors, by bucket of a hash; the buckets count and answer each block
   which of its anchors occur again anywhere. A window whose anchor occurs once is no repeat.
2. Windows whose anchor has more than HOT occurrences get a longer one: n-grams of 8, then 22, then all 35
   words (or bytes likewise), counted in the same way, all longer ones in one pass. So groups are bounded by longer prefixes.
3. Each block sends the stretches of text around its repeated anchors, grouped by anchor. The group orders
   its windows exactly, over the text itself, and answers with ranges of window starts. Groups are dealt by weight: anchors with over
   HOT / HEAVY occurrences are groups of their own, the others share groups by hash. Equal stretches of a
   group are ordered once.
4. Windows that occur more than HOT times as a whole are all alike: in the same pass each block sends each one
   once with its places, and a Spark aggregate by the window's text settles them.
5. Each block applies the ranges to its documents.

A block's rows for buckets and groups are no more than its anchors, and short ones aren't compressed, so
what is exchanged grows with the input and not with the product of blocks and groups.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_count, bucketed, in_blocks, staged, texts, total_bytes

BLOCK_BYTES = 16 << 20  # of documents in one block
BUCKET_BYTES = 16 << 20  # of documents whose anchors meet in one bucket, on average
GROUP_BYTES = 4 << 20  # of documents whose repeated stretches would meet in one group if all repeat
HOT = 100_000  # occurrences of an anchor whose group takes some 300 MB; beyond, its windows get a longer one
HEAVY = 16  # an anchor with over HOT / HEAVY occurrences is a group of its own
SEGMENT = 1 << 20  # units handled at once
LATE = np.int64(2**63 - 1)  # a null doc_id comes after all others
MULT = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Unit:
    """What a text is made of. split: body to units; hashes: units to uint64; join: units [a, b) to bytes."""

    window: int
    grams: tuple[int, ...]  # lengths of the anchors, rising to the window's
    split: Callable
    hashes: Callable
    join: Callable
    glue: bytes  # between kept pieces
    #: (stretches, anchor numbers, anchor offsets, window) -> (stretch, start, group) of windows, equal texts in one group
    order: Callable
    #: True: a window goes if it starts anywhere else; False: if it also starts in a smaller document
    anywhere: bool
    segment: int = SEGMENT


def grams_of(window: int, least: int) -> tuple[int, ...]:
    """Anchor lengths: the shortest, half-way to the window's, and the window's."""
    least = min(least, window)
    return tuple(sorted({least, window - (window - least) // 2, window}))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of the `gram` units from each place, built by doubling."""
    out, done, power, cur, mul = None, 0, 1, h, MULT
    n = len(h) - gram + 1
    while True:
        if gram & power:
            if out is None:
                out = cur[:n]
            else:
                out = out * np.uint64(mul) + cur[done : done + n]
            done += power
        if done == gram:
            return _mix(out)
        cur = cur[:-power] * np.uint64(mul) + cur[power:]
        mul = mul * mul & 0xFFFFFFFFFFFFFFFF
        power *= 2


def runs(h: np.ndarray, window: int, gram: int, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor, its key) of the runs of windows with the same anchor; only windows in the mask."""
    g = _gram_hashes(h, gram)
    w = window - gram + 1
    cur, size = (g & ~np.uint64(0xFFFFFF)) | np.arange(len(g), dtype=np.uint64), 1
    while 2 * size <= w:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    n = len(g) - w + 1
    least = np.minimum(cur[:n], cur[w - size : w - size + n])
    anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    edge = anchor[1:] != anchor[:-1]
    if mask is not None:
        edge |= mask[1:] != mask[:-1]
    first = np.flatnonzero(np.concatenate(([True], edge)))
    last = np.append(first[1:], n) - 1
    if mask is not None:
        first, last = first[mask[first]], last[mask[first]]
    at = anchor[first]
    return first, last, at, _mix(g[at] + np.uint64(MULT)) >> np.uint64(16)


class Known:
    """Repeated anchors of a block, or only the hot ones: their keys, sorted, by level, and which of them are hot."""

    def __init__(self, flags: pa.Table, levels: int, only_hot: bool = False):
        self.levels = []
        level = np.array(flags["level"].to_pylist(), np.int64)
        for k in range(levels):
            own = np.flatnonzero(level == k).tolist()
            keys = np.concatenate([np.zeros(0, np.uint64), *[unpack_keys(flags["keys"][i].as_py()) for i in own]])
            hot = np.concatenate([np.zeros(0, np.int8), *[unpack(flags["hot"][i].as_py())[0] for i in own]])
            if only_hot:
                keys, hot = keys[hot == 2], hot[hot == 2]
            order = np.argsort(keys)
            self.levels.append((keys[order], hot[order]))

    def state(self, level: int, key: np.ndarray) -> np.ndarray:
        """Of keys: 0 if they occur once, 1, or 2 if they are heavy, or 3 if they are hot."""
        keys, hot = self.levels[level]
        if not len(keys):
            return np.zeros(len(key), np.int8)
        where = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[where] == key, 1 + hot[where], 0)

    def find(self, level: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(occurs again, is hot) of keys."""
        state = self.state(level, key)
        return state > 0, state == 3


def _covered(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of n windows lie in runs of them."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, last + 1, -1)
    return np.cumsum(cover[:-1]) > 0


def leveled(h: np.ndarray, unit: Unit, known: Known | None, upto: int):
    """(level, runs) of a text's windows: on each level those whose shorter anchors are hot."""
    mask = None
    for level in range(upto):
        first, last, at, key = runs(h, unit.window, unit.grams[level], mask)
        yield level, first, last, at, key
        if level + 1 < upto:
            hot = known.find(level, key)[1]
            if not hot.any():
                return
            mask = _covered(len(h) - unit.window + 1, first[hot], last[hot])


def _segments(units, unit: Unit):
    """(first unit, hashes) of pieces whose windows together are the text's windows."""
    n = len(units)
    for lo in range(0, n - unit.window + 1, unit.segment):
        yield lo, unit.hashes(units[lo : min(n, lo + unit.segment + unit.window - 1)])


CODES = {"<i1": 0, "<i4": 1, "<i8": 2, "<u4": 3, "<u8": 4, "<f4": 5}
SHORT = 1024  # bytes from which on arrays are compressed


def pack(*arrays) -> bytes:
    """Arrays of numbers, or bytes, one after another behind their kinds and lengths."""
    head, data = bytearray([len(arrays)]), []
    for a in arrays:
        if isinstance(a, bytes):
            head += bytes([255]) + len(a).to_bytes(5, "little")
            data.append(a)
        else:
            kind = "<" + a.dtype.kind + str(a.dtype.itemsize)
            head += bytes([CODES[kind]]) + len(a).to_bytes(5, "little")
            data.append(a.tobytes())
    whole = bytes(head) + b"".join(data)
    return b"\1" + zstandard.ZstdCompressor(level=1).compress(whole) if len(whole) > SHORT else b"\0" + whole


def unpack(blob: bytes) -> list:
    whole = zstandard.ZstdDecompressor().decompress(blob[1:]) if blob[0] else blob[1:]
    names, out, at = {v: k for k, v in CODES.items()}, [], 1 + 6 * whole[0]
    for k in range(whole[0]):
        code, n = whole[1 + 6 * k], int.from_bytes(whole[2 + 6 * k : 7 + 6 * k], "little")
        if code == 255:
            out.append(whole[at : at + n])
            at += n
        else:
            out.append(np.frombuffer(whole, names[code], n, at))
            at += out[-1].nbytes
    return out


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted numbers of 48 bits as differences, byte planes apart."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes())


def unpack_keys(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack(blob)[0], np.uint8).reshape(6, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :6] = planes.T
    return np.cumsum(steps.view("<u8").ravel().astype(np.uint64), dtype=np.uint64)


def grouped(number: np.ndarray):
    """(number, its places in order) for each distinct number."""
    order = np.argsort(number, kind="stable")
    edge = np.flatnonzero(np.diff(number[order])) + 1
    for own in np.split(order, edge) if len(order) else ():
        yield int(number[own[0]]), own


def _ordered(table: pa.Table) -> list[tuple[int, bytes]]:
    """A block's documents in the same order in every job."""
    return sorted((LATE if i is None else i, b) for i, b in zip(table["doc_id"].to_pylist(), table["body"].to_pylist()))


def _name(unit: Unit, n_buckets: int):
    """Rows by bucket: a block's distinct anchors, and how often each occurs in it: the shortest, or where flags tell of hot ones, all longer ones of their windows."""

    def run(docs: pa.Table, flags: pa.Table | None) -> pa.Table:
        known = Known(flags, 1, only_hot=True) if flags is not None else None
        levels = range(1) if known is None else range(1, len(unit.grams))
        found = {k: [np.zeros(0, np.uint64)] for k in levels}
        for body in docs["body"].to_pylist() if known is None or len(known.levels[0][0]) else ():
            for _, h in _segments(unit.split(body), unit):
                first, last, _, key = runs(h, unit.window, unit.grams[0])
                if known is None:
                    found[0].append(key)
                    continue
                hot = known.find(0, key)[1]
                if hot.any():
                    mask = _covered(len(h) - unit.window + 1, first[hot], last[hot])
                    for k in levels:
                        found[k].append(runs(h, unit.window, unit.grams[k], mask)[3])
        out: list[tuple] = []
        for k in levels:
            keys, counts = np.unique(np.concatenate(found[k]), return_counts=True)
            bucket = ((keys * np.uint64(n_buckets)) >> np.uint64(48)).astype(np.int64)  # keys are sorted, so buckets are
            lead = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, np.int64)
            counts = np.minimum(counts, 2**31).astype(np.uint32)
            out += [(k, int(bucket[a]), pack_keys(keys[a:b]), pack(counts[a:b])) for a, b in zip(lead.tolist(), [*lead[1:].tolist(), len(keys)])]
        block = docs["block"][0].as_py() if out else 0
        return pa.table({"level": pa.array([x[0] for x in out], pa.int32()), "bucket": pa.array([x[1] for x in out], pa.int32()), "block": pa.array([block] * len(out), pa.int32()), "keys": pa.array([x[2] for x in out], pa.binary()), "counts": pa.array([x[3] for x in out], pa.binary())})

    return run


def _answer(hot: int, heavy: int):
    """Rows by block: its anchors that occur again, and which are heavy (1) or hot (2)."""

    def run(table: pa.Table) -> pa.Table:
        blocks, level = table["block"].to_pylist(), table["level"][0].as_py()
        keys = [unpack_keys(x) for x in table["keys"].to_pylist()]
        counts = np.concatenate([unpack(x)[0] for x in table["counts"].to_pylist()]).astype(np.int64)
        place = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        k, c = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        total = np.repeat(np.add.reduceat(c, first), np.diff(np.append(first, len(k))))
        again = np.flatnonzero(total > 1)
        order, over = order[again], np.where(total[again] > hot, 2, total[again] > heavy).astype(np.int8)
        out = [(blocks[p], pack_keys(keys[order[mine]]), pack(over[mine]), int((over[mine] == 2).sum())) for p, mine in grouped(place[order])]  # each row's keys stay sorted
        return pa.table({"level": pa.array([level] * len(out), pa.int32()), "block": pa.array([x[0] for x in out], pa.int32()), "keys": pa.array([x[1] for x in out], pa.binary()), "hot": pa.array([x[2] for x in out], pa.binary()), "n_hot": pa.array([x[3] for x in out], pa.int64())})

    return run


FLAGS = "level int, block int, keys binary, hot binary, n_hot bigint"


SENT = "grp bigint, block int, blob binary, text binary, n bigint, first bigint"


def _stretches(unit: Unit, n_groups: int, levels: int):
    """Rows by group of anchors: a block's stretches of windows whose anchor occurs again but isn't hot.

    And a row with text for each window of the block that is hot as a whole: how often and where it starts, its
    least document. These go to negative groups, by text and block, as nothing needs them together there."""

    def run(docs: pa.Table, flags: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        bodies: list[bytes] = []
        seen: dict[bytes, list] = {}
        if flags.num_rows:
            known = Known(flags, levels)
            for row, (doc, body) in enumerate(_ordered(docs)):
                units = unit.split(body)
                for lo, h in _segments(units, unit):
                    for level, first, last, at, key in leveled(h, unit, known, levels):
                        state = known.state(level, key)
                        hit = np.flatnonzero((state == 1) | (state == 2))
                        n = len(hit)
                        if n:
                            rows.append((key[hit] * np.uint64(4) + np.uint64(level), state[hit] == 2, np.full(n, doc, np.int64), np.full(n, row, np.int32), (first[hit] + lo).astype(np.int64), (at - first)[hit].astype(np.int32)))
                            bodies += [unit.join(units, a, b) for a, b in zip((first[hit] + lo).tolist(), (last[hit] + lo + unit.window).tolist())]
                        if level + 1 == len(unit.grams):
                            hot = np.flatnonzero(state == 3)
                            for a, k in zip((first[hot] + lo).tolist(), key[hot].tolist()):
                                one = seen.setdefault(unit.join(units, a, a + unit.window), [k, 0, doc, array("q"), array("q"), array("q"), array("q")])
                                one[1] += 1
                                one[2] = min(one[2], doc)
                                if one[3] and one[3][-1] == row and one[5][-1] == a - 1:
                                    one[5][-1] = a  # the run of starts goes on
                                else:
                                    for x, v in zip(one[3:], (row, a, a, doc)):
                                        x.append(v)
        out: list[tuple] = []
        block = docs["block"][0].as_py() if rows or seen else 0
        if rows:
            key, heavy, doc, row, start, off = (np.concatenate(x) for x in zip(*rows))
            for grp, own in grouped(np.where(heavy, n_groups + key.astype(np.int64), (_mix(key) % np.uint64(n_groups)).astype(np.int64))):
                text = [bodies[i] for i in own.tolist()]
                out.append((grp, pack(key[own], doc[own], row[own], start[own], off[own], np.array([len(x) for x in text], np.int64), b"".join(text)), None, None, None))
        for text, (k, n, first, *places) in seen.items():
            out.append((-1 - (k + block) % n_groups, pack(*[np.array(x, np.int64) for x in places]), text, n, int(first)))
        grp, blob, text, n, first = zip(*out) if out else [()] * 5
        return pa.table({"grp": pa.array(grp, pa.int64()), "block": pa.array([block] * len(out), pa.int32()), "blob": pa.array(blob, pa.binary()), "text": pa.array(text, pa.binary()), "n": pa.array(n, pa.int64()), "first": pa.array(first, pa.int64())})

    return run


def radix_order(group: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Order by group, then label: counting passes of 16 bits, the least significant first."""
    order = None
    for number in (label.astype(np.uint64), group.astype(np.uint64)):
        for shift in range(0, max(1, int(number.max()).bit_length()), 16):
            digit = ((number >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return order


def descend(root: np.ndarray, label: Callable[[np.ndarray, int], np.ndarray], steps: int, branch: Callable | None = None) -> np.ndarray:
    """A number for each suffix, the same for those that share root and all labels.

    label(suffixes, step): their labels. Groups that agree in a label only grow longer; the others are split,
    and suffixes left alone are done with. branch(step, sizes of the groups split, sizes of what they split into,
    their number each) is told of every split."""
    order = radix_order(root - root.min(), np.zeros(len(root), np.int64)) if len(root) else np.zeros(0, np.int64)
    live, out, done = order, np.full(len(root), -1, np.int64), 0
    change = np.ones(len(live), bool)
    change[1:] = root[live][1:] != root[live][:-1]
    for step in range(steps + 1):
        g = np.cumsum(change) - 1
        alone = np.bincount(g)[g] == 1 if len(g) else np.zeros(0, bool)
        out[live[alone]] = done + np.arange(int(alone.sum()))
        done += int(alone.sum())
        live, g, change = live[~alone], g[~alone], change[~alone]
        if step == steps or not len(live):
            break
        g = np.cumsum(change) - 1
        first = np.flatnonzero(change)
        lab = label(live, step)
        whole = np.logical_and.reduceat(lab == lab[first][g], first)
        sub = np.flatnonzero(~whole[g])
        if len(sub):
            by = sub[radix_order(g[sub], lab[sub])]
            live[sub], lab[sub] = live[by], lab[by]
            cut = np.zeros(len(live), bool)
            cut[1:] = (lab[1:] != lab[:-1]) & ~change[1:]
            if branch is not None:
                sizes = np.diff(np.append(np.flatnonzero(change | cut), len(live)))
                branch(step, np.bincount(g)[~whole], sizes, np.add.reduceat(cut.astype(np.int64), first)[~whole] + 1)
            change |= cut
    out[live] = done + np.cumsum(change) - 1
    return out


FOUND = "block int, blob binary, text binary, n bigint, first bigint"


def _settle(unit: Unit):
    """Rows by block: (row, first, last) of window starts to remove. Rows of windows that are hot as a whole stay as they are."""

    def run(table: pa.Table) -> pa.Table:
        if table["grp"][0].as_py() < 0:
            return table.select(["block", "blob", "text", "n", "first"])
        blocks = table["block"].to_pylist()
        got = [unpack(x) for x in table["blob"].to_pylist()]
        key, doc, row, start, off, size = (np.concatenate([x[k] for x in got]) for k in range(6))
        of = np.repeat(np.array(blocks, np.int64), [len(x[0]) for x in got])
        ends = np.cumsum(size)
        whole = b"".join(x[6] for x in got)
        del got
        anchor = np.unique(key, return_inverse=True)[1]
        number: dict[tuple, int] = {}  # equal stretches, with the same anchor at the same place, are ordered once
        alike = np.array([number.setdefault((k, o, whole[a:b]), len(number)) for k, o, a, b in zip(anchor.tolist(), off.tolist(), (ends - size).tolist(), ends.tolist())], np.int64)
        del whole
        lead = np.unique(alike, return_index=True)[1]
        c, s, g = unit.order([x[2] for x in number], anchor[lead], off[lead].astype(np.int64), unit.window)
        del number
        if unit.anywhere:
            limit = (np.bincount(g, np.bincount(alike)[c])[g] > 1).astype(np.int64)
        else:
            low, least = np.full(len(lead), LATE), np.full(int(g.max()) + 1, LATE)
            np.minimum.at(low, alike, doc)
            np.minimum.at(least, g, low[c])
            limit = least[g]
        # runs of windows of a stretch with the same limit; each of the equal stretches compares itself with them
        edge = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (limit[1:] != limit[:-1]))))
        lo, hi, limit = s[edge], s[np.append(edge[1:], len(c)) - 1], limit[edge]
        n_runs = np.bincount(c[edge], minlength=len(lead))
        n = n_runs[alike]
        who = np.repeat(np.arange(len(alike)), n)
        run_ = np.arange(len(who)) + np.repeat((np.cumsum(n_runs) - n_runs)[alike] - (np.cumsum(n) - n), n)
        gone = limit[run_] > 0 if unit.anywhere else limit[run_] < doc[who]
        who, run_ = who[gone], run_[gone]
        lo, hi = lo[run_] + start[who], hi[run_] + start[who]
        out = [(b, pack(row[who[sel]], lo[sel], hi[sel])) for b, sel in grouped(of[who])]
        none = [None] * len(out)
        return pa.table({"block": pa.array([x[0] for x in out], pa.int32()), "blob": pa.array([x[1] for x in out], pa.binary()), "text": pa.array(none, pa.binary()), "n": pa.array(none, pa.int64()), "first": pa.array(none, pa.int64())})

    return run


def _apply(unit: Unit):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        rows = _ordered(docs)
        parts = [np.zeros((3, 0), np.int64)]
        for blob, least in zip(found["blob"].to_pylist(), found["least"].to_pylist()):
            got = unpack(blob)
            part = np.array(got[:3], np.int64)
            parts.append(part if least is None or unit.anywhere else part[:, got[3] > least])
        row, lo, hi = np.concatenate(parts, 1)
        order = np.argsort(row, kind="stable")
        row, lo, hi = row[order], lo[order], hi[order]
        edge = np.searchsorted(row, np.arange(len(rows) + 1))
        ids, sizes, spans, kept = [], [], [], []
        for k, (doc, body) in enumerate(rows):
            units = unit.split(body)
            own = slice(edge[k], edge[k + 1])
            cover = np.zeros(len(units) + 1, np.int64)
            np.add.at(cover, lo[own], 1)
            np.add.at(cover, hi[own] + unit.window, -1)
            flip = np.diff(np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).view(np.int8), [0])))
            a, b = np.flatnonzero(flip == 1).tolist(), np.flatnonzero(flip == -1).tolist()
            ids.append(None if doc == LATE else doc)
            sizes.append(len(units))
            spans.append([{"start": x, "end": y} for x, y in zip(a, b)])
            pieces = [unit.join(units, x, y) for x, y in zip([0, *b], [*a, len(units)]) if y > x]
            kept.append(unit.glue.join(pieces))
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_units": pa.array(sizes, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})

    return run


ANCHORS = "level int, bucket int, block int, keys binary, counts binary"


def remove_repeats(docs: DataFrame, unit: Unit, name: str, hot: int = HOT, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_units, spans of removed units, kept binary) of every document."""
    spark = docs.sparkSession
    bodies = texts(docs, id_col, text_col)
    size = total_bytes(bodies)
    n_blocks = block_count(spark, size, block_bytes)
    n_buckets, n_groups = max(1, -(-size // BUCKET_BYTES)), max(1, -(-size // GROUP_BYTES))
    blocks = bucketed(in_blocks(bodies, n_blocks), f"{name}_docs", "block", n_blocks, "zstd")

    def by_block(df: DataFrame):
        return (df if df is blocks else df.repartition(n_blocks, "block")).groupBy("block")

    def counted(named: DataFrame) -> DataFrame:
        met = named.repartition(n_buckets, "bucket").groupBy("bucket", "level")
        return staged(met.applyInArrow(_answer(hot, max(1, hot // HEAVY)), FLAGS), f"{name}-flags")

    name_ = _name(unit, n_buckets)
    flags, levels = counted(by_block(blocks).applyInArrow(lambda docs: name_(docs, None), ANCHORS)), 1
    crowded = bool(flags.where("n_hot > 0").limit(1).count())
    if crowded and len(unit.grams) > 1:
        longer = counted(by_block(blocks).cogroup(by_block(flags)).applyInArrow(name_, ANCHORS))
        flags, levels = flags.unionByName(longer), len(unit.grams)
        crowded = bool(longer.where(f"n_hot > 0 and level = {levels - 1}").limit(1).count())
    sent = by_block(blocks).cogroup(by_block(flags)).applyInArrow(_stretches(unit, n_groups, levels), SENT)
    found = staged(sent.repartition(n_groups, "grp").groupBy("grp").applyInArrow(_settle(unit), FOUND), f"{name}-found")
    ranges = found.where("text is null").select("block", "blob", F.lit(None).cast("bigint").alias("least"))
    if crowded:
        many = found.where("text is not null")
        # a row for each text; written, so that Spark may split the join's share of a text that all blocks have
        totals = staged(many.groupBy("text").agg(F.min("first").alias("least"), F.sum("n").alias("total")), f"{name}-totals")
        ranges = ranges.unionByName(many.join(totals, "text").where("total > 1").select("block", "blob", "least"))
    return by_block(blocks).cogroup(by_block(ranges)).applyInArrow(_apply(unit), "doc_id bigint, n_units bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
