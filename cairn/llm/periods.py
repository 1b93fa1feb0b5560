"""Runs of words that repeat with a period, by internal pattern matching.

A run is a maximal stretch whose words q apart are alike, q being its smallest period, and which is at least LEAST
words and two periods long. The words of a document are cut into dyadic blocks of 4, 8, 16, … words. A run of
period q holds a block of about q / 2 words together with its copy q words on, so each block asks where it occurs
again within a window of four times its length.

Suffixes are ranked by prefix doubling, which leaves out those whose words are alone in their document: after k
rounds the suffixes that share 2^k words are an interval of the suffix array. A wavelet tree over the array answers
range successors: the next place in an interval at or after a given one. The occurrences of a block without a
period of up to half its length are few and each gives a candidate. Those of a periodic block lie in arithmetic
progressions, one for each stretch that keeps the block's period d: two such stretches that a longer period maps to
each other begin or end that period apart, and where they touch, every step of the progression is a candidate. The ranks of all rounds
tell how far words agree to either side of a candidate, and so its run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

LEAST = 12  # words of a run; the finest blocks are laid out for this many and more
STRIDE = 3  # between blocks of four words: six words that agree hold one
PIECE_BYTES = 3 << 20  # of texts handled at once; a longer text is handled alone


def tokens(bodies: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(words of each text, distinct words, number of each word), between ASCII white space."""
    whole = bodies.cast(pa.large_binary())
    text = pa.Array.from_buffers(pa.large_string(), len(whole), whole.buffers(), offset=whole.offset)
    parts = pc.ascii_split_whitespace(text)
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty part
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    return np.bincount(np.repeat(np.arange(len(whole)), sizes)[filled], minlength=len(whole)), coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Wavelet:
    """Range successors over an array of numbers below 2^bits: one array of counts for each bit, the highest first."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for shift in reversed(range(bits)):
            zero = (values >> shift) & 1 == 0
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=count[1:])
            self.levels.append((shift, int(count[-1]), count))
            values = np.concatenate((values[zero], values[~zero]))

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, none: int) -> np.ndarray:
        """For each range [lo, hi) of the array: its smallest number that is at least `least`, or none."""
        a, b, below = lo.astype(np.int64), hi.astype(np.int64), np.zeros(len(lo), np.int64)
        for shift, zeros, count in self.levels:
            a0, b0, one = count[a].astype(np.int64), count[b].astype(np.int64), (least >> shift) & 1 == 1
            below += np.where(one, b0 - a0, 0)
            a, b = np.where(one, zeros + a - a0, a0), np.where(one, zeros + b - b0, b0)
        out = np.full(len(lo), none, np.int64)
        found = np.flatnonzero(below < hi - lo)
        a, b, nth, got = lo[found].astype(np.int64), hi[found].astype(np.int64), below[found], np.zeros(len(found), np.int64)
        for shift, zeros, count in self.levels:
            a0, b0 = count[a].astype(np.int64), count[b].astype(np.int64)
            one = nth >= b0 - a0
            nth = np.where(one, nth - (b0 - a0), nth)
            a, b = np.where(one, zeros + a - a0, a0), np.where(one, zeros + b - b0, b0)
            got |= one.astype(np.int64) << shift
        out[found] = got
        return out


def _classes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order, first of the class of each in that order, size of its class)."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
    size = np.diff(np.append(first, len(k)))
    return order, np.repeat(first, size), np.repeat(size, size)


class Suffixes:
    """The suffixes of documents' symbols that share four symbols with another one of their document.

    symbols: the documents one after another, a symbol of its own before each and at the end; doc: the document of
    each symbol, -1 for those. blocks: for each dyadic length 2^k (k, places, interval of each, interval of its
    first half)."""

    def __init__(self, symbols: np.ndarray, doc: np.ndarray):
        self.x, self.n = symbols, len(symbols)
        self.places = self._repeated(symbols, doc)
        m = self.m = len(self.places)
        self.number = np.full(self.n + 1, m, np.int32)  # of each place among those kept, m for others
        self.number[self.places] = np.arange(m)
        inner = np.zeros(self.n + 2, np.int32)
        inner[self.places + 1] = 1
        self.ahead = np.cumsum(inner, dtype=np.int32)  # kept places before each place
        self.at = np.append(self.places, 4 * self.n)  # of each number; far away for none
        self.ranks, self.blocks = [], []
        order, first, size_ = _classes(self._key)
        rank, size = np.empty(m, np.int64), np.empty(m, np.int64)
        rank[order], size[order] = first, size_
        suffixes, live, half, k = order.copy(), np.arange(m), None, 2
        while len(live):
            self.ranks.append((k, np.append(rank, -1).astype(np.int32)))
            own = live[self.places[live] % (STRIDE if k == 2 else 1 << k) == 0]
            lo, hi = rank[own], rank[own] + size[own]
            before = (lo, hi) if half is None else (half[0][own], half[0][own] + half[1][own])
            self.blocks.append((k, self.places[own], lo, hi, *before))
            behind = self.number[np.minimum(self.places[live] + (1 << k), self.n)]
            second = np.where(behind < m, rank[np.minimum(behind, m - 1)], m + live)  # what nothing else shares is a rank of its own
            old = rank[live]
            order, first, size_ = _classes(old * (2 * m) + second)
            old, own = old[order], live[order]
            start = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            base = np.repeat(start, np.diff(np.append(start, len(old))))
            suffixes[old + np.arange(len(old)) - base] = own
            half, rank, size = (rank, size), rank.copy(), size.copy()
            rank[own], size[own] = old + first - base, size_
            live = np.sort(own[size_ > 1])
            k += 1
        self.tree = Wavelet(suffixes, max(1, m.bit_length()))

    def _repeated(self, x: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Places whose four symbols occur again in their document; _key: the class of these four."""
        two = np.flatnonzero((doc[:-1] >= 0) & (doc[:-1] == doc[1:]))
        width = int(x.max()).bit_length() if len(x) else 1
        key = ((doc[two] << width | x[two]) << width) | x[two + 1]
        ordered = np.sort(key)
        again = ordered[1:][ordered[1:] == ordered[:-1]]
        again = again[np.concatenate((np.ones(min(1, len(again)), bool), again[1:] != again[:-1]))]
        pair = np.full(len(x) + 2, -1, np.int64)
        if len(again):
            where = np.minimum(np.searchsorted(again, key), len(again) - 1)
            hit = again[where] == key
            pair[two[hit]] = where[hit]
        four = np.flatnonzero((pair[:-2] >= 0) & (pair[2:] >= 0))
        key = pair[four] * (len(again) + 1) + pair[four + 2]
        order, _, size = _classes(key)
        kept = np.sort(order[size > 1])
        self._key = key[kept]
        return four[kept]

    def successor(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The next place at or after `least` in intervals of the suffix array; far away for none."""
        return self.at[self.tree.successor(lo, hi, self.ahead[np.minimum(least, self.n)].astype(np.int64), self.m)]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that agree from places i and j on; i < j, in one document."""
        a, b = i.copy(), np.minimum(j, self.n - 1)
        for k, rank in reversed(self.ranks):
            of = self.number[a]
            same = (of < self.m) & (rank[of] == rank[self.number[b]])
            a, b = a + (same << k), b + (same << k)
        for _ in range(3):
            same = self.x[a] == self.x[b]
            a, b = a + same, b + same
        return a - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that agree before places i and j."""
        a, b = i.copy(), np.minimum(j, self.n - 1)
        for k, rank in reversed(self.ranks):
            of = self.number[np.maximum(a - (1 << k), 0)]
            same = (of < self.m) & (a >= 1 << k) & (rank[of] == rank[self.number[np.maximum(b - (1 << k), 0)]])
            a, b = a - (same << k), b - (same << k)
        for _ in range(3):
            same = self.x[a - 1] == self.x[b - 1]
            a, b = a - same, b - same
        return i - a


def _steps(first: np.ndarray, last: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of first, first + step, … up to last, for each row."""
    n = np.maximum((last - first) // step + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * step[row]


def candidates(own: Suffixes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods): pairs that hold one for each run at least."""
    for k, b, lo, hi, half_lo, half_hi in own.blocks:
        size = 1 << k
        least, most = (1, 14) if k == 2 else (2 * size - 1, 4 * size - 2)
        seen = own.successor(lo, hi, b + 1)
        near = np.flatnonzero(seen <= b + most)
        b, lo, hi, half_lo, half_hi, seen = (x[near] for x in (b, lo, hi, half_lo, half_hi, seen))
        if not len(b):
            continue
        if k == 2:
            by = [own.x[b + t] for t in range(4)]
            period = np.where((by[0] == by[2]) & (by[1] == by[3]), np.where(by[0] == by[1], 1, 2), 0)
        else:  # of up to half the block: the next place of its first half, if the block goes on alike
            nxt = own.successor(half_lo, half_hi, b + 1)
            period = np.zeros(len(b), np.int64)
            close = np.flatnonzero(nxt <= b + size // 2)
            step = nxt[close] - b[close]
            period[close] = np.where(own.forward(b[close], nxt[close]) >= size - step, step, 0)
        at = np.flatnonzero(period == 0)
        while len(at):
            q = seen[at] - b[at]
            yield b[at][q >= least], q[q >= least]
            seen[at] = own.successor(lo[at], hi[at], seen[at] + 1)
            at = at[seen[at] <= b[at] + most]
        at = np.flatnonzero(period)
        d = period
        begin, end = b.copy(), b.copy()
        begin[at] -= own.backward(b[at], b[at] + d[at])
        end[at] += d[at] + own.forward(b[at], b[at] + d[at])
        yield b[at][d[at] >= least], d[at][d[at] >= least]
        after = end.copy()
        while len(at):
            o = own.successor(lo[at], hi[at], after[at] - size + 1)
            at, o = at[o <= b[at] + most], o[o <= b[at] + most]
            s, e = o - own.backward(o, o + d[at]), o + d[at] + own.forward(o, o + d[at])
            for q in (s - begin[at], e - end[at]):
                ok = (q >= least) & (q <= most)
                yield b[at][ok], q[ok]
            touch = np.flatnonzero((end[at] >= s) & (end[at] - s < d[at]))
            t = at[touch]
            longest = np.minimum(end[t] - begin[t], e[touch] - s[touch]) + d[t]
            row, q = _steps(o[touch] - b[t], np.minimum(np.minimum(most, longest), e[touch] - b[t] - size), d[t])
            yield b[t][row][q >= least], q[q >= least]
            after[at] = e


def runs(size: np.ndarray, words: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period. size: words of each text; words: their numbers, one text after another."""
    if least < LEAST:
        raise ValueError(f"runs have {LEAST} words at least")
    doc = np.repeat(np.arange(len(size)), size)
    n = len(words) + len(size) + 1
    place = np.arange(len(words)) + doc + 1
    symbols, of = np.empty(n, np.int64), np.full(n, -1, np.int64)
    inner = np.zeros(n, bool)
    inner[place] = True
    marks = int(words.max()) + 1 if len(words) else 0
    symbols[place], symbols[~inner] = words, marks + np.arange(len(size) + 1)
    of[place] = doc
    own = Suffixes(symbols, of)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *candidates(own)] if own.m else [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    b, q = (np.concatenate(x) for x in zip(*found))
    ok = b + q < n
    b, q = b[ok], q[ok]
    ok = of[b] == of[b + q]
    b, q = b[ok], q[ok]
    start = b - own.backward(b, b + q)
    length = b + q + own.forward(b, b + q) - start
    ok = length >= np.maximum(least, 2 * q)
    start, length, q = start[ok], length[ok], q[ok]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), bool)  # a stretch's smallest period comes first
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    text = of[start]
    head = np.cumsum(size) - size + np.arange(len(size)) + 1
    return text, start - head[text], length, q


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Numbers of the words that stand at each place of a text, where repeats are planted; a null id counts as the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + np.arange(n - a) % p
    return at


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, least: int = LEAST, change: Callable[[int | None, int], np.ndarray | None] | None = None, id_col: str = "doc_id", text_col: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row, without a shuffle.

    runs by start and period; collapsed: the words that no run has after its first period, joined by single spaces.
    change(doc_id, n): which word stands at each place, if not its own. Null and empty texts have no words and no
    runs; rows with the same or a null id are texts of their own; a stretch has one period, the smallest. A very
    long text is handled alone and takes some 100 bytes a word, and 4 more a word and round where it repeats. An
    empty table gives none; extra columns aren't read."""

    def piece(ids: pa.Array, bodies: pa.Array) -> pa.RecordBatch:
        size, names, words = tokens(bodies)
        head = np.cumsum(size) - size
        if change is not None:
            for k, (i, n) in enumerate(zip(ids.to_pylist(), size.tolist())):
                new = change(i, n)
                if new is not None:
                    words[head[k] : head[k] + n] = words[head[k] + new]
        text, start, length, period = runs(size, words, least)
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, head[text] + start + period, 1)
        np.add.at(gone, head[text] + start + length, -1)
        kept = np.cumsum(gone[:-1]) == 0
        left = np.concatenate(([0], np.cumsum(np.bincount(np.repeat(np.arange(len(size)), size)[kept], minlength=len(size)))))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), names.take(pa.array(words[kept]))), pa.scalar(" ", pa.large_string()))
        one = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
        of = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(size))))).astype(np.int32)
        return pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(of), one), joined.cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches):
        for batch in batches:
            ids, bodies = batch["doc_id"], batch["body"]
            piece_ = np.cumsum(pc.binary_length(bodies).to_numpy(zero_copy_only=False).astype(np.int64)) // piece_bytes
            cuts = [0, *(np.flatnonzero(np.diff(piece_)) + 1).tolist(), len(ids)] if len(ids) else []
            for a, b in zip(cuts, cuts[1:]):
                yield piece(ids[a:b], bodies[a:b])

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def report(found: DataFrame) -> DataFrame:
    better = lambda x, y: (x["length"] > y["length"]) | ((x["length"] == y["length"]) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
    first = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda y, x: F.when(y.isNull() | better(x, y), x).otherwise(y))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    found = found.withColumn("longest", first)
    milli = F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).cast("bigint")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "longest.start", "longest.length", "longest.period", milli.alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
