"""Spelling variants by FM-index search schemes over a vocabulary.

Two words within one edit agree in a half: with the edit in a word's second half the other word begins with its
first half, and else ends with its second. So words meet by halves: each word asks under its own two halves and is
offered under those of words one shorter, as long, and one longer, four rows in all. Buckets of halves hold a
delimited vocabulary, indexed in both directions: the suffix ranks of the text and of the text reversed. A search
matches the half exactly and extends over the other, one interval of ranks for each of the words still possible,
allowing one insertion, deletion or replacement. A half with more words than a bucket should hold is dealt out in
shares, each of which is asked.

What leaves a bucket is one row for each word asked: how many are near, and the best of them, never the pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, texts
from .periods import tokens

LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5  # how much more frequent a form is than its variant
SHARE = 60_000  # rows of a bucket, and of one half in it
PIECE_BYTES = 8 << 20  # of texts tokenized at once
HELD = 400_000  # distinct words that a task holds before it passes their counts on
STATES = 1 << 20  # of a search at once
DROPS = 199

_LETTERS = np.full(256, 32, np.uint8)
for _c in range(65, 91):
    _LETTERS[_c] = _LETTERS[_c + 32] = _c + 32
_ZERO = np.array([zlib.crc32(bytes([k])) ^ zlib.crc32(b"\0") for k in range(256)], np.uint32)  # table of the checksum's steps


def letter_runs(bodies: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(runs of each text, distinct runs, number of each run): maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased."""
    whole = bodies.cast(pa.large_binary())
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    out = _LETTERS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[data[lead + 1] & 0xC0 == 0x80]
    out[lead], out[lead + 1] = 0xC3, data[lead + 1]
    return tokens(pa.Array.from_buffers(pa.large_binary(), len(whole), [None, whole.buffers()[1], pa.py_buffer(out)], offset=whole.offset))


def dropped(ids: list[int | None], of: np.ndarray, names: list[bytes], which: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(places of the runs that lose a letter, what they become): those where 199 divides crc32 of `id:run`; a null id counts as the empty text."""
    heads = np.array([zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in ids], np.uint32)
    own = np.array([zlib.crc32(x) for x in names], np.uint32)
    size = np.array([len(x) for x in names], np.int64)
    most = min(64, int(size.max())) if len(names) else 0
    shifted = np.empty((most + 1, len(ids)), np.uint32)  # the head's checksum behind so many zero bytes
    shifted[0] = heads
    for k in range(most):
        shifted[k + 1] = (shifted[k] >> np.uint32(8)) ^ _ZERO[shifted[k] & np.uint32(255)]
    h = shifted[np.minimum(size[which], most), of] ^ own[which]
    for p in np.flatnonzero(size[which] > most).tolist():
        h[p] = zlib.crc32(names[which[p]], int(heads[of[p]]))
    hit = np.flatnonzero(h % np.uint32(DROPS) == 0)
    out = []
    for p in hit.tolist():
        w = names[which[p]].decode()
        k = int(h[p]) % len(w)
        out.append((w[:k] + w[k + 1 :]).encode())
    return hit, out


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, change: Callable | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): letter runs of the texts with least_chars code points and least_count occurrences.

    change(ids, text of each run, distinct runs, number of each run): the places of runs to change, and their
    new words. Null texts have no runs."""

    def count(ids: pa.Array, bodies: pa.Array, held: dict[bytes, int]) -> None:
        size, coded, which = letter_runs(bodies)
        names = coded.cast(pa.large_binary()).to_pylist()
        n = np.bincount(which, minlength=len(names))
        if change is not None:
            hit, new = change(ids.to_pylist(), np.repeat(np.arange(len(size)), size), names, which)
            n -= np.bincount(which[hit], minlength=len(names))
            for w in new:
                if len(w.decode()) >= least_chars:
                    held[w] = held.get(w, 0) + 1
        long = pc.utf8_length(coded).to_numpy(zero_copy_only=False) >= least_chars
        for k in np.flatnonzero(long & (n > 0)).tolist():
            held[names[k]] = held.get(names[k], 0) + int(n[k])

    def rows(held: dict[bytes, int]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    def run(batches):
        held: dict[bytes, int] = {}
        for batch in batches:
            ids, bodies = batch["doc_id"], batch["body"]
            piece = np.cumsum(pc.binary_length(bodies).to_numpy(zero_copy_only=False).astype(np.int64)) // PIECE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(ids)] if len(ids) else []
            for a, b in zip(cuts, cuts[1:]):
                count(ids[a:b], bodies[a:b], held)
                if len(held) > HELD:
                    yield rows(held)
        if held:
            yield rows(held)

    return texts(docs, id_col, text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Index:
    """An FM-index over a delimited vocabulary, for patterns that are read from a word's beginning on.

    codes: a row of letters for each word, padded with 0, or the words reversed. A rank interval holds the places
    whose letters, read backwards to the delimiter, begin alike; the letters behind them lead on."""

    def __init__(self, codes: np.ndarray, size: np.ndarray):
        w = len(size)
        self.words = w
        text = np.zeros(int(size.sum()) + w + 1, np.int64)
        head = np.cumsum(size + 1) - size - 1  # of the delimiter before each word
        inner = np.ones(len(text), bool)
        inner[np.append(head, len(text) - 1)] = False
        text[inner] = codes[np.arange(codes.shape[1]) < size[:, None]]
        self.n = len(text)
        rank = text + w + 1
        rank[~inner] = np.arange(w + 1)  # delimiters by their word
        order = np.argsort(rank, kind="stable")
        k, live, rows = 1, order, order
        first = self._first(rank[order])
        rank = np.empty(self.n, np.int64)
        rank[order] = first
        live = np.sort(order[np.bincount(first, minlength=self.n)[first] > 1])
        while len(live):
            key = rank[live] * self.n + rank[live - k]
            order = np.argsort(key, kind="stable")
            own, key = live[order], key[order]
            old = rank[own]
            base = self._first(old)
            rows[old + np.arange(len(own)) - base] = own
            first = self._first(key)
            new = old + first - base
            rank = rank.copy()
            rank[own] = new
            live = np.sort(own[np.bincount(first, minlength=len(own))[first] > 1])
            k *= 2
        last = rows == self.n - 1
        self.behind = np.where(last, 0, text[np.minimum(rows + 1, self.n - 1)])
        entries = np.flatnonzero(~last)
        self.keys = np.sort(self.behind[entries] * (self.n + 1) + entries)  # letter by letter, the rows that lead on by it
        self.word = np.searchsorted(head, rows[self.keys[:w]], "right") - 1  # of each delimiter that ends a word
        self.letters = np.unique(text[inner])

    @staticmethod
    def _first(key: np.ndarray) -> np.ndarray:
        edge = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        return np.repeat(edge, np.diff(np.append(edge, len(key))))

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals one letter on."""
        at = c.astype(np.int64) * (self.n + 1)
        return 1 + np.searchsorted(self.keys, at + lo), 1 + np.searchsorted(self.keys, at + hi)

    def ends(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, word) of the words that end in intervals."""
        a, b = np.searchsorted(self.keys[: self.words], lo), np.searchsorted(self.keys[: self.words], hi)
        hit = np.flatnonzero(b > a)  # words are distinct, so one at most
        return hit, self.word[a[hit]]

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, letter, its interval one letter on) for every letter that leads on, by interval."""
        few = hi - lo <= len(self.letters)
        own = np.flatnonzero(few)
        n = (hi - lo)[own]
        row = np.repeat(own, n)
        c = self.behind[np.repeat(lo[own], n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]
        key = np.unique((row << 9 | c)[c > 0])
        many = np.flatnonzero(~few)
        key = np.sort(np.concatenate((key, (many[:, None] << 9 | self.letters).ravel())))
        row, c = key >> 9, key & 511
        a, b = self.step(c, lo[row], hi[row])
        ok = b > a
        return row[ok], c[ok], a[ok], b[ok]


def search(index: Index, codes: np.ndarray, size: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the words one edit away whose first `exact` letters are the query's; each pair once.

    An inserted letter goes behind its equals, and of equal letters the last is deleted, so no word is met twice."""
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    codes = np.concatenate((codes.astype(np.int64), np.zeros((len(codes), 2), np.int64)), 1)  # 0 behind the last letter

    def rest(q: np.ndarray, pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """The edit is spent: what is left must follow."""
        while len(q):
            over = pos == size[q]
            hit, word = index.ends(lo[over], hi[over])
            found.append((q[over][hit], word))
            q, pos, lo, hi = q[~over], pos[~over], lo[~over], hi[~over]
            lo, hi = index.step(codes[q, pos], lo, hi)
            ok = hi > lo
            q, pos, lo, hi = q[ok], pos[ok] + 1, lo[ok], hi[ok]

    def some(q: np.ndarray) -> None:
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), index.words, np.int64)
        for t in range(int(exact[q].max())):
            on = np.flatnonzero((exact[q] > t) & (hi > lo))
            lo[on], hi[on] = index.step(codes[q[on], t], lo[on], hi[on])
        on = hi > lo
        q, pos, lo, hi = q[on], exact[q][on], lo[on], hi[on]
        while len(q):
            cur, nxt = codes[q, pos], codes[q, pos + 1]
            out = np.flatnonzero((pos < size[q]) & (cur != nxt))
            rest(q[out], pos[out] + 1, lo[out], hi[out])  # deleted
            node, which = np.unique(lo * (index.n + 2) + hi, return_inverse=True)
            node, c, a, b = index.children(node // (index.n + 2), node % (index.n + 2))
            n = np.bincount(node, minlength=int(which.max()) + 1)
            first = np.cumsum(n) - n
            row = np.repeat(np.arange(len(q)), n[which])
            at = np.repeat(first[which], n[which]) + np.arange(len(row)) - np.repeat(np.cumsum(n[which]) - n[which], n[which])
            c, a, b, same = c[at], a[at], b[at], c[at] == cur[row]
            new, inside = np.flatnonzero(~same), pos[row] < size[q[row]]
            rest(q[row[new]], pos[row[new]], a[new], b[new])  # inserted
            new = np.flatnonzero(~same & inside)
            rest(q[row[new]], pos[row[new]] + 1, a[new], b[new])  # replaced
            on = np.flatnonzero(same & inside)
            q, pos, lo, hi = q[row[on]], pos[row[on]] + 1, a[on], b[on]

    step = max(1, STATES // 64)
    for k in range(0, len(codes), step):
        some(np.arange(k, min(len(codes), k + step)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(letters of each word in a row, padded with 0; lengths)."""
    size = np.array([len(w) for w in words], np.int64)
    codes = np.zeros((len(words), int(size.max()) if len(words) else 0), np.uint8)
    codes[np.arange(codes.shape[1]) < size[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return codes, size


def _flip(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each row's letters from the last to the first."""
    at = size[:, None] - 1 - np.arange(codes.shape[1])
    return np.where(at >= 0, np.take_along_axis(codes, np.maximum(at, 0), 1), 0)


NEAR = "word string, n bigint, n_near bigint, best_n bigint, best string"


def _bucket(table: pa.Table) -> pa.Table:
    """A row for each word that asks: how many near words the bucket has, and the most frequent of them."""
    word = [w.encode("latin-1") for w in table["word"].to_pylist()]
    role, key, n, ask, split = (table[c].to_pylist() for c in ("role", "key", "n", "ask", "split"))
    out: list[list] = [[], [], [], [], []]
    for back in (0, 1):
        own = [i for i, r in enumerate(role) if r == back]
        items = sorted({word[i] for i in own if table["offer"][i].as_py()})
        asks = {word[i]: i for i in own if ask[i]}
        if not asks:
            continue
        count = {word[i]: n[i] for i in own}
        names, of = list(asks), list(asks.values())
        codes, size = _matrix(names)
        half = size // 2
        q = x = np.zeros(0, np.int64)
        if items:
            item_codes, item_size = _matrix(items)
            if back:
                q, x = search(Index(_flip(item_codes, item_size), item_size), _flip(codes, size), size, size - half)
                width = min(codes.shape[1], item_codes.shape[1])  # those that begin with the first half have met by it
                apart = (item_codes[x, :width] != codes[q, :width]) & (np.arange(width) < half[q][:, None])
                new = apart.any(1) | (half[q] > item_size[x])
                q, x = q[new], x[new]
            else:
                q, x = search(Index(item_codes, item_size), codes, size, half)
        if any(split[i] for i in of):  # a half in shares: only what is offered under it counts here
            given = {(key[i], word[i]) for i in own if table["offer"][i].as_py()}
            ok = np.array([not split[of[a]] or (key[of[a]], items[b]) in given for a, b in zip(q.tolist(), x.tolist())], bool)
            q, x = q[ok], x[ok]
        freq = np.array([count[w] for w in items], np.int64)
        order = np.lexsort((x, -freq[x], q)) if len(q) else np.zeros(0, np.int64)
        q, x = q[order], x[order]
        near = np.bincount(q, minlength=len(names))
        best = np.full(len(names), -1, np.int64)
        lead = np.flatnonzero(np.concatenate((np.ones(min(1, len(q)), bool), q[1:] != q[:-1])))
        best[q[lead]] = x[lead]
        for k, (w, i) in enumerate(zip(names, of)):
            b = int(best[k])
            for col, v in zip(out, (w.decode("latin-1"), n[i], int(near[k]), None if b < 0 else int(freq[b]), None if b < 0 else items[b].decode("latin-1"))):
                col.append(v)
    return pa.table({c: pa.array(v, t) for c, v, t in zip(("word", "n", "n_near", "best_n", "best"), out, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))})


def near_words(vocab: DataFrame, share: int = SHARE) -> DataFrame:
    """(word, n, n_near, best_n, best) of every word (word, n): how many are one edit away; the most frequent, of several the first by code point."""
    spark = vocab.sparkSession
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    odd = size % 2 == 1
    halves = [(0, half, True), (0, F.when(odd, half + 1).otherwise(half - 1), False), (1, size - half, True), (1, F.when(odd, half).otherwise(half + 1), False)]
    cut = lambda back, n: F.concat(F.lit("S"), F.substring(F.col("word"), -n, n)) if back else F.concat(F.lit("P"), F.substring(F.col("word"), F.lit(1), n))
    rows = vocab.select("word", "n", F.explode(F.array(*[F.struct(F.lit(back).alias("role"), cut(back, n).alias("key"), F.lit(ask).alias("ask")) for back, n, ask in halves])).alias("r")).select("word", "n", "r.*")
    total = 4 * vocab.count()
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // share))
    crowded = rows.groupBy("key").count().where(F.col("count") > share).select("key", F.ceil(F.col("count") / share).cast("int").alias("shares"))
    crowded = staged(crowded, "spelling-halves")  # one row for each `share` rows at most
    rows = rows.join(F.broadcast(crowded), "key", "left")
    place = lambda at, ask, offer: F.struct(at.cast("int").alias("at"), ask.alias("ask"), F.lit(offer).alias("offer"))
    every = F.when(F.col("ask"), F.transform(F.sequence(F.lit(0), F.col("shares") - 1), lambda s: place(s, F.lit(True), False))).otherwise(F.array().cast("array<struct<at:int,ask:boolean,offer:boolean>>"))
    one = F.array(place(F.pmod(F.xxhash64("word"), F.col("shares")), F.lit(False), True))
    places = F.when(F.col("shares").isNull(), F.array(place(F.lit(0), F.col("ask"), True))).otherwise(F.concat(one, every))
    dealt = rows.select("word", "n", "role", "key", F.col("shares").isNotNull().alias("split"), F.explode(places).alias("p")).select("word", "n", "role", "key", "split", "p.at", "p.ask", "p.offer")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("key", "at"), F.lit(n_buckets)).cast("int")).drop("at")
    found = dealt.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(_bucket, NEAR)
    least = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best"))).alias("b")
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), least).select("word", "n", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO, share: int = SHARE, change: Callable | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    form: the most frequent near word, the first by code point of several, if it is `ratio` times as frequent, else
    null; root: where forms lead in the end, the word itself without one. Null and empty texts have no words;
    repeated rows count as often as they occur, whatever their ids; very long texts are tokenized alone. An empty
    table gives none; extra columns aren't read."""
    vocab = staged(vocabulary(docs, least_chars, least_count, change, id_col, text_col), "spelling-words")
    known = F.col("best_n") >= ratio * F.col("n")
    found = staged(near_words(vocab, share).select("word", F.when(known, F.col("best")).alias("form"), "n", "n_near", F.when(known, F.col("best_n")).alias("form_n")), "spelling-near")
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # each round follows twice as many forms; each form is more frequent by the ratio, so there are few
        far = roots.select(F.col("word").alias("at"), F.col("root").alias("to"))
        further = staged(roots.join(far, F.col("root") == F.col("at"), "left").select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "spelling-roots")
        roots = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            break
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
