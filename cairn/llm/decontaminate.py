"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded block of documents of one partition. Only runs of benchmark words that are long
enough to hold a phrase can match, so these runs are what the shard's index holds, with a separator
between them; a run over a shard's size is cut with an overlap. All phrases of the benchmark are searched backwards at once through the ranks of a wavelet
matrix over the shard's BWT; occurrences are found from sampled suffix positions, and overlapping hits
merge to removal spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

PHRASE = 13
SHARD_WORDS = 1 << 18  # words that one index holds
SAMPLE = 8  # every so many positions, and each run's start, is kept for locating
ITEM_BYTES = 4 << 20  # benchmark text in one block: some 100 MB in a worker, with words and windows
AT_ONCE = 2  # blocks that a pass over the documents takes along; more go in further passes
#: A-Z to lower case; other ASCII that is no letter or digit to a space; the rest stays.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(body: bytes) -> list[bytes]:
    return body.translate(FOLD).split()


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling."""
    n, step = len(seq), 1
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class ShardIndex:
    """FM-index over word numbers 1..size; each run of words is followed by a separator of its own."""

    def __init__(self, seq: np.ndarray, size: int, sample: int = SAMPLE):
        """seq: word numbers, 0 at separators."""
        n = len(seq)
        apart = seq == 0
        own = np.where(apart, np.cumsum(apart) - 1, seq + int(apart.sum()))  # separators are smallest, all different
        order = suffix_order(own)
        self.bwt = seq[order - 1]  # of the first suffix: the last symbol, a separator
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=size + 1))))  # symbols smaller than c
        keep = (order % sample == 0) | apart[order - 1]
        self.kept = keep
        self.kept_rank = np.cumsum(keep) - 1
        self.kept_at = order[keep]
        self.bits = max(1, int(size).bit_length())
        self.levels = []
        cur = self.bwt
        for b in range(self.bits - 1, -1, -1):
            ones = (cur >> b) & 1
            self.levels.append((np.concatenate(([0], np.cumsum(ones))).astype(np.int32), n - int(ones.sum())))
            cur = np.concatenate((cur[ones == 0], cur[ones == 1]))
        self.first = self._walk(np.arange(size + 1), np.zeros(size + 1, np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, (ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            r = ones[i]
            i = np.where((c >> b) & 1, zeros + r, i - r)
        return i

    def step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where suffixes that start with c, before the i-th suffix, end in the order."""
        return self.before[c] + self._walk(c, i) - self.first[c]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[lo, hi) of each phrase; phrases fill their row from the right."""
        width = phrases.shape[1]
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.bwt), np.int64)
        live = np.arange(len(phrases))
        for k in range(width):
            live = live[(hi[live] > lo[live])]
            now = live[lengths[live] > k]
            if not len(now):
                break
            c = phrases[now, width - 1 - k]
            lo[now], hi[now] = self.step(c, lo[now]), self.step(c, hi[now])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes."""
        rows, out, back = rows.copy(), np.zeros(len(rows), np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            done = self.kept[rows[todo]]
            out[todo[done]] = self.kept_at[self.kept_rank[rows[todo[done]]]] + back
            todo = todo[~done]
            c = self.bwt[rows[todo]]
            rows[todo] = self.step(c, rows[todo])
            back += 1
        return out


class Phrases:
    """The benchmark's distinct windows as rows of word numbers, filled from the right, and the items that have each."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.number: dict[bytes, int] = {}
        self.names = [x for x, _ in items]
        rows, owner = [np.zeros((0, width), np.int32)], [np.zeros(0, np.int32)]
        for k, (_, body) in enumerate(items):
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words(body)], np.int32)
            if len(ids):
                padded = np.concatenate((np.zeros(max(0, width - len(ids)), np.int32), ids))
                rows.append(np.lib.stride_tricks.sliding_window_view(padded, width))
                owner.append(np.full(len(rows[-1]), k, np.int32))
        rows, owner = np.concatenate(rows), np.concatenate(owner)
        order = np.lexsort((owner, *rows.T))
        rows, owner = rows[order], owner[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(1)
        again = ~new
        again[1:] &= owner[1:] == owner[:-1]  # the item has the window more than once
        first = np.flatnonzero(new[~again])
        self.rows, self.owner, self.first = rows[new], owner[~again], first
        self.count = np.diff(np.append(first, len(self.owner)))
        self.lengths = (self.rows > 0).sum(1)
        self.least = int(self.lengths.min()) if len(self.rows) else 0

    def of(self, window: int) -> np.ndarray:
        """Items that have the window."""
        return self.owner[self.first[window] : self.first[window] + self.count[window]]


def _cut_runs(starts: np.ndarray, ends: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs [start, end) in pieces of at most limit + overlap, each sharing `overlap` places with the next."""
    n = np.maximum(1, -(-(ends - starts - overlap) // limit))
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    lo = np.repeat(starts, n) + k * limit
    return lo, np.minimum(lo + limit + overlap, np.repeat(ends, n))


def _shards(starts: np.ndarray, ends: np.ndarray, limit: int):
    size = np.cumsum(ends - starts + 1)
    lo = 0
    while lo < len(starts):
        base = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, base + limit, "right")))
        yield slice(lo, hi)
        lo = hi


def hits(bodies: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """For each document: its number of words, hit spans [start, end) in words, and hit items."""
    get, ids, lens = phrases.number.get, [], []
    for body in bodies:
        ws = words(body)
        lens.append(len(ws))
        ids += [get(w, 0) for w in ws]
        ids.append(0)
    seq = np.array(ids, np.int64)
    begin = np.concatenate(([0], np.cumsum(np.array(lens, np.int64) + 1)))
    cover = np.zeros(len(seq) + 1, np.int64)
    of: list[set[int]] = [set() for _ in bodies]
    if phrases.least:
        edge = np.diff(np.concatenate(([0], (seq > 0).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= phrases.least
        starts, ends = _cut_runs(starts[long], ends[long], SHARD_WORDS, phrases.rows.shape[1] - 1)
        for part in _shards(starts, ends, SHARD_WORDS):
            s, size = starts[part], ends[part] - starts[part] + 1  # one more for the separator
            at = np.repeat(s - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            held = seq[at]
            held[np.cumsum(size) - 1] = 0
            index = ShardIndex(held, len(phrases.number))
            lo, hi = index.search(phrases.rows, phrases.lengths)
            n = np.maximum(hi - lo, 0)
            which = np.repeat(np.arange(len(n)), n)
            rows = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            where = at[index.locate(rows)]
            np.add.at(cover, where, 1)
            np.add.at(cover, where + phrases.lengths[which], -1)
            doc = np.searchsorted(begin, where, "right") - 1
            for d, w in np.unique(np.stack((doc, which), 1), axis=0).tolist():
                of[d].update(phrases.of(w).tolist())
    hit = np.diff(np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).view(np.int8), [0])))
    a, b = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
    first = np.searchsorted(a, begin)
    return [(lens[d], list(zip((a[first[d] : first[d + 1]] - begin[d]).tolist(), (b[first[d] : first[d + 1]] - begin[d]).tolist())), sorted(of[d])) for d in range(len(bodies))]


SCHEMA = "doc_id bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def _pieces(item_bytes: int, phrase: int):
    """Items of over item_bytes in pieces that share phrase - 1 words, so that each window lies in one."""

    def run(batches):
        for batch in batches:
            names, bodies = [], []
            for name, body in zip(batch["item"].to_pylist(), batch["body"].to_pylist()):
                if len(body) <= item_bytes:
                    names.append(name)
                    bodies.append(body)
                    continue
                ws = words(body)
                ends = np.cumsum([len(w) + 1 for w in ws])
                lo = 0
                while lo == 0 or lo + phrase - 1 < len(ws):
                    hi = max(lo + phrase, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + item_bytes, "right")))
                    names.append(name)
                    bodies.append(b" ".join(ws[lo:hi]))
                    lo = hi - phrase + 1
                    if len(bodies) > 16:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], ["item", "body"])
                        names, bodies = [], []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], ["item", "body"])

    return run


def join_spans(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans [start, end) of rows, those that meet or overlap as one; by row and start."""
    order = np.lexsort((start, rows))
    rows, start, end = rows[order], start[order].astype(np.int64), end[order].astype(np.int64)
    far = int(end.max()) + 1 if len(end) else 1
    reach = np.maximum.accumulate(end + rows * far)
    new = np.ones(len(rows), bool)
    new[1:] = start[1:] + rows[1:] * far > reach[:-1]
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(rows)) - 1 if len(lead) else lead
    return rows[lead], start[lead], reach[last] - rows[lead] * far


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _span_lists(n: int, rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    rows, start, end = join_spans(rows, start, end)
    edges = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n))))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"]))


def merged_spans(lists: Column) -> Column:
    """Of each row's lists of spans, those that meet or overlap as one."""

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def merge(col: pa.Array) -> pa.Array:
        inner = col.flatten()
        spans = inner.flatten()
        rows = np.repeat(np.repeat(np.arange(len(col)), pc.list_value_length(col).fill_null(0)), pc.list_value_length(inner).fill_null(0))
        return _span_lists(len(col), rows, np.asarray(spans.field("start")), np.asarray(spans.field("end")))

    return merge(lists)


def _pass(docs: DataFrame, blocks: list[list[tuple[str, bytes]]], phrase: int) -> DataFrame:
    """docs: doc_id, body and columns that are passed on. Each batch of documents meets all blocks of items."""
    kept = [c for c in docs.columns if c not in ("doc_id", "body")]
    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in kept)
    shared = docs.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        known = [Phrases(x, phrase) for x in shared.value]
        for batch in batches:
            ids, bodies = batch["doc_id"], batch["body"].to_pylist()
            lo = 0
            while lo < len(bodies):
                hi, size = lo, 0
                while hi < len(bodies) and (hi == lo or size + len(bodies[hi]) <= 8 << 20):
                    size += len(bodies[hi])
                    hi += 1
                found = [hits(bodies[lo:hi], x) for x in known]
                flat = np.array([(k, a, b) for one in found for k, x in enumerate(one) for a, b in x[1]], np.int64).reshape(-1, 3)
                items = [sorted({x.names[i] for x, one in zip(known, found) for i in one[k][2]}) for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array([x[0] for x in found[0]], pa.int64()), _span_lists(hi - lo, *flat.T), pa.array(items, pa.list_(pa.string())), *[batch[c].slice(lo, hi - lo) for c in kept]], ["doc_id", "n_words", "spans", "items", *kept])
                lo = hi

    return docs.mapInArrow(run, SCHEMA + kinds)


def contamination(docs: DataFrame, benchmark: DataFrame, phrase: int = PHRASE, item_bytes: int = ITEM_BYTES, at_once: int = AT_ONCE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, spans in words, items, then the columns in keep) of every document.

    Repeated item rows count once, longer items are cut into pieces with an overlap, and what is left is measured.
    Blocks of about item_bytes go to the workers, at_once of them in one pass without any shuffle; a larger
    benchmark takes several passes, whose hits are merged by document. Null and empty texts have no words; items
    without words match nothing; an item_id that is null counts as ''; rows with the same doc_id stay as many
    rows, and of items with equal texts each is named. Empty tables give no rows, or rows without hits; other
    columns are read only if they are kept, whatever their names."""
    bench = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(f"`{item_text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))
    bench = staged(bench.distinct().mapInArrow(_pieces(item_bytes, phrase), "item string, body binary"), "benchmark")
    size = bench.agg(F.sum(F.octet_length("body") + F.octet_length("item") + 16).alias("n")).first()["n"] or 0
    n = max(1, -(-size // item_bytes))
    keep = keep or []
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)]
    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"), *kept)
    named = [F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)]
    bench = bench.withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(n)))
    block = lambda k: [(r["item"], bytes(r["body"])) for r in bench.where(F.col("part") == k).collect()]
    if n <= at_once:
        found = _pass(plain, [block(k) for k in range(n)], phrase)
        return found.select("doc_id", "n_words", "spans", "items", *named)
    plain = plain.withColumn("sha", F.sha2("body", 256))
    once = plain.select("doc_id", "sha", "body")
    parts = None
    for k in range(0, n, at_once):
        found = staged(_pass(once, [block(i) for i in range(k, min(n, k + at_once))], phrase), "benchmark-hits")
        parts = found if parts is None else parts.unionByName(found)
    merged = parts.groupBy("doc_id", "sha").agg(F.max("n_words").alias("n_words"), F.collect_set("spans").alias("lists"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    merged = merged.withColumn("spans", merged_spans(F.col("lists"))).withColumnsRenamed({"doc_id": "of_id", "sha": "of_sha"})
    rows = plain.drop("body").join(merged, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("sha") == F.col("of_sha")))
    return rows.select("doc_id", "n_words", "spans", "items", *named)


def verdicts(found: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The counts, the items' digest and the verdict of contamination's rows, with the columns in keep."""
    kept = [f"kept_{i}" for i in range(len(keep or []))]
    found = found.toDF("doc_id", "n_words", "spans", "items", *kept)  # kept columns may have these names too
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(F.array_distinct("items")).cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.array_distinct("items")), ",").cast("binary"), 256).alias("items_sha256"), *kept).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
