"""Language-model scores by a probabilistic suffix tree over tokens.

A document is START, its lower-cased words and END. The tree's states are contexts of up to DEPTH symbols before
a token. The root knows each token's share of the training tokens, one share being for all unknown words. A
longer context is kept if it occurs SUPPORT times and its next-token distribution diverges from its suffix's: by
DIVERGENCE nats a place and more, each place being judged by the others (an empirical distribution of few
places always diverges from anything). Its distribution is smoothed with that of its longest kept suffix, so it
sums up to 1 over the known tokens and the unknown one, as the root's does. A token is scored from the longest
kept suffix of what precedes it.

The counts grow with the corpus, so they pass through neither driver nor broadcast. Blocks of documents are written once as
numbers of their words. They name their distinct words, then, one context length after another, their distinct (context, token) pairs whose
context occurs often enough; buckets add the counts up, test the contexts and answer the blocks. Contexts are named by a hash of 64 bits, the tokens behind one by 56;
words are told apart by their text. A context with very many places has its pairs in many buckets: each adds its share, and the sum decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import block_count, bucketed, in_blocks, staged, texts, total_bytes
from .repeats import MULT, _mix, grouped, pack, unpack

DEPTH = 2  # symbols of the longest context
SUPPORT = 2  # times that a context must occur
DIVERGENCE = 0.05  # nats a place
MASS = 10.0  # weight of the suffix's distribution in smoothing
HOT = 1_000_000  # places of a context from which on its pairs are dealt to many buckets, which each add their share to its test
HOT_PARTS = -1  # in the place of a block: rows with such shares
BLOCK_BYTES = 8 << 20
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


def tokenize(bodies: pa.ChunkedArray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(words of each text, distinct words, number of each word): lower-cased ASCII, between ASCII white space."""
    whole = bodies.cast(pa.large_binary()).combine_chunks()
    text = pa.Array.from_buffers(pa.large_string(), len(whole), whole.buffers(), offset=whole.offset)
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text))
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty part
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    names = coded.dictionary
    words = pa.Array.from_buffers(pa.large_binary(), len(names), names.buffers(), offset=names.offset).to_pylist()
    return np.bincount(np.repeat(np.arange(len(whole)), sizes)[filled], minlength=len(whole)), words, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * np.uint64(MULT) + b)


def _placed(words: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the words' hashes, their order by hash, bucket of each in that order): the same for the same set of words."""
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(w) for w in words], np.uint64)
    order = np.argsort(h, kind="stable")
    if (h[order][1:] == h[order][:-1]).any():
        order = np.array(sorted(range(len(words)), key=lambda i: (int(h[i]), words[i])))
    return h, order, (h[order] % np.uint64(n)).astype(np.int64)


class Coded:
    """A block's documents as numbers of its words: what all passes but the first read."""

    def __init__(self, blob: bytes):
        self.size, ids, joined, train, doc, known = unpack(blob)
        self.ids, self.train, self.words = ids.astype(np.int64), train > 0, joined.split(b" ") if joined else []
        self.doc = pa.array(doc, mask=known == 0)

    @staticmethod
    def row(docs: pa.Table) -> pa.Table:
        size, words, ids = tokenize(docs["body"])
        train, doc = np.array(docs["train"].to_pylist(), np.int8), docs["doc_id"].combine_chunks()
        known = np.asarray(doc.is_valid()).astype(np.int8)
        blob = pack(size.astype(np.int64), ids.astype(np.uint32), b" ".join(words), train, np.asarray(doc.fill_null(0)).astype(np.int64), known)
        return pa.table({"block": docs["block"][:1], "coded": pa.array([blob], pa.binary())})


CODED = "block int, coded binary"


def _name_words(n_buckets: int):
    """Rows by bucket: a block's distinct words, and how often training documents have each."""

    def run(batches):
        for batch in batches:
            for block, blob in zip(batch["block"].to_pylist(), batch["coded"].to_pylist()):
                own_ = Coded(blob)
                counts = np.bincount(own_.ids, np.repeat(own_.train, own_.size), len(own_.words)).astype(np.int64)
                _, order, place = _placed(own_.words, n_buckets)
                out = []
                for k, own in grouped(place):
                    own = order[own]
                    out.append((k, pack(b" ".join([own_.words[i] for i in own.tolist()]), counts[own])))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([block] * len(out), pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["bucket", "block", "blob"])

    return run


ASKED = "bucket int, block int, blob binary"
ANSWERS = "level int, block int, bucket int, blob binary, words bigint, tokens bigint"


def _answers(level: int, bucket: int, blocks: list[int], blobs: list[bytes], words: int = 0, tokens: int = 0) -> pa.Table:
    n = len(blocks)
    rest = [0] * max(0, n - 1)
    return pa.table({"level": pa.array([level] * n, pa.int32()), "block": pa.array(blocks, pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()), "blob": pa.array(blobs, pa.binary()), "words": pa.array([words, *rest][:n], pa.int64()), "tokens": pa.array([tokens, *rest][:n], pa.int64())})


def _sum_words(table: pa.Table) -> pa.Table:
    got = [unpack(x) for x in table["blob"].to_pylist()]
    total: dict[bytes, int] = {}
    for joined, n in got:
        for w, c in zip(joined.split(b" "), n.tolist()):
            total[w] = total.get(w, 0) + c
    known = sum(1 for c in total.values() if c)
    blobs = [pack(np.array([total[w] for w in joined.split(b" ")], np.int64)) for joined, _ in got]
    return _answers(0, table["bucket"][0].as_py(), table["block"].to_pylist(), blobs, known, sum(total.values()))


TOKEN_BYTES = 7  # of a token's hash, which tell the tokens behind one context apart
STEPS = 2048.0  # to the nat: how finely blocks tell buckets the shares by the suffix


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys in order, each once; a place of each; number of each place's key)."""
    order = np.argsort(keys)  # of equal ones any may come first
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def tokens_out(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]).tobytes()


def tokens_in(data: bytes) -> np.ndarray:
    keys = np.zeros((len(data) // TOKEN_BYTES, 8), np.uint8)
    keys[:, :TOKEN_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    return keys.view("<u8").ravel()


def counts_out(n: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Counts in a byte each; those of 255 and more beside them."""
    return np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype(np.int64)


def counts_in(small: bytes, large: np.ndarray) -> np.ndarray:
    n = np.frombuffer(small, np.uint8).astype(np.int64)
    n[n == 255] = large
    return n


class Block:
    """The symbols of a block's documents one after another, with what is known of each."""

    def __init__(self, docs: pa.Table, answers: pa.Table, n_buckets: int, tokens: int, words: int, ends: int, support: int = SUPPORT, mass: float = MASS, hot: int = HOT, dropped: tuple[np.ndarray, ...] = ()):
        self.n_buckets, self.support, self.mass, self.hot = n_buckets, support, mass, hot
        own = Coded(docs["coded"][0].as_py())
        size, words_, ids, self.doc = own.size, own.words, own.ids, own.doc
        self.size = size + 1  # with END
        first = np.cumsum(self.size + 1) - self.size - 1
        self.pos = np.arange(int((self.size + 1).sum())) - np.repeat(first, self.size + 1)
        last = first + self.size
        inner = np.ones(len(self.pos), bool)
        inner[first] = inner[last] = False
        names, order, place = _placed(words_, n_buckets)
        self.h = np.empty(len(self.pos), np.uint64)
        self.h[first], self.h[last], self.h[inner] = START, END, names[ids]
        self.train = np.repeat(own.train, self.size + 1)
        self.dropped = dropped
        self.answers = {(a, b): c for a, b, c in zip(answers["level"].to_pylist(), answers["bucket"].to_pylist(), answers["blob"].to_pylist())}
        count = np.zeros(len(words_), np.int64)
        for k, own in grouped(place):
            count[order[own]] = unpack(self.answers[0, k])[0]
        self.count = np.full(len(self.pos), ends, np.int64)  # of the symbol; START is as frequent as END
        self.count[inner] = count[ids]
        self.share = (self.count + 0.1) / (tokens + 0.1 * (words + 1))
        self.p = self.share.copy()
        #: of the `level` symbols that end at each place: hash and count
        self.level, self.ending, self.times = 1, self.h, self.count

    def asked(self):
        """What the next context length asks for: (places, pair of each place, order of the pairs by bucket and context, and
        in that order a place of each pair, its context, is that hot, its bucket)."""
        at = np.flatnonzero(self.pos >= self.level)
        at = at[self.times[at - 1] >= self.support]
        pairs, first, pair = distinct(_combine(self.ending[at - 1], self.h[at]))
        context, hot = self.ending[at[first] - 1], self.times[at[first] - 1] > self.hot
        bucket = (np.where(hot, pairs, context) % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(context, kind="stable")
        narrow = bucket.astype(np.uint16) if self.n_buckets <= 1 << 16 else bucket
        order = order[np.argsort(narrow[order], kind="stable")]
        return at, pair, order, at[first][order], context[order], hot[order], bucket[order]

    def ask(self) -> list[tuple[int, bytes]]:
        """Rows by bucket: contexts with their numbers of pairs and whether they are hot; tokens, training counts and log shares by the suffix."""
        at, pair, order, spot, context, hot, bucket = self.asked()
        n = np.bincount(pair, self.train[at], len(order))[order].astype(np.int64)
        logs = np.minimum(np.rint(-np.log(self.p[spot]) * STEPS), 65535).astype("<u2")
        out = []
        for k, own in grouped(bucket):
            c = context[own]
            lead = np.flatnonzero(np.concatenate((np.ones(1, bool), c[1:] != c[:-1])))
            size = np.diff(np.append(lead, len(c)))
            out.append((k, pack(c[lead], *counts_out(size), hot[own][lead].astype(np.int8), tokens_out(self.h[spot[own]]), *counts_out(n[own]), logs[own].tobytes())))
        return out

    def learn(self) -> None:
        """Take in the answers for the next context length."""
        at, pair, order, _, context, hot, bucket = self.asked()
        times, kept = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
        for k, own in grouped(bucket):
            small, large, flags = unpack(self.answers[self.level, k])
            c = context[own]
            number = np.cumsum(np.concatenate((np.zeros(1, np.int64), c[1:] != c[:-1])))
            times[order[own]] = counts_in(small, large)
            kept[order[own]] = np.unpackbits(np.frombuffer(flags, np.uint8))[number] > 0
        if len(self.dropped) >= self.level and len(self.dropped[self.level - 1]):  # hot ones that were tested as a whole
            kept[order[hot & np.isin(context, self.dropped[self.level - 1])]] = False
        n, use = times[pair], kept[pair]
        ending = np.zeros_like(self.h)
        ending[1:] = _combine(self.ending[:-1], self.h[1:])
        count = np.zeros(len(self.h), np.int64)
        count[at] = n
        context = self.times[at - 1]
        self.p[at[use]] = ((n + self.mass * self.p[at]) / (context + self.mass))[use]
        self.level, self.ending, self.times = self.level + 1, ending, count

    def sums(self, values: np.ndarray) -> np.ndarray:
        """By document, START left out."""
        start = np.cumsum(self.size + 1) - self.size - 1
        return np.add.reduceat(np.where(self.pos > 0, values, 0), start) if len(start) else np.zeros(0)


def _name_pairs(given: tuple, level: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple[int, bytes]] = []
        if docs.num_rows:
            block = Block(docs, answers, *given)
            for _ in range(level - 1):
                block.learn()
            rows = block.ask()
        at = docs["block"][0].as_py() if rows else 0
        return pa.table({"bucket": pa.array([x[0] for x in rows], pa.int32()), "block": pa.array([at] * len(rows), pa.int32()), "blob": pa.array([x[1] for x in rows], pa.binary())})

    return run


def gains(total: np.ndarray, p: np.ndarray, context: np.ndarray, mass: float) -> tuple[np.ndarray, np.ndarray]:
    """(places, gain in nats) of contexts numbered 0, 1, …: how much likelier each place is by the context's other places than by its suffix."""
    seen = total > 0
    n, c = total[seen].astype(np.float64), context[seen]
    size = int(context.max()) + 1 if len(context) else 0
    places = np.bincount(c, n, size)
    own = np.bincount(c, n * (np.log(n - 1 + mass * p[seen]) - np.log(p[seen])), size)
    return places, own - places * np.log(np.maximum(places - 1 + mass, 1e-9))


def _sum_pairs(level: int, support: int, divergence: float, mass: float):
    def run(table: pa.Table) -> pa.Table:
        got = [unpack(x) for x in table["blob"].to_pylist()]
        sizes = [counts_in(x[1], x[2]) for x in got]
        contexts, hot = (np.concatenate([x[k] for x in got]) for k in (0, 3))
        context = np.repeat(contexts, np.concatenate(sizes))
        hot_ = np.repeat(hot, np.concatenate(sizes)) > 0
        n = np.concatenate([counts_in(x[5], x[6]) for x in got])
        logs = np.concatenate([np.frombuffer(x[7], "<u2") for x in got]).astype(np.float64)
        pairs, first, which = distinct(_combine(context, np.concatenate([tokens_in(x[4]) for x in got])))
        total = np.bincount(which, n, len(pairs)).astype(np.int64)
        names, spot, number = distinct(context[first])
        places, gain = gains(total, np.exp(-logs[first] / STEPS), number, mass)
        warm = hot_[first][spot]
        kept = warm | ((places >= support) & (gain >= divergence * places))
        edge, lead = np.cumsum([0, *[int(x.sum()) for x in sizes]]), np.cumsum([0, *[len(x) for x in sizes]])
        of = kept[np.searchsorted(names, contexts)]
        blobs = [pack(*counts_out(total[which[a:b]]), np.packbits(of[c:d]).tobytes()) for a, b, c, d in zip(edge[:-1], edge[1:], lead[:-1], lead[1:])]
        blocks = table["block"].to_pylist()
        if warm.any():  # these have pairs in other buckets too: what each adds to the test
            own, c = total > 0, number
            part = np.bincount(c[own], total[own] * (np.log(total[own] - 1 + mass * np.exp(-logs[first][own] / STEPS)) + logs[first][own] / STEPS), len(names))
            blobs.append(pack(names[warm], places[warm].astype(np.int64), np.rint(part[warm] * 1000).astype(np.int64)))  # thousandths of a nat
            blocks.append(HOT_PARTS)
        return _answers(level, table["bucket"][0].as_py(), blocks, blobs)

    return run


def _dropped(answers: DataFrame, level: int, support: int, divergence: float, mass: float) -> np.ndarray:
    """Hot contexts that the test as a whole doesn't keep. There is at most one hot context for `hot` tokens, at 8 bytes each."""

    def parts(batches):
        for b in batches:
            got = [unpack(x) for x in b["blob"].to_pylist()]
            cols = [np.concatenate([np.zeros(0, t), *[x[k] for x in got]]) for k, t in enumerate((np.uint64, np.int64, np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0].view(np.int64)), pa.array(cols[1]), pa.array(cols[2] / 1000)], ["context", "places", "own"])

    rows = answers.where((F.col("level") == level) & (F.col("block") == HOT_PARTS)).select("blob").mapInArrow(parts, "context bigint, places bigint, own double")
    whole = rows.groupBy("context").agg(F.sum("places").alias("places"), F.sum("own").alias("own"))
    gain = F.col("own") - F.col("places") * F.log(F.greatest(F.col("places") - 1 + mass, F.lit(1e-9)))
    lost = whole.where((F.col("places") < support) | (gain < divergence * F.col("places"))).select("context").collect()
    return np.array(sorted(r["context"] for r in lost), np.int64).view(np.uint64)


OUT = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(given: tuple, depth: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
        block = Block(docs, answers, *given)
        for _ in range(depth):
            block.learn()
        n_known = block.sums((block.count > 0).astype(np.int64))
        return pa.table({"doc_id": block.doc, "n_tokens": pa.array(block.size, pa.int64()), "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(block.sums(np.log10(block.share))), "score": pa.array(block.sums(np.log10(block.p)))})

    return run


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, support: int = SUPPORT, divergence: float = DIVERGENCE, mass: float = MASS, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    train: a condition on the column doc_id that marks what is learned from. Null and empty texts are the end
    token alone. Rows with the same or a null doc_id are scored each, and repeated rows count as often as they
    occur. Without training documents every token has the share of an unknown one. An empty table gives none;
    extra columns aren't read."""
    spark = docs.sparkSession
    bodies = texts(docs, id_col, text_col)
    size = total_bytes(bodies)
    n_blocks = block_count(spark, size, block_bytes)
    n_buckets = max(1, -(-size // block_bytes))
    blocks = in_blocks(bodies.withColumn("train", F.coalesce(train, F.lit(False))), n_blocks)

    def by_block(df: DataFrame):
        return df.repartition(n_blocks, "block").groupBy("block")

    def by_bucket(df: DataFrame):
        return df.repartition(n_buckets, "bucket").groupBy("bucket")

    # in buckets by block: the passes read it where it lies, and only the answers are sent to it
    coded = bucketed(by_block(blocks).applyInArrow(Coded.row, CODED), "tree_tokens", "block")
    answers = staged(by_bucket(coded.mapInArrow(_name_words(n_buckets), ASKED)).applyInArrow(_sum_words, ANSWERS), "tree-words")
    sums = answers.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    ends = bodies.where(train).count()
    tokens, words = sums["tokens"] + ends, sums["words"] + (ends > 0)
    given = (n_buckets, tokens, words, ends, support, mass, hot)
    dropped: tuple[np.ndarray, ...] = ()
    for level in range(1, depth + 1):
        named = coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_name_pairs((*given, dropped), level), ASKED)
        new = staged(by_bucket(named).applyInArrow(_sum_pairs(level, support, divergence, mass), ANSWERS), "tree-pairs")
        dropped = (*dropped, _dropped(new, level, support, divergence, mass))
        answers = answers.unionByName(new.where(F.col("block") >= 0))
    out = coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score((*given, dropped), depth), OUT)
    return out.withColumn("train_tokens", F.lit(tokens).cast("bigint"))
