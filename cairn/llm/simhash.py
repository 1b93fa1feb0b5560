"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has a bit set where over half of its shingles' hashes have it. Two fingerprints
link at BITS or fewer differing bits. The 64 bits are a ring of five segments. If at most four bits
differ, then from some segment on, every chain of 1, 2, 3, 4 consecutive segments differs in at most
4/5, 8/5, 12/5, 16/5 bits, so in 0, 1, 2, 3. Links are looked for where a chain of two agrees that far:
each fingerprint offers the values of two segments and asks for them and for all values that differ in
one bit of the second. Longer chains then prune, and the full distance decides.

Fingerprints that share such a value meet in numpy blocks that return a spanning forest, not pairs. A
value that more than HOT fingerprints share is dealt with otherwise: these fingerprints each name all
values within two bits; two fingerprints within four bits name a common value, so linking all that name
a value to its smallest finds the same groups, with work in proportion to their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, texts

SHINGLE = 4
BITS = 4  # the ring below is laid out for this many
SEED = 42
HOT = 4096
#: The ring's segments: first bit and width.
RING = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    """64 bits; zero for a text without words."""
    w = body.lower().split()
    if not w:
        return 0
    hashed, seed = xxhash.xxh64_intdigest, SEED
    if len(w) <= shingle:
        return hashed(b" ".join(w), seed)
    ones, n = np.zeros(64, np.int64), len(w) - shingle + 1
    for lo in range(0, n, 1 << 16):
        part = w[lo : lo + (1 << 16) + shingle - 1]
        h = np.array([hashed(b" ".join(x), seed) for x in zip(*[part[k:] for k in range(shingle)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint): the fingerprint's bits as a signed number; no shuffle."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, shingle) for x in b["body"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp)], ["doc_id", "fp"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def _cut(fp: np.ndarray, at: int, width: int) -> np.ndarray:
    return (fp >> np.uint64(at)) & np.uint64((1 << width) - 1)


def _offers(batches):
    """For each fingerprint and ring position: its own value (role 0) and those it asks for (role 1)."""
    for b in batches:
        fp = np.asarray(b["fp"]).view(np.uint64)
        keys, fps, roles = [], [], []
        for i, (at, width) in enumerate(RING):
            nxt, more = RING[(i + 1) % 5]
            head = (np.uint64(i) << np.uint64(26)) | (_cut(fp, at, width) << np.uint64(13))
            tail = _cut(fp, nxt, more)
            for flip in (0, *[1 << k for k in range(more)]):
                keys.append(head | (tail ^ np.uint64(flip)))
                fps.append(fp)
                roles.append(np.full(len(fp), flip > 0, np.int8))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(fps).view(np.int64)), pa.array(np.concatenate(roles))], ["key", "fp", "role"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) of the linked nodes that aren't the smallest."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        np.minimum.at(least, label, least)  # roots follow their members
        least = least[least]
        if (least == label).all():
            break
        label = least
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _links(key: np.ndarray, fp: np.ndarray, role: np.ndarray, bits: int):
    """Forests of the links among rows with the same key, of which one has role 0."""
    order = np.lexsort((role, key))
    key, fp, role = key[order], fp[order].view(np.uint64), role[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    owners = np.add.reduceat((role == 0).astype(np.int64), first)
    per = np.repeat(np.where(size > 1, owners, 0), size)  # partners of each row
    start = np.repeat(first, size)
    found_a, found_b = [], []
    done = np.cumsum(per)
    lo = 0
    while lo < len(per):
        hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + 2_000_000, "right")))
        n = per[lo:hi]
        row = np.repeat(np.arange(lo, hi), n)
        other = np.repeat(start[lo:hi] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ring = key[row] >> 26
        diff = fp[row] ^ fp[other]
        for i in range(5):
            mine = np.flatnonzero((ring == i) & (row != other))
            d = diff[mine]
            mask = 0
            for length in range(1, 5):  # chains within their budgets
                at, width = RING[(i + length - 1) % 5]
                mask |= ((1 << width) - 1) << at
                ok = np.bitwise_count(d & np.uint64(mask)) <= bits * length // 5
                mine, d = mine[ok], d[ok]
            mine = mine[np.bitwise_count(d) <= bits]
            found_a.append(fp[row[mine]])
            found_b.append(fp[other[mine]])
        lo = hi
    a, b = np.concatenate(found_a).view(np.int64), np.concatenate(found_b).view(np.int64)
    return forest(a, b)


def _meet(bits: int, hot: int):
    names = ["a", "b", "hot"]

    def rows(a, b, is_hot):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), is_hot))], names)

    def run(batches):
        left = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8))
        busy = None  # the key of a group that has proved hot
        for b in batches:
            now = tuple(np.concatenate((x, np.asarray(b[c]))) for x, c in zip(left, ("key", "fp", "role")))
            key = now[0]
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last group may go on
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(first, len(key)))
            large = np.repeat((size > hot) | (key[first] == busy), size)
            if large.any():
                fp = np.unique(now[1][large])
                yield rows(fp, fp, True)
                busy = key[-1] if large[-1] else None
            if large[-1]:
                cut = len(key)  # its rows have all been named
            whole = np.flatnonzero(~large[:cut])
            if len(whole):
                yield rows(*_links(*(x[whole] for x in now), bits), False)
            left = tuple(x[cut:] for x in now)
        if len(left[0]):
            yield rows(*_links(*left, bits), False)

    return run


def _near_points(batches):
    """All values within two bits of each hot fingerprint, with the smallest that names each, by batch."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate((np.zeros(1, np.uint64), one, one[i] ^ one[j]))
    for b in batches:
        fp = np.asarray(b["fp"]).view(np.uint64)
        for lo in range(0, len(fp), 256):
            part = fp[lo : lo + 256]
            yield pa.RecordBatch.from_arrays([pa.array((part[:, None] ^ flips).ravel().view(np.int64)), pa.array(np.repeat(part, len(flips)).view(np.int64))], ["z", "fp"])


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) edges whose components are those of all links between the distinct fingerprints in column fp."""
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    offers = distinct.mapInArrow(_offers, "key bigint, fp bigint, role tinyint")
    met = staged(offers.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_meet(BITS, hot), "a bigint, b bigint, hot boolean"), "simhash-links")
    few = met.where("not hot").select("a", "b").distinct()
    crowd = met.where("hot").select(F.col("a").alias("fp")).distinct()
    points = crowd.mapInArrow(_near_points, "z bigint, fp bigint")
    roots = points.groupBy("z").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most").select("z", "b")
    more = points.join(roots, "z").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return few.unionByName(more)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node that it reaches.

    Large stars and small stars in turn: each node's neighbours move to its smallest one, until nothing
    changes. Only minima are gathered by node, so a node with very many neighbours is no burden."""
    cur = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # as a table, so that Spark can split the join's share of a node with very many neighbours
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "components-least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        new = staged(small.unionByName(down.select("a", F.col("m").alias("b"))).distinct(), "components")
        tell = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tell(new) == tell(cur):
            return new.select(F.col("a").alias("node"), F.col("b").alias("root"))
        cur = new


def _rooted(prints: DataFrame, hot: int) -> DataFrame:
    """(fp, root, least): each fingerprint with its component's smallest one, and its own least `rank`."""
    classes = staged(prints.groupBy("fp").agg(F.min("rank").alias("least")), "simhash-classes")
    roots = components(links(classes.select("fp"), hot))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest doc_id reachable over links.

    Null and empty texts have fingerprint zero and link like others. Rows with the same doc_id each have
    their own fingerprint. A null doc_id is no candidate for component_id, which is null where a component
    has no other. An empty table gives none."""
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    rooted = _rooted(prints.withColumn("rank", F.col("doc_id")), hot)
    ids = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    owned = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(owned, "fp").select("doc_id", "fp", "component_id")


def _hashable(rows: DataFrame, name: str) -> Column:
    """The column, or its JSON text where it holds what Spark has no hash of."""
    kind = rows.schema[name].dataType.simpleString()
    return F.to_json(F.struct(name)) if "map<" in kind or "variant" in kind else F.col(name)


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One whole row of each component: that with the smallest doc_id, null last; of several, the one whose row hashes smallest.

    Components are told apart by their fingerprints, so null and repeated ids are rows like others. Columns of
    any kind are kept, under any names; an empty table gives none."""
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(docs.columns)]
    plain = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"), *kept)
    carried = [c for c in plain.columns if c != "body"]
    kinds = ", ".join(f"{c} {plain.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x, shingle) for x in b["body"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b[c] for c in carried], pa.array(fp)], [*carried, "fp"])

    # the row's number holds once the table is written
    rows = staged(plain.mapInArrow(run, f"{kinds}, fp bigint").withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*[_hashable(rows, f"kept_{i}") for i in range(len(kept))]).alias("hash"), "row")
    rooted = _rooted(rows.select("fp", rank.alias("rank")), hot)
    first = staged(rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row").alias("row")), "simhash-first")
    # nearly as many as the rows: never to be broadcast, however small the table
    return rows.join(first.hint("merge"), "row").select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)])


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
