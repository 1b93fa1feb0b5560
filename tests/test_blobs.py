"""Geometry blobs against a plain reader and writer, and boxes against exact clipping."""

import math
import struct
from fractions import Fraction

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.functions import blobs, spatial

number = st.integers(-50, 50).map(float)
point = st.tuples(number, number)
SHAPES = {
    "Point": st.lists(st.lists(st.lists(point, min_size=1, max_size=1), min_size=1, max_size=1), min_size=1, max_size=1),
    "LineString": st.lists(st.lists(st.lists(point, min_size=1, max_size=5), min_size=1, max_size=1), min_size=1, max_size=1),
    "Polygon": st.lists(st.lists(st.lists(point, min_size=1, max_size=5), min_size=1, max_size=3), min_size=1, max_size=1),
    "MultiPoint": st.lists(st.lists(st.lists(point, min_size=1, max_size=1), min_size=1, max_size=1), max_size=4),
    "MultiLineString": st.lists(st.lists(st.lists(point, min_size=1, max_size=5), min_size=1, max_size=1), max_size=3),
    "MultiPolygon": st.lists(st.lists(st.lists(point, min_size=1, max_size=5), min_size=1, max_size=3), max_size=3),
}
shape = st.sampled_from(list(SHAPES)).flatmap(lambda k: st.tuples(st.just(k), SHAPES[k]))


def wkb(kind: str, parts: list, order: str, dims: str = "", extended: bool = False, srs: int | None = None) -> bytes:
    """Well-known binary by hand."""
    extra = len(dims)

    def head(k: str, own: int | None = None) -> bytes:
        number = blobs.KINDS.index(k)
        number = number | (0x80000000 if "z" in dims else 0) | (0x40000000 if "m" in dims else 0) if extended else number + 1000 * {"": 0, "z": 1, "m": 2, "zm": 3}[dims]
        return struct.pack(order + "BI", order == "<", number | (0x20000000 if own is not None else 0)) + (b"" if own is None else struct.pack(order + "i", own))

    points = lambda ps: b"".join(struct.pack(order + f"{2 + extra}d", *p, *[9.0] * extra) for p in ps)
    count = lambda n: struct.pack(order + "I", n)

    def single(k: str, rings: list, own: int | None = None) -> bytes:
        if k == "Point":
            return head(k, own) + points(rings[0])
        if k == "LineString":
            return head(k, own) + count(len(rings[0])) + points(rings[0])
        return head(k, own) + count(len(rings)) + b"".join(count(len(r)) + points(r) for r in rings)

    if kind.startswith("Multi"):
        return head(kind, srs) + count(len(parts)) + b"".join(single(kind[5:], p) for p in parts)
    return single(kind, parts[0], srs)


def framed(body: bytes, srs: int, envelope: int, order: str) -> bytes:
    return b"GP\0" + bytes([envelope << 1 | (order == "<")]) + struct.pack(order + "i", srs) + bytes(blobs.ENVELOPES[envelope]) + body


def plain(got) -> list:
    return [None if g is None else (g["geom_type"], g["srs_id"], [[[(p["x"], p["y"]) for p in r] for r in part] for part in g["parts"]]) for g in got.to_pylist()]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(shape, st.sampled_from("<>"), st.sampled_from(["", "z", "m", "zm"]), st.booleans(), st.one_of(st.none(), st.integers(0, 4)), st.integers(-1, 99999)), max_size=6))
def test_reads_every_kind(rows):
    data, want = [b"", None, b"GP"], [None, None, None]
    for (kind, parts), order, dims, extended, envelope, srs in rows:
        body = wkb(kind, parts, order, dims, extended, srs if extended else None)
        data.append(body if envelope is None else framed(body, srs, envelope, order))
        want.append((kind, srs if extended or envelope is not None else 0, parts))
    assert plain(blobs.parse(pa.array(data, pa.binary()))) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(shape, min_size=1, max_size=6), st.booleans(), st.booleans(), st.integers(0, 99999))
def test_round_trip(shapes, envelope, big, srs):
    to = lambda parts: [[[{"x": x, "y": y} for x, y in r] for r in p] for p in parts]
    given_ = pa.array([{"geom_type": k, "srs_id": srs, "parts": to(p)} for k, p in shapes] + [None, {"geom_type": "Curve", "srs_id": 1, "parts": []}], blobs.READ)
    out = blobs.render(given_, envelope, big)
    assert out.to_pylist()[-2:] == [None, None]
    assert plain(blobs.parse(out)) == [(k, srs, p) for k, p in shapes] + [None, None]
    for blob, (k, parts) in zip(out.to_pylist(), shapes):
        points = [p for part in parts for r in part for p in r]
        order = ">" if big else "<"
        box = struct.pack(order + "4d", min(x for x, _ in points), max(x for x, _ in points), min(y for _, y in points), max(y for _, y in points)) if envelope and points else b""
        assert blob == b"GP\0" + bytes([(2 if box else 0) | (not big) | (0 if points else 16)]) + struct.pack(order + "i", srs) + box + wkb(k, parts, order)


@settings(max_examples=150, deadline=None)
@given(shape, st.sampled_from("<>"), st.data())
def test_cut_blobs_are_null(s, order, data):
    body = framed(wkb(*s, order), 3006, 1, order)
    cut = data.draw(st.integers(0, len(body) - 1))
    assert plain(blobs.parse(pa.array([body[:cut], body], pa.binary())))[0] is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=4), shape, st.integers(0, 200), st.integers(0, 255))
def test_any_bytes(noise, s, at, byte):
    """Whatever the bytes, reading ends, and good blobs beside them are read."""
    good = framed(wkb(*s, "<"), 1, 0, "<")
    bad = bytearray(good)
    bad[at % len(bad)] = byte
    got = plain(blobs.parse(pa.array([*noise, bytes(bad), b"GP\0\1" + bytes(4) + b"\1\6\0\0\0\xff\xff\xff\xff", good], pa.binary())))
    assert got[-1] == (s[0], 1, s[1]) and got[-2] is None


def test_empty_and_unknown():
    nan = struct.pack("<BI2d", 1, 1, math.nan, math.nan)
    line, polygon, curve = struct.pack("<BII", 1, 2, 0), struct.pack("<BII", 1, 3, 0), struct.pack("<BII", 1, 8, 0)
    mixed = struct.pack("<BII", 1, 4, 1) + struct.pack("<BII", 1, 2, 0)  # a line among points
    collection = struct.pack("<BII", 1, 7, 2) + wkb("Point", [[[(1.0, 2.0)]]], ">") + wkb("MultiLineString", [[[(0.0, 0.0), (1.0, 1.0)]]], "<")
    got = plain(blobs.parse(pa.array([nan, line, polygon, curve, mixed, collection], pa.binary())))
    assert got == [("Point", 0, []), ("LineString", 0, []), ("Polygon", 0, []), None, None, ("GeometryCollection", 0, [[[(1.0, 2.0)]], [[(0.0, 0.0), (1.0, 1.0)]]])]
    none = pa.array([{"geom_type": k, "srs_id": 0, "parts": []} for k in ("Point", "LineString", "Polygon", "MultiPolygon")], blobs.READ)
    assert [g and g[2] for g in plain(blobs.parse(blobs.render(none, True, False)))] == [[], [], [], []]


def test_many_rings():
    rings = [[(float(k), 0.0), (k + 0.5, 0.0), (float(k), 1.0), (float(k), 0.0)] for k in range(3000)]
    assert plain(blobs.parse(pa.array([wkb("Polygon", [rings], ">")], pa.binary()))) == [("Polygon", 0, [rings])]


# ---- boxes


def clip(p, q, box) -> bool:
    """Whether a segment meets a box, by clipping in exact numbers."""
    t0, t1 = Fraction(0), Fraction(1)
    for k in (0, 1):
        a, d, lo, hi = Fraction(p[k]), Fraction(q[k]) - Fraction(p[k]), Fraction(box[k]), Fraction(box[k + 2])
        if d == 0:
            if not lo <= a <= hi:
                return False
        else:
            u, v = sorted(((lo - a) / d, (hi - a) / d))
            t0, t1 = max(t0, u), min(t1, v)
    return t0 <= t1


def within(p, rings) -> bool:
    """Even-odd rule in exact numbers."""
    odd = False
    for r in rings:
        for a, b in zip(r, r[1:]):
            if (a[1] > p[1]) != (b[1] > p[1]) and Fraction(b[0] - a[0]) * Fraction(p[1] - a[1]) / Fraction(b[1] - a[1]) + Fraction(a[0]) > p[0]:
                odd = not odd
    return odd


def meets(kind, parts, box) -> bool:
    for rings in parts:
        for r in rings:
            if any(clip(a, b, box) for a, b in zip(r, r[1:] if "Point" not in kind and len(r) > 1 else r)):
                return True
        if "Polygon" in kind and within(box[:2], rings):
            return True
    return False


@pytest.fixture(scope="module")
def boxed(spark):
    import random

    rnd = random.Random(4)
    spot = lambda: (float(rnd.randrange(0, 20)), float(rnd.randrange(0, 20)))
    rows = [("Polygon", [[[(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0), (0.0, 0.0)], [(5.0, 5.0), (15.0, 5.0), (15.0, 15.0), (5.0, 15.0), (5.0, 5.0)]]], b) for b in [(7.0, 7.0, 8.0, 8.0), (1.0, 1.0, 2.0, 2.0), (5.0, 7.0, 6.0, 8.0), (-5.0, -5.0, 40.0, 40.0), (-5.0, 3.0, -1.0, 4.0)]]
    for _ in range(1500):
        kind = rnd.choice(list(SHAPES))
        n = rnd.randrange(1, 3) if kind.startswith("Multi") else 1
        if "Point" in kind:
            parts = [[[spot()]] for _ in range(n)]
        elif "Line" in kind:
            parts = [[[spot() for _ in range(rnd.randrange(1, 4))]] for _ in range(n)]
        else:
            parts = []
            for _ in range(n):
                rings = []
                for _ in range(rnd.randrange(1, 3)):
                    ring = [spot() for _ in range(rnd.randrange(3, 5))]
                    rings.append([*ring, ring[0]])
                parts.append(rings)
        x, y = spot()
        rows.append((kind, parts, (x, y, x + rnd.choice([0, 1, 4]), y + rnd.choice([0, 1, 4]))))
    return rows


def test_boxes_against_clipping(spark, boxed):
    df = spark.createDataFrame([(i, k, p, *b) for i, (k, p, b) in enumerate(boxed)], f"i int, kind string, parts {blobs.PARTS}, a double, b double, c double, d double")
    got = {r[0]: r[1] for r in df.select("i", spatial.meets_box(F.col("kind"), F.col("parts"), *[F.col(c) for c in "abcd"])).collect()}
    wrong = [(b, got[i], meets(*b)) for i, b in enumerate(boxed) if got[i] != meets(*b)]
    assert wrong == [] and 100 < sum(got.values()) < 1400


def test_parts(spark):
    square = lambda x, n: [(x, 0.0), (x + n, 0.0), (x + n, n), (x, n), (x, 0.0)]
    rows = [("MultiPolygon", [[square(0.0, 10.0), square(1.0, 2.0)], [square(20.0, 3.0)]]), ("Polygon", []), ("LineString", [[[(1.0, 5.0), (2.0, 3.0)]]]), (None, None)]
    df = spark.createDataFrame(rows, f"kind string, parts {blobs.PARTS}")
    got = df.select(spatial.parts_area(F.col("kind"), F.col("parts")), spatial.bounds(F.col("parts")), spatial.meets_box(F.col("kind"), F.col("parts"), 0, 0, 1, 4)).collect()
    assert [r[0] for r in got] == [105.0, 0.0, 0.0, None]
    assert [r[1] and tuple(r[1]) for r in got] == [(0.0, 0.0, 23.0, 10.0), None, (1.0, 3.0, 2.0, 5.0), None]
    assert [r[2] for r in got] == [True, False, False, None]
