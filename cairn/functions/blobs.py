"""Geometry blobs: the header of layered files, then well-known binary of any kind, read and written.

A blob is `GP`, a version byte, flags (byte order, kind of envelope, empty), a reference system's number, an
envelope of 0, 4, 6 or 8 doubles, and the geometry: points, lines, polygons, their multiples, and collections,
in either byte order, with Z and M (ISO and extended type numbers alike), of which x and y are kept. Bare
well-known binary is read too.

A geometry is parts of rings of points: a point is one ring of one point, a line one ring, a polygon its outer
ring and then its holes, and each member of a multiple is a part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The kinds by number, bytes of the envelopes by their number, and flags of extended types.
KINDS = ("", "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
ENVELOPES = (0, 32, 48, 48, 64)
HAS_Z, HAS_M, HAS_SRS = 0x80000000, 0x40000000, 0x20000000

PARTS = "array<array<array<struct<x:double,y:double>>>>"
GEOMETRY = f"struct<geom_type:string,srs_id:int,parts:{PARTS}>"
POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
READ = pa.struct([("geom_type", pa.string()), ("srs_id", pa.int32()), ("parts", pa.list_(pa.list_(pa.list_(POINT))))])


class _Bytes:
    """All blobs of a batch as one array, with reads at many places at once."""

    def __init__(self, blobs: pa.Array):
        whole = blobs.cast(pa.large_binary())
        edges = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
        self.start, self.end = edges[:-1], edges[1:]
        data = whole.buffers()[2]
        self.data = np.concatenate((np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), np.zeros(64, np.uint8)))

    def u4(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        got = np.ascontiguousarray(self.data[at[:, None] + np.arange(4)])
        return np.where(little, got.view("<u4").ravel(), got.view(">u4").ravel()).astype(np.int64)

    def f8(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        got = np.ascontiguousarray(self.data[at[:, None] + np.arange(8)])
        return np.where(little, got.view("<f8").ravel(), got.view(">f8").ravel())


def _ranges(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, one after another."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def parse(blobs: pa.Array) -> pa.Array:
    """struct(geom_type, srs_id, parts) of each blob; null for null, broken and unknown ones.

    All blobs go on together, one header or ring a round, so a batch takes as many rounds as its largest geometry
    has parts and rings."""
    src, n = _Bytes(blobs), len(blobs)
    at, end = src.start.copy(), src.end
    size = end - at
    framed = (size >= 8) & (src.data[at] == 0x47) & (src.data[at + 1] == 0x50)
    flags = np.where(framed, src.data[at + 3], 0).astype(np.int64)
    envelope = np.append(ENVELOPES, [-1, -1, -1])[flags >> 1 & 7]
    srs = np.where(framed, src.u4(at + 4, flags & 1 == 1), 0).astype(np.uint32).view(np.int32).copy()
    at = np.where(framed, at + 8 + np.maximum(envelope, 0), at)
    ok = np.asarray(blobs.is_valid()) & (envelope >= 0) & (size > 0) & (at < end)
    kind = np.zeros(n, np.int64)
    members = np.where(ok, 1, 0)  # geometries still to come
    rings = np.zeros(n, np.int64)  # rings still to come of the one at hand
    little, width = np.ones(n, bool), np.full(n, 2)
    parts, found = np.zeros(n, np.int64), [np.zeros((5, 0), np.int64)]  # blob, part, place of the points, their number, their width and order
    while True:
        head = np.flatnonzero(ok & (rings == 0) & (members > 0))
        ring = np.flatnonzero(ok & (rings > 0))
        if not len(head) and not len(ring):
            break
        if len(head):
            fits = at[head] + 5 <= end[head]
            ok[head[~fits]] = False
            head = head[fits]
            order = src.data[at[head]]
            little[head] = order == 1
            raw = src.u4(at[head] + 1, little[head])
            flagged = raw & (HAS_Z | HAS_M | HAS_SRS)
            base = raw - flagged
            dims, what = base // 1000, base % 1000
            width[head] = 2 + np.where(dims > 0, np.array([0, 1, 1, 2])[np.minimum(dims, 3)], (flagged & HAS_Z > 0) * 1 + (flagged & HAS_M > 0))
            at[head] += 5
            own = flagged & HAS_SRS > 0
            srs[head[own]] = src.u4(np.minimum(at[head[own]], len(src.data) - 4), little[head[own]]).astype(np.uint32).view(np.int32)
            at[head] += np.where(own, 4, 0)
            first = kind[head] == 0
            under = kind[head]
            good = (order <= 1) & (dims <= 3) & (what >= 1) & (what <= 7) & (first | (under == 7) | ((under >= 4) & (what == under - 3)))
            counted = what > 1
            good &= at[head] + np.where(counted, 4, 0) <= end[head]
            ok[head[~good]] = False
            head, what, counted, first = head[good], what[good], counted[good], first[good]
            kind[head] = np.where(first, what, kind[head])
            count = np.where(counted, src.u4(np.minimum(at[head], len(src.data) - 4), little[head]), 1)
            members[head] += np.where(what >= 4, count, 0) - 1
            rings[head] = np.where(what == 3, count, np.where(what < 3, 1, 0))
            # the number of a line's points is read with its ring, and a point has none
            at[head] += np.where((what == 3) | (what >= 4), 4, 0)
            single = head[what == 1]
            parts[head[what <= 3]] += 1
            fits = (at[single] + 8 * width[single] <= end[single])
            ok[single[~fits]] = False
            single = single[fits]
            found.append(np.stack([single, parts[single], at[single], np.ones(len(single), np.int64), width[single] * 2 + little[single]]))
            at[single] += 8 * width[single]
            rings[single] = 0
            # more members or rings than bytes are broken, and would go on for long
            ok[(members * 5 > end - at) | (rings * 4 > end - at)] = False
        ring = ring[ok[ring]]
        if len(ring):
            fits = at[ring] + 4 <= end[ring]
            ok[ring[~fits]] = False
            ring = ring[fits]
            count = src.u4(at[ring], little[ring])
            fits = at[ring] + 4 + 8 * width[ring] * count <= end[ring]
            ok[ring[~fits]] = False
            ring, count = ring[fits], count[fits]
            found.append(np.stack([ring, parts[ring], at[ring] + 4, count, width[ring] * 2 + little[ring]]))
            at[ring] += 4 + 8 * width[ring] * count
            rings[ring] -= 1
    ok &= kind > 0
    blob, part, place, count, how = np.concatenate(found, 1)
    order = np.argsort(blob, kind="stable")
    order = order[ok[blob[order]]]
    blob, part, place, count, how = (x[order] for x in (blob, part, place, count, how))
    step = np.repeat(8 * (how // 2), count)
    where, order = np.repeat(place, count) + _ranges(count) * step, np.repeat(how % 2 == 1, count)
    x, y = src.f8(where, order), src.f8(where + 8, order)
    real = ~(np.isnan(x) | np.isnan(y))  # an empty point is of not-a-numbers
    count = np.bincount(np.repeat(np.arange(len(count)), count)[real], minlength=len(count)) if len(count) else count
    some = count > 0  # what is empty has no parts
    blob, part, count = blob[some], part[some], count[some]
    points = pa.StructArray.from_arrays([pa.array(x[real]), pa.array(y[real])], ["x", "y"])
    cuts = lambda k: pa.array(np.concatenate(([0], np.cumsum(k))).astype(np.int32))
    ring_list = pa.ListArray.from_arrays(cuts(count), points)
    new = np.ones(len(blob), bool)
    new[1:] = (blob[1:] != blob[:-1]) | (part[1:] != part[:-1])
    per_part = np.diff(np.append(np.flatnonzero(new), len(blob)))
    part_list = pa.ListArray.from_arrays(cuts(per_part), ring_list)
    per_blob = np.bincount(blob[new], minlength=n)
    parts_ = pa.ListArray.from_arrays(cuts(per_blob), part_list)
    names = pa.DictionaryArray.from_arrays(pa.array(kind.astype(np.int8)), pa.array(KINDS)).cast(pa.string())
    return pa.StructArray.from_arrays([names, pa.array(srs), parts_], fields=list(READ), mask=pa.array(~ok))


def render(geometry: pa.Array, envelope: bool, big: bool) -> pa.Array:
    """Blobs of struct(geom_type, srs_id, parts), empty ones without parts; null for null, collections and unknown kinds, and for parts that the kind can't have."""
    kind = np.array([KINDS.index(k) if k in KINDS[1:7] else 0 for k in geometry.field(0).to_pylist()], np.int64)
    srs = geometry.field(1).fill_null(0).to_numpy(zero_copy_only=False)
    n = len(geometry)
    edges = lambda a: a.offsets.to_numpy().astype(np.int64)
    part_list = geometry.field(2)
    ring_list, points = part_list.values, part_list.values.values.values
    e_blob, e_part, e_ring = edges(part_list), edges(ring_list), edges(ring_list.values)
    x, y = (np.asarray(points.field(k), np.float64) for k in range(2))
    n_parts = np.diff(e_blob)
    first, last = e_blob[:-1], e_blob[1:]
    ring_points = np.diff(e_ring)
    part_rings = np.diff(e_part)
    blob_of_part = np.full(len(part_rings), -1, np.int64)
    inner = np.repeat(first, n_parts) + _ranges(n_parts)
    blob_of_part[inner] = np.repeat(np.arange(n), n_parts)
    single = (kind - 1) % 3 + 1  # what each part is
    ok = np.asarray(geometry.is_valid()) & np.asarray(part_list.is_valid()) & (kind > 0)
    sums = lambda v, e: np.concatenate(([0], np.cumsum(v)))[e[1:]] - np.concatenate(([0], np.cumsum(v)))[e[:-1]]
    part_points = sums(ring_points, e_part)
    one_ring = (part_rings == 1) & (part_points >= 1)
    what = np.where(blob_of_part >= 0, single[blob_of_part], 0)
    fine = np.where(what == 1, one_ring & (part_points == 1), np.where(what == 2, part_rings == 1, part_rings >= 1))
    ok &= sums(~fine & (blob_of_part >= 0), e_blob) == 0
    ok &= (kind > 3) | (n_parts <= 1)
    bare = ok & (kind <= 3) & (n_parts == 0)
    part_size = np.where(what == 1, 21, np.where(what == 2, 9 + 16 * part_points, 9 + 4 * part_rings + 16 * part_points))
    many = kind > 3
    body = np.where(many | bare & (kind > 1), 9, np.where(bare, 21, 0)) + sums(np.where(blob_of_part >= 0, part_size, 0), e_blob)
    blob_points = sums(part_points, e_blob)
    boxed = np.where(ok & envelope & (blob_points > 0), 32, 0)
    size = np.where(ok, 8 + boxed + body, 0)
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    u4, f8 = (">u4", ">f8") if big else ("<u4", "<f8")

    def put(at: np.ndarray, values: np.ndarray, kind_: str) -> None:
        raw = np.ascontiguousarray(values.astype(kind_)).view(np.uint8).reshape(len(at), int(kind_[-1]))
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    own = np.flatnonzero(ok)
    flags = (boxed[own] > 0) * 2 + (0 if big else 1) + (blob_points[own] == 0) * 16
    for k, v in enumerate((0x47, 0x50, 0)):
        out[start[own] + k] = v
    out[start[own] + 3] = flags
    put(start[own] + 4, srs[own].astype(np.int64) & 0xFFFFFFFF, u4)
    with_box = np.flatnonzero(boxed > 0)
    if len(with_box):
        # points of a blob lie together, as its parts and rings do
        lo = e_ring[e_part[e_blob[with_box]]]
        for k, (v, f) in enumerate(((x, np.minimum), (x, np.maximum), (y, np.minimum), (y, np.maximum))):
            put(start[with_box] + 8 + 8 * k, f.reduceat(np.append(v, 0.0), np.stack((lo, lo + blob_points[with_box]), 1).ravel())[::2], f8)
    geom = start + 8 + boxed
    multi = np.flatnonzero(ok & many)
    out[geom[multi]] = 0 if big else 1
    put(geom[multi] + 1, kind[multi], u4)
    put(geom[multi] + 5, n_parts[multi], u4)
    out[geom[bare]] = 0 if big else 1
    put(geom[bare] + 1, kind[bare], u4)
    point = np.flatnonzero(bare & (kind == 1))
    for k in (5, 13):
        put(geom[point] + k, np.full(len(point), np.nan), f8)
    part = np.flatnonzero((blob_of_part >= 0) & ok[blob_of_part])
    of = blob_of_part[part]
    ahead = np.cumsum(part_size[part]) - part_size[part]
    lead = np.flatnonzero(np.concatenate((np.ones(min(1, len(of)), bool), of[1:] != of[:-1])))
    at = geom[of] + np.where(many[of], 9, 0) + ahead - np.repeat(ahead[lead], np.diff(np.append(lead, len(of))))
    out[at] = 0 if big else 1
    put(at + 1, what[part], u4)
    poly = what[part] == 3
    put(at[poly] + 5, part_rings[part[poly]], u4)
    rings = np.repeat(e_part[part], part_rings[part]) + _ranges(part_rings[part])
    r_what, r_of = np.repeat(what[part], part_rings[part]), np.repeat(np.arange(len(part)), part_rings[part])
    r_size = np.where(r_what == 1, 16, 4 + 16 * ring_points[rings])
    r_ahead = np.cumsum(r_size) - r_size
    lead = np.flatnonzero(np.concatenate((np.ones(min(1, len(r_of)), bool), r_of[1:] != r_of[:-1])))
    r_at = at[r_of] + np.where(r_what == 3, 9, 5) + r_ahead - np.repeat(r_ahead[lead], np.diff(np.append(lead, len(r_of))))
    put(r_at[r_what > 1], ring_points[rings[r_what > 1]], u4)
    k = ring_points[rings]
    p_at = np.repeat(r_at + np.where(r_what == 1, 0, 4), k) + 16 * _ranges(k)
    p = np.repeat(e_ring[rings], k) + _ranges(k)
    put(p_at, x[p], f8)
    put(p_at + 8, y[p], f8)
    edges_ = np.concatenate(([0], np.cumsum(size)))
    binary = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(edges_.astype(np.int64)), pa.py_buffer(out)])
    return pc.if_else(pa.array(ok), binary, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def read_geometry(blob: Column) -> Column:
    """struct(geom_type, srs_id, parts) of a geometry blob; null where it is null, broken or of an unknown kind."""

    @F.arrow_udf(GEOMETRY)
    def read(col: pa.Array) -> pa.Array:
        return parse(col)

    return read(blob)


def write_geometry(geom_type: Column, parts: Column, srs_id: int = 3006, envelope: bool = True, big_endian: bool = False) -> Column:
    """The blob of a geometry, empty without parts; null where a part isn't what the kind has, and for collections."""

    @F.arrow_udf("binary")
    def write(col: pa.Array) -> pa.Array:
        return render(col, envelope, big_endian)

    return write(F.struct(geom_type.alias("geom_type"), F.lit(srs_id).cast("int").alias("srs_id"), parts.cast(PARTS).alias("parts")))
