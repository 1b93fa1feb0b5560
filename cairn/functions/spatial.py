"""Coordinates in SWEREF 99 TM metres and WGS 84 degrees, distances, areas; column expressions only.

The projection is the published Krueger series for the transverse Mercator projection of GRS 80."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let

AXIS, FLATTENING = 6378137.0, 1 / 298.257222101
MERIDIAN, SCALE, EAST0, NORTH0 = 15.0, 0.9996, 500000.0, 0.0
EARTH_KM = 6371.0088

E2 = FLATTENING * (2 - FLATTENING)
N1 = FLATTENING / (2 - FLATTENING)
ARC = SCALE * AXIS / (1 + N1) * (1 + N1**2 / 4 + N1**4 / 64)
#: Series to metres, series to degrees, and the two latitude corrections, by rising order.
FORWARD = (N1 / 2 - 2 * N1**2 / 3 + 5 * N1**3 / 16 + 41 * N1**4 / 180, 13 * N1**2 / 48 - 3 * N1**3 / 5 + 557 * N1**4 / 1440, 61 * N1**3 / 240 - 103 * N1**4 / 140, 49561 * N1**4 / 161280)
INVERSE = (N1 / 2 - 2 * N1**2 / 3 + 37 * N1**3 / 96 - N1**4 / 360, N1**2 / 48 + N1**3 / 15 - 437 * N1**4 / 1440, 17 * N1**3 / 480 - 37 * N1**4 / 840, 4397 * N1**4 / 161280)
TO_ISO = (E2, (5 * E2**2 - E2**3) / 6, (104 * E2**3 - 45 * E2**4) / 120, 1237 * E2**4 / 1260)
FROM_ISO = (E2 + E2**2 + E2**3 + E2**4, -(7 * E2**2 + 17 * E2**3 + 30 * E2**4) / 6, (224 * E2**3 + 889 * E2**4) / 120, -4279 * E2**4 / 1260)


def _powers(s: Column, terms: tuple) -> Column:
    out = F.lit(terms[0])
    for k, t in enumerate(terms[1:], 1):
        out = out + F.lit(t) * F.pow(s, F.lit(2.0 * k))
    return out


def to_wgs84(df: DataFrame, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds degrees to rows with metres; null coordinates stay null."""
    u, v = (F.col(y) - NORTH0) / ARC, (F.col(x) - EAST0) / ARC
    df = df.withColumns({"_u": u, "_v": v})
    u, v = F.col("_u"), F.col("_v")
    a, b = u, v
    for k, t in enumerate(INVERSE, 1):
        a = a - F.lit(t) * F.sin(2 * k * u) * F.cosh(2 * k * v)
        b = b - F.lit(t) * F.cos(2 * k * u) * F.sinh(2 * k * v)
    df = df.withColumns({"_a": a, "_b": b})
    df = df.withColumn("_p", F.asin(F.sin("_a") / F.cosh("_b")))
    p = F.col("_p")
    out = df.withColumns({lon: F.lit(MERIDIAN) + F.degrees(F.atan(F.sinh("_b") / F.cos("_a"))), lat: F.degrees(p + F.sin(p) * F.cos(p) * _powers(F.sin(p), FROM_ISO))})
    return out.drop("_u", "_v", "_a", "_b", "_p")


def to_metres(df: DataFrame, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y") -> DataFrame:
    """Adds metres to rows with degrees."""
    p, d = F.radians(F.col(lat)), F.radians(F.col(lon) - MERIDIAN)
    iso = p - F.sin(p) * F.cos(p) * _powers(F.sin(p), TO_ISO)
    df = df.withColumns({"_p": iso, "_d": d})
    df = df.withColumns({"_a": F.atan(F.tan("_p") / F.cos("_d")), "_b": F.atanh(F.cos("_p") * F.sin("_d"))})
    a, b = F.col("_a"), F.col("_b")
    north, east = a, b
    for k, t in enumerate(FORWARD, 1):
        north = north + F.lit(t) * F.sin(2 * k * a) * F.cosh(2 * k * b)
        east = east + F.lit(t) * F.cos(2 * k * a) * F.sinh(2 * k * b)
    return df.withColumns({x: ARC * east + EAST0, y: ARC * north + NORTH0}).drop("_p", "_d", "_a", "_b")


def metres(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """to_metres of arrays."""
    p, d = np.radians(lat), np.radians(lon - MERIDIAN)
    s = np.sin(p)
    iso = p - s * np.cos(p) * sum(t * s ** (2 * k) for k, t in enumerate(TO_ISO))
    a, b = np.arctan(np.tan(iso) / np.cos(d)), np.arctanh(np.cos(iso) * np.sin(d))
    north = a + sum(t * np.sin(2 * k * a) * np.cosh(2 * k * b) for k, t in enumerate(FORWARD, 1))
    east = b + sum(t * np.cos(2 * k * a) * np.sinh(2 * k * b) for k, t in enumerate(FORWARD, 1))
    return ARC * east + EAST0, ARC * north + NORTH0


def degrees(x: Column, y: Column) -> Column:
    """struct(lon, lat) of metres, as to_wgs84 has them, by an Arrow function.

    For rows that are filtered by their degrees at once: Spark would write the whole series anew into each
    comparison, and into the join below, in methods too large to be compiled."""

    @F.arrow_udf("struct<lon:double,lat:double>")
    def of(px: pa.Array, py: pa.Array) -> pa.Array:
        u, v = ((np.asarray(c.cast(pa.float64()).fill_null(np.nan)) - o) / ARC for c, o in ((py, NORTH0), (px, EAST0)))
        a = u - sum(t * np.sin(2 * k * u) * np.cosh(2 * k * v) for k, t in enumerate(INVERSE, 1))
        b = v - sum(t * np.cos(2 * k * u) * np.sinh(2 * k * v) for k, t in enumerate(INVERSE, 1))
        p = np.arcsin(np.sin(a) / np.cosh(b))
        s = np.sin(p)
        lat = p + s * np.cos(p) * sum(t * s ** (2 * k) for k, t in enumerate(FROM_ISO))
        return pa.StructArray.from_arrays([pa.array(MERIDIAN + np.degrees(np.arctan(np.sinh(b) / np.cos(a)))), pa.array(np.degrees(lat))], ["lon", "lat"])

    return of(x, y)


def metre_box(minx: np.ndarray, miny: np.ndarray, maxx: np.ndarray, maxy: np.ndarray) -> tuple[np.ndarray, ...]:
    """(minx, miny, maxx, maxy) in metres of boxes that hold boxes in degrees.

    The edges, which bend in metres, are sampled, and the margin is more than what lies between two samples."""
    t = np.linspace(0, 1, 33)
    x, y = minx[:, None] + (maxx - minx)[:, None] * t, miny[:, None] + (maxy - miny)[:, None] * t
    whole = lambda v: np.broadcast_to(v[:, None], x.shape)
    east, north = metres(np.concatenate((x, x, whole(minx), whole(maxx)), 1), np.concatenate((whole(miny), whole(maxy), y, y), 1))
    x0, x1, y0, y1 = east.min(1), east.max(1), north.min(1), north.max(1)
    mx, my = (x1 - x0) * 0.02 + 1000, (y1 - y0) * 0.02 + 1000
    return x0 - mx, y0 - my, x1 + mx, y1 + my


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def circle_km2(km: float) -> Column:
    return F.pi() * km * km


def in_box(x: Column, y: Column, minx, miny, maxx, maxy) -> Column:
    """Inside or on the edge."""
    return x.between(minx, maxx) & y.between(miny, maxy)


def within_km(df: DataFrame, lon0: float, lat0: float, km: float, x: str = "x", y: str = "y") -> DataFrame:
    """Rows within km of a centre given in degrees, with lon, lat and distance_km.

    A box in metres with a margin of 2 % goes first: it reaches the Parquet scan, the distance can't."""
    east, north = (float(v) for v in metres(np.float64(lon0), np.float64(lat0)))
    r = km * 1000 * 1.02 + 50
    near = df.where(in_box(F.col(x), F.col(y), east - r, north - r, east + r, north + r))
    near = to_wgs84(near, x, y).withColumn("distance_km", haversine_km(F.lit(lon0), F.lit(lat0), F.col("lon"), F.col("lat")))
    return near.where(F.col("distance_km") <= km)


def ring_area(ring: Column) -> Column:
    """Area of a closed ring of (x, y), by the shoelace formula around its first point."""
    x0, y0 = F.get(ring, F.lit(0))["x"], F.get(ring, F.lit(0))["y"]
    nxt = F.slice(ring, F.lit(2), F.size(ring))
    cross = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), nxt, lambda p, q: (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0))
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, c: s + c)) / 2


def polygon_area(geom_type: Column, rings: Column) -> Column:
    """Outer ring less the holes; 0 for other geometries."""
    areas = F.transform(rings, ring_area)
    whole = F.aggregate(areas, F.lit(0.0), lambda s, a: s - a) + 2 * F.get(areas, F.lit(0))
    return F.when(geom_type.isin("Polygon", "MultiPolygon") & (F.size(rings) > 0), whole).otherwise(F.lit(0.0))


def parts_area(geom_type: Column, parts: Column) -> Column:
    """Area of all parts of a polygon or its multiple, each one's outer ring less its holes; 0 for other geometries."""
    one = lambda rings: let(F.transform(rings, ring_area), lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s - x) + 2 * F.coalesce(F.get(a, F.lit(0)), F.lit(0.0)))
    return F.when(geom_type.isin("Polygon", "MultiPolygon"), F.aggregate(F.transform(parts, one), F.lit(0.0), lambda s, a: s + a)).otherwise(F.when(parts.isNotNull(), 0.0))


def bounds(parts: Column) -> Column:
    """struct(minx, miny, maxx, maxy) of all points; null without any."""
    edge = lambda p, c, f: f(F.transform(p, lambda q: q[c]))
    box = lambda p: F.when(F.size(p) > 0, F.struct(edge(p, "x", F.array_min).alias("minx"), edge(p, "y", F.array_min).alias("miny"), edge(p, "x", F.array_max).alias("maxx"), edge(p, "y", F.array_max).alias("maxy")))
    return let(F.flatten(F.flatten(parts)), box)


def meets_box(geom_type: Column, parts: Column, minx, miny, maxx, maxy) -> Column:
    """Whether a geometry and a box have a point in common, edges included; null for null, false for empty.

    A segment meets the box if their extents do and not all corners lie on one side of it. A polygon also meets a
    box that no edge of its meets if the box's corner lies within: edges to its right are odd in number, holes
    counted. Parts of a collection are outlines."""
    x0, y0, x1, y1 = (c if isinstance(c, Column) else F.lit(float(c)) for c in (minx, miny, maxx, maxy))

    def segment(p: Column, q: Column) -> Column:
        side = lambda cx, cy: (q["x"] - p["x"]) * (cy - p["y"]) - (q["y"] - p["y"]) * (cx - p["x"])
        near = (F.least(p["x"], q["x"]) <= x1) & (F.greatest(p["x"], q["x"]) >= x0) & (F.least(p["y"], q["y"]) <= y1) & (F.greatest(p["y"], q["y"]) >= y0)
        across = lambda s: (F.array_min(s) <= 0) & (F.array_max(s) >= 0)
        return near & let(F.array(side(x0, y0), side(x0, y1), side(x1, y0), side(x1, y1)), across)

    def right_of_corner(p: Column, q: Column) -> Column:
        at = F.try_divide((q["x"] - p["x"]) * (y0 - p["y"]), q["y"] - p["y"]) + p["x"]
        return ((p["y"] > y0) != (q["y"] > y0)) & (at > x0)

    def pairs(ring: Column, f) -> Column:
        n = F.greatest(F.size(ring) - 1, F.lit(0))
        return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), f)

    vertex = F.exists(parts, lambda rings: F.exists(rings, lambda ring: F.exists(ring, lambda p: in_box(p["x"], p["y"], x0, y0, x1, y1))))
    edge = F.exists(parts, lambda rings: F.exists(rings, lambda ring: F.exists(pairs(ring, segment), lambda hit: hit)))
    odd = lambda rings: F.size(F.filter(F.flatten(F.transform(rings, lambda ring: pairs(ring, right_of_corner))), lambda c: c)) % 2 == 1
    inside = geom_type.isin("Polygon", "MultiPolygon") & F.exists(parts, odd)
    return vertex | (~geom_type.isin("Point", "MultiPoint") & (edge | inside))


def wkb_point(df: DataFrame, wkb: str = "wkb") -> DataFrame:
    """Adds x and y of WKB points (either byte order, Z and SRID flags allowed); other geometries give null."""
    @F.pandas_udf("x double, y double")
    def read(col: pd.Series) -> pd.DataFrame:
        """Blobs with the same head and length are read as one array."""
        out = np.full((len(col), 2), np.nan)
        heads = col.map(lambda b: (bytes(b[:5]), len(b)) if b is not None and len(b) >= 21 else None)
        for (head, size), rows in heads.dropna().groupby(heads).groups.items():
            order = "<" if head[0] else ">"
            kind = int(np.frombuffer(head, order + "u4", 1, 1)[0])
            at = 9 if kind & 0x20000000 else 5
            if kind & 0xFFFF in (1, 1001) and size >= at + 16:
                places = col.index.get_indexer(rows)
                data = np.frombuffer(b"".join(col.iloc[places]), np.uint8).reshape(len(places), size)
                out[places] = np.ascontiguousarray(data[:, at : at + 16]).view(order + "f8")
        return pd.DataFrame(out, columns=["x", "y"])

    at = read(F.col(wkb))
    clean = lambda c: F.when(~F.isnan(c), c)
    return df.withColumn("_at", at).withColumns({"x": clean(F.col("_at.x")), "y": clean(F.col("_at.y"))}).drop("_at")
