"""Joins, updates, profiles, windows and samples over site tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.spatial import degrees, in_box, metre_box, polygon_area

REGION_LIMIT = 100  # regions up to which a range join broadcasts them; more go by a quadtree's leaves


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str) -> DataFrame:
    """Left join to a dimension with unique keys; out is the value, or the key where it is unknown."""
    small = dim.select(F.col(dim_key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(small, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce("_value", F.col(key))).drop("_key", "_value")


def keyed_update(df: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Sets the columns where the key matches, to null too; other rows, and null keys, stay.

    changes must have one row for each key; with more, the largest by value wins, so that no row doubles."""
    new = changes.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(*[F.col(c) for c in columns])).alias("_new"))
    joined = df.join(new, F.col(key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    return joined.select(*[F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


class Leaves:
    """A quadtree's leaves, laid out by a sample of points: each holds about the same number of them.

    A leaf is a stretch of the curve that goes through all cells of 2^DEPTH by 2^DEPTH, quarter by quarter. Places
    beyond the sample's bounds belong to the cells at its edge, so every point has one leaf."""

    DEPTH = 20

    def __init__(self, x: np.ndarray, y: np.ndarray, most: int = 4096):
        self.low = np.array([x.min(), y.min()]) if len(x) else np.zeros(2)
        size = np.array([np.ptp(x), np.ptp(y)]) if len(x) else np.zeros(2)
        self.scale = (2**self.DEPTH - 1) / np.where(size > 0, size, 1.0)
        codes = np.sort(self.code(*self.cell(x, y)))
        full = max(1, 4 * len(codes) // most)  # points of the sample from which on a leaf is split
        starts, todo = [], [(0, 0)]
        while todo:
            start, depth = todo.pop()
            width = 4 ** (self.DEPTH - depth)
            n = np.searchsorted(codes, start + width) - np.searchsorted(codes, start)
            if n > full and depth < self.DEPTH:
                todo += [(start + k * (width // 4), depth + 1) for k in range(4)]
            else:
                starts.append((start, depth))
        starts.sort()
        self.starts = np.array([s for s, _ in starts], np.int64)
        at, width = self.place(self.starts), 2 ** (self.DEPTH - np.array([d for _, d in starts], np.int64))
        self.least, self.last = at, at + width - 1

    def cell(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.clip(np.floor((v - lo) * k), 0, 2**self.DEPTH - 1).astype(np.int64) for v, lo, k in zip((x, y), self.low, self.scale))

    @classmethod
    def code(cls, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cx), np.int64)
        for k in range(cls.DEPTH):
            out |= ((cx >> k & 1) << (2 * k)) | ((cy >> k & 1) << (2 * k + 1))
        return out

    @classmethod
    def place(cls, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((2, len(codes)), np.int64)
        for k in range(cls.DEPTH):
            out[0] |= (codes >> (2 * k) & 1) << k
            out[1] |= (codes >> (2 * k + 1) & 1) << k
        return out

    def of_points(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, self.code(*self.cell(x, y)), "right") - 1

    def of_box(self, minx: float, miny: float, maxx: float, maxy: float) -> np.ndarray:
        (x0, x1), (y0, y1) = self.cell(np.array([minx, maxx]), np.array([miny, maxy]))
        return np.flatnonzero((self.least[0] <= x1) & (self.last[0] >= x0) & (self.least[1] <= y1) & (self.last[1] >= y0))


def leaves(points: DataFrame, x: str, y: str, sample: int = 100_000, most: int = 4096) -> Leaves:
    """Leaves by about `sample` points, which with the leaves are all that the driver holds."""
    n = points.count()
    some = points.select(F.col(x).cast("double"), F.col(y).cast("double")).where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    got = (some if n <= sample else some.sample(False, sample / n, 7)).limit(2 * sample).toPandas()
    return Leaves(got.iloc[:, 0].to_numpy(float), got.iloc[:, 1].to_numpy(float), most)


def region_join(points: DataFrame, regions: DataFrame, x: str = "lon", y: str = "lat", tree: Leaves | None = None) -> DataFrame:
    """Points with each region whose box holds them, edges included.

    Few regions are broadcast, after they have been counted. Many are joined by the leaves of a quadtree: a point has
    one leaf, a region those that its box meets, and leaves hold alike many points, so a crowded place is many keys
    and an empty stretch few. A place with very many points at one spot is a leaf that Spark can split."""
    box = in_box(F.col(x), F.col(y), F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    if tree is None and regions.limit(REGION_LIMIT + 1).count() <= REGION_LIMIT:
        return points.join(F.broadcast(regions), box)
    grown = tree or leaves(points, x, y)

    @F.arrow_udf("int")
    def of_point(px: pa.Array, py: pa.Array) -> pa.Array:
        a, b = (np.asarray(v.cast(pa.float64()).fill_null(np.nan)) for v in (px, py))
        known = ~(np.isnan(a) | np.isnan(b))
        return pa.array(grown.of_points(np.where(known, a, 0.0), np.where(known, b, 0.0)).astype(np.int32), mask=~known)

    @F.arrow_udf("array<int>")
    def of_box(*edges: pa.Array) -> pa.Array:
        rows = zip(*[e.to_pylist() for e in edges])
        return pa.array([[] if None in r or r[0] > r[2] or r[1] > r[3] else grown.of_box(*r).tolist() for r in rows], pa.list_(pa.int32()))

    cells = regions.withColumn("_leaf", F.explode(of_box("minx", "miny", "maxx", "maxy")))
    return points.withColumn("_leaf", of_point(x, y)).join(cells, "_leaf").where(box).drop("_leaf")


def metre_boxes(regions: DataFrame) -> DataFrame:
    """regions, boxes in degrees, with a box in metres around each one: _x0, _y0, _x1, _y1."""

    @F.arrow_udf("struct<_x0:double,_y0:double,_x1:double,_y1:double>")
    def around(*edges: pa.Array) -> pa.Array:
        found = metre_box(*[np.asarray(e.cast(pa.float64()).fill_null(np.nan)) for e in edges])
        return pa.StructArray.from_arrays([pa.array(v, from_pandas=True) for v in found], ["_x0", "_y0", "_x1", "_y1"])

    return regions.withColumn("_box", around("minx", "miny", "maxx", "maxy")).select(*regions.columns, "_box.*")


def degree_region_join(points: DataFrame, regions: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """region_join of points in metres with boxes in degrees: points with lon, lat and each region that holds them.

    A box in metres goes first, so only points near a region are projected; the exact test follows."""
    placed = metre_boxes(regions).withColumnsRenamed({"minx": "_minx", "miny": "_miny", "maxx": "_maxx", "maxy": "_maxy", "_x0": "minx", "_y0": "miny", "_x1": "maxx", "_y1": "maxy"})
    near = region_join(points, placed, x, y).drop("minx", "miny", "maxx", "maxy").withColumn("_at", degrees(F.col(x), F.col(y)))
    near = near.withColumns({"lon": F.col("_at.lon"), "lat": F.col("_at.lat")}).drop("_at")
    found = near.where(in_box(F.col("lon"), F.col("lat"), F.col("_minx"), F.col("_miny"), F.col("_maxx"), F.col("_maxy")))
    return found.withColumnsRenamed({"_minx": "minx", "_miny": "miny", "_maxx": "maxx", "_maxy": "maxy"})


def region_counts(points: DataFrame, regions: DataFrame, name: str = "sitename", joined: DataFrame | None = None) -> DataFrame:
    """(region, total, named) of every region, empty ones with 0. Counts first, then the few rows are joined.

    joined: points with their regions, in place of region_join's by lon and lat."""
    found = (region_join(points, regions) if joined is None else joined).groupBy("region").agg(F.count("*").alias("total"), F.count(name).alias("named"))
    return regions.select("region").join(found, "region", "left").select("region", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("named", F.lit(0)).alias("named"))


def first_per(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group, with their place in column nth."""
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("nth") <= n)


def dedup(df: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key; rows with a null key all stay."""
    keyed = first_per(df.where(F.col(key).isNotNull()), [key], order, 1).drop("nth")
    return keyed.unionByName(df.where(F.col(key).isNull()))


def top_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) of the columns' values, nulls left out; one pass over df."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("r")).select("r.*")
    return long.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("count"))


def value_totals(counts: DataFrame) -> DataFrame:
    """(column, nonNullRecords, uniqueValues): one row for each column of top_values."""
    return counts.groupBy("column").agg(F.sum("count").alias("nonNullRecords"), F.count("*").alias("uniqueValues"))


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, totalRecords, nonNullRecords, uniqueValues, value, count, percentage) of every value.

    Totals are summed up by column and joined back as a few rows, so a column's values never meet in one task."""
    total = df.agg(F.count("*").alias("totalRecords"))
    found = top_values(df, columns)
    found = found.join(F.broadcast(value_totals(found)), "column")  # one row for each of the columns
    return found.crossJoin(F.broadcast(total)).select("column", "totalRecords", "nonNullRecords", "uniqueValues", "value", "count", F.round(100 * F.col("count") / F.col("totalRecords"), 2).alias("percentage"))


def sketch_profile(df: DataFrame, columns: list[str], top: int = 10, log_k: int = 12, tracked: int = 10_000) -> DataFrame:
    """(column, totalRecords, nonNullRecords, uniqueValues, unique_error, values, count_error) by sketches.

    Where column_profile shuffles every distinct value of every column, here one exchange moves a sketch of some kB for each column and
    task. uniqueValues is an estimate, within unique_error of the number in 99 of 100 cases (three standard errors of
    a sketch of 2^log_k cells), and as good as exact up to some hundred values. values has the `top` commonest values as text with their counts, each
    at most count_error too large; with no more than `tracked` different values they are exact."""
    one = [F.count("*").alias("_n")]
    for k, c in enumerate(columns):
        text = f"cast(`{c}` as string)"
        one += [F.count(F.col(f"`{c}`")).alias(f"_n{k}"), F.expr(f"hll_sketch_estimate(hll_sketch_agg({text}, {log_k}))").alias(f"_u{k}"), F.expr(f"approx_top_k({text}, {top}, {tracked})").alias(f"_t{k}")]
    listed = lambda t: F.transform(F.filter(t, lambda v: v["item"].isNotNull()), lambda v: F.struct(v["item"].alias("value"), v["count"].alias("count")))
    spread = F.lit(3 * 1.04 / 2 ** (log_k / 2))
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col("_n").alias("totalRecords"), F.col(f"_n{k}").alias("nonNullRecords"), F.coalesce(F.col(f"_u{k}"), F.lit(0)).cast("bigint").alias("uniqueValues"),
            (spread * F.coalesce(F.col(f"_u{k}"), F.lit(0))).alias("unique_error"), listed(F.col(f"_t{k}")).alias("values"),
            F.when(F.col(f"_u{k}") * (1 + spread) > tracked, F.col(f"_n{k}") * 3.5 / tracked).otherwise(0.0).alias("count_error"),
        )
        for k, c in enumerate(columns)
    ]
    return df.agg(*one).select(F.inline(F.array(*rows)))


def profile_document(df: DataFrame, columns: list[str], name: str, timestamp: str, values: int = 1000) -> DataFrame:
    """One JSON document (column document): timestamp, database, totalRecords, columns in their given order with their values.

    Values are listed by falling count, then by value, the first `values` of each column: the document is a
    report for people, and uniqueValues tells how many there are. column_profile has all of them."""
    counts = top_values(df, columns)
    first = first_per(counts, ["column"], [F.desc("count"), "value"], values)
    one = df.agg(F.count("*").alias("totalRecords"))
    listed = first.groupBy("column").agg(F.sort_array(F.collect_list(F.struct("nth", "value", "count"))).alias("values"))
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    each = listed.join(F.broadcast(value_totals(counts)), "column").crossJoin(F.broadcast(one))
    share = F.transform("values", lambda v: F.struct(v["value"].alias("value"), v["count"].alias("count"), F.round(100 * v["count"] / F.col("totalRecords"), 2).alias("percentage")))
    rows = F.sort_array(F.collect_list(F.struct(order.alias("at"), F.struct("column", "totalRecords", "nonNullRecords", "uniqueValues", share.alias("values")).alias("c"))))
    whole = F.struct(F.lit(timestamp).alias("timestamp"), F.lit(name).alias("database"), F.max("totalRecords").alias("totalRecords"), F.transform(rows, lambda r: r["c"]).alias("columns"))
    return each.agg(F.to_json(whole).alias("document"))


def statistics(df: DataFrame, categorical: list[str], numeric: list[str], name: str) -> DataFrame:
    """(name, kind, total, area_km2, unique_values, most_common, min, max, mean): the table, with its geometry types by
    count, then each categorical column with its three commonest values and each numeric column with its range and mean."""
    none = {c: F.lit(None).cast(t) for c, t in (("total", "bigint"), ("area_km2", "double"), ("unique_values", "bigint"), ("most_common", "string"), ("min", "double"), ("max", "double"), ("mean", "double"))}
    shaped = lambda d, kind, **given: d.select("name", F.lit(kind).alias("kind"), *[given.get(c, x).alias(c) for c, x in none.items()])
    counts = top_values(df, [*categorical, "geom_type"])
    three = first_per(counts, ["column"], [F.desc("count"), "value"], 3)
    common = three.groupBy("column").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", F.concat_ws("=", "value", F.col("count").cast("string")).alias("t")))), lambda r: r["t"]), ", ").alias("common"))
    each = value_totals(counts).join(F.broadcast(common), "column").withColumnRenamed("column", "name")
    types = counts.where("column = 'geom_type'").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(-F.col("count"), F.concat_ws("=", "value", F.col("count").cast("string")).alias("t")))), lambda r: r["t"]), ", ").alias("types"))
    whole = df.agg(F.count("*").alias("total"), area_km2().alias("area_km2")).crossJoin(F.broadcast(types)).withColumn("name", F.lit(name))
    numbers = numeric_stats(df, numeric).withColumnRenamed("column", "name")
    out = shaped(whole, "table", total=F.col("total"), area_km2=F.col("area_km2"), most_common=F.col("types"))
    out = out.unionByName(shaped(each.where(F.col("name").isin(categorical)), "categorical", unique_values=F.col("uniqueValues"), most_common=F.col("common")))
    return out.unionByName(shaped(numbers, "numerical", min=F.col("min"), max=F.col("max"), mean=F.col("mean")))


def numeric_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, min, max, mean) as doubles; nulls where a column has no value."""
    aggs = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    rows = ", ".join(f"'{c}', `{c}_min`, `{c}_max`, `{c}_mean`" for c in columns)
    return df.agg(*aggs).select(F.expr(f"stack({len(columns)}, {rows}) as (column, min, max, mean)"))


def area_km2() -> Column:
    """Aggregate: total area of all geometries, null unless some row is a Polygon."""
    return F.when(F.max((F.col("geom_type") == "Polygon").cast("int")) == 1, F.sum(polygon_area(F.col("geom_type"), F.col("rings"))) / 1e6)


def redundant_columns(df: DataFrame, columns: list[str], nulls: float = 0.999) -> DataFrame:
    """(column, constant, null_share, redundant): columns with one value at most, and those that are null nearly everywhere.

    Least and greatest values tell whether a column is constant, so one aggregate without distinct counts does for all."""
    aggs = [F.count("*").alias("_n")] + [x for c in columns for x in (F.min(F.col(c)).eqNullSafe(F.max(F.col(c))).alias(f"{c}_d"), F.count(F.col(c)).alias(f"{c}_c"))]
    rows = ", ".join(f"'{c}', `{c}_d`, `{c}_c`" for c in columns)
    out = df.agg(*aggs).select("_n", F.expr(f"stack({len(columns)}, {rows}) as (column, constant, n)"))
    share = F.try_divide((F.col("_n") - F.col("n")).cast("double"), F.col("_n").cast("double"))
    return out.select("column", "constant", F.round(share, 6).alias("null_share"), (F.col("constant") | (share >= nulls)).alias("redundant"))


def drop_redundant(df: DataFrame, columns: list[str], nulls: float = 0.999) -> DataFrame:
    """df without those of the columns that redundant_columns names (one row for each column reaches the driver)."""
    return df.drop(*[r["column"] for r in redundant_columns(df, columns, nulls).where("redundant").collect()])


def take(df: DataFrame, order: list, n: int | None) -> DataFrame:
    """The first n rows by order; all rows for None and 0."""
    return df.orderBy(*order).limit(n) if n else df


def hash_sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n rows in the order of their keys' md5: a reproducible random sample."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key))), key).limit(n)


def random_sample(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    return df.orderBy(F.rand(seed)).limit(n)
