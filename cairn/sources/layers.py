"""Layered feature tables: read, list, save, combine; derived tables, results, metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import filesystem

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
#: The feature table; layer is its partition column.
FEATURES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("geom_type", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("rings", T.ArrayType(T.ArrayType(POINT)))]
    + [T.StructField(c, T.StringType()) for c in ("designationschemevalue", "designationvalue", "protectionclassificationvalue", "protectionclassificationvalue2", "inspireid", "sitename", "legalfoundationdocument", "layer")]
)


def _there(spark: SparkSession, path: str) -> bool:
    fs, at = filesystem(spark, path)
    return fs.exists(at)


def layers(df: DataFrame) -> DataFrame:
    return df.select("layer").distinct()


def load_layer(spark: SparkSession, path: str, layer: str | None = None, schema: T.StructType | None = FEATURES) -> DataFrame:
    """One layer; the first by name if none is named. FileNotFoundError if the path isn't there."""
    if not _there(spark, path):
        raise FileNotFoundError(path)
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if layer is None:
        first = layers(df).agg(F.min("layer").alias("layer")).first()["layer"]
        return df.where(F.col("layer").eqNullSafe(F.lit(first)))
    return df.where(F.col("layer") == layer)


def save_layer(df: DataFrame, path: str, layer: str) -> None:
    """Write df as a layer; other layers at the path stay."""
    df.withColumn("layer", F.lit(layer)).write.partitionBy("layer").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def z_order(x: Column, y: Column, low: tuple[float, float], high: tuple[float, float]) -> Column:
    """bigint: the place of (x, y) on the curve that goes through all cells of 65,536 by 65,536 between low and high, quarter by quarter; null first."""

    def cell(c: Column, a: float, b: float) -> Column:
        share = (c.cast("double") - a) * (65535 / (b - a) if b > a else 0.0)
        return F.greatest(F.lit(0), F.least(F.lit(65535), F.floor(share))).cast("bigint")

    def spread(v: Column) -> Column:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = (v.bitwiseOR(F.shiftleft(v, shift))).bitwiseAND(F.lit(mask).cast("bigint"))
        return v

    both = spread(cell(x, low[0], high[0])).bitwiseOR(F.shiftleft(spread(cell(y, low[1], high[1])), 1))
    return F.when(x.isNotNull() & y.isNotNull() & ~F.isnan(x.cast("double")) & ~F.isnan(y.cast("double")), both)


def save_clustered(df: DataFrame, path: str, layer: str, files: int, x: str = "x", y: str = "y", row_group_bytes: int = 32 << 20) -> None:
    """save_layer with rows near each other in space near each other in the files, which box filters on x and y then skip.

    Rows are sorted along a curve through space: Spark samples splitters for the files, each of which is a stretch of it,
    sorted, in row groups that know their least and greatest x and y. Rows without a place come first."""
    b = df.agg(*[f(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(n) for n, f, c in (("x0", F.min, x), ("y0", F.min, y), ("x1", F.max, x), ("y1", F.max, y))]).first()
    low, high = ((b["x0"] or 0.0), (b["y0"] or 0.0)), ((b["x1"] or 0.0), (b["y1"] or 0.0))
    keyed = df.withColumn("_z", z_order(F.col(x), F.col(y), low, high))
    dealt = keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").withColumn("layer", F.lit(layer))
    dealt.write.partitionBy("layer").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes).mode("overwrite").parquet(path)


def combine(parts: dict[str, DataFrame]) -> DataFrame:
    """Union by name of layers that share a schema, each with its name."""
    out = None
    for name, df in parts.items():
        df = df.withColumn("layer", F.lit(name))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no layers")
    return out


def derive_table(df: DataFrame, where: Column, path: str) -> None:
    """Write the rows that meet the condition as a new table; fails where one is already."""
    df.where(where).write.mode("errorifexists").parquet(path)


def save_results(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, null fields as null."""
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds absent columns as nulls; names are compared as Spark resolves them."""
    there = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in there})


def metadata(points: DataFrame, fixed: dict[str, str], x: str = "x", y: str = "y") -> DataFrame:
    """(key, value): fixed entries, the count and the bounds, from one aggregate."""
    text = lambda c: c.cast("decimal(20,3)").cast("string")
    one = points.agg(F.count("*").cast("string").alias("feature_count"), *[text(f(c)).alias(n) for n, f, c in (("min_x", F.min, x), ("min_y", F.min, y), ("max_x", F.max, x), ("max_y", F.max, y))])
    one = one.withColumns({k: F.lit(v) for k, v in fixed.items()})
    pairs = ", ".join(f"'{c}', `{c}`" for c in one.columns)
    return one.select(F.expr(f"stack({len(one.columns)}, {pairs}) as (key, value)"))
