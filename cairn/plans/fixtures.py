"""Site tables derived from the orders table, as expressions that Spark and DuckDB both read.

Each view is a list of (column, expression) over another view, so queries and their oracles see the same
rows, and the tables grow with orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.blobs import PARTS
from cairn.functions.jsonld import DOC_PREFIX, SITE_PREFIX

NN = "chr(10), chr(10)"
UUID = "concat(substr(m, 1, 8), '-', substr(m, 9, 4), '-', substr(m, 13, 4), '-', substr(m, 17, 4), '-', substr(m, 21, 12))"
CLASS_SV = "case when k % 4 = 0 then 'Stensättning' when k % 4 = 1 then 'Röse' when k % 4 = 2 then 'Okänd' else 'Hög' end"
PLACING = "case when k % 3 = 0 then 'Synlig ovan mark' when k % 3 = 1 then 'Ej synlig ovan mark' else 'ÖVERTÄCKT' end"
BODY = "concat('Rund, ', k % 9 + 2, ' m diam och 0,', k % 7 + 1, ' m h.', case when k % 6 = 0 then ' Mittgrop.' else '' end)"
URL_LINE = "case when k % 4 = 1 then concat(chr(10), 'Kantkedja 3 cm. Se https://example.org/x', k) else '' end"
URL_LINE_CLEAN = "case when k % 4 = 1 then concat(chr(10), 'Kantkedja 3 cm. Se') else '' end"
DISCLAIMER = "case when k % 7 = 0 then concat(chr(10), 'Beskrivningen är inte kvalitetssäkrad.') else '' end"
GEO = "concat('Västergötland | County: Halland | Municipality: M', k % 11, ' | Parish: P', k % 17)"

#: view: (source view or table, [(column, expression)], condition)
VIEWS = {
    "keyed": ("orders", [("k", "o_orderkey"), ("m", "md5(cast(case when o_orderkey % 23 = 0 then o_orderkey - 1 else o_orderkey end as string))")], None),
    "features": (
        "keyed",
        [
            ("id", "k"),
            ("layer", "case when k % 10 < 6 then 'PS_NationalMonuments_point' when k % 10 < 9 then 'PS_NationalMonuments_poly' else 'PS_NationalMonuments_line' end"),
            ("geom_type", "case when k % 10 < 6 then 'Point' when k % 10 < 9 then 'Polygon' else 'LineString' end"),
            ("x", "cast(300000 + (k * 7919) % 400000 as double)"),
            ("y", "cast(6150000 + (k * 104729) % 550000 as double)"),
            ("designationschemevalue", "'INSPIRE'"),
            ("designationvalue", "'archaeological'"),
            ("protectionclassificationvalue", "'archaeological'"),
            ("protectionclassificationvalue2", "case when k % 2000 = 0 then 'other' end"),
            ("inspireid", "concat('raa/', k)"),
            ("sitename", "case when k % 13 = 0 then concat('Site ', k) end"),
            ("legalfoundationdocument", f"concat('https://example.org/lamning/', {UUID})"),
        ],
        None,
    ),
    "points": ("features", [(c, c) for c in ("id", "x", "y", "inspireid", "sitename", "legalfoundationdocument")], "geom_type = 'Point'"),
    "descriptions": (
        "keyed",
        [
            ("k", "k"),
            ("inspireid", "concat('raa/', k)"),
            ("description", f"case when k % 31 = 0 then null when k % 29 = 0 then '' else concat('Title: Site ', k, {NN}, 'Class: ', {CLASS_SV}, {NN}, 'Placering: ', {PLACING}, {NN}, case when k % 5 <> 0 then concat('Beskrivning: ', {BODY}, {URL_LINE}, {DISCLAIMER}, {NN}) else '' end, 'Province: ', {GEO}, {NN}, 'Vegetation: Skog', {NN}, 'RAÄ-nummer: Lerum ', k, ':1', {NN}, 'inga uppgifter ', k) end"),
        ],
        None,
    ),
    "sites": (
        "keyed",
        [
            ("k", "k"),
            ("inspireid", "concat('raa/', k)"),
            ("uuid", UUID),
            ("class", "case when k % 4 = 0 then 'Stone setting' when k % 4 = 1 then 'Cairn' when k % 4 = 2 then 'Other' else 'Burial mound' end"),
            ("location", "case when k % 3 = 0 then 'Visible above ground' when k % 3 = 1 then 'Not visible above ground' end"),
            ("damage_status", "case when k % 9 = 0 then 'Not damaged' else 'Unknown' end"),
            ("vegetation", "case when k % 6 = 0 then 'Skog' end"),
            ("tradition", "cast(null as string)"),
            ("description", "case when k % 8 <> 0 then concat('Site ', k, ' lies at ', repeat('a', cast(k % 40 as int))) end"),
            ("itemTitle", "concat('Site ', k)"),
            ("itemKeyword", "case when k % 13 = 0 then '[\"grav\"]' end"),
            ("generatedDescription", "case when k % 5 = 0 then concat('A site, number ', k) end"),
        ],
        None,
    ),
    "fetched": (
        "keyed",
        [
            ("k", "k"),
            ("inspireid", "concat('raa/', k)"),
            ("status", "case when k % 11 in (7, 8) then 404 else 200 end"),
            (
                "body",
                "case when k % 11 in (7, 8) then null when k % 11 = 9 then '{\"@graph\":[{\"@id\":\"http://example.org/other\",\"ksam:itemTitle\":\"x\"}]}' else concat("
                f"'{{\"@graph\":[{{\"@id\":\"{SITE_PREFIX}', k, '\",\"ksam:itemTitle\":\"Site ', k, '\",\"ksam:itemClassName\":', case when k % 33 = 10 then 'null' when k % 33 = 21 then '\"{{bare\"' when k % 11 = 10 then '\"bare\"' else '{{\"@value\":\"Röse\"}}' end, "
                "',\"ksam:itemDescription\":', case when k % 4 = 3 then '{\"@id\":\"#d1\"}' else '[{\"@id\":\"#d1\"},{\"@id\":\"#gone\"},{\"@id\":\"#d2\"}]' end, "
                "',\"ksam:context\":{\"@id\":\"#c\"},\"ksam:itemNumber\":[{\"@id\":\"#n\"}],\"ksam:serviceOrganization\":{\"@value\":\"RAÄ\"},\"ksam:buildDate\":\"2025-01-0', k % 9 + 1, '\"', "
                "case when k % 6 = 0 then ',\"ksam:itemKeyword\":[\"grav\",\"sten\"]' when k % 6 = 1 then ',\"ksam:itemKeyword\":[]' when k % 6 = 2 then ',\"ksam:itemKeyword\":\"ensam\"' when k % 6 = 3 then ',\"ksam:itemKeyword\":[{\"@value\":\"objekt\"}]' else '' end, "
                "'},{\"@id\":\"#d1\",\"ksam:type\":{\"@value\":\"Beskrivning\"},\"ksam:desc\":{\"@value\":\"old\"}},{\"@id\":\"#d1\",\"ksam:type\":{\"@value\":\"Beskrivning\"},\"ksam:desc\":{\"@value\":\"text ', k, '\"}},"
                "{\"@id\":\"#d2\",\"ksam:desc\":{\"@value\":\"more\"}},{\"@id\":\"#c\",\"ksam:countyName\":{\"@value\":\"Halland\"},\"ksam:parishName\":{\"@value\":\"P', k % 17, '\"}},"
                "{\"@id\":\"#n\",\"ksam:type\":{\"@value\":\"RAÄ-nummer\"},\"ksam:number\":{\"@value\":\"Lerum ', k, ':1\"}}]}') end",
            ),
        ],
        None,
    ),
    "relations": ("keyed", [("k", "k"), ("body", "case when k % 22 = 8 then '{\"result\":{\"relations\":{\"relation\":[]}}}' else concat('{\"result\":{\"relations\":{\"relation\":[{\"content\":\"http://example.org/dok/', k * 2, '\"},{\"content\":\"http://example.org/dok/0\"}]}}}') end")], "k % 11 in (7, 8, 9)"),
    "documentation": ("keyed", [("doc_id", "cast(k * 2 as string)"), ("body", f"concat('{{\"@graph\":[{{\"@id\":\"{DOC_PREFIX}', k * 2, '\",\"itemLabel\":\"Record ', k, '\"}}]}}')")], "k % 11 in (7, 8, 9)"),
    "replies": ("keyed", [("k", "k"), ("reply", "concat(case when k % 5 = 0 then concat(chr(10), chr(10), 'Lost paragraph', chr(10)) else '' end, case when k % 7 = 0 then chr(10) else '' end, 'A cairn number ', k, '.', case when k % 3 = 0 then concat(chr(10), chr(10), 'Second one.', chr(10), 'Kept line.') else '' end, case when k % 4 = 0 then concat(chr(10), '# Heading', chr(10), 'tail') else '' end)")], None),
}


#: Views whose rows are some hundred times as wide as the key that they are made from: the keys are dealt out first.
WIDE = ("descriptions", "fetched")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or one of the driver's tables."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source, cols, where = VIEWS[name]
    df = view(spark, sf_dir, source)
    if where:
        df = df.where(where)
    if name in WIDE:
        df = df.select("k").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k")
    return df.selectExpr(*[f"{e} as `{c}`" for c, e in cols])


def oracle(sql: str) -> str:
    """The SQL with the views that it names in front."""
    need: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in need:
            add(VIEWS[name][0])
            need.append(name)

    import re

    for word in re.findall(r"[A-Za-z_]+", sql):
        add(word)
    parts = []
    for n in need:
        source, cols, where = VIEWS[n]
        parts.append(f"{n} as (select " + ", ".join(f'{e} as "{c}"' for c, e in cols) + f" from {source}" + (f" where {where}" if where else "") + ")")
    sql = sql.strip()
    if sql.lower().startswith("with "):
        return "with " + ", ".join(parts) + ", " + sql[5:]
    return ("with " + ", ".join(parts) + " " if parts else "") + sql


REGIONS = [("Stockholm", 17.5, 59.0, 18.5, 60.0), ("Gothenburg", 11.5, 57.5, 12.5, 58.5), ("Malmö", 12.8, 55.3, 13.2, 55.8), ("Uppsala", 17.0, 59.7, 18.0, 60.2), ("Västerås", 16.0, 59.5, 16.8, 59.8), ("Örebro", 15.0, 59.2, 15.4, 59.4), ("Linköping", 15.4, 58.3, 15.8, 58.5)]


def regions(spark: SparkSession) -> DataFrame:
    """Named boxes in degrees."""
    return spark.createDataFrame(REGIONS, "region string, minx double, miny double, maxx double, maxy double")


REGIONS_SQL = "select * from (values " + ", ".join(f"('{r}', {a}, {b}, {c}, {d})" for r, a, b, c, d in REGIONS) + ") as t(region, minx, miny, maxx, maxy)"


def with_rings(features: DataFrame) -> DataFrame:
    """Adds rings: a rectangle of 10 + id % 90 by 10 + id % 70 metres, with a hole of 2 by 3 for each thirtieth id."""
    p = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    rect = lambda x0, y0, w, h: F.array(p(x0, y0), p(x0 + w, y0), p(x0 + w, y0 + h), p(x0, y0 + h), p(x0, y0))
    outer = rect(F.lit(0.0), F.lit(0.0), 10.0 + F.col("id") % 90, 10.0 + F.col("id") % 70)
    hole = rect(F.lit(1.0), F.lit(1.0), F.lit(2.0), F.lit(3.0))
    poly = F.when(F.col("id") % 30 == 7, F.array(outer, hole)).otherwise(F.array(outer))
    return features.withColumn("rings", F.when(F.col("geom_type") == "Polygon", poly).otherwise(F.array().cast("array<array<struct<x:double,y:double>>>")))


def with_parts(features: DataFrame) -> DataFrame:
    """Geometries of all kinds: kind, and parts of rings. Lines have three points, each second one a second part;
    polygons are those of with_rings, some with a second square; some points are two."""
    p = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    one = lambda *points: F.array(F.array(*points))
    two, dot, line = F.col("id") % 20 == 19, F.col("geom_type") == "Point", F.col("geom_type") == "LineString"
    near, square = F.col("id") % 50 == 5, (F.col("geom_type") == "Polygon") & (F.col("id") % 40 == 6)
    path = F.array(F.array(p(0, 0), p(30, 40), p(60, F.col("id") % 50)))
    parts = (
        F.when(dot & near, F.array(one(p(0, 0)), one(p(7, 9))).cast(PARTS)).when(dot, F.array(one(p(0, 0))).cast(PARTS))
        .when(line & two, F.array(path, one(p(100, 100), p(110, 120))).cast(PARTS)).when(line, F.array(path).cast(PARTS))
        .when(square, F.array(F.col("rings"), one(p(200, 200), p(205, 200), p(205, 205), p(200, 205), p(200, 200))).cast(PARTS)).otherwise(F.array("rings").cast(PARTS))
    )
    kind = F.when((dot & near) | (line & two) | square, F.concat(F.lit("Multi"), "geom_type")).otherwise(F.col("geom_type"))
    return with_rings(features).withColumns({"parts": parts, "kind": kind})
