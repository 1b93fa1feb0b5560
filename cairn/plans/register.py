"""The registered queries over site tables, each with the DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import blobs, captions, jsonld, quality, spatial, text
from cairn.functions.class_labels import class_labels, pairs
from cairn.operators import clients, tables
from cairn.sources import layers
from cairn.sources.scratch import scratch
from cairn.sources.stored import StoredTable

from .fixtures import BODY, CLASS_SV, DISCLAIMER, GEO, NN, PLACING, REGIONS_SQL, URL_LINE_CLEAN, oracle, regions, view, with_parts, with_rings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LABELS_SQL = "select * from (values " + ", ".join("('" + a.replace("'", "''") + "', '" + b.replace("'", "''") + "')" for a, b in pairs()) + ") as t(class_sv, class_en)"
CENTRE = (12.154978, 57.482183)
RADIUS_KM = 20.0


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = oracle(sql)
        return f

    return add


#: Fixed values for the SQL: the inverse series of the projection (GRS 80, meridian 15 degrees, scale 0.9996), and the Earth's radius.
SERIES_A = "u - 0.000837732168164144 * sin(2 * u) * cosh(2 * v) - 5.905869626082731e-08 * sin(4 * u) * cosh(4 * v) - 1.6734889049883464e-10 * sin(6 * u) * cosh(6 * v) - 2.1677378055967573e-13 * sin(8 * u) * cosh(8 * v)"
SERIES_B = "v - 0.000837732168164144 * cos(2 * u) * sinh(2 * v) - 5.905869626082731e-08 * cos(4 * u) * sinh(4 * v) - 1.6734889049883464e-10 * cos(6 * u) * sinh(6 * v) - 2.1677378055967573e-13 * cos(8 * u) * sinh(8 * v)"
SERIES_LAT = "0.006739496761943626 - 5.314390558188795e-05 * pow(sin(p), 2) + 5.748912755111949e-07 * pow(sin(p), 4) - 6.820452542788346e-09 * pow(sin(p), 6)"
INVERSE_SQL = f"""select *, 15 + degrees(atan(sinh(b) / cos(a))) as lon, degrees(p + sin(p) * cos(p) * ({SERIES_LAT})) as lat
  from (select *, asin(sin(a) / cosh(b)) as p from (select *, {SERIES_A} as a, {SERIES_B} as b from (select *, y / 6364902.1661127405::double as u, (x - 500000) / 6364902.1661127405::double as v from points)))"""
KM_SQL = "2 * 6371.0088::double * asin(sqrt(pow(sin(radians(lat - 57.482183::double) / 2), 2) + cos(radians(57.482183::double)) * cos(radians(lat)) * pow(sin(radians(lon - 12.154978::double) / 2), 2)))"
LL = f"with ll as ({INVERSE_SQL})"
PLACED = LL + f", regions as ({REGIONS_SQL}), placed as (select r.region, p.* from ll p join regions r on p.lon between r.minx and r.maxx and p.lat between r.miny and r.maxy)"


def _placed(s: SparkSession, d: str) -> DataFrame:
    return spatial.to_wgs84(view(s, d, "points"))


# ---- layers, scans, derived tables


@query("select distinct layer from features")
def list_layers(s, d):
    return layers.layers(view(s, d, "features"))


@query("select id, inspireid, layer from features where geom_type <> 'Polygon'")
def layer_union(s, d):
    f = view(s, d, "features")
    parts = {n: f.where(F.col("layer") == n).drop("layer") for n in ("PS_NationalMonuments_point", "PS_NationalMonuments_line")}
    return layers.combine(parts).select("id", "inspireid", "layer")


@query("select id, geom_type, x, y, inspireid, sitename, layer from features where layer = 'PS_NationalMonuments_line'")
def layer_round_trip(s, d):
    """Two layers saved to one table, one of them loaded again."""
    f, path = view(s, d, "features"), scratch(s, "layers")
    f = f.select(*[F.col(x.name).cast(x.dataType) if x.name in f.columns else F.lit(None).cast(x.dataType).alias(x.name) for x in layers.FEATURES])
    for n in ("PS_NationalMonuments_poly", "PS_NationalMonuments_line"):
        layers.save_layer(f.where(F.col("layer") == n).drop("layer"), path, n)
    return layers.load_layer(s, path, "PS_NationalMonuments_line").select("id", "geom_type", "x", "y", "inspireid", "sitename", "layer")


@query("""select concat('{"id":', id, ',"sitename":', case when sitename is null then 'null' else concat('"', sitename, '"') end, ',"layer":"', layer, '"}') as line from features""")
def results_json(s, d):
    """Results written as JSON lines, nulls included, and read again as text."""
    path = scratch(s, "results")
    layers.save_results(view(s, d, "features").select("id", "sitename", "layer"), path)
    return s.read.text(path).select(F.col("value").alias("line"))


@query("select id, sitename, cast(null as varchar) as description, cast(null as double) as score from features")
def ensured_columns(s, d):
    return layers.ensure_columns(view(s, d, "features").select("id", "sitename"), {"description": "string", "sitename": "string", "score": "double"})


@query("select inspireid, uuid from sites")
def id_scan(s, d):
    return view(s, d, "sites").select("inspireid", "uuid")


@query('select inspireid, class, "generatedDescription" from sites where "generatedDescription" is not null')
def with_caption_subset(s, d):
    return view(s, d, "sites").where(F.col("generatedDescription").isNotNull()).select("inspireid", "class", "generatedDescription")


@query("""select inspireid, case when k % 11 in (7, 8) then description when k % 11 in (9, 10) then null else concat('new ', k) end as description,
    case when k % 11 in (7, 8) then "itemTitle" when k % 11 in (9, 10) then null else concat('Title ', k) end as "itemTitle" from sites""")
def keyed_update(s, d):
    f = view(s, d, "sites")
    new = f.where("k % 11 not in (7, 8)").selectExpr("inspireid", "case when k % 11 < 9 then concat('new ', k) end as description", "case when k % 11 < 9 then concat('Title ', k) end as itemTitle")
    return tables.keyed_update(f, new, "inspireid", ["description", "itemTitle"]).select("inspireid", "description", "itemTitle")


@query("""with a as (select count(*) as n, min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from points)
    select 'feature_count' as key, cast(n as varchar) as value from a union all select 'min_x', cast(cast(x0 as decimal(20,3)) as varchar) from a union all select 'min_y', cast(cast(y0 as decimal(20,3)) as varchar) from a
    union all select 'max_x', cast(cast(x1 as decimal(20,3)) as varchar) from a union all select 'max_y', cast(cast(y1 as decimal(20,3)) as varchar) from a union all select 'source', 'layer point' union all select 'crs', 'EPSG:3006'""")
def metadata_kv(s, d):
    return layers.metadata(view(s, d, "points"), {"source": "layer point", "crs": "EPSG:3006"})


@query("select id, x as longitude, y as latitude from points")
def wkb_points(s, d):
    @F.pandas_udf("binary")
    def wkb(x: pd.Series, y: pd.Series) -> pd.Series:
        rows = np.zeros(len(x), [("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
        rows["order"], rows["kind"], rows["x"], rows["y"] = 1, 1, x, y
        data = rows.tobytes()
        return pd.Series([data[k : k + 21] for k in range(0, len(data), 21)])

    p = view(s, d, "points").select("id", wkb("x", "y").alias("wkb"))
    return spatial.wkb_point(p).select("id", F.col("x").alias("longitude"), F.col("y").alias("latitude"))


#: The vertices of the geometries of all kinds (fixtures.with_parts), one row each; kinds; each ring's segments.
VERTICES = """vertices as (
    select id, 1 as part, 1 as ring, 1 as n, x as px, y as py from features where geom_type = 'Point'
    union all select id, 2, 1, 1, x + 7, y + 9 from features where geom_type = 'Point' and id % 50 = 5
    union all select id, 1, 1, n, x + dx, y + case when n = 3 then id % 50 else dy end from features, (values (1, 0, 0), (2, 30, 40), (3, 60, 0)) as t(n, dx, dy) where geom_type = 'LineString'
    union all select id, 2, 1, n, x + dx, y + dy from features, (values (1, 100, 100), (2, 110, 120)) as t(n, dx, dy) where geom_type = 'LineString' and id % 20 = 19
    union all select id, 1, 1, n, x + dx * (10 + id % 90), y + dy * (10 + id % 70) from features, (values (1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 1), (5, 0, 0)) as t(n, dx, dy) where geom_type = 'Polygon'
    union all select id, 1, 2, n, x + 1 + dx * 2, y + 1 + dy * 3 from features, (values (1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 1), (5, 0, 0)) as t(n, dx, dy) where geom_type = 'Polygon' and id % 30 = 7
    union all select id, 2, 1, n, x + 200 + dx * 5, y + 200 + dy * 5 from features, (values (1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 1), (5, 0, 0)) as t(n, dx, dy) where geom_type = 'Polygon' and id % 40 = 6),
  kinds as (select id, layer, x, y, case when (geom_type = 'Point' and id % 50 = 5) or (geom_type = 'LineString' and id % 20 = 19) or (geom_type = 'Polygon' and id % 40 = 6) then concat('Multi', geom_type) else geom_type end as kind, geom_type from features),
  sums as (select id, count(distinct part) as n_parts, count(*) as n_points, min(px) as minx, min(py) as miny, max(px) as maxx, max(py) as maxy from vertices group by id)"""
PARTS_AREA = "case when geom_type = 'Polygon' then (10.0::double + id % 90) * (10 + id % 70) - case when id % 30 = 7 then 6 else 0 end + case when id % 40 = 6 then 25 else 0 end else 0 end"


def _blobs(s: SparkSession, d: str) -> DataFrame:
    """Features with their geometry as a blob: in turn with an envelope, without one, and big-endian; each nineteenth is cut."""
    f = with_parts(view(s, d, "features"))
    write = lambda **how: blobs.write_geometry(F.col("kind"), F.col("parts"), 3006, **how)
    turn = F.col("id") % 3
    return f.withColumn("geom", F.when(turn == 0, write(envelope=True)).when(turn == 1, write(envelope=False)).otherwise(write(envelope=False, big_endian=True)))


@query(f"""with {VERTICES} select id, case when id % 19 <> 0 then kind end as kind, case when id % 19 <> 0 then 3006 end as srs_id, case when id % 19 <> 0 then n_parts end as n_parts, case when id % 19 <> 0 then n_points end as n_points,
    case when id % 19 <> 0 then {PARTS_AREA} end as area, case when id % 19 <> 0 then minx end as minx, case when id % 19 <> 0 then miny end as miny, case when id % 19 <> 0 then maxx end as maxx, case when id % 19 <> 0 then maxy end as maxy from kinds join sums using (id)""")
def geometry_blobs(s, d):
    """Blobs of all kinds written and read again: kinds, areas and bounds; those that are cut short give null."""
    b = _blobs(s, d).select("id", F.when(F.col("id") % 19 == 0, F.expr("substring(geom, 1, length(geom) - 5)")).otherwise(F.col("geom")).alias("geom"))
    g = b.select("id", blobs.read_geometry(F.col("geom")).alias("g")).select("id", "g.*").withColumn("b", spatial.bounds(F.col("parts")))
    n_points = F.when(F.col("parts").isNotNull(), F.size(F.flatten(F.flatten("parts"))).cast("bigint"))
    n_parts = F.when(F.col("parts").isNotNull(), F.size("parts").cast("bigint"))
    area = F.round(spatial.parts_area(F.col("geom_type"), F.col("parts")), 6)
    return g.select("id", F.col("geom_type").alias("kind"), "srs_id", n_parts.alias("n_parts"), n_points.alias("n_points"), area.alias("area"), "b.minx", "b.miny", "b.maxx", "b.maxy")


@query(f"with {VERTICES} select layer, kind, count(*) as \"rows\", sum(n_points)::bigint as n_points, round(sum({PARTS_AREA}), 6) as area, min(minx) as minx, max(maxy) as maxy from kinds join sums using (id) group by layer, kind")
def blob_layers(s, d):
    """All layers saved with their geometry as blobs, and each loaded by its name."""
    path = scratch(s, "blob-layers")
    f = _blobs(s, d).select("id", "geom", "layer")
    names = ("PS_NationalMonuments_point", "PS_NationalMonuments_line", "PS_NationalMonuments_poly")
    for n in names:
        layers.save_layer(f.where(F.col("layer") == n).drop("layer"), path, n)
    got = layers.combine({n: layers.load_layer(s, path, n, None).drop("layer") for n in names})
    g = got.select("layer", blobs.read_geometry(F.col("geom")).alias("g")).select("layer", "g.*").withColumn("b", spatial.bounds(F.col("parts")))
    area = F.round(F.sum(spatial.parts_area(F.col("geom_type"), F.col("parts"))), 6)
    n_points = F.sum(F.size(F.flatten(F.flatten("parts"))))
    return g.groupBy("layer", F.col("geom_type").alias("kind")).agg(F.count("*").alias("rows"), n_points.alias("n_points"), area.alias("area"), F.min("b.minx").alias("minx"), F.max("b.maxy").alias("maxy"))


OWN_BOX = ("x - 20 + id % 97", "y - 20 + id % 83", "x - 20 + id % 97 + (id % 5) * 0.5", "y - 20 + id % 83 + (id % 7) * 0.5")


@query(f"""with {VERTICES}, boxes as (select id, kind, x, y, {OWN_BOX[0]} as x0, {OWN_BOX[1]} as y0, ({OWN_BOX[2]})::double as x1, ({OWN_BOX[3]})::double as y1 from kinds),
  edges as (select v.id, v.px as ax, v.py as ay, w.px as bx, w.py as by_, part from vertices v join vertices w using (id, part, ring) where w.n = v.n + 1 and v.ring = 1),
  hits as (select id from vertices join boxes using (id) where px between x0 and x1 and py between y0 and y1
    union select id from edges join boxes using (id) where least(ax, bx) <= x1 and greatest(ax, bx) >= x0 and least(ay, by_) <= y1 and greatest(ay, by_) >= y0
      and (kind like '%Polygon' or not ((bx - ax) * (y0 - ay) - (by_ - ay) * (x0 - ax) > 0 and (bx - ax) * (y1 - ay) - (by_ - ay) * (x0 - ax) > 0 and (bx - ax) * (y0 - ay) - (by_ - ay) * (x1 - ax) > 0 and (bx - ax) * (y1 - ay) - (by_ - ay) * (x1 - ax) > 0)
       and not ((bx - ax) * (y0 - ay) - (by_ - ay) * (x0 - ax) < 0 and (bx - ax) * (y1 - ay) - (by_ - ay) * (x0 - ax) < 0 and (bx - ax) * (y0 - ay) - (by_ - ay) * (x1 - ax) < 0 and (bx - ax) * (y1 - ay) - (by_ - ay) * (x1 - ax) < 0))
    union select id from boxes where kind like '%Polygon' and x0 <= x + 10 + id % 90 and x1 >= x and y0 <= y + 10 + id % 70 and y1 >= y and not (id % 30 = 7 and x0 > x + 1 and x1 < x + 3 and y0 > y + 1 and y1 < y + 4))
  select id, layer, kind from kinds where id in (select id from hits)""")
def features_in_boxes(s, d):
    """Features of all layers that meet a small box of their own: points, segments, polygons with holes."""
    f = with_parts(view(s, d, "features"))
    return f.where(spatial.meets_box(F.col("kind"), F.col("parts"), *[F.expr(b).cast("double") for b in OWN_BOX])).select("id", "layer", "kind")


@query("""with v as (select 1 as pos, 'class' as c, class as value from sites union all select 2, 'location', location from sites union all select 3, 'damage_status', damage_status from sites), t as (select count(*) as total from sites),
    n as (select pos, c, value, count(*) as n from v where value is not null group by all),
    w as (select pos, c, sum(n)::bigint as filled, count(*) as kinds, string_agg(concat('{"value":"', value, '","count":', n, ',"percentage":', cast(round(100.0::double * n / total, 2) as varchar), '}'), ',' order by n desc, value) as vals from n, t group by pos, c)
    select concat('{"timestamp":"2025-01-01T00:00:00.000Z","database":"sites","totalRecords":', any_value(total), ',"columns":[', string_agg(concat('{"column":"', c, '","totalRecords":', total, ',"nonNullRecords":', filled, ',"uniqueValues":', kinds, ',"values":[', vals, ']}'), ',' order by pos), ']}') as document from w, t""")
def profile_document(s, d):
    return tables.profile_document(view(s, d, "sites"), ["class", "location", "damage_status"], "sites", "2025-01-01T00:00:00.000Z")


# ---- filters


@query("select id, layer from features where geom_type = 'LineString'")
def filter_geom_type(s, d):
    return view(s, d, "features").where(F.col("geom_type") == "LineString").select("id", "layer")


@query("select id, sitename from features where sitename is not null")
def named_sites(s, d):
    return view(s, d, "features").where(F.col("sitename").isNotNull()).select("id", "sitename")


@query(LL + " select id, round(lon, 6) as lon, round(lat, 6) as lat from ll where lon between 11.5 and 12.5 and lat between 57.5 and 58.5")
def bbox_filter(s, d):
    p = _placed(s, d).where(spatial.in_box(F.col("lon"), F.col("lat"), 11.5, 57.5, 12.5, 58.5))
    return p.select("id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("select id, x, y from points where x between 300000 and 400000 and y between 6400000 and 6500000")
def metre_box(s, d):
    return view(s, d, "points").where(spatial.in_box(F.col("x"), F.col("y"), 300000, 6400000, 400000, 6500000)).select("id", "x", "y")


@query("select id, x, y, sitename from points where x between 300000 and 340000 and y between 6400000 and 6440000")
def clustered_box(s, d):
    """A box of a layer that is stored along a curve through space, of which few row groups are read."""
    path = scratch(s, "clustered")
    layers.save_clustered(view(s, d, "points").select("id", "x", "y", "sitename"), path, "point", 16)
    return layers.load_layer(s, path, "point", None).where(spatial.in_box(F.col("x"), F.col("y"), 300000.0, 6400000.0, 340000.0, 6440000.0)).select("id", "x", "y", "sitename")


@query(LL + f""", h as (select id, {KM_SQL} as km from ll)
    select id, round(km, 6) as distance_km from h where km <= 20""")
def radius_filter(s, d):
    return spatial.within_km(view(s, d, "points"), *CENTRE, RADIUS_KM).select("id", F.round("distance_km", 6).alias("distance_km"))


@query("select inspireid from descriptions where description is not null and description <> ''")
def has_text(s, d):
    return view(s, d, "descriptions").where(F.col("description").isNotNull() & (F.col("description") != "")).select("inspireid")


@query("""select inspireid, class from sites where location = 'Visible above ground' and "generatedDescription" is null""")
def caption_queue(s, d):
    return _queue(s, d).select("inspireid", "class")


def _queue(s, d):
    return view(s, d, "sites").where((F.col("location") == "Visible above ground") & F.col("generatedDescription").isNull())


@query("select inspireid, uuid, class from sites where inspireid = 'raa/777'")
def site_lookup(s, d):
    return view(s, d, "sites").where(F.col("inspireid") == "raa/777").select("inspireid", "uuid", "class")


CHECKED = ["designationschemevalue", "designationvalue", "protectionclassificationvalue", "protectionclassificationvalue2", "inspireid", "sitename"]


@query(" union all ".join(f"select '{c}' as \"column\", count(distinct {c}) <= 1 as constant, round((count(*) - count({c})) * 1.0::double / count(*), 6) as null_share, count(distinct {c}) <= 1 or (count(*) - count({c})) * 1.0::double / count(*) >= 0.999 as redundant from features" for c in CHECKED))
def redundant_columns(s, d):
    return tables.redundant_columns(view(s, d, "features"), CHECKED)


@query("select id, inspireid, sitename from features")
def without_redundant(s, d):
    return tables.drop_redundant(view(s, d, "features").select("id", *CHECKED), CHECKED)


@query("select inspireid from descriptions where coalesce(description, '') = ''")
def reject_rows(s, d):
    return view(s, d, "descriptions").where(F.coalesce("description", F.lit("")) == "").select("inspireid")


# ---- joins


@query(f"with labels_ as ({LABELS_SQL}) select k, v.class_sv, coalesce(l.class_en, v.class_sv) as class_en from (select k, {CLASS_SV} as class_sv from keyed) v left join labels_ l on v.class_sv = l.class_sv")
def class_translate(s, d):
    f = view(s, d, "keyed").selectExpr("k", f"{CLASS_SV} as class_sv")
    return tables.lookup(f, F.broadcast(class_labels(s)), "class_sv", "class_sv", "class_en", "class_en").select("k", "class_sv", "class_en")


@query("""select k, '#d1' as ref, concat('text ', k) as content from fetched where k % 11 < 7 or k % 11 = 10 and true
    union all select k, '#d2', 'more' from fetched where (k % 11 < 7 or k % 11 = 10) and k % 4 <> 3""".replace("where k % 11 < 7 or k % 11 = 10 and true", "where (k % 11 < 7 or k % 11 = 10) and k % 4 <> 3"))
def entity_refs(s, d):
    f = view(s, d, "fetched").select("k", jsonld.graph(F.col("body")).alias("g"))
    f = f.withColumn("main", jsonld.main_entity(F.col("g")))
    r = f.select("k", "g", F.explode(jsonld.refs(F.col("main"), "ksam:itemDescription")).alias("ref"))
    hit = r.withColumn("e", jsonld.entity(F.col("g"), F.col("ref"))).where("e is not null")
    return hit.select("k", "ref", jsonld.value(F.col("e"), "ksam:desc").alias("content"))


@query(PLACED + " select region, id from placed")
def region_join(s, d):
    return tables.degree_region_join(view(s, d, "points"), regions(s)).select("region", "id")


@query("""select k, case when k % 11 < 7 or k % 11 = 10 then 'direct' else 'documentation' end as source, case when k % 11 < 7 or k % 11 = 10 then 'No label' else concat('Record ', k) end as "itemLabel",
    case when k % 11 < 7 or k % 11 = 10 then concat('Site ', k) else 'No title' end as "itemTitle" from fetched where k % 11 < 7 or k % 11 = 10 or k % 22 <> 8""")
def fallback_resolve(s, d):
    f = view(s, d, "fetched")
    direct = f.where("status = 200").withColumn("main", jsonld.main_entity(jsonld.graph(F.col("body")))).where("main is not null").select("k", "main")
    rest = f.select("k").join(direct.select("k"), "k", "left_anti")
    rel = view(s, d, "relations").withColumn("uri", F.get_json_object("body", "$.result.relations.relation[0].content")).where("uri is not null")
    ids = rest.join(rel.select("k", F.substring_index("uri", "/", -1).alias("doc_id")), "k")
    docs = view(s, d, "documentation").withColumn("main", jsonld.main_entity(jsonld.graph(F.col("body")), jsonld.DOC_PREFIX)).where("main is not null")
    other = ids.join(docs.select("doc_id", "main"), "doc_id").select("k", "main")
    both = direct.withColumn("source", F.lit("direct")).unionByName(other.withColumn("source", F.lit("documentation")))
    pick = lambda n, default: F.coalesce(jsonld.plain(F.col("main"), n), jsonld.plain(F.col("main"), f"ksam:{n}"), F.lit(default)).alias(n)
    return both.select("k", "source", pick("itemLabel", "No label"), pick("itemTitle", "No title"))


@query('select inspireid from sites where "generatedDescription" is null')
def uncaptioned_anti(s, d):
    f = view(s, d, "sites")
    return f.select("inspireid").join(f.where("generatedDescription is not null").select("inspireid"), "inspireid", "left_anti")


# ---- aggregates


@query("""select count(*) as "rows", cast(13 as bigint) as "columns", string_agg(distinct geom_type, ',' order by geom_type) as geom_types, min(x) as minx, min(y) as miny, max(x) as maxx, max(y) as maxy,
    (select string_agg(inspireid, ',' order by id) from (select id, inspireid from features order by id limit 3)) as sample, 'EPSG:3006' as crs,
    'id:bigint, layer:string, geom_type:string, x:double, y:double, designationschemevalue:string, designationvalue:string, protectionclassificationvalue:string, protectionclassificationvalue2:string, inspireid:string, sitename:string, legalfoundationdocument:string, rings:array<array<struct<x:double,y:double>>>' as schema from features""")
def explore_summary(s, d):
    f = with_rings(view(s, d, "features"))
    one = f.agg(F.count("*").alias("rows"), F.array_join(F.sort_array(F.collect_set("geom_type")), ",").alias("geom_types"), F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"))
    head = tables.take(f, ["id"], 3).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "inspireid"))), lambda r: r["inspireid"]), ",").alias("sample"))
    return one.crossJoin(head).withColumns({"columns": F.lit(len(f.columns)).cast("bigint"), "crs": F.lit("EPSG:3006"), "schema": F.lit(", ".join(f"{n}:{t}" for n, t in f.dtypes))})


@query("""select min(x) as minx, min(y) as miny, max(case when geom_type = 'Polygon' then x + 10 + id % 90 else x end) as maxx, max(case when geom_type = 'Polygon' then y + 10 + id % 70 else y end) as maxy from features""")
def total_bounds(s, d):
    f = with_rings(view(s, d, "features"))
    edge = lambda c, f_: F.when(F.size("rings") > 0, f_(F.transform(F.flatten("rings"), lambda p: p[c]))).otherwise(F.col(c))
    return f.agg(F.min(edge("x", F.array_min)).alias("minx"), F.min(edge("y", F.array_min)).alias("miny"), F.max(edge("x", F.array_max)).alias("maxx"), F.max(edge("y", F.array_max)).alias("maxy"))


@query('select geom_type, count(*) as "count" from features group by geom_type')
def geom_histogram(s, d):
    return view(s, d, "features").groupBy("geom_type").count()


AREA_SQL = "round(sum(case when geom_type = 'Polygon' then (10.0::double + id % 90) * (10 + id % 70) - case when id % 30 = 7 then 6 else 0 end else 0 end) / 1e6, 9)"


@query(f"select {AREA_SQL} as area_km2 from features")
def area_km2(s, d):
    return with_rings(view(s, d, "features")).agg(F.round(tables.area_km2(), 9).alias("area_km2"))


CATS = ["class", "location", "damage_status"]
CATS_SQL = " union all ".join(f"select '{c}' as \"column\", cast({c} as varchar) as value from sites where {c} is not null" for c in CATS)


@query(f"""with v as ({CATS_SQL}), n as (select "column", value, count(*) as c from v group by all), r as (select *, row_number() over (partition by "column" order by c desc, value) as nth from n)
    select "column", count(*) as "unique", string_agg(concat(value, '=', c), ', ' order by nth) filter (nth <= 3) as top3 from r group by "column" """)
def column_stats_cat(s, d):
    counts = tables.top_values(view(s, d, "sites"), CATS)
    three = tables.first_per(counts, ["column"], [F.desc("count"), "value"], 3)
    top = F.transform(F.sort_array(F.collect_list(F.struct("nth", F.concat_ws("=", "value", F.col("count").cast("string")).alias("t")))), lambda r: r["t"])
    top3 = three.groupBy("column").agg(F.array_join(top, ", ").alias("top3"))
    return tables.value_totals(counts).join(top3, "column").select("column", F.col("uniqueValues").alias("unique"), "top3")


@query(" union all ".join(f"select '{c}' as \"column\", min({c}) as \"min\", max({c}) as \"max\", round(avg({c}), 4) as mean from points" for c in ("x", "y")))
def column_stats_num(s, d):
    return tables.numeric_stats(view(s, d, "points"), ["x", "y"]).withColumn("mean", F.round("mean", 4))


@query("select layer, count(*) as total, count(sitename) as named, round(100.0::double * count(sitename) / count(*), 1) as percentage from features group by layer")
def named_share(s, d):
    g = view(s, d, "features").groupBy("layer").agg(F.count("*").alias("total"), F.count("sitename").alias("named"))
    return g.withColumn("percentage", F.round(100 * F.col("named") / F.col("total"), 1))


@query(PLACED + " select r.region, count(p.id) as total, count(p.sitename) as named from regions r left join placed p on p.region = r.region group by r.region")
def region_counts(s, d):
    p = view(s, d, "points")
    return tables.region_counts(p, regions(s), joined=tables.degree_region_join(p, regions(s)))


@query('select count(*) as total, count(description) as description, count("itemTitle") as "itemTitle", count("itemKeyword") as "itemKeyword", round(100.0::double * count("itemKeyword") / count(*), 1) as keyword_share from sites')
def field_coverage(s, d):
    one = view(s, d, "sites").agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in ("description", "itemTitle", "itemKeyword")])
    return one.withColumn("keyword_share", F.round(100 * F.try_divide("itemKeyword", "total"), 1))


@query("select cast(min(length(description)) as bigint) as min_length, cast(max(length(description)) as bigint) as max_length, round(avg(length(description)), 4) as mean_length from descriptions")
def length_stats(s, d):
    n = F.length("description").cast("bigint")
    return view(s, d, "descriptions").agg(F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.round(F.avg(n), 4).alias("mean_length"))


@query('select class, count(*) as "count" from sites group by class order by 2 desc, 1 limit 5')
def top_classes(s, d):
    return view(s, d, "sites").groupBy("class").count().orderBy(F.desc("count"), "class").limit(5)


@query(f"""with v as ({CATS_SQL}), n as (select "column", value, count(*) as c from v group by all), t as (select count(*) as total from sites)
    select "column", total as "totalRecords", cast(sum(c) over (partition by "column") as bigint) as "nonNullRecords", count(*) over (partition by "column") as "uniqueValues", value, c as "count", round(100.0::double * c / total, 2) as percentage from n, t""")
def column_profile(s, d):
    return tables.column_profile(view(s, d, "sites"), CATS)


@query(f"""with v as ({CATS_SQL}), n as (select "column", value, count(*) as c from v group by all), t as (select count(*) as total from sites), r as (select *, row_number() over (partition by "column" order by c desc, value) as nth from n)
    select "column", any_value(total) as "totalRecords", sum(c)::bigint as "nonNullRecords", count(*) as "uniqueValues", string_agg(concat(value, '=', c), ', ' order by c desc, value) as "values", 0.0::double as count_error from n, t group by "column" """)
def sketch_profile(s, d):
    """The columns' profile by sketches alone, which are exact for so few values."""
    out = tables.sketch_profile(view(s, d, "sites"), CATS)
    told = F.transform(F.array_sort("values", lambda a, b: F.when(a["count"] > b["count"], -1).when(a["count"] < b["count"], 1).when(a["value"] < b["value"], -1).otherwise(1)), lambda v: F.concat_ws("=", v["value"], v["count"].cast("string")))
    return out.select("column", "totalRecords", "nonNullRecords", "uniqueValues", F.array_join(told, ", ").alias("values"), "count_error")


@query("""select count(*) as source_total, count("generatedDescription") as matching, count("generatedDescription") as output_total, cast(0 as bigint) as violations from sites""")
def subset_audit(s, d):
    f, path = view(s, d, "sites"), scratch(s, "subset")
    layers.derive_table(f, F.col("generatedDescription").isNotNull(), path)
    out = s.read.parquet(path)  # what was written is what is judged
    a = f.agg(F.count("*").alias("source_total"), F.count("generatedDescription").alias("matching"))
    return a.crossJoin(out.agg(F.count("*").alias("output_total"), F.count_if(F.col("generatedDescription").isNull()).alias("violations")))


GOOD = "(k % 11 < 7 or k % 11 = 10)"


@query(f"""select field, sum(n)::bigint as occurrences, count(distinct k) as documents from (
    select k, 'Beskrivning' as field, 1 as n from fetched where {GOOD} and k % 4 <> 3 union all select k, 'Unknown', 1 from fetched where {GOOD} and k % 4 <> 3 union all select k, 'geographic', 1 from fetched where {GOOD}
    union all select k, 'RAÄ-nummer', 1 from fetched where {GOOD} union all select k, 'organization', 1 from fetched where {GOOD} union all select k, 'buildDate', 1 from fetched where {GOOD}) group by field""")
def field_frequency(s, d):
    f = view(s, d, "fetched").select("k", jsonld.graph(F.col("body")).alias("g")).withColumn("main", jsonld.main_entity(F.col("g"))).where("main is not null")
    x = f.select("k", F.explode(jsonld.parts(F.col("g"), F.col("main"))).alias("p")).where("p.field is not null")
    return x.groupBy(F.col("p.field").alias("field")).agg(F.count("*").alias("occurrences"), F.count_distinct("k").alias("documents"))


@query(f"""with f as (select field, sum(n)::bigint as occurrences from (
    select 'Beskrivning' as field, 1 as n from fetched where {GOOD} and k % 4 <> 3 union all select 'Unknown', 1 from fetched where {GOOD} and k % 4 <> 3 union all select 'geographic', 1 from fetched where {GOOD}
    union all select 'RAÄ-nummer', 1 from fetched where {GOOD} union all select 'organization', 1 from fetched where {GOOD} union all select 'buildDate', 1 from fetched where {GOOD}) group by field)
    select 'field' as kind, cast(row_number() over (order by occurrences desc, field) as bigint) as nth, field as name, occurrences as "count" from f
    union all select 'error', cast(row_number() over (order by k) as bigint), concat('raa/', k), cast(1 as bigint) from (select k from fetched where k % 11 = 10 order by k limit 10)""")
def frequency_report(s, d):
    """Fields by falling frequency, then the first ten sites whose documents couldn't be read."""
    fields = field_frequency(s, d).select("field", "occurrences")
    ranked = fields.withColumn("nth", F.row_number().over(tables.Window.orderBy(F.desc("occurrences"), "field")))  # a row for each field
    bad = view(s, d, "fetched").select("k", "inspireid", jsonld.enrichment(F.col("body"))["error"].alias("error")).where("error")
    first = tables.take(bad, ["k"], 10).withColumn("nth", F.row_number().over(tables.Window.orderBy("k")))
    shaped = lambda f, kind, name, n: f.select(F.lit(kind).alias("kind"), F.col("nth").cast("bigint").alias("nth"), F.col(name).alias("name"), n.alias("count"))
    return shaped(ranked, "field", "field", F.col("occurrences")).unionByName(shaped(first, "error", "inspireid", F.lit(1).cast("bigint")))


@query("select count(*) as total, count(*) filter (status = 200) as successful, count(*) filter (status <> 200) as failed, round(100.0::double * count(*) filter (status = 200) / count(*), 1) as success_rate from fetched")
def enrich_outcome(s, d):
    one = view(s, d, "fetched").agg(F.count("*").alias("total"), F.count_if(F.col("status") == 200).alias("successful"), F.count_if(F.col("status") != 200).alias("failed"))
    return one.withColumn("success_rate", F.round(100 * F.try_divide("successful", "total"), 1))


@query(LL + f""", h as (select id, {KM_SQL} as km from ll),
    n as (select (select count(*) from features) as a, (select count(*) from points) as b, (select count(distinct legalfoundationdocument) from points) as c, (select count(*) from h where km <= 20) as e)
    select 'features' as stage, a as "rows", cast(0 as bigint) as removed, 1.0::double as kept, cast(null as double) as coverage_km2 from n union all select 'points', b, a - b, round(b::double / a, 6), null from n union all select 'deduplicated', c, b - c, round(c::double / b, 6), null from n union all select 'radius', e, c - e, round(e::double / c, 6), round(pi() * 400, 3) from n""")
def stage_retention(s, d):
    f, p = view(s, d, "features"), view(s, d, "points")
    a = f.agg(F.count("*").alias("a"), F.count_if(F.col("geom_type") == "Point").alias("b"))
    c = p.agg(F.count_distinct("legalfoundationdocument").alias("c"))
    e = spatial.within_km(p, *CENTRE, RADIUS_KM).agg(F.count("*").alias("e"))
    kept = "stack(4, 'features', a, 0L, 1D, 'points', b, a - b, round(b / a, 6), 'deduplicated', c, b - c, round(c / b, 6), 'radius', e, c - e, round(e / c, 6)) as (stage, rows, removed, kept)"
    out = a.crossJoin(c).crossJoin(e).select(F.expr(kept))
    return out.withColumn("coverage_km2", F.when(F.col("stage") == "radius", F.round(spatial.circle_km2(RADIUS_KM), 3)))


def _common_sql(c: str) -> str:
    return f"(select string_agg(concat(value, '=', n), ', ' order by n desc, value) from (select {c} as value, count(*) as n from features where {c} is not null group by 1 order by 2 desc, 1 limit 3))"


@query(f"""select 'features' as name, 'table' as kind, count(*) as total, {AREA_SQL} as area_km2, cast(null as bigint) as unique_values, (select string_agg(concat(geom_type, '=', n), ', ' order by n desc) from (select geom_type, count(*) as n from features group by 1)) as most_common, cast(null as double) as "min", cast(null as double) as "max", cast(null as double) as mean from features
    """ + "".join(f" union all select '{c}', 'categorical', null, null, count(distinct {c}), {_common_sql(c)}, null, null, null from features" for c in ("layer", "designationvalue", "sitename")) + "".join(f" union all select '{c}', 'numerical', null, null, null, null, min({c}), max({c}), round(avg({c}), 4) from features" for c in ("x", "y")))
def table_statistics(s, d):
    out = tables.statistics(with_rings(view(s, d, "features")), ["layer", "designationvalue", "sitename"], ["x", "y"], "features")
    return out.withColumns({"area_km2": F.round("area_km2", 9), "mean": F.round("mean", 4)})


# ---- windows, sorts, samples


@query(f"""with v as ({CATS_SQL}), n as (select "column", value, count(*) as c from v group by all), r as (select *, row_number() over (partition by "column" order by c desc, value) as nth from n)
    select "column", value, c as "count", cast(nth as bigint) as nth from r where nth <= 3""")
def top3_per_column(s, d):
    out = tables.first_per(tables.top_values(view(s, d, "sites"), CATS), ["column"], [F.desc("count"), "value"], 3)
    return out.withColumn("nth", F.col("nth").cast("bigint"))


@query(PLACED + " select region, id, sitename, nth from (select region, id, sitename, cast(row_number() over (partition by region order by id) as bigint) as nth from placed where sitename is not null) where nth <= 3")
def region_samples(s, d):
    named = tables.degree_region_join(view(s, d, "points").where("sitename is not null"), regions(s))
    return tables.first_per(named, ["region"], ["id"], 3).select("region", "id", "sitename", F.col("nth").cast("bigint").alias("nth"))


@query("select min(id) as id, substr(legalfoundationdocument, 29) as uuid from points group by 2")
def points_dedup(s, d):
    p = view(s, d, "points").withColumn("uuid", text.first_uuid(F.col("legalfoundationdocument")))
    return tables.dedup(p, "uuid", ["id"]).select("id", "uuid")


@query(f"select k, concat('{jsonld.SITE_PREFIX}', k) as main_id from fetched where {GOOD}")
def main_entity(s, d):
    f = view(s, d, "fetched").withColumn("main", jsonld.main_entity(jsonld.graph(F.col("body")))).where("main is not null")
    return f.select("k", jsonld.plain(F.col("main"), "@id").alias("main_id"))


@query("select inspireid, class from sites order by k limit 100")
def limit_sites(s, d):
    return tables.take(view(s, d, "sites"), ["k"], 100).select("inspireid", "class")


@query("select inspireid, cast(length(description) as bigint) as n from descriptions where description is not null order by length(description) desc, inspireid limit 5")
def longest_descriptions(s, d):
    return view(s, d, "descriptions").where("description is not null").select("inspireid", F.length("description").cast("bigint").alias("n")).orderBy(F.desc("n"), "inspireid").limit(5)


@query("select inspireid from descriptions where description is not null and description <> '' order by md5(inspireid), inspireid limit 50")
def hash_sample(s, d):
    return tables.hash_sample(has_text(s, d), "inspireid", 50)


@query("""select inspireid from sites where location = 'Visible above ground' and "generatedDescription" is null order by md5(concat('batch', inspireid)), inspireid limit 500""")
def caption_batch(s, d):
    return tables.hash_sample(_queue(s, d), "inspireid", 500, "batch").select("inspireid")


# ---- text


def _blank(sql: str) -> str:
    return f"case when k % 31 <> 0 and k % 29 <> 0 then {sql} end"


FULL_BODY = f"concat({BODY}, {URL_LINE_CLEAN}, case when k % 4 = 1 and k % 7 = 0 then ' ' else '' end, {DISCLAIMER})"


@query(f"""select k, {_blank(CLASS_SV)} as class, {_blank(PLACING)} as location, {_blank(GEO)} as province, {_blank("concat('Lerum ', k, ':1')")} as raa_number, {_blank("concat('Site ', k)")} as title,
    {_blank("'Skog'")} as vegetation, cast(null as varchar) as url, {_blank("concat('inga uppgifter ', k)")} as rest, {_blank("k % 5 <> 0")} as has_description from descriptions""")
def parse_blocks(s, d):
    f = view(s, d, "descriptions").select("k", text.block_columns(F.col("description")).alias("b"))
    return f.select("k", *[f"b.{c}" for c in ("class", "location", "province", "raa_number", "title", "vegetation", "url", "rest")], F.when(F.col("b").isNotNull(), F.col("b.description_swedish").isNotNull()).alias("has_description"))


@query("""select k, case when k % 31 <> 0 and k % 29 <> 0 then 'Site ' || k end as title, case when k % 31 <> 0 and k % 29 <> 0 then case when k % 5 <> 0 then 'Placering=placering,Beskrivning=beskrivning,RAÄ-nummer=raä-nummer' else 'Placering=placering,RAÄ-nummer=raä-nummer' end end as rejected from descriptions""")
def guarded_blocks(s, d):
    f = view(s, d, "descriptions").select("k", text.block_columns(F.col("description"), strict=True).alias("b"))
    return f.select("k", "b.title", F.array_join(F.transform("b.rejected", lambda x: F.concat_ws("=", x["label"], x["name"])), ",").alias("rejected"))


@query("""select k, label, lower(replace(replace(replace(replace(label, 'å', 'a'), 'ä', 'a'), 'ö', 'o'), ' ', '_')) as name from (select k, case when k % 3 = 0 then 'RAÄ-nummer' when k % 3 = 1 then 'Antikvarisk bedömning' else 'Undersökningsstatus Å' end as label from keyed)""")
def normalise_names(s, d):
    f = view(s, d, "keyed").selectExpr("k", "case when k % 3 = 0 then 'RAÄ-nummer' when k % 3 = 1 then 'Antikvarisk bedömning' else 'Undersökningsstatus Å' end as label")
    return f.withColumn("name", text.normalise(F.col("label")))


def _lines(s, d, names: list[str], source: str = "descriptions") -> DataFrame:
    f = view(s, d, source).withColumn("found", text.sections(F.col("description")))
    return f.withColumns(text.line_fields(F.col("found"), names))


@query(f"""select k, {_blank(CLASS_SV)} as class, {_blank(PLACING)} as placement, {_blank(f"case when k % 5 <> 0 then {FULL_BODY} end")} as description_sv, {_blank(f"concat('Lerum ', k, ':1', {NN}, 'inga uppgifter ', k)")} as raa_number,
    {_blank("concat('Site ', k)")} as title from descriptions""")
def parse_lines(s, d):
    return _lines(s, d, ["class", "placement", "description_sv", "raa_number", "title"]).select("k", "class", "placement", "description_sv", "raa_number", "title")


@query(f"""select k, cast(null as varchar) as province, {_blank("'Halland'")} as county, {_blank("concat('M', k % 11)")} as municipality, {_blank(f"concat('P', k % 17, {NN}, 'Vegetation: Skog')")} as parish from descriptions""")
def parse_geo_line(s, d):
    return _lines(s, d, ["province", "county", "municipality", "parish"]).select("k", "province", "county", "municipality", "parish")


@query("select k, trim(regexp_replace(description, '(?i)https?://[^[:space:]]+', '', 'g'), chr(10) || ' ') as text from descriptions")
def strip_urls(s, d):
    return view(s, d, "descriptions").select("k", text.strip_urls(F.col("description")).alias("text"))


@query("select k, replace(description, 'Beskrivningen är inte kvalitetssäkrad.', '') as text from descriptions")
def strip_disclaimers(s, d):
    return view(s, d, "descriptions").select("k", text.strip_disclaimers(F.col("description")).alias("text"))


CAPTION_SQL = f"""case when k % 31 = 0 or k % 29 = 0 or k % 5 = 0 then '' else concat(case when k % 4 = 0 then 'Stensättning (Stone setting)' when k % 4 = 1 then 'Röse (Cairn)' when k % 4 = 2 then 'Okänd' else 'Hög (Burial mound)' end, chr(10), 'Description (sv): ', {BODY}, {URL_LINE_CLEAN}) end"""


def _inputs(s, d) -> DataFrame:
    f = _lines(s, d, ["class", "placement", "description_sv", "terrain", "orientation"])
    dim = class_labels(s).withColumnRenamed("class_sv", "_sv")
    f = f.join(F.broadcast(dim), f["class"] == dim["_sv"], "left")
    return f.withColumn("given", captions.caption_input(F.col("class"), F.col("class_en"), F.col("description_sv"), F.col("terrain"), F.col("orientation")))


@query(f"select k, {CAPTION_SQL} as given from descriptions")
def caption_input(s, d):
    return _inputs(s, d).select("k", "given")


@query("""select k, md5(concat(chr(10), '    SOURCE DATA:', chr(10), '    ', 'class: ', class, ',', chr(10), 'description: ', coalesce(description, 'null'), ',', chr(10), 'vegetation: ', coalesce(vegetation, 'null'), ',', chr(10), 'tradition: null,', chr(10), 'damage_status: ', damage_status, ',', chr(10), 'location: ', coalesce(location, 'null'), ',', chr(10), chr(10), chr(10), '    YOUR INSTRUCTIONS:', chr(10), '    ', 'Short.', chr(10), '    ')) as prompt_md5 from sites""")
def prompt_record(s, d):
    f = view(s, d, "sites")
    return f.select("k", F.md5(captions.record_prompt({n: F.col(n) for n in captions.RECORD_FIELDS}, "Short.")).alias("prompt_md5"))


@query(f"select k, length({CAPTION_SQL}) * 2 + {len(captions.TEXT_ORDER) + 1 + len(chr(10) * 2 + 'Site description: ')} as n, concat('Site description: ', {CAPTION_SQL}) as tail from descriptions")
def prompt_text(s, d):
    f = _inputs(s, d).withColumn("prompt", captions.text_prompt(F.col("given")))
    return f.select("k", F.length("prompt").cast("bigint").alias("n"), F.regexp_extract("prompt", r"(?s)\n\n(Site description: .*)\z", 1).alias("tail"))


CLEAN_SQL = """case when k % 5 = 0 then concat(case when k % 7 = 0 then chr(10) else '' end, 'A cairn number ', k, '.', case when k % 3 = 0 then concat(chr(10), chr(10), 'Second one.', chr(10), 'Kept line.') else '' end)
    else concat('A cairn number ', k, '.', case when k % 3 = 0 then concat(chr(10), 'Kept line.') else '' end) end"""


@query(f"select k, concat({CLEAN_SQL}, case when k % 4 = 0 then concat(chr(10), 'tail') else '' end) as caption, replace(trim(reply, chr(10)), chr(10), ' ') as flat from replies")
def clean_caption(s, d):
    return view(s, d, "replies").select("k", captions.clean_caption(F.col("reply")).alias("caption"), captions.flat_caption(F.col("reply")).alias("flat"))


@query("select k, case when length(description) > 30 then concat(substr(description, 1, 30), '...') else description end as preview from sites")
def preview_text(s, d):
    return view(s, d, "sites").select("k", text.preview(F.col("description"), 30).alias("preview"))


@query("select id, substr(legalfoundationdocument, 29) as uuid from features")
def extract_uuid(s, d):
    return view(s, d, "features").select("id", text.first_uuid(F.col("legalfoundationdocument")).alias("uuid"))


@query("""select k, case when ms < 1000 then concat(ms, 'ms') when ms < 60000 then concat(regexp_replace(cast(ms / 1000 as varchar), '\\.0$', ''), 's') when ms < 3600000 then concat(regexp_replace(cast(ms / 60000 as varchar), '\\.0$', ''), 'm')
    else concat(ms // 3600000, 'h ', (ms % 3600000) // 60000, 'm') end as label from (select k, case when k % 4 = 0 then k % 1000 when k % 4 = 1 then 1000 + k % 59000 when k % 4 = 2 then 60000 * (1 + k % 59) + 30000 else 3600000 + k * 977 end as ms from keyed)""")
def duration_label(s, d):
    f = view(s, d, "keyed").selectExpr("k", "case when k % 4 = 0 then k % 1000 when k % 4 = 1 then 1000 + k % 59000 when k % 4 = 2 then 60000 * (1 + k % 59) + 30000 else 3600000 + k * 977 end as ms")
    return f.select("k", text.duration_label(F.col("ms")).alias("label"))


# ---- JSON-LD


ASSEMBLED = f"""concat('Title: Site ', k, {NN}, case when k % 11 = 10 then '' else concat('Class: Röse', {NN}) end, case when k % 4 <> 3 then concat('Beskrivning: text ', k, {NN}, 'Unknown: more', {NN}) else '' end, 'County: Halland | Parish: P', k % 17, {NN}, 'RAÄ-nummer: Lerum ', k, ':1', {NN}, 'Organization: RAÄ', {NN}, 'Build Date: 2025-01-0', k % 9 + 1)"""


@query(f"select k, case when k % 11 in (7, 8) then 'No data available' when k % 11 = 9 then 'Main entity not found' else {ASSEMBLED} end as description from fetched")
def assemble_description(s, d):
    return view(s, d, "fetched").select("k", jsonld.description(F.col("body")).alias("description"))


@query(f"""select k, case when k % 11 < 7 then concat('Site ', k) end as "itemTitle", case when k % 11 < 7 then {ASSEMBLED} end as description, k % 11 = 10 as error from fetched""")
def enrichment_record(s, d):
    return view(s, d, "fetched").select("k", jsonld.enrichment(F.col("body")).alias("e")).select("k", "e.itemTitle", "e.description", F.coalesce("e.error", F.lit(False)).alias("error"))


@query(f"""select k, case when k % 6 = 0 then 2 when k % 6 in (2, 3) then 1 end::bigint as n, case when k % 6 = 0 then 'grav' when k % 6 = 2 then 'ensam' when k % 6 = 3 then '{{"@value":"objekt"}}' end as first,
    case when k % 6 = 0 then '["grav","sten"]' when k % 6 = 2 then '["ensam"]' when k % 6 = 3 then '[{{"@value":"objekt"}}]' end as json from fetched where {GOOD}""")
def keyword_json(s, d):
    f = view(s, d, "fetched").withColumn("main", jsonld.main_entity(jsonld.graph(F.col("body")))).where("main is not null")
    f = f.select("k", jsonld.keywords(F.col("main")).alias("json")).withColumn("list", F.from_json("json", "array<string>"))
    return f.select("k", F.when(F.col("list").isNotNull(), F.size("list")).cast("bigint").alias("n"), F.get("list", F.lit(0)).alias("first"), "json")


@query(f"""select k, unnest(case when k % 6 = 0 then ['grav', 'sten'] when k % 6 = 2 then ['ensam'] when k % 6 = 3 then ['objekt'] end) as keyword from fetched where {GOOD}""")
def keyword_explode(s, d):
    f = view(s, d, "fetched").withColumn("main", jsonld.main_entity(jsonld.graph(F.col("body")))).where("main is not null")
    return f.select("k", F.explode(jsonld.keyword_list(jsonld.keywords(F.col("main")))).alias("keyword"))


# ---- projection


@query(LL + " select id, round(lon, 6) as lon, round(lat, 6) as lat from ll")
def to_wgs84(s, d):
    return _placed(s, d).select("id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("select id, round(x, 3) as x, round(y, 3) as y from points")
def to_metres(s, d):
    back = spatial.to_metres(_placed(s, d).select("id", "lon", "lat"))
    return back.select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


# ---- quality


VIS_SQL = "case when k % 31 = 0 or k % 29 = 0 then 1 when k % 3 = 0 then 2 else 0 end"
DETAIL_SQL = "case when k % 31 = 0 or k % 29 = 0 or k % 5 = 0 then 0 else 2 + case when k % 6 = 0 then 1 else 0 end + case when k % 4 = 1 then 2 else 0 end end"
DISC_SQL = "k % 31 <> 0 and k % 29 <> 0 and k % 5 <> 0 and k % 7 = 0"
COND_SQL = f"case when k % 31 = 0 or k % 29 = 0 or k % 5 = 0 or k % 7 = 0 then 0 when {DETAIL_SQL} >= 4 then 2 else 1 end"


@query(f"select k, {VIS_SQL} as visibility from descriptions")
def visibility_score(s, d):
    return _lines(s, d, ["placement"]).select("k", quality.visibility(F.col("placement")).alias("visibility"))


@query(f"select k, {DISC_SQL} as disclaimer from descriptions")
def disclaimer_flag(s, d):
    return _lines(s, d, ["description_sv"]).select("k", quality.disclaimer_present(F.col("description"), F.col("description_sv")).alias("disclaimer"))


@query(f"select k, {DETAIL_SQL} as detail from descriptions")
def detail_score(s, d):
    return _lines(s, d, ["description_sv"]).select("k", quality.detail_score(F.col("description_sv")).alias("detail"))


@query(f"select k, {COND_SQL} as condition from descriptions")
def condition_score(s, d):
    return _lines(s, d, ["description_sv"]).select("k", quality.condition(F.col("description"), F.col("description_sv")).alias("condition"))


# ---- jobs with stub clients: what a service would answer is made from the request


def stub_fetch(uuid: str) -> str | None:
    if uuid.startswith("f"):
        raise ValueError("refused")
    return None if uuid.startswith("0") else '{"@graph":[{"@id":"http://kulturarvsdata.se/raa/lamning/%s","ksam:itemTitle":"Site %s"}]}' % (uuid, uuid[:4])


def stub_caption(prompt: str) -> str:
    return f"A site described in {len(prompt)} characters.\n\nMore."


PROMPT_LENGTH = len(captions.TEXT_ORDER) + 1 + len("\n\nSite description: ")


def stub_describe(prompt: str) -> str:
    if len(prompt) % 10 == 3:
        raise ValueError("refused: too odd")
    return f"\nA site\ndescribed in {len(prompt)} characters. "


@query(f"""with r as (select k, description as original, given, case when given = '' then 'missing' when odd then 'ERROR: refused: too odd' else concat('A site described in ', n, ' characters.') end as description, {VIS_SQL} as v, {COND_SQL} as c, {PLACING} as p, {DISC_SQL} as dp, {DETAIL_SQL} as ds, odd
      from (select *, length(given) * 2 + {PROMPT_LENGTH} as n, (length(given) * 2 + {PROMPT_LENGTH}) % 10 = 3 and given <> '' as odd from (select k, description, {CAPTION_SQL} as given from descriptions where k % 31 <> 0 and k % 29 <> 0)))
    select k, original as original_description, case when odd then '' else given end as desc_input, description, case when given = '' then 0 when odd then 1 else v end as visibility, case when given = '' then 0 when odd then 1 else c end as condition_known,
      case when given <> '' and not odd then p end as placement, case when given <> '' and not odd then dp end as disclaimer_present, case when given <> '' and not odd then ds end as detail_score, case when given = '' then 'no_usable_description' end as reason, case when odd then 'refused: too odd' end as error from r""")
def score_sites(s, d):
    """The result row of each site with a description: caption by the client, scores and quality signals; missing and failed ones as the rules say."""
    f = _inputs(s, d).where(F.col("description").isNotNull() & (F.col("description") != ""))
    asked = f.withColumn("_r", clients.reply(stub_describe, F.when(F.col("given") != "", captions.text_prompt(F.col("given")))))
    replies = asked.withColumns({"reply": captions.flat_caption(F.col("_r.reply")), "error": F.regexp_replace("_r.error", "^[A-Za-z]+: ", "")}).drop("_r")
    return quality.result_rows(replies)


@query("""select k, case when substr(uuid, 1, 1) not in ('0', 'f') then concat('{"@graph":[{"@id":"http://kulturarvsdata.se/raa/lamning/', uuid, '","ksam:itemTitle":"Site ', substr(uuid, 1, 4), '"}]}') end as body from sites where k % 5 = 0""")
def fetch_in_order(s, d):
    return clients.fetch_batch(view(s, d, "sites").where("k % 5 = 0"), stub_fetch, "k", "uuid", partitions=None, per_second=None).select("k", "body")


@query("select case when uuid like 'f%' then 'error' when uuid like '0%' then 'missing' else 'ok' end as status, count(*) as n from sites group by 1")
def fetch_outcome(s, d):
    got = clients.fetch(view(s, d, "sites"), stub_fetch, "inspireid", "uuid", None, None)
    return got.groupBy("status").agg(F.count("*").alias("n"))


@query("""select inspireid, case when ok then concat('Site ', substr(uuid, 1, 4)) else "itemTitle" end as "itemTitle", case when ok then concat('Title: Site ', substr(uuid, 1, 4)) else description end as description, case when not ok then "itemKeyword" end as "itemKeyword"
    from (select *, substr(uuid, 1, 1) not in ('0', 'f') as ok from sites)""")
def enrich_job(s, d):
    f = view(s, d, "sites")
    got = clients.fetch_once(f, stub_fetch, "inspireid", "uuid", scratch(s, "fetched"), partitions=None, per_second=None).where("status = 'ok'")
    new = got.select("inspireid", jsonld.enrichment(F.col("body")).alias("e")).select("inspireid", "e.description", "e.itemTitle", "e.itemKeyword")
    return tables.keyed_update(f, new, "inspireid", ["description", "itemTitle", "itemKeyword"]).select("inspireid", "itemTitle", "description", "itemKeyword")


@query("""with r as (select substr(uuid, 1, 1) not in ('0', 'f') as ok, uuid from sites)
    select count(*) as total, count(*) filter (ok) as successful, count(*) filter (not ok) as failed, round(100.0::double * count(*) filter (ok) / count(*), 1) as success_rate, count(*) filter (ok) as titles, cast(0 as bigint) as keywords, cast(0 as bigint) as extraction_errors, count(*) filter (uuid like 'f%') as refused from r""")
def enrich_counts(s, d):
    """What the enrichment job counts, over the bodies that it keeps: they are fetched once and read for both parts."""
    got = clients.fetch_once(view(s, d, "sites"), stub_fetch, "inspireid", "uuid", scratch(s, "fetched"), partitions=None, per_second=None)
    e = got.select("status", jsonld.enrichment(F.col("body")).alias("e")).select("status", "e.*")
    one = e.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("successful"), F.count_if(F.col("status") != "ok").alias("failed"), F.count("itemTitle").alias("titles"), F.count("itemKeyword").alias("keywords"), F.count_if(F.col("error")).alias("extraction_errors"), F.count_if(F.col("status") == "error").alias("refused"))
    return one.withColumn("success_rate", F.round(100 * F.try_divide("successful", "total"), 1))


_tried: dict[str, int] = {}  # attempts of requests at hand, in each worker


def stub_flaky(uuid: str) -> str | None:
    """Busy at first for some, always for others; the rest as stub_fetch answers."""
    n = _tried[uuid] = _tried.get(uuid, 0) + 1
    if uuid[0] == "2" or uuid[0] == "1" and n % 3:
        if n == 3:
            del _tried[uuid]
        raise clients.TransientError("busy")
    _tried.pop(uuid, None)
    return stub_fetch(uuid)


@query("""select inspireid, case when uuid like '2%' or uuid like 'f%' then 'error' when uuid like '0%' then 'missing' else 'ok' end as status, case when uuid like '2%' then 'TransientError: busy' when uuid like 'f%' then 'ValueError: refused' end as error from sites""")
def fetch_paced(s, d):
    """Requests under one rate for all tasks, with retries: some answer the third time, some never."""
    got = clients.fetch(view(s, d, "sites"), stub_flaky, "inspireid", "uuid", None, 100_000.0, least=0.0, most=0.0)
    return got.select("inspireid", "status", "error")


@query("""select inspireid, case when ok then concat('Site ', substr(uuid, 1, 4)) else "itemTitle" end as "itemTitle", case when ok then concat('Title: Site ', substr(uuid, 1, 4)) else description end as description, case when not ok then "itemKeyword" end as "itemKeyword"
    from (select *, substr(uuid, 1, 1) not in ('0', 'f') as ok from sites)""")
def enrich_resumed(s, d):
    """The enrichment job over a stored table: a first run that ends early, a second that goes on with its log, and a merge by key."""
    columns = ["itemTitle", "description", "itemKeyword"]
    f, log = view(s, d, "sites"), scratch(s, "answers")
    stored = StoredTable(s, scratch(s, "sites"))
    stored.create(f.select("inspireid", *columns), "inspireid", 16)
    half = f.where(F.substring("uuid", 2, 1) < "8")  # what the first run came to
    clients.fetch_resumed(half, stub_fetch, "inspireid", "uuid", log, 100_000, partitions=None, per_second=None)
    got = clients.fetch_resumed(f, stub_fetch, "inspireid", "uuid", log, 100_000, partitions=None, per_second=None).where("status = 'ok'")
    new = got.select("inspireid", jsonld.enrichment(F.col("body")).alias("e")).select("inspireid", *[f"e.{c}" for c in columns])
    stored.merge(new, columns)
    return stored.read()


@query("""select inspireid, case when k % 11 in (7, 8) then description when k % 11 in (9, 10) then null else concat('new ', k) end as description,
    case when k % 11 in (7, 8) then "itemTitle" when k % 11 in (9, 10) then null else concat('Title ', k) end as "itemTitle" from sites""")
def merge_stored(s, d):
    """The keyed update of a stored table: matching rows are set, to null too; unknown and null keys do nothing."""
    f = view(s, d, "sites")
    stored = StoredTable(s, scratch(s, "sites"))
    stored.create(f.select("inspireid", "description", "itemTitle"), "inspireid", 16)
    new = f.where("k % 11 not in (7, 8)").selectExpr("inspireid", "case when k % 11 < 9 then concat('new ', k) end as description", "case when k % 11 < 9 then concat('Title ', k) end as itemTitle")
    none = f.where("k % 100 = 0").selectExpr("case when k % 200 = 0 then concat('unknown/', k) end as inspireid", "'x' as description", "'x' as itemTitle")
    stored.merge(new.unionByName(none), ["description", "itemTitle"])
    return stored.read()


def _parsed(sql: str, old: str) -> str:
    return f"case when s.k % 31 <> 0 and s.k % 29 <> 0 then {sql} else {old} end".replace("k %", "s.k %").replace("s.s.k", "s.k").replace(", k,", ", s.k,").replace(", k)", ", s.k)")


@query(f"""select s.inspireid, {_parsed(CLASS_SV, "s.class")} as class, {_parsed("'Skog'", "s.vegetation")} as vegetation, s.damage_status, {_parsed("concat('Site ', k)", "cast(null as varchar)")} as title,
    {_parsed("concat('Lerum ', k, ':1')", "cast(null as varchar)")} as raa_number, {_parsed("concat('inga uppgifter ', k)", "cast(null as varchar)")} as rest, cast(null as varchar) as url from sites s""")
def parsed_update(s, d):
    """Columns parsed from descriptions, put into a stored table by key: those that a description has, where there is one. Absent columns are added first."""
    stored = StoredTable(s, scratch(s, "parsed"))
    stored.create(view(s, d, "sites").select("inspireid", "class", "vegetation", "damage_status"), "inspireid", 16)
    columns = ["class", "vegetation", "title", "raa_number", "rest", "url"]
    stored.add_columns({c: "string" for c in columns})
    given = view(s, d, "descriptions").where("description <> ''").select("inspireid", text.block_columns(F.col("description")).alias("b"))
    stored.merge(given.select("inspireid", *[f"b.{c}" for c in columns]), columns, only_present=True)
    return stored.read()


@query("""select inspireid, case when k % 11 = 0 then k * 10000000000 else k % 1000 end as n, case when k % 7 = 0 then k / 2.0::double end as score, cast(null as varchar) as note from sites""")
def evolved_table(s, d):
    """A stored table whose columns came and widened: files of three schemas read as one."""
    f = view(s, d, "sites")
    stored = StoredTable(s, scratch(s, "evolved"))
    stored.create(f.selectExpr("inspireid", "cast(k % 1000 as int) as n"), "inspireid", 16)
    stored.add_columns({"score": "double", "N": "string"})
    stored.merge(f.where("k % 7 = 0").selectExpr("inspireid", "k / 2D as score"), ["score"])
    stored.widen("n", "bigint")
    stored.add_columns({"note": "string"})
    stored.merge(f.where("k % 11 = 0").selectExpr("inspireid", "k * 10000000000 as n"), ["n"])
    return stored.read()


RECORD_LENGTH = len("\n    SOURCE DATA:\n    \n\n    YOUR INSTRUCTIONS:\n    \n    ") + len(captions.RECORD_ORDER) + sum(len(n) + len(": ,\n") for n in captions.RECORD_FIELDS)


@query(f"""with b as (select inspireid from sites where location = 'Visible above ground' and "generatedDescription" is null order by md5(concat('batch', inspireid)), inspireid limit 500)
    select s.inspireid, case when b.inspireid is null then "generatedDescription" when description is null then 'empty description' else concat('A site described in ', {RECORD_LENGTH} + length(class) + length(description) + length(coalesce(vegetation, 'null')) + 4 + length(damage_status) + length(location), ' characters.') end as "generatedDescription"
    from sites s left join b on b.inspireid = s.inspireid""")
def caption_job(s, d):
    batch = tables.hash_sample(_queue(s, d), "inspireid", 500, "batch")
    given = F.coalesce("description", F.lit("")) != ""
    asked = batch.where(given).select("inspireid", captions.record_prompt({n: F.col(n) for n in captions.RECORD_FIELDS}).alias("prompt"))
    replies = clients.generate(asked, stub_caption, "inspireid", "prompt").where("reply is not null")
    new = replies.select("inspireid", captions.clean_caption(F.col("reply")).alias("generatedDescription"))
    none = batch.where(~given).select("inspireid", captions.or_empty(F.col("description"), F.lit(None)).alias("generatedDescription"))
    return tables.keyed_update(view(s, d, "sites"), new.unionByName(none), "inspireid", ["generatedDescription"]).select("inspireid", "generatedDescription")
