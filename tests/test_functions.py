"""Quirks of the site operators, one small table each."""

import json
import os
import random
import socket
import struct
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from cairn.functions import captions, jsonld, quality, spatial, text
from cairn.operators import clients, tables
from cairn.sources import layers


def one(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


# ---- block parser


def test_blocks(spark):
    texts = ["Class: Röse\n\nrest one\n\nClass: Hög\n\n Title :  a: b \n\nUnknown: x\n\nnocolon", "Classx", "", None, "RAÄ-nummer: A\xa0\n\nURL: https://x.y/z"]
    df = one(spark, texts).select(text.block_columns(F.col("c")).alias("b"), text.block_columns(F.col("c"), strict=True).alias("s"))
    rows = df.select("b.*").collect()
    assert rows[0]["class"] == "Hög" and rows[0]["title"] == "a: b" and rows[0]["rest"] == "rest one\n\nUnknown: x\n\nnocolon"
    assert rows[1]["class"] == "Classx" and rows[1]["rest"] == ""  # the key is the entry less its last character
    assert rows[2]["rest"] is None and rows[3]["class"] is None
    assert rows[4]["raa_number"] == "A" and rows[4]["url"] == "https://x.y/z"
    assert all(r["rejected"] in ([], None) for r in rows)
    strict = df.select("s.*").collect()
    assert "raa_number" not in strict[4] and strict[4]["url"] == "https://x.y/z"
    assert [tuple(x) for x in strict[4]["rejected"]] == [("RAÄ-nummer", "raä-nummer")] and strict[0]["rejected"] == []


def test_rest_of_blocks(spark):
    def plain(t):
        out = ""
        for e in t.split("\n\n"):
            out = e if out == "" else out + "\n\n" + e
        return out

    texts = ["x", "\n\nx", "\n\n\n\nx\n\n\n\ny\n\n", "a\n\n\n\n", "\n\n", " \n\nb"]
    assert column(one(spark, texts), text.block_columns(F.col("c"))["rest"]) == [plain(t) for t in texts]


def test_parsers_name_the_text_once(spark):
    """However many columns are taken, blocks are split once, and a body is parsed once."""
    df = one(spark, ["x"])
    b = df.select(text.block_columns(F.col("c")).alias("b")).select("b.class", "b.title", "b.url", "b.rest")
    assert b._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    for c in (jsonld.description(F.col("c")), jsonld.enrichment(F.col("c"))):
        plan = df.select(c.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(") == 1


def test_strict_names():
    low = str.maketrans("åäö ", "aao_")
    kept = [c for k, c in text.BLOCK_COLUMNS.items() if k.translate(low).lower() == c]
    assert list(text.block_names(strict=True).values()) == kept
    assert kept == ["class", "province", "organization", "build_date", "last_changed", "url", "title", "vegetation", "tradition"]


def test_normalise(spark):
    assert column(one(spark, ["RAÄ-nummer", "Terräng", "Antikvarisk bedömning", "Åå"]), text.normalise(F.col("c"))) == ["raä-nummer", "terrang", "antikvarisk_bedomning", "åa"]


# ---- line parser


def test_lines(spark):
    record = "before\nBeskrivning: one\r\nVegetation: Skog\n\nlast\nKlass: Röse\nClass: Hög\nReferens:\nTerräng: bog http://a.b/c \nProvince: X | County: Y | Parish: P: Q"
    df = one(spark, [record, "", None]).withColumn("found", text.sections(F.col("c")))
    rows = df.withColumns(text.line_fields(F.col("found"))).collect()
    assert rows[0]["description_sv"] == "one\nVegetation: Skog\n\nlast" and rows[0]["class"] == "Röse\nHög"
    assert rows[0]["reference"] is None and rows[0]["terrain"] == "bog"
    assert rows[0]["province"] is None and rows[0]["county"] == "Y" and rows[0]["parish"] == "P: Q"
    assert all(r["class"] is None and r["county"] is None for r in rows[1:])
    fixed = df.withColumns(text.line_fields(F.col("found"), ["province", "county"], fix_first=True)).first()
    assert fixed["province"] == "X" and fixed["county"] == "Y"


def test_disclaimers_and_urls(spark):
    got = column(one(spark, ["A. BESKRIVNINGEN ÄR INTE KVALITETSSÄKRAD. Se även  Inventeringsbok", "only\xa0"]), text.strip_disclaimers(F.col("c")))
    assert got == ["A.", "only"]
    assert column(one(spark, ["see HTTPS://a.b/ö?x, end"]), text.strip_urls(F.col("c"))) == ["see  end"]


# ---- captions


def test_clean_caption(spark):
    cases = {"a\n\nb\nc": "a\nc", "\n\nfirst\nsecond": "second", "a\n#h\n#i": "a\n#i", "plain": "plain", "a\n\nb\n\nc": "a\n\nc", "\n# x": "# x"}
    got = column(one(spark, list(cases)), captions.clean_caption(F.col("c")))
    assert got == list(cases.values())


def test_caption_input(spark):
    df = spark.createDataFrame([("Röse", "Cairn", "stor", None, " N "), ("Xyz", None, "Information kan saknas, vara felaktig eller inaktuell.", "t", None), (None, None, "d", "", None)], "a string, b string, c string, d string, e string")
    got = column(df, captions.caption_input(*[F.col(x) for x in "abcde"]))
    assert got == ["Röse (Cairn)\nDescription (sv): stor\nOrientation (sv): N", "", "Description (sv): d"]


def test_labels(spark):
    assert column(one(spark, [0, 999, 1500, 60_000, 90_000, 3_661_000], "bigint"), text.duration_label(F.col("c"))) == ["0ms", "999ms", "1.5s", "1m", "1.5m", "1h 1m"]
    assert column(one(spark, ["abcdef", "abc", None]), text.preview(F.col("c"), 3)) == ["abc...", "abc", None]
    u = "0a1b2c3d-0000-1111-2222-333344445555"
    assert column(one(spark, [f"https://x/{u}", "none", None]), text.first_uuid(F.col("c"))) == [u, None, None]


# ---- quality


def test_quality(spark):
    assert column(one(spark, ["Ej synlig ovan mark", "Synlig ovan mark", "ÖVERTÄCKT", "undermarken", None]), quality.visibility(F.col("c"))) == [0, 2, 0, 1, 1]
    assert column(one(spark, ["1 m 2,5 cm 3 mm 4 meter 5 m 6 m", "Hällristning", "3 mil", None]), quality.detail_score(F.col("c"))) == [5, 2, 0, 0]
    df = spark.createDataFrame([("x", "1 m 2 m 3 m röse"), ("Se även Inventeringsbok", "1 m 2 m 3 m röse"), ("x", " "), ("x", "bara text")], "o string, d string")
    assert column(df, quality.condition(F.col("o"), F.col("d"))) == [2, 0, 0, 1]


# ---- JSON-LD


def doc(*entities):
    return json.dumps({"@graph": list(entities)}, ensure_ascii=False)


def test_jsonld(spark):
    site = jsonld.SITE_PREFIX + "1"
    ref = {"@id": "#d", "ksam:type": {"@value": "T"}, "ksam:desc": {"@value": "old"}}
    full = doc({"@id": "x"}, {"@id": site, "ksam:itemTitle": "A", "ksam:itemDescription": [{"@id": "#d"}, {"@id": "#gone"}], "ksam:itemKeyword": ["é", "b"]}, ref, ref | {"ksam:desc": {"@value": "new"}})
    alone = doc({"@id": site, "ksam:itemDescription": {"@id": "#d"}, "ksam:itemKeyword": "one"}, ref)
    wrong = doc({"@id": site, "ksam:itemTitle": "B", "ksam:serviceOrganization": "bare"})
    odd = doc({"@id": site, "ksam:itemDescription": [{"@id": "#d"}]}, {"@id": "#d", "ksam:type": "bare", "ksam:desc": {"@value": "x"}})
    bodies = [full, alone, wrong, odd, doc({"@id": "x"}), "{}", "no json", None]
    df = one(spark, bodies)
    assert column(df, jsonld.description(F.col("c"))) == ["Title: A\n\nT: new", "No description available", "Title: B", "Unknown: x", "Main entity not found", "No data available", "No data available", "No data available"]
    got = [r[0] for r in df.select(jsonld.enrichment(F.col("c"))).collect()]
    assert json.loads(got[0]["itemKeyword"]) == ["é", "b"] and got[0]["itemTitle"] == "A" and not got[0]["error"]
    assert json.loads(got[1]["itemKeyword"]) == ["one"]
    assert got[2]["error"] and got[2]["itemTitle"] is None and got[3]["error"]
    assert all(g["description"] is None and not g["error"] for g in got[4:])
    mixed = doc({"@id": site, "ksam:itemKeyword": [{"@value": "k"}, "p"]})
    m = jsonld.main_entity(jsonld.graph(F.col("c")))
    assert column(one(spark, [mixed]), jsonld.keyword_list(jsonld.keywords(m))) == [["k", "p"]]


class Wrong(Exception):
    pass


def plain_record(body):
    """(title, description is there, error) by the rules, step by step: whatever isn't an object where one is expected is wrong."""

    def at(entity, name):
        v = entity.get(name, {})
        if not isinstance(v, dict):
            raise Wrong
        return v.get("@value")

    try:
        d = json.loads(body)
    except (TypeError, ValueError):
        return None, False, False
    try:
        g = d.get("@graph", [])
        if g is None or isinstance(g, (int, float)):
            raise Wrong
        main = None
        for e in g if isinstance(g, list) else []:
            if isinstance(e, dict):
                if not isinstance(e.get("@id", ""), str):
                    raise Wrong
                if e.get("@id", "").startswith(jsonld.SITE_PREFIX):
                    main = e
                    break
        if main is None:
            return None, False, False
        if any(not isinstance(e, (dict, list, str)) for e in g):
            raise Wrong
        known = {e["@id"]: e for e in g if isinstance(e, dict) and isinstance(e.get("@id"), str)}
        at(main, "ksam:itemClassName"), at(main, "ksam:serviceOrganization")
        for name, content in jsonld.LISTS:
            for r in main[name] if isinstance(main.get(name), list) else []:
                if isinstance(r, dict) and r.get("@id") in known:
                    at(known[r["@id"]], "ksam:type"), at(known[r["@id"]], content)
        ctx = main.get("ksam:context")
        if isinstance(ctx, dict) and ctx.get("@id") in known:
            for _, f in jsonld.PLACES:
                at(known[ctx["@id"]], f)
        return main.get("ksam:itemTitle"), True, False
    except Wrong:
        return None, False, True


def test_nulls_and_other_types(spark):
    """Null, string, number and list in every object's place, against the rules step by step."""
    site, bodies = jsonld.SITE_PREFIX + "1", []
    good = {"@id": site, "ksam:itemTitle": "T", "ksam:itemDescription": [{"@id": "#d"}, None, 3, "x", {"@id": None}], "ksam:itemNumber": [{"@id": "#n"}], "ksam:context": {"@id": "#c"}}
    target, number, place = {"@id": "#d", "ksam:type": {"@value": "B"}, "ksam:desc": {"@value": "x"}}, {"@id": "#n", "ksam:number": {"@value": 5}}, {"@id": "#c", "ksam:parishName": {"@value": "P"}}
    odd = [None, "bare", '{"@value":"text"}', "{", 7, True, [], ["x"], {}, {"@value": None}, {"@value": "v"}]
    for v in odd:
        for name in ("ksam:itemClassName", "ksam:serviceOrganization", "ksam:itemTitle", "ksam:itemKeyword", "ksam:context", "ksam:itemSpecification"):
            bodies.append(doc(good | {name: v}, target, number, place))
        bodies += [doc(good, target | {"ksam:type": v}, number, place), doc(good, target | {"ksam:desc": v}, number, place), doc(good, target, number | {"ksam:number": v}, place), doc(good, target, number, place | {"ksam:countyName": v})]
        bodies += [doc({"@id": v}, good, target), doc(good, {"@id": "#z", "ksam:type": v}), json.dumps({"@graph": v}), json.dumps(v), doc(v, good), doc(good, v), doc(v)]
    bodies += [doc(good), json.dumps({"@graph": []}), "[", "", None]
    got = [r[0] for r in one(spark, bodies).select(jsonld.enrichment(F.col("c"))).collect()]
    for body, r in zip(bodies, got):
        if body is not None and not isinstance(json.loads(body or "0") if body != "[" else 0, dict):
            want = (None, False, False)  # no document at all
        else:
            want = plain_record(body)
        title = want[0] if want[0] is None or isinstance(want[0], str) else r["itemTitle"]  # other types are told as text
        assert (r["itemTitle"], r["description"] is not None, r["error"]) == (title, *want[1:]), body


def test_types_of_contents(spark):
    site = jsonld.SITE_PREFIX + "1"
    bodies = [doc({"@id": site, "ksam:itemDescription": [{"@id": "#d"}]}, {"@id": "#d", "ksam:desc": {"@value": "x"}} | t) for t in ({}, {"ksam:type": {}}, {"ksam:type": {"@value": None}}, {"ksam:type": {"@value": "B"}})]
    assert column(one(spark, bodies), jsonld.description(F.col("c"))) == ["Unknown: x", "Unknown: x", "None: x", "B: x"]


def test_look_ups_in_large_graphs(spark):
    """Ten thousand entities, all of them named, some twice: the last wins, and time follows the size."""
    import time

    def large(n):
        entities = [{"@id": f"#{k}", "ksam:desc": {"@value": f"{v}{k}"}} for v in ("old", "new") for k in range(n) if v == "old" or k % 3 == 0]
        return doc({"@id": jsonld.SITE_PREFIX + "1", "ksam:itemDescription": [{"@id": f"#{k}"} for k in range(n)]}, *entities)

    took = {}
    for n in (1000, 10_000):
        df = one(spark, [large(n)]).cache()
        df.count()
        began = time.perf_counter()
        got = column(df, jsonld.description(F.col("c")))[0]
        took[n] = time.perf_counter() - began
        assert got == "\n\n".join(f"Unknown: {'new' if k % 3 == 0 else 'old'}{k}" for k in range(n))
    assert took[10_000] < 40 * max(took[1000], 0.05)


def test_reference_forms_agree(spark):
    """In-row references against an equi-join."""
    bodies = [(i, doc({"@id": jsonld.SITE_PREFIX + str(i), "ksam:itemDescription": [{"@id": f"#{k}"} for k in range(i)]}, *[{"@id": f"#{k}", "ksam:desc": {"@value": f"v{k}"}} for k in range(0, 6, 2)])) for i in range(5)]
    df = spark.createDataFrame(bodies, "i int, c string").withColumn("g", jsonld.graph(F.col("c"))).withColumn("m", jsonld.main_entity(F.col("g")))
    a = df.select("i", F.explode(jsonld.labelled(F.col("g"), F.col("m"), "ksam:itemDescription", "ksam:desc")).alias("x")).select("i", "x.text")
    refs = df.select("i", F.explode(jsonld.refs(F.col("m"), "ksam:itemDescription")).alias("ref"))
    ents = df.select("i", F.explode("g").alias("e")).select("i", jsonld.plain(F.col("e"), "@id").alias("ref"), jsonld.value(F.col("e"), "ksam:desc").alias("text"))
    b = refs.join(ents, ["i", "ref"]).select("i", "text")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 0


# ---- spatial


def test_projection(spark):
    df = spark.createDataFrame([(12.154978, 57.482183), (18.0, 59.3), (15.0, 60.0), (11.0, 68.5)], "lon double, lat double")
    there = spatial.to_metres(df)
    first = there.first()
    assert abs(first["x"] - 329441.920) < 0.001 and abs(first["y"] - 6374634.178) < 0.001
    back = spatial.to_wgs84(there.withColumnsRenamed({"lon": "lon0", "lat": "lat0"}))
    assert all(abs(r["lon"] - r["lon0"]) < 1e-9 and abs(r["lat"] - r["lat0"]) < 1e-9 for r in back.collect())


def test_area_and_boxes(spark):
    ring = lambda x, y, w, h: [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]
    rows = [("Polygon", [ring(5e5, 6e6, 100.0, 50.0), ring(5e5 + 1, 6e6 + 1, 10.0, 10.0)]), ("Point", []), ("LineString", [[(0.0, 0.0), (1.0, 1.0)]])]
    df = spark.createDataFrame(rows, "geom_type string, rings array<array<struct<x:double,y:double>>>")
    assert abs(df.agg(tables.area_km2()).first()[0] - 4900 / 1e6) < 1e-12
    assert df.where("geom_type <> 'Polygon'").agg(tables.area_km2()).first()[0] is None
    edge = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (2.1, 1.0)], "x double, y double")
    assert column(edge, spatial.in_box(F.col("x"), F.col("y"), 1, 1, 2, 2)) == [True, True, False]


def test_wkb(spark):
    df = spark.createDataFrame([(struct.pack("<BIdd", 1, 1, 1.5, 2.5),), (struct.pack(">BIdd", 0, 1, 3.0, 4.0),), (struct.pack("<BIIdd", 1, 0x20000001, 3006, 5.0, 6.0),), (struct.pack("<BIdd", 1, 2, 1.0, 1.0),), (None,), (b"x",)], "wkb binary")
    assert [tuple(r) for r in spatial.wkb_point(df).select("x", "y").collect()] == [(1.5, 2.5), (3.0, 4.0), (5.0, 6.0), (None, None), (None, None), (None, None)]


def test_leaves_are_even(spark):
    """Nine tenths of the points in one city: no task of a join by leaves has over three times the median's rows."""
    city = spark.range(90_000).select((F.randn(1) * 0.01 + 18.0).alias("lon"), (F.randn(2) * 0.01 + 59.3).alias("lat"))
    land = spark.range(10_000).select((F.rand(3) * 12 + 11).alias("lon"), (F.rand(4) * 13 + 55).alias("lat"))
    tree = tables.leaves(city.unionByName(land), "lon", "lat", sample=20_000)
    xy = city.unionByName(land).toPandas()
    leaf = tree.of_points(xy["lon"].to_numpy(), xy["lat"].to_numpy())
    tasks = spark.createDataFrame([(int(x),) for x in leaf], "leaf int").groupBy(F.pmod(F.hash("leaf"), F.lit(64))).count().toPandas()["count"]
    assert len(tree.starts) < 8192 and len(tasks) == 64 and tasks.max() <= 3 * tasks.median()
    boxes = [(x, y, x + w, y + w) for x, y, w in [(17.99, 59.29, 0.001), (11.0, 55.0, 0.001), (10.0, 50.0, 30.0)]]
    assert [len(tree.of_box(*b)) for b in boxes][2] == len(tree.starts) and len(tree.of_box(*boxes[1])) <= 4


def test_region_join_by_leaves(spark):
    """Many boxes, small, large, empty, alike and beyond the points, against all pairs."""
    rnd = random.Random(5)
    spots = [(i, *((rnd.gauss(18, 0.01), rnd.gauss(59.3, 0.01)) if i % 3 else (rnd.uniform(11, 23), rnd.uniform(55, 68)))) for i in range(900)]
    spots += [(900 + i, 18.0, 59.25) for i in range(300)] + [(2000, None, 59.0), (2001, float("nan"), 59.0), (2002, 18.0, None)]
    boxes = []
    for k in range(300):
        i, x, y = spots[rnd.randrange(900)]
        w, h = rnd.choice([0, 0.001, 0.05, 3.0]), rnd.choice([0, 0.002, 0.05, 9.0])
        boxes.append((f"r{k}", x, y, x + w, y + h))
    boxes += [boxes[0], ("far", 100.0, 0.0, 120.0, 10.0), ("all", -180.0, -90.0, 180.0, 90.0), ("turned", 19.0, 60.0, 17.0, 50.0), ("none", None, 50.0, 60.0, 70.0)]
    points = spark.createDataFrame(spots, "id int, lon double, lat double")
    regions = spark.createDataFrame(boxes, "region string, minx double, miny double, maxx double, maxy double")
    got = sorted(map(tuple, tables.region_join(points, regions).select("region", "id").collect()))
    want = sorted((r, i) for r, a, b, c, d in boxes if a is not None for i, x, y in spots if None not in (x, y) and x == x and a <= x <= c and b <= y <= d)
    assert got == want and len(got) > 5000


def test_projection_by_arrays(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x in range(200_000, 900_000, 90_001) for y in range(6_100_000, 7_700_000, 200_003)] + [(None, 1.0)], "x double, y double")
    got = spatial.to_wgs84(df).withColumn("d", spatial.degrees(F.col("x"), F.col("y"))).collect()
    assert all(abs(r["lon"] - r["d"]["lon"]) < 1e-12 and abs(r["lat"] - r["d"]["lat"]) < 1e-12 for r in got if r["x"] is not None)
    x, y = spatial.metres(*(np.array([r[c] for r in got[:-1]]) for c in ("lon", "lat")))
    assert max(abs(x - [r["x"] for r in got[:-1]])) < 1e-3 and max(abs(y - [r["y"] for r in got[:-1]])) < 1e-3


def test_metre_boxes_hold_their_regions(spark):
    """Boxes across the middle meridian, wide and high ones: points on and within the edges are within the metres."""
    boxes = [(-5.0, 40.0, 33.0, 71.0), (11.5, 57.5, 12.5, 58.5), (14.0, 60.0, 16.0, 61.0), (15.0, 55.0, 15.0, 56.0), (8.0, 0.0, 22.0, 5.0), (17.0, 59.7, 18.0, 60.2)]
    regions = spark.createDataFrame([(str(k), *b) for k, b in enumerate(boxes * 2)], "region string, minx double, miny double, maxx double, maxy double")
    held = tables.metre_boxes(regions)
    assert held.count() == 12
    t = spark.range(0, 61).select((F.col("id") / 60).alias("t"))
    spots = regions.crossJoin(t).crossJoin(t.withColumnRenamed("t", "u")).withColumns({"lon": F.expr("minx + (maxx - minx) * t"), "lat": F.expr("miny + (maxy - miny) * u")})
    spots = spatial.to_metres(spots.select("region", "lon", "lat")).join(held.select("region", "_x0", "_y0", "_x1", "_y1"), "region")
    assert spots.where("not (x between _x0 and _x1 and y between _y0 and _y1)").count() == 0


def test_region_join_by_cells(spark, monkeypatch):
    pts = spark.createDataFrame([(i, 10 + i % 13 * 0.37, 55 + i % 7 * 0.61, "n" if i % 3 else None) for i in range(200)], "id int, lon double, lat double, sitename string")
    regs = spark.createDataFrame([("a", 10.0, 55.0, 11.5, 57.0), ("b", 11.0, 56.0, 14.0, 58.0), ("none", 1.0, 1.0, 2.0, 2.0)], "region string, minx double, miny double, maxx double, maxy double")
    few = sorted(map(tuple, tables.region_join(pts, regs).select("region", "id").collect()))
    counts = {r["region"]: (r["total"], r["named"]) for r in tables.region_counts(pts, regs).collect()}
    assert counts["none"] == (0, 0) and sum(t for t, _ in counts.values()) == len(few)
    monkeypatch.setattr(tables, "REGION_LIMIT", 1)
    assert few == sorted(map(tuple, tables.region_join(pts, regs).select("region", "id").collect()))


# ---- tables


def test_keyed_update(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), (None, "3", "z")], "k string, v string, w string")
    new = spark.createDataFrame([("a", None), ("zz", "9"), (None, "7")], "k string, v string")
    assert sorted(map(tuple, tables.keyed_update(df, new, "k", ["v"]).collect()), key=str) == sorted([("a", None, "x"), ("b", "2", "y"), (None, "3", "z")], key=str)
    twice = spark.createDataFrame([("a", "8"), ("a", "9")], "k string, v string")
    assert tables.keyed_update(df, twice, "k", ["v"]).count() == 3


def test_dedup_and_limit(spark):
    df = spark.createDataFrame([(2, "u"), (1, "u"), (3, None), (4, None)], "id int, uuid string")
    assert sorted(r["id"] for r in tables.dedup(df, "uuid", ["id"]).collect()) == [1, 3, 4]
    assert tables.take(df, ["id"], 0).count() == 4 and tables.take(df, ["id"], None).count() == 4 and tables.take(df, ["id"], 2).count() == 2
    assert len(tables.random_sample(df, 2, 1).collect()) == 2


#: Counts of a published profile of 1,491 records.
PROFILE = {
    "damage_status": (1491, {"Unknown": (1350, 90.54), "Not damaged": (121, 8.12), "Impact/Damage": (17, 1.14)}),
    "location": (1491, {"Visible above ground": (1466, 98.32), "Not visible above ground": (21, 1.41), "In building or under water": (4, 0.27)}),
}


def test_profile(spark):
    n, values = PROFILE["location"]
    rows = [(v,) for v, (c, _) in values.items() for _ in range(c)]
    got = tables.column_profile(one(spark, [r[0] for r in rows]).withColumnRenamed("c", "location"), ["location"]).orderBy(F.desc("count"), F.desc("value")).collect()
    assert [(r["value"], r["count"], r["percentage"]) for r in got] == [(v, c, p) for v, (c, p) in values.items()]
    assert all(r["totalRecords"] == r["nonNullRecords"] == n and r["uniqueValues"] == 3 for r in got)
    c, p = PROFILE["damage_status"][1]["Not damaged"]
    few = one(spark, ["Not damaged"] * c + [None] * (n - c)).withColumnRenamed("c", "damage_status")
    r = tables.column_profile(few, ["damage_status"]).collect()
    assert len(r) == 1 and r[0]["percentage"] == p and r[0]["nonNullRecords"] == c
    both = few.crossJoin(spark.createDataFrame([("Cairn",)], "class string"))
    document = tables.profile_document(both, ["class", "damage_status"], "t", "2025-08-25T11:30:27.147Z").first()["document"]
    column = lambda name, filled, *values: {"column": name, "totalRecords": n, "nonNullRecords": filled, "uniqueValues": 1, "values": list(values)}
    want = {"timestamp": "2025-08-25T11:30:27.147Z", "database": "t", "totalRecords": n, "columns": [column("class", n, {"value": "Cairn", "count": n, "percentage": 100.0}), column("damage_status", c, {"value": "Not damaged", "count": c, "percentage": p})]}
    assert json.loads(document) == want and document == json.dumps(want, separators=(",", ":"))  # in the same order too
    many = one(spark, [f"v{k:03d}" for k in range(50)]).withColumnRenamed("c", "v")
    cut = json.loads(tables.profile_document(many, ["v"], "t", "now", values=7).first()["document"])["columns"][0]
    assert cut["uniqueValues"] == 50 and [x["value"] for x in cut["values"]] == [f"v{k:03d}" for k in range(7)]


def test_empty_statistics(spark):
    none = spark.createDataFrame([], "a double, b string, geom_type string, rings array<array<struct<x:double,y:double>>>")
    assert tuple(tables.numeric_stats(none, ["a"]).first()) == ("a", None, None, None)
    assert none.agg(tables.area_km2()).first()[0] is None
    assert {r["column"]: (r["constant"], r["null_share"]) for r in tables.redundant_columns(none, ["a", "b"]).collect()} == {"a": (True, None), "b": (True, None)}
    assert [(r["name"], r["kind"], r["total"], r["max"]) for r in tables.statistics(none, ["b"], ["a"], "t").orderBy("name").collect()] == [("a", "numerical", None, None), ("t", "table", 0, None)]
    mixed = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (1, None, None)], "c int, v string, n string")
    assert tables.drop_redundant(mixed, ["c", "v", "n"], 0.6).columns == ["v"]


# ---- sources


def test_layers(spark, tmp_path):
    path = f"file://{tmp_path}/features"
    a = spark.createDataFrame([(1, "Point"), (2, "Point")], "id bigint, geom_type string")
    layers.save_layer(a, path, "one")
    layers.save_layer(a.limit(1), path, "two")
    layers.save_layer(a.where("id = 2"), path, "one")
    assert [r["id"] for r in layers.load_layer(spark, path, "one", None).collect()] == [2]
    assert layers.load_layer(spark, path, None, None).select("layer").distinct().collect()[0][0] == "one"
    with pytest.raises(FileNotFoundError):
        layers.load_layer(spark, f"{path}-none")
    assert sorted(r["layer"] for r in layers.layers(spark.read.parquet(path)).collect()) == ["one", "two"]
    layers.derive_table(a, F.col("id") > 1, f"{path}-sub")
    with pytest.raises(Exception):
        layers.derive_table(a, F.col("id") > 1, f"{path}-sub")
    layers.save_results(spark.createDataFrame([(1, "é", None)], "i int, t string, n string"), f"{path}-json")
    assert [r["value"] for r in spark.read.text(f"{path}-json").collect()] == ['{"i":1,"t":"é","n":null}']
    assert layers.ensure_columns(a, {"description": "string", "ID": "int"}).columns == ["id", "geom_type", "description"]


# ---- layout and sketches


def test_box_reads_few_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    df = spark.range(60_000).select("id", (F.rand(1) * 1000).alias("x"), (F.rand(2) * 1000).alias("y"), F.sha2(F.col("id").cast("string"), 512).alias("name"))
    df = df.unionByName(spark.createDataFrame([(-1, None, 5.0, "a"), (-2, float("nan"), 5.0, "b")], "id bigint, x double, y double, name string"))
    box, read = (200.0, 300.0, 260.0, 350.0), {}
    for name, save in (("plain", lambda p: layers.save_layer(df.repartition(16), p, "l")), ("clustered", lambda p: layers.save_clustered(df, p, "l", 16, row_group_bytes=1 << 18))):
        path = f"{tmp_path}/{name}"
        save(path)
        got = layers.load_layer(spark, path, "l", None).where(spatial.in_box(F.col("x"), F.col("y"), *box))
        assert "GreaterThanOrEqual(x,200.0)" in got._jdf.queryExecution().toString()
        read[name] = sorted(r["id"] for r in got.collect())
        stats = []
        for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                cols = {meta.schema.column(c).name: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
                stats.append(not cols["x"].has_min_max or not (cols["x"].max < box[0] or cols["x"].min > box[2] or cols["y"].max < box[1] or cols["y"].min > box[3]))
        if name == "clustered":
            assert len(stats) >= 16 and sum(stats) <= len(stats) / 4, (sum(stats), len(stats))
        else:
            assert all(stats)
    assert read["plain"] == read["clustered"] and len(read["plain"]) > 100


def test_z_order(spark):
    rows = [(x, y) for x in range(4) for y in range(4)]
    df = spark.createDataFrame(rows + [(None, 1), (9, 9)], "x int, y int").select("x", "y", layers.z_order(F.col("x"), F.col("y"), (0, 0), (3, 3)).alias("z")).collect()
    at = {(r["x"], r["y"]): r["z"] for r in df}
    assert [p for p in sorted(rows, key=at.get)][:8] == [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (3, 0), (2, 1), (3, 1)]
    assert at[None, 1] is None and at[9, 9] == at[3, 3]


def test_sketches_keep_their_bounds(spark):
    from cairn.plans.fixtures import view

    f = view(spark, "/root/testdata/sf0.01", "features")
    columns = [c for c in f.columns]
    out = tables.sketch_profile(f, columns, top=5, tracked=1000)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    exact = {c: dict(f.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string")).count().collect()) for c in columns}
    total = f.count()
    for r in out.collect():
        want = exact[r["column"]]
        assert r["totalRecords"] == total and r["nonNullRecords"] == sum(want.values())
        assert abs(r["uniqueValues"] - len(want)) <= r["unique_error"]
        assert all(0 <= v["count"] - want[v["value"]] <= r["count_error"] for v in r["values"])
        if len(want) <= 1000:
            assert r["count_error"] == 0 and len(r["values"]) == min(5, len(want)) and [v["count"] for v in r["values"]] == sorted(want.values(), reverse=True)[:5]
    empty = tables.sketch_profile(f.limit(0), columns[:2]).collect()
    assert [(r["totalRecords"], r["uniqueValues"], r["values"]) for r in empty] == [(0, 0, [])] * 2


# ---- clients


def test_fetch_once(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}") for i in range(20)], "id int, uuid string")
    seen = spark.sparkContext.accumulator(0)

    def client(u):
        seen.add(1)
        return u.upper()

    got = clients.fetch_once(df, client, "id", "uuid", f"{tmp_path}/bodies", partitions=None, per_second=None)
    assert got.count() == 20 and {r["body"] for r in got.collect()} == {f"U{i}" for i in range(20)} and seen.value == 20


def test_a_rate_for_all_tasks(spark, tmp_path):
    """Requests stay under the rate and use nine tenths of it, with most in one partition, with one task, and with retries counted."""
    rate = 200.0
    for name, parts in (("skewed", [270, 10, 10, 10]), ("alone", [300])):
        rows = [(p, p * 1000 + i) for p, n in enumerate(parts) for i in range(n)]
        df = spark.createDataFrame(rows, "p int, id int").repartitionByRange(len(parts), "p")
        log = tmp_path / name
        log.mkdir()

        def client(u, log=log):
            with open(log / str(os.getpid()), "a") as f:
                f.write(f"{time.time()} {u}\n")
            if int(u) % 50 == 7 and open(log / str(os.getpid())).read().count(f" {u}\n") < 2:
                raise clients.TransientError("busy")
            return u

        got = clients.fetch(df, client, "id", "id", None, rate, least=0.0, most=0.0).collect()
        assert len(got) == len(rows) and {r["status"] for r in got} == {"ok"}
        at = sorted(float(line.split()[0]) for f in log.iterdir() for line in f.read_text().splitlines())
        retried = sum(1 for _, i in rows if i % 50 == 7)
        assert len(at) == len(rows) + retried
        used = (len(at) - 1) / (at[-1] - at[0])
        assert 0.9 * rate <= used <= 1.02 * rate, (name, used)
        for k in range(len(at) - 60):
            assert 60 <= rate * (at[k + 60] - at[k]) + 8  # in any stretch: slots may be used a little late, then close together


def test_slots():
    from cairn.operators.pace import Pace, _Slots

    slots = _Slots(10.0)
    assert [round(slots.take(n, now), 6) for n, now in ((1, 100.0), (1, 100.0), (3, 100.0), (1, 100.05), (1, 200.0))] == [0.0, 0.1, 0.2, 0.45, 0.0]
    with pytest.raises(ValueError):
        Pace("127.0.0.1", 0)
    pace = Pace("127.0.0.1", 1000.0)
    stranger = socket.create_connection(pace.address, timeout=5)
    stranger.sendall(bytes(16) + b"\1\0\0\0")
    assert stranger.recv(8) == b""  # the secret is asked for
    lease = pace.leases()
    began = time.monotonic()
    for _ in range(100):
        lease()
    assert 0.08 <= time.monotonic() - began < 0.5
    pace.close()


def test_replies_stay_with_their_rows(spark):
    def client(p):
        if p == "bad":
            raise ValueError(p)
        return None if p == "none" else p.upper()

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "none"), (4, None), (1, "a")], "k int, p string")
    got = df.withColumn("r", clients.reply(client, F.col("p"))).select("k", "r.reply", "r.error").collect()
    assert [tuple(r) for r in got] == [(1, "A", None), (2, None, "ValueError: bad"), (3, None, "no response"), (4, None, None), (1, "A", None)]


def test_fetch_resumed(spark, tmp_path):
    """A run that is killed half-way goes on: what the log has is asked once, failures once more by each run."""
    n, log, calls = 120, f"file://{tmp_path}/log", tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([(i, f"u{i}") for i in range(n)] + [(None, "x")], "id int, uuid string")

    def tell(u):
        with open(calls / str(os.getpid()), "a") as f:
            f.write(u + "\n")

    asked = lambda: Counter(line for f in calls.iterdir() for line in f.read_text().splitlines())

    def killed(u):
        if sum(asked().values()) >= 50:
            raise KeyboardInterrupt("killed")
        tell(u)
        return u.upper()

    def good(u):
        tell(u)
        if u == "u3":
            raise ValueError("refused")
        return None if u == "u4" else u.upper()

    how = {"batch": 10, "partitions": 1, "per_second": None}
    with pytest.raises(Exception):
        clients.fetch_resumed(df, killed, "id", "uuid", log, **how)
    kept = spark.read.parquet(log).count()
    assert 20 <= kept <= 50
    before = asked()
    got = {r["id"]: (r["status"], r["body"]) for r in clients.fetch_resumed(df, good, "id", "uuid", log, **how).collect()}
    assert set(got) == {str(i) for i in range(n)}
    twice = [u for u, c in asked().items() if c > 1]
    assert len(twice) == sum(before.values()) - kept <= 20  # what was in flight
    total = sum(asked().values())
    again = {r["id"]: (r["status"], r["body"]) for r in clients.fetch_resumed(df, good, "id", "uuid", log, **how).collect()}
    refused = got["3"][0] == "error"
    assert again == got and sum(asked().values()) == total + refused  # nothing but what failed
    fixed = {r["id"]: r["status"] for r in clients.fetch_resumed(df, lambda u: u, "id", "uuid", log, **how).collect()}
    assert fixed["3"] == "ok"
    assert clients.fetch_resumed(df, killed, "id", "uuid", log, **how).count() == n  # all is answered: nobody is asked
    none = spark.createDataFrame([], "id int, uuid string")
    assert clients.fetch_resumed(none, killed, "id", "uuid", f"file://{tmp_path}/none", **how).count() == 0


@pytest.mark.parametrize("partitions", [1, None])
def test_fetch_resumed_reads_once(spark, tmp_path, monkeypatch, partitions):
    """However many batches there are, requests and log are read a few times; each request is asked once."""
    n, log = 60, f"file://{tmp_path}/log"
    seen, called, read = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), []

    @F.udf("int")
    def noted(i):
        seen.add(1)
        return i

    def client(u):
        called.add(1)
        return u.upper()

    parquet = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **how: (read.append(paths), parquet(self, *paths, **how))[1])
    df = spark.createDataFrame([(i, f"u{i}") for i in range(n)], "id int, uuid string").withColumn("id", noted.asNondeterministic()("id"))
    how = {"batch": 5, "partitions": partitions, "per_second": None}
    clients.fetch_resumed(df.where("uuid < 'u3'"), client, "id", "uuid", log, **how)
    half = called.value
    assert 0 < half < n
    got = clients.fetch_resumed(df, client, "id", "uuid", log, **how)
    assert seen.value <= 6 * n and read.count((log,)) <= 4
    assert {r["id"]: (r["status"], r["body"]) for r in got.collect()} == {str(i): ("ok", f"U{i}") for i in range(n)}
    assert called.value == n


def test_fetch_resumed_in_one_job(spark, tmp_path):
    """Without a number of partitions too, a run that is killed half-way loses only what was in flight."""
    n, log, calls = 200, f"file://{tmp_path}/log", tmp_path / "calls"
    calls.mkdir()
    df = spark.range(n).selectExpr("cast(id as string) as id", "concat('u', id) as uuid")

    def tell(u):
        with open(calls / str(os.getpid()), "a") as f:
            f.write(u + "\n")
        return u.upper()

    asked = lambda: Counter(line for f in calls.iterdir() for line in f.read_text().splitlines())

    def killed(u):
        if sum(asked().values()) >= 120:
            raise KeyboardInterrupt("killed")
        return tell(u)

    how = {"batch": 20, "partitions": None, "per_second": None}
    with pytest.raises(Exception):
        clients.fetch_resumed(df, killed, "id", "uuid", log, **how)
    before, kept = sum(asked().values()), spark.read.parquet(log).count()
    assert before - kept <= 60  # four tasks of about five requests, by a hash
    assert clients.fetch_resumed(df, tell, "id", "uuid", log, **how).where("status = 'ok'").count() == n
    assert sum(asked().values()) == n + before - kept
    few = df.where("id < '103'")
    assert clients.fetch_resumed(few, str.upper, "id", "uuid", f"file://{tmp_path}/few", batch=1, per_second=None).count() == few.count()  # some batches are empty


def test_results_of_a_failing_client(spark):
    rows = [(1, "A", "in", "Synlig ovan mark", "5 m", "A cairn.", None), (2, "B", "in", None, None, None, "refused"), (3, "C", "", None, None, None, None)]
    df = spark.createDataFrame(rows, "k int, description string, given string, placement string, description_sv string, reply string, error string")
    got = {r["k"]: r for r in quality.result_rows(df).collect()}
    assert (got[1]["description"], got[1]["visibility"], got[1]["condition_known"], got[1]["detail_score"], got[1]["reason"]) == ("A cairn.", 2, 1, 1, None)
    assert (got[2]["description"], got[2]["visibility"], got[2]["condition_known"], got[2]["desc_input"], got[2]["error"], got[2]["placement"]) == ("ERROR: refused", 1, 1, "", "refused", None)
    assert (got[3]["description"], got[3]["visibility"], got[3]["condition_known"], got[3]["reason"]) == ("missing", 0, 0, "no_usable_description")


def test_fetch_retries():
    calls, waits = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise clients.TransientError("busy")
        return "ok"

    assert clients.call_with_retry(flaky, "a", pause=waits.append) == ("ok", None) and waits == [4.0, 4.0]
    assert clients.call_with_retry(lambda x: 1 / 0, "a")[1].startswith("ZeroDivisionError")

    def never(x):
        raise ConnectionError("down")

    assert clients.call_with_retry(never, "a", pause=waits.append)[1] == "ConnectionError: down"


def test_fetch(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "bad"), ("3", "none"), ("4", None)], "id string, uuid string")

    def client(u):
        if u == "bad":
            raise ValueError(u)
        return None if u == "none" else f"<{u}>"

    got = {r["id"]: (r["status"], r["body"]) for r in clients.fetch(df, client, "id", "uuid", 2, None).collect()}
    assert got == {"1": ("ok", "<a>"), "2": ("error", None), "3": ("missing", None), "4": ("error", None)}
    paced = clients.fetch(df.limit(3), lambda u: u, "id", "uuid", 1, 20.0)
    assert paced.count() == 3
    batch = spark.createDataFrame([(2, "b"), (1, "a"), (10, "bad")], "ord int, uuid string")
    assert [tuple(r) for r in clients.fetch_batch(batch, client, "ord", "uuid", per_second=None).select("ord", "body").collect()] == [(1, "<a>"), (2, "<b>"), (10, None)]
    replies = {r["id"]: (r["reply"], r["error"]) for r in clients.generate(df, client, "id", "uuid", 2).collect()}
    assert replies["1"] == ("<a>", None) and replies["3"] == (None, "no response")
