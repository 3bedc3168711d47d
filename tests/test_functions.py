"""Geometry, coordinate systems, names and values."""

import math

import pytest
from pyspark.sql import functions as F

from voltweave.functions import crs, values
from voltweave.functions import geometry as G


def on(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1:] if len(columns) > 1 else r[1] for r in sorted(df.select("i", *columns).collect())]


def test_parse_edge_cases(spark):
    texts = [None, "", "bad", "null", '{"type":"Blob","coordinates":[1,2]}', '{"type":"LineString","coordinates":[[1,2]]}', '{"type":"Point","coordinates":[]}', '{"type":"point","coordinates":[1,2,3]}', '{"type":"Point","coordinates":[1]}',
             '{"type":"Polygon","coordinates":[[[0,0],[1,1]]]}', '{"type":"GeometryCollection","geometries":[]}', '{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}', '{"type":"LineString","coordinates":[]}', '{"type":"LineString","coordinates":[[1,2],[3]]}']
    got = on(spark, texts, G.parse(F.col("t")))
    assert [g and g.type for g in got] == [None] * 6 + ["Point", "Point", None, None, "GeometryCollection", "MultiPoint", "LineString", None]
    assert got[6].parts == [] and got[7].parts == [[[(1.0, 2.0)]]] and got[10].parts is None and got[11].parts == [[[(1.0, 2.0)]], [[(3.0, 4.0)]]]


WKT = {
    '{"type":"Point","coordinates":[2,48]}': "POINT(2 48)",
    '{"type":"point","coordinates":[2.50,48.0,7]}': "POINT(2.5 48.0)",
    '{"type":"Point","coordinates":[0.0005,-0.00001]}': "POINT(0.0005 -1e-05)",
    '{"type":"Point","coordinates":[12345678.25,1]}': "POINT(12345678.25 1)",
    '{"type":"LineString","coordinates":[[0,0],[1,1],[5]]}': "LINESTRING(0 0, 1 1)",
    '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]],[]]}': "POLYGON((0 0, 1 0, 1 1, 0 0))",
    '{"type":"MultiPoint","coordinates":[[0,0],[1,1]]}': "MULTIPOINT((0 0), (1 1))",
    '{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[2,2],[3,3]]]}': "MULTILINESTRING((0 0, 1 1), (2 2, 3 3))",
    '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]}': "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)))",
    '{"type":"LineString","coordinates":[]}': None,
    '{"type":"GeometryCollection","geometries":[]}': None,
    "bad": None,
}


def test_wkt(spark):
    assert dict(zip(WKT, on(spark, list(WKT), G.wkt(F.col("t"))), strict=True)) == WKT


def test_geojson_round_trip(spark):
    texts = [t for t, w in WKT.items() if w and "[5]" not in t and "[]" not in t]
    g = G.parse(F.col("t"))
    for a, b in on(spark, texts, g.alias("a"), G.parse(G.to_geojson(g)).alias("b")):
        assert a == b and a is not None


def test_centroids(spark):
    texts = {
        '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[0,0],[2,0],[2,4],[0,4],[0,0]]]}': (3, 2),
        '{"type":"Polygon","coordinates":[[[0,0],[0,4],[4,4],[4,0]]]}': (2, 2),
        '{"type":"MultiLineString","coordinates":[[[0,0],[2,0]],[[10,0],[10,6]]]}': (7.75, 2.25),
        '{"type":"MultiPoint","coordinates":[[0,0],[2,4]]}': (1, 2),
        '{"type":"Polygon","coordinates":[[[0,0],[2,0],[4,0]]]}': (2, 0),
        '{"type":"Point","coordinates":[5,6]}': (5, 6),
    }
    got = on(spark, list(texts), *[c.alias(n) for n, c in zip("xy", G.centroid(G.parse(F.col("t"))), strict=True)])
    for g, w in zip(got, texts.values(), strict=True):
        assert g == pytest.approx(w)


def test_crs_control_points_and_round_trips(spark):
    df = spark.createDataFrame([(3.0, 46.5), (-4.9, 41.4), (9.5, 51.0), (0.0005, 48.85)], "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    x, y = crs.lambert93(lon, lat)
    mx, my = crs.web_mercator(lon, lat)
    rows = df.select("lon", "lat", x.alias("x"), y.alias("y"), *[c.alias(n) for n, c in zip(("a", "b"), crs.from_lambert93(x, y), strict=True)], mx.alias("mx"), my.alias("my"), *[c.alias(n) for n, c in zip(("c", "d"), crs.from_web_mercator(mx, my), strict=True)]).collect()
    assert (rows[0].x, rows[0].y) == pytest.approx((700000, 6600000), abs=1e-6)
    for r in rows:
        assert (r.a, r.b, r.c, r.d) == pytest.approx((r.lon, r.lat, r.lon, r.lat), abs=1e-9)
        assert r.my == pytest.approx(6378137 * math.asinh(math.tan(math.radians(r.lat))), abs=1e-6)


def test_names_and_values(spark):
    assert on(spark, ["a-b c.D", "x"], values.clean_name(F.col("t"))) == ["a_b_c_D", "x"]
    assert on(spark, ["p/q/My-File v.2.geojson", "noext", "a/.hidden"], values.table_name(F.col("t"))) == ["my_file_v.2", "noext", ".hidden"]
    f = ['{"id":5}', '{"id":"x"}', '{"id":null}', "{}", '{"id":true}', '{"id":1.5}']
    assert on(spark, f, values.feature_id(F.col("t"), F.col("i"))) == ["5", "x", "None", "feature_3", "True", "1.5"]
    assert on(spark, ['{"type":"A"}', '{"type":null}', "{}"], values.feature_type(F.col("t"))) == ["A", None, "Feature"]
    assert values.byte_text(1536) == "1.50 KB" and values.byte_text(5 * 2**40) == "5.00 TB"
