"""Registered queries over layers synthesised from the given tables, and their oracle SQL (brute force, no cells)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import crs
from ..functions import geometry as G
from ..functions import values as V
from ..operators import connect as C
from ..operators import ids
from ..operators import schema as S
from ..operators import statistics as T
from . import ingest


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Synthesised layers: (layer, table, key, shift, remainder of key by 4 for lines) -----------------------
SYNTHESISED = (
    ("postes_source", "supplier", "s_suppkey", 11, None), ("postes_electrique", "customer", "c_custkey", 23, None), ("position_geographique", "part", "p_partkey", 37, None),
    ("reseau_hta", "orders", "o_orderkey", 5, 0), ("reseau_souterrain_hta", "orders", "o_orderkey", 5, 1), ("reseau_bt", "orders", "o_orderkey", 5, 2), ("reseau_souterrain_bt", "orders", "o_orderkey", 5, 3),
)


def rows(spark: SparkSession, sf: str) -> DataFrame:
    """layer, k, x, y, x2, y2 (the second end of lines). A table of several layers is read once."""
    out, lines = None, [x for x in SYNTHESISED if x[4] is not None]
    for layer, name, key, s, part in (*(x for x in SYNTHESISED if x[4] is None), lines[0]):
        k = F.col(key).cast("long")
        # Every remainder has its layer; keys below nothing have none, as in the SQL.
        label = F.lit(layer) if part is None else F.element_at(F.array(*(F.lit(x[0]) for x in sorted(lines, key=lambda x: x[4]))), (k % len(lines)).cast("int") + 1)
        t = _table(spark, sf, name).select(key)
        if part is not None:
            t = t.where(k % len(lines) >= 0)
        x, y = ((k * k * 31 + k * 7919 + s) % 4001).cast("double"), ((k * k * 17 + k * 104729 + s) % 4003).cast("double")
        x2, y2 = (x + (k % 61 - 30), y + (k % 53 - 26)) if part is not None else (F.lit(None), F.lit(None))
        t = t.select(label.alias("layer"), k.alias("k"), x.alias("x"), y.alias("y"), x2.cast("double").alias("x2"), y2.cast("double").alias("y2"))
        out = t if out is None else out.unionByName(t)
    return out


def layer_features(spark: SparkSession, sf: str) -> DataFrame:
    numbered = ids.layer_ids(rows(spark, sf), "k")
    return numbered.select("id", "layer", "ordinal", "k", "x", "y", "x2", "y2", _geom())


def unnumbered(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`layer_features` without their ids, which take a ranking."""
    return rows(spark, sf).select(F.col("k").cast("string").alias("id"), "layer", _geom())


def _geom():
    v = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    point = F.struct(F.lit("Point").alias("type"), F.array(F.array(F.array(v("x", "y")))).alias("parts"))
    line = F.struct(F.lit("LineString").alias("type"), F.array(F.array(F.array(v("x", "y"), v("x2", "y2")))).alias("parts"))
    return F.when(F.col("x2").isNull(), point).otherwise(line).alias("geom")


_PARTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, {i} AS pos, CAST({key} AS BIGINT) AS k, CAST(({key} * {key} * 31 + {key} * 7919 + {s}) % 4001 AS DOUBLE) AS x, "
    f"CAST(({key} * {key} * 17 + {key} * 104729 + {s}) % 4003 AS DOUBLE) AS y, {part is not None} AS line FROM {name}" + (f" WHERE {key} % 4 = {part}" if part is not None else "")
    for i, (layer, name, key, s, part) in enumerate(SYNTHESISED)
)
F_SQL = f"""f0 AS ({_PARTS}), f AS (
  SELECT layer, pos, k, x, y, line, CASE WHEN line THEN x + (k % 61 - 30) END AS x2, CASE WHEN line THEN y + (k % 53 - 26) END AS y2,
    row_number() OVER (PARTITION BY layer ORDER BY k) AS ordinal, layer || '_' || row_number() OVER (PARTITION BY layer ORDER BY k) AS id FROM f0
)"""
_RULES = ", ".join(f"('{a}', '{b}')" for a, x in config.LAYERS.items() for b in x.can_connect_to)
_LAYERS = ", ".join(f"('{k}', CAST({x.radius} AS DOUBLE), {x.priority}, {i})" for i, (k, x) in enumerate(config.LAYERS.items()))
R_SQL = f"""rules(a, b) AS (VALUES {_RULES}), layers(layer, radius, priority, pos) AS (VALUES {_LAYERS}),
mutual AS (SELECT r.a, r.b FROM rules r JOIN rules q ON r.a = q.b AND r.b = q.a)"""
_PROBES = """probe AS (
  SELECT id AS src_id, layer AS src_layer, 'S' AS "end", x AS px, y AS py FROM f WHERE line UNION ALL
  SELECT id, layer, 'E', x2, y2 FROM f WHERE line UNION ALL SELECT id, layer, 'P', x, y FROM f WHERE NOT line
)"""
_D = """CASE WHEN NOT line OR (x2 = x AND y2 = y) THEN sqrt((px - x) * (px - x) + (py - y) * (py - y))
  WHEN ((px - x) * (x2 - x) + (py - y) * (y2 - y)) / ((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) <= 0 THEN sqrt((px - x) * (px - x) + (py - y) * (py - y))
  WHEN ((px - x) * (x2 - x) + (py - y) * (y2 - y)) / ((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) >= 1 THEN sqrt((px - x2) * (px - x2) + (py - y2) * (py - y2))
  ELSE abs((px - x) * (y2 - y) - (py - y) * (x2 - x)) / sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) END"""
_NEAR = f"""{F_SQL}, {R_SQL}, {_PROBES}, met AS (
  SELECT src_id, src_layer, "end", f.id AS dst_id, f.layer AS dst_layer, f.pos AS dst_pos, f.ordinal AS dst_ordinal, p.priority, pr.radius, {_D} AS distance
  FROM probe JOIN layers pr ON pr.layer = probe.src_layer JOIN f ON least(f.x, coalesce(f.x2, f.x)) <= px + pr.radius AND greatest(f.x, coalesce(f.x2, f.x)) >= px - pr.radius
    AND least(f.y, coalesce(f.y2, f.y)) <= py + pr.radius AND greatest(f.y, coalesce(f.y2, f.y)) >= py - pr.radius AND f.id <> src_id
  JOIN mutual m ON m.a = src_layer AND m.b = f.layer JOIN layers p ON p.layer = f.layer
), near AS (SELECT * FROM met WHERE distance <= radius)"""
_LIMIT = """CASE WHEN "end" <> 'P' THEN 2 WHEN starts_with(src_layer, 'postes') THEN 100 WHEN ends_with(src_layer, 'bt') THEN 5 ELSE 20 END"""
_TOP = f"""{_NEAR}, ranked AS (SELECT *, row_number() OVER (PARTITION BY src_id, "end" ORDER BY priority, distance, dst_pos, dst_ordinal) AS rank FROM near),
top AS (SELECT * FROM ranked WHERE rank <= {_LIMIT})"""
_CONNECTED = f"""{_TOP}, edge AS (SELECT DISTINCT src_id, dst_id FROM top),
line_n AS (SELECT f.id, f.layer, f.line, CAST(count(e.dst_id) AS BIGINT) AS n FROM f LEFT JOIN edge e ON e.src_id = f.id GROUP BY ALL)"""

Q: dict = {}
O: dict[str, str] = {}


def query(sql: str):
    def add(f):
        Q[f.__name__], O[f.__name__] = f, sql
        return f

    return add


# Layers and rules ----------------------------------------------------------------------------------


@query(f"WITH {F_SQL} SELECT layer, k, x, y, x2, y2 FROM f")
def layers_union(spark, sf):
    return rows(spark, sf)


@query(f"WITH {F_SQL} SELECT id, layer, k FROM f WHERE layer = 'reseau_bt'")
def layer_scan(spark, sf):
    wanted = ["id", "layer", "k", "code_commune"]
    df = layer_features(spark, sf).where(F.col("layer") == "reseau_bt")
    return df.select(*[c for c in wanted if c in df.columns])


@query(f"WITH {F_SQL} SELECT layer, k, CAST(ordinal AS BIGINT) AS ordinal, id FROM f")
def ordinal_ids(spark, sf):
    return ids.layer_ids(rows(spark, sf), "k").select("layer", "k", "ordinal", "id")


@query(f"WITH {R_SQL} SELECT layer, CAST(priority AS INTEGER) AS priority, CAST(pos AS INTEGER) AS pos FROM layers ORDER BY priority, pos")
def layer_order(spark, sf):
    return T.layer_order(config.layer_table(spark))


@query(f"WITH {R_SQL} SELECT a AS src_layer, b AS dst_layer FROM mutual")
def mutual_rules(spark, sf):
    return config.mutual_pairs(spark)


@query(f"WITH {F_SQL}, {R_SQL} SELECT id, layer FROM f WHERE layer IN (SELECT b FROM rules WHERE a = 'position_geographique')")
def rule_semi_join(spark, sf):
    allowed = config.layer_table(spark).where(F.col("layer") == "position_geographique").select(F.explode("can_connect_to").alias("layer"))
    return layer_features(spark, sf).select("id", "layer").join(F.broadcast(allowed), "layer", "left_semi")


@query(f"WITH {F_SQL}, {R_SQL} SELECT id, CAST(l.priority AS INTEGER) AS priority, l.radius FROM f JOIN layers l USING (layer)")
def priority_lookup(spark, sf):
    layer = F.col("layer")
    return layer_features(spark, sf).select("id", config.priority_of(layer).alias("priority"), config.radius_of(layer).alias("radius"))


@query(f"WITH {F_SQL}, {_PROBES} SELECT src_id, \"end\", CAST({_LIMIT} AS INTEGER) AS max_connections FROM probe")
def conn_limit(spark, sf):
    p = C.probes(layer_features(spark, sf))
    return p.select("src_id", "end", config.connection_limit(F.col("src_layer"), F.col("end") != "P").cast("int").alias("max_connections"))


# Geometry ------------------------------------------------------------------------------------------

_N = "CAST(CAST({} AS BIGINT) AS VARCHAR)"
_TEXT = (
    "CASE WHEN line THEN '{\"type\":\"LineString\",\"coordinates\":[[' || %s || ',' || %s || '],[' || %s || ',' || %s || ']]}' "
    "ELSE '{\"type\":\"Point\",\"coordinates\":[' || %s || ',' || %s || ']}' END" % tuple(_N.format(c) for c in ("x", "y", "x2", "y2", "x", "y"))
)


def geometry_text(spark, sf) -> DataFrame:
    n = lambda c: F.col(c).cast("long").cast("string")
    line = F.concat(F.lit('{"type":"LineString","coordinates":[['), n("x"), F.lit(","), n("y"), F.lit("],["), n("x2"), F.lit(","), n("y2"), F.lit("]]}"))
    point = F.concat(F.lit('{"type":"Point","coordinates":['), n("x"), F.lit(","), n("y"), F.lit("]}"))
    good = F.when(F.col("x2").isNull(), point).otherwise(line)
    # Every ninth cell is no geometry.
    return layer_features(spark, sf).select("id", "k", F.when(F.col("k") % 9 == 0, "bad").otherwise(good).alias("geo_shape"))


@query(f"WITH {F_SQL} SELECT id, CASE WHEN line THEN 'LineString' ELSE 'Point' END AS type, x, y FROM f WHERE k % 9 <> 0")
def geometry_parse(spark, sf):
    g = geometry_text(spark, sf).withColumn("g", G.parse(F.col("geo_shape"))).where(F.col("g").isNotNull())
    v = G.first_vertex(F.col("g"))
    return g.select("id", F.col("g.type").alias("type"), v["x"].alias("x"), v["y"].alias("y"))


@query(f"WITH {F_SQL} SELECT id, CAST(CASE WHEN line THEN 2 ELSE 1 END AS INTEGER) AS n, x AS first_x, coalesce(y2, y) AS last_y FROM f WHERE k % 9 <> 0")
def original_coordinates(spark, sf):
    c = geometry_text(spark, sf).withColumn("c", G.original_coordinates(F.col("geo_shape"))).where(F.col("c").isNotNull())
    return c.select("id", F.size("c").alias("n"), F.col("c")[0][0].alias("first_x"), F.element_at("c", -1)[1].alias("last_y"))


@query(f"WITH {F_SQL}, {_PROBES} SELECT src_id, \"end\", px, py FROM probe")
def line_endpoints(spark, sf):
    return C.probes(layer_features(spark, sf)).select("src_id", "end", "px", "py")


@query("""SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(o_orderkey % 1000 AS DOUBLE) + (CAST(o_orderkey % 7 AS DOUBLE) + 1) AS cx,
  CAST(o_orderkey % 900 AS DOUBLE) + (CAST(o_orderkey % 5 AS DOUBLE) + 1) AS cy FROM orders""")
def centroid(spark, sf):
    """Of rectangles with a hole around their middle, whose centroid is the middle."""
    k = F.col("o_orderkey")
    x, y, w, h = (k % 1000).cast("double"), (k % 900).cast("double"), (k % 7 + 1).cast("double"), (k % 5 + 1).cast("double")
    box = lambda f: F.array(*(F.struct((x + w + w * f * a).alias("x"), (y + h + h * f * b).alias("y")) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))))
    geom = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(box(1.0), box(0.5))).alias("parts"))
    cx, cy = G.centroid(F.col("geom"))
    return _table(spark, sf, "orders").select(k.cast("long").alias("k"), geom.alias("geom")).select("k", F.round(cx, 6).alias("cx"), F.round(cy, 6).alias("cy"))


@query(f"WITH {F_SQL} SELECT id, round(6378137.0 * radians(x / 500 - 4), 3) AS mx, round(6378137.0 * ln(tan(pi() / 4 + radians(y / 500 + 42) / 2)), 3) AS my FROM f")
def web_mercator(spark, sf):
    mx, my = crs.web_mercator(F.col("x") / 500 - 4, F.col("y") / 500 + 42)
    return layer_features(spark, sf).select("id", F.round(mx, 3).alias("mx"), F.round(my, 3).alias("my"))


@query(f"WITH {F_SQL}, p AS (SELECT *, CAST(k % 4001 AS DOUBLE) AS px, CAST(k % 4003 AS DOUBLE) AS py FROM f) SELECT id, {_D} AS distance FROM p WHERE line")
def point_segment_distance(spark, sf):
    p = ((F.col("k") % 4001).cast("double"), (F.col("k") % 4003).cast("double"))
    f = layer_features(spark, sf).where(F.col("x2").isNotNull())
    return f.select("id", G.segment_distance(*p, F.col("x"), F.col("y"), F.col("x2"), F.col("y2")).alias("distance"))


@query(f"WITH {F_SQL} SELECT id, 'POINT(' || {_N.format('x')} || ' ' || {_N.format('y')} || ')' AS wkt FROM f WHERE NOT line AND k % 9 <> 0")
def wkt_point(spark, sf):
    return geometry_text(spark, sf).select("id", G.wkt(F.col("geo_shape")).alias("wkt")).where(F.col("wkt").startswith("POINT"))


@query(f"WITH {F_SQL} SELECT id, 'LINESTRING(' || {_N.format('x')} || ' ' || {_N.format('y')} || ', ' || {_N.format('x2')} || ' ' || {_N.format('y2')} || ')' AS wkt FROM f WHERE line AND k % 9 <> 0")
def wkt_linestring(spark, sf):
    return geometry_text(spark, sf).select("id", G.wkt(F.col("geo_shape")).alias("wkt")).where(F.col("wkt").startswith("LINESTRING"))


# Connections -----------------------------------------------------------------------------------------


@query(f"""WITH {F_SQL}, {R_SQL}, {_PROBES} SELECT src_id, "end", f.id AS dst_id FROM probe JOIN layers l ON l.layer = src_layer
  JOIN f ON least(f.x, coalesce(f.x2, f.x)) <= px + 1.5 * l.radius AND greatest(f.x, coalesce(f.x2, f.x)) >= px - 1.5 * l.radius
  AND least(f.y, coalesce(f.y2, f.y)) <= py + 1.5 * l.radius AND greatest(f.y, coalesce(f.y2, f.y)) >= py - 1.5 * l.radius AND f.id <> src_id""")
def bbox_join(spark, sf):
    return C.bbox_pairs(layer_features(spark, sf))


@query(f'WITH {_NEAR} SELECT src_id, "end", dst_id, distance FROM near')
def distance_join(spark, sf):
    return C.distance_join(layer_features(spark, sf)).select("src_id", "end", "dst_id", "distance")


@query(f'WITH {_TOP} SELECT src_id, "end", CAST(rank AS INTEGER) AS rank, dst_id, distance FROM top')
def topk_connections(spark, sf):
    return C.nearest_pairs(layer_features(spark, sf), placed=unnumbered(spark, sf)).select("src_id", "end", "rank", "dst_id", "distance")


def connected(spark, sf) -> DataFrame:
    return C.connect(layer_features(spark, sf), placed=unnumbered(spark, sf))


@query(f"WITH {_TOP}, edge AS (SELECT DISTINCT src_id, dst_id FROM top) SELECT f.id AS src_id, dst_id FROM f LEFT JOIN edge ON edge.src_id = f.id")
def connections(spark, sf):
    return connected(spark, sf).select(F.col("id").alias("src_id"), F.explode_outer("connections").alias("dst_id"))


@query(f"WITH {_CONNECTED} SELECT layer, count(*) AS feature_count, CAST(sum(n) AS BIGINT) AS total_connections, CAST(sum(n) AS DOUBLE) / count(*) AS avg_connections FROM line_n GROUP BY layer")
def network_statistics(spark, sf):
    return T.averaged(C.connection_counts(layer_features(spark, sf), placed=unnumbered(spark, sf)))


@query(f"WITH {_CONNECTED} SELECT count(*) AS total_features, CAST(sum(n) AS BIGINT) AS total_connections, CAST(sum(n) AS DOUBLE) / count(*) AS avg_connections FROM line_n")
def network_totals(spark, sf):
    return T.total_of_layers(C.connection_counts(layer_features(spark, sf), placed=unnumbered(spark, sf)))


@query(f"WITH {F_SQL} SELECT layer, CASE WHEN line THEN 'LineString' ELSE 'Point' END AS geometry_type, count(*) AS n FROM f GROUP BY ALL")
def geometry_types(spark, sf):
    return T.geometry_types(layer_features(spark, sf))


@query(f"""WITH {F_SQL} SELECT id, layer, layer IN ('postes_source', 'reseau_bt') AS resumed FROM f""")
def resume_antijoin(spark, sf):
    """Features of layers saved before, and of the others computed anew."""
    f = layer_features(spark, sf).select("id", "layer")
    done = spark.createDataFrame([("postes_source",), ("reseau_bt",)], "layer string")
    saved = f.join(F.broadcast(done), "layer", "left_semi").withColumn("resumed", F.lit(True))
    return saved.unionByName(f.join(F.broadcast(done), "layer", "left_anti").withColumn("resumed", F.lit(False)))


# GeoJSON documents: one collection for each customer, one feature for each order -----------------------


def collections(spark, sf) -> DataFrame:
    """(path, text) built by concatenation."""
    k = F.col("o_orderkey").cast("long")
    s = k.cast("string")
    ident = F.when(k % 5 == 0, "").when(k % 5 == 1, '"id":null,').when(k % 5 == 2, F.concat(F.lit('"id":"s'), s, F.lit('",'))).otherwise(F.concat(F.lit('"id":'), s, F.lit(",")))
    kind = F.when(k % 11 == 0, "").when(k % 11 == 1, '"type":null,').otherwise('"type":"Feature",')
    geometry = F.when(k % 7 == 0, "null").when(k % 7 == 1, "{}").otherwise(F.concat(F.lit('{"type":"Point","coordinates":['), (k % 4001).cast("string"), F.lit(","), (k % 97).cast("string"), F.lit("]}")))
    a = F.when(k % 3 == 0, "null").otherwise(s)
    properties = F.concat(F.lit('{"a-key":'), a, F.lit(',"b.c":"'), F.col("o_orderstatus"), F.lit('","tags":["x","'), s, F.lit('"],"deep":{"v":'), s, F.lit('},"big":'), s, F.lit(".5"), F.lit(',"flag":'), F.when(k % 2 == 0, "true").otherwise("false"), F.lit("}"))
    text = F.concat(F.lit("{"), kind, ident, F.lit('"geometry":'), geometry, F.lit(',"properties":'), properties, F.lit("}"))
    each = _table(spark, sf, "orders").select(F.col("o_custkey").cast("long").alias("c"), k.alias("k"), text.alias("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]), ",")
    return each.groupBy("c").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), joined, F.lit("]}")).alias("text"))


_FEATURE = """g AS (SELECT CAST(o_custkey AS BIGINT) AS c, CAST(o_orderkey AS BIGINT) AS k, o_orderstatus AS s,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS position FROM orders)"""


def exploded(spark, sf) -> DataFrame:
    return S.explode_features(collections(spark, sf))


@query(f"WITH {_FEATURE} SELECT c, position, CAST(k AS VARCHAR) AS deep FROM g")
def geojson_explode(spark, sf):
    return exploded(spark, sf).select("c", "position", F.get_json_object("feature", "$.properties.deep.v").alias("deep"))


@query(f"""WITH {_FEATURE} SELECT c, position, CASE k % 5 WHEN 0 THEN 'feature_' || position WHEN 1 THEN 'None' WHEN 2 THEN 's' || k ELSE CAST(k AS VARCHAR) END AS feature_id,
  CASE k % 11 WHEN 1 THEN NULL ELSE 'Feature' END AS feature_type FROM g""")
def feature_ids(spark, sf):
    f = F.col("feature")
    return exploded(spark, sf).select("c", "position", V.feature_id(f, F.col("position")).alias("feature_id"), V.feature_type(f).alias("feature_type"))


_GEOMETRY = "CASE WHEN k % 7 < 2 THEN NULL ELSE '{\"type\":\"Point\",\"coordinates\":[' || (k % 4001) || ',' || (k % 97) || ']}' END"


@query(f"WITH {_FEATURE} SELECT c, position, {_GEOMETRY} AS geometry_json FROM g")
def geometry_json(spark, sf):
    return exploded(spark, sf).select("c", "position", V.geometry_json(F.col("feature")).alias("geometry_json"))


@query(f"""WITH {_FEATURE} SELECT CASE k % 5 WHEN 0 THEN 'feature_' || position WHEN 1 THEN 'None' WHEN 2 THEN 's' || k ELSE CAST(k AS VARCHAR) END AS feature_id,
  CASE k % 11 WHEN 1 THEN NULL ELSE 'Feature' END AS feature_type, {_GEOMETRY} AS geometry_json,
  CASE WHEN k % 7 < 2 THEN NULL ELSE 'POINT(' || (k % 4001) || ' ' || (k % 97) || ')' END AS geometry, CASE WHEN k % 3 = 0 THEN NULL ELSE k END AS a_key,
  s AS b_c, k + 0.5::DOUBLE AS big, '{{"v":' || k || '}}' AS deep, k % 2 = 0 AS flag, 'x,' || k AS tags FROM g""")
def geojson_flatten(spark, sf):
    schema = [("", n, t) for n, t in S.FIXED] + [("a-key", "a_key", "INTEGER"), ("b.c", "b_c", "STRING"), ("big", "big", "FLOAT"), ("deep", "deep", "JSON"), ("flag", "flag", "BOOLEAN"), ("tags", "tags", "STRING REPEATED")]
    return S.flatten(exploded(spark, sf), schema).withColumn("tags", F.array_join("tags", ","))


@query("""WITH v AS (SELECT event_id, unnest(json_keys(props)) AS key, props FROM events), t AS (SELECT event_id, key, json_type(props, '$.' || key) AS t FROM v)
SELECT key, CASE arg_min(t, event_id) WHEN 'BIGINT' THEN 'INTEGER' WHEN 'UBIGINT' THEN 'INTEGER' WHEN 'DOUBLE' THEN 'FLOAT' WHEN 'BOOLEAN' THEN 'BOOLEAN' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'STRING' ELSE 'JSON' END AS type
FROM t GROUP BY key""")
def infer_schema(spark, sf):
    f = _table(spark, sf, "events").select(F.col("event_id").alias("position"), F.concat(F.lit('{"properties":'), "props", F.lit("}")).alias("feature"))
    return S.infer_types(S.property_values(f)).select("key", "type")


@query("SELECT c_custkey AS k, translate(c_name || '.' || c_mktsegment || ' x', '- .', '___') AS name FROM customer")
def clean_names(spark, sf):
    return _table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), V.clean_name(F.concat("c_name", F.lit("."), "c_mktsegment", F.lit(" x"))).alias("name"))


@query("SELECT p_partkey AS k, lower(translate('Out ' || p_name || '.v2-' || p_partkey, '- ', '__')) AS name FROM part")
def table_names(spark, sf):
    path = F.concat(F.lit("processed/sub.d/Out "), "p_name", F.lit(".v2-"), F.col("p_partkey").cast("string"), F.lit(".geojson"))
    return _table(spark, sf, "part").select(F.col("p_partkey").alias("k"), V.table_name(path).alias("name"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, coalesce(json_extract_string(props, '$.k.z'), 'none') AS z FROM events")
def nested_get(spark, sf):
    return _table(spark, sf, "events").select("event_id", V.nested(F.col("props"), "k", "none").alias("k"), V.nested(F.col("props"), "k.z", "none").alias("z"))


_PATH = "'processed/' || CASE WHEN o_orderkey % 2 = 0 THEN 'reseau_souterrain_hta' ELSE 'reseau_bt' END || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '.json' ELSE '.geojson' END"


@query(f"SELECT path FROM (SELECT {_PATH} AS path FROM orders) WHERE contains(path, 'reseau_souterrain_hta') AND ends_with(path, '.geojson')")
def file_filter(spark, sf):
    k = F.col("o_orderkey")
    path = F.concat(F.lit("processed/"), F.when(k % 2 == 0, "reseau_souterrain_hta").otherwise("reseau_bt"), k.cast("string"), F.when(k % 3 == 0, ".json").otherwise(".geojson"))
    return _table(spark, sf, "orders").select(path.alias("path")).where(V.wanted_file(F.col("path")))


@query("""SELECT CAST(sum(CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey ELSE 0 END) AS BIGINT) AS total_rows_processed, printf('%.2f seconds', sum(CAST(o_orderkey % 8 AS DOUBLE) / 8)) AS total_processing_time,
  CAST(count(*) FILTER (o_orderkey % 10 <> 0) AS BIGINT) || '/' || count(*) AS success_rate FROM orders""")
def load_summary(spark, sf):
    k = F.col("o_orderkey").cast("long")
    return ingest.summary(_table(spark, sf, "orders").select(F.when(k % 10 != 0, "success").otherwise("failed").alias("status"), k.alias("rows_processed"), ((k % 8).cast("double") / 8).alias("processing_time")))


@query(f"""WITH {_TOP}, e AS (SELECT DISTINCT src_id, dst_id FROM top) SELECT e.src_id, e.dst_id FROM e LEFT JOIN e b ON b.src_id = e.dst_id AND b.dst_id = e.src_id WHERE b.src_id IS NULL""")
def one_way_edges(spark, sf):
    """Edges without a reverse edge: limits and radii make connections asymmetric."""
    e, layer = C.one_way(C.nearest_pairs(layer_features(spark, sf), placed=unnumbered(spark, sf))), F.array(*map(F.lit, config.LAYERS))
    return e.select(*(F.concat_ws("_", layer[F.col(f"{k}_pos")], F.col(f"{k}_ordinal").cast("string")).alias(f"{k}_id") for k in ("src", "dst")))


from . import file_queries  # noqa: E402, F401  adds the queries over files
