"""Geometry as columns: struct<type, parts: polygon[] -> ring[] -> vertex<x, y>[]>. No user-defined function.

Point is 1/1/1, LineString 1/1/n, MultiPoint n/1/1, MultiLineString n/1/m, Polygon 1/r/m, MultiPolygon p/r/m. A
GeometryCollection keeps its type with null parts. What does not parse, or breaks a type's least number of
vertices (line 2, ring 3), is null; empty coordinates are kept as no parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPES = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection")
VERTICES = "array<struct<x:double,y:double>>"
GEOM = f"struct<type:string,parts:array<array<{VERTICES}>>>"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def parse(text: Column) -> Column:
    """A GeoJSON geometry; null where it is none."""
    return let(F.from_json(text, "type string, coordinates string, geometries string"), _parsed)


def _parsed(got: Column) -> Column:
    def at(depth: int, use) -> Column:
        wrapped = F.concat(F.lit('{"c":'), got["coordinates"], F.lit("}"))
        return let(F.from_json(wrapped, "c " + "array<" * depth + "double" + ">" * depth)["c"], use)

    def ok(v: Column) -> Column:
        return (F.size(v) >= 2) & v[0].isNotNull() & v[1].isNotNull()

    def line(c: Column, least: int) -> Column:
        """Vertices of a line; null if they are too few or one is none. Empty coordinates are an empty line."""
        good = (F.size(c) == 0) | ((F.size(c) >= least) & F.forall(c, ok))
        return F.when(good, F.transform(c, lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))))

    def whole(parts: Column) -> Column:
        """Null if any line inside is null; without empty lines and parts."""
        some = lambda items: F.filter(items, lambda x: F.size(x) > 0)
        return let(parts, lambda q: F.when(~F.exists(q, lambda p: F.exists(p, lambda r: r.isNull())), some(F.transform(q, some))))

    def by_type(kind: Column) -> Column:
        parts = (
            F.when(kind == "point", at(1, lambda c: whole(F.when((F.size(c) == 0) | ok(c), F.array(F.array(line(F.filter(F.array(c), lambda v: F.size(v) > 0), 1)))))))
            .when(kind == "linestring", at(2, lambda c: whole(F.when(c.isNotNull(), F.array(F.array(line(c, 2)))))))
            .when(kind == "multipoint", at(2, lambda c: whole(F.transform(c, lambda v: F.array(line(F.array(v), 1))))))
            .when(kind == "polygon", at(3, lambda c: whole(F.when(c.isNotNull(), F.array(F.transform(c, lambda r: line(r, 3)))))))
            .when(kind == "multilinestring", at(3, lambda c: whole(F.transform(c, lambda r: F.array(line(r, 2))))))
            .when(kind == "multipolygon", at(4, lambda c: whole(F.transform(c, lambda p: F.transform(p, lambda r: line(r, 3))))))
        )
        name = F.lit(None).cast("string")
        for t in TYPES:
            name = F.when(kind == t.lower(), t).otherwise(name)
        collection = (kind == "geometrycollection") & got["geometries"].isNotNull()
        return let(parts, lambda p: F.when(p.isNotNull() | collection, F.struct(name.alias("type"), p.alias("parts"))))

    return let(F.lower(got["type"]), by_type)


def original_coordinates(text: Column) -> Column:
    """Vertices of a Point or LineString as they are written (2 or 3 ordinates); null for other types and empty ones."""
    got = F.from_json(text, "type string, coordinates string")
    wrap = F.concat(F.lit('{"c":'), got["coordinates"], F.lit("}"))
    kind = F.lower(got["type"])
    point = F.from_json(wrap, "c array<double>")["c"]
    line = F.from_json(wrap, "c array<array<double>>")["c"]
    return F.when((kind == "point") & (F.size(point) > 0), F.array(point)).when((kind == "linestring") & (F.size(line) > 0), line)


def first_vertex(geom: Column) -> Column:
    return geom["parts"][0][0][0]


def last_vertex(geom: Column) -> Column:
    return F.try_element_at(geom["parts"][0][0], F.lit(-1))


def point_distance(px, py, qx, qy) -> Column:
    dx, dy = px - qx, py - qy
    return F.sqrt(dx * dx + dy * dy)


def segment_distance(px, py, ax, ay, bx, by) -> Column:
    """Distance of a point to a segment; one of no length is a point."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    some = F.nullif(square, F.lit(0.0))
    along = ((px - ax) * dx + (py - ay) * dy) / some
    across = F.abs((px - ax) * dy - (py - ay) * dx) / F.sqrt(some)
    return F.when((square == 0) | (along <= 0), point_distance(px, py, ax, ay)).when(along >= 1, point_distance(px, py, bx, by)).otherwise(across)


def segments(ring: Column) -> Column:
    """Consecutive vertex pairs; a lone vertex is a segment of no length."""
    pairs = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.when(F.size(ring) == 1, F.array(F.struct(ring[0].alias("a"), ring[0].alias("b")))).otherwise(pairs)


def closed(ring: Column) -> Column:
    return F.when(ring[0] == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def is_area(geom: Column) -> Column:
    return geom["type"].isin("Polygon", "MultiPolygon")


def all_segments(geom: Column) -> Column:
    rings = F.flatten(geom["parts"])
    rings = F.when(is_area(geom), F.transform(rings, closed)).otherwise(rings)
    return F.flatten(F.transform(rings, segments))


def contains(rings: Column, px: Column, py: Column) -> Column:
    """Whether the point is inside a polygon (odd number of crossings of a ray)."""
    crossings = F.transform(
        F.flatten(F.transform(rings, lambda r: segments(closed(r)))),
        lambda s: F.when(((s["a"]["y"] > py) != (s["b"]["y"] > py)) & (px < (s["b"]["x"] - s["a"]["x"]) * (py - s["a"]["y"]) / F.nullif(s["b"]["y"] - s["a"]["y"], F.lit(0.0)) + s["a"]["x"]), 1).otherwise(0),
    )
    return F.aggregate(crossings, F.lit(0), lambda a, x: a + x) % 2 == 1


def centroid(geom: Column) -> tuple[Column, Column]:
    """Planar centroid: of areas (holes taken off), else by length of lines, else of points; of a Point itself."""
    c = F.when(geom["type"] == "Point", geom["parts"][0][0][0]).otherwise(_centroid(geom))
    return c["x"], c["y"]


def _mean(items: Column, weight, x, y) -> Column:
    """struct(x, y): means of x and y weighted by ``weight``; null where the weights add up to nothing."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(t: Column, i: Column) -> Column:
        return let(weight(i), lambda w: F.struct((t["w"] + w).alias("w"), (t["x"] + w * x(i)).alias("x"), (t["y"] + w * y(i)).alias("y")))

    def finish(t: Column) -> Column:
        w = F.nullif(t["w"], F.lit(0.0))
        return F.when(w.isNotNull(), F.struct((t["x"] / w).alias("x"), (t["y"] / w).alias("y")))

    return F.aggregate(items, zero, add, finish)


def _centroid(geom: Column) -> Column:
    half = lambda k: lambda s: (s["a"][k] + s["b"][k]) / 2
    length = lambda s: point_distance(s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])
    points = F.flatten(F.flatten(geom["parts"]))
    by_point = _mean(points, lambda v: F.lit(1.0), lambda v: v["x"], lambda v: v["y"])
    by_length = _mean(all_segments(geom), length, half("x"), half("y"))

    # Areas relative to the geometry's first vertex, which keeps digits.
    def area_and_moments(ring: Column, o: Column) -> Column:
        zero = F.struct(*(F.lit(0.0).alias(k) for k in ("area", "mx", "my")))

        def add(t: Column, q: Column) -> Column:
            ax, ay, bx, by = q["a"]["x"] - o["x"], q["a"]["y"] - o["y"], q["b"]["x"] - o["x"], q["b"]["y"] - o["y"]
            return let(ax * by - bx * ay, lambda c: F.struct((t["area"] + c / 2).alias("area"), (t["mx"] + c * (ax + bx) / 6).alias("mx"), (t["my"] + c * (ay + by) / 6).alias("my")))

        return F.aggregate(segments(closed(ring)), zero, add)

    def signed(ring: Column, i: Column, o: Column) -> Column:
        """A ring's part in the sum goes by its place (the first is the outline), not by its direction."""

        def turn(m: Column) -> Column:
            s = F.when((m["area"] < 0) == (i == 0), -1.0).otherwise(1.0)
            return F.struct((m["area"] * s).alias("area"), (m["mx"] * s).alias("mx"), (m["my"] * s).alias("my"))

        return let(area_and_moments(ring, o), turn)

    def by_area(o: Column) -> Column:
        rings = F.flatten(F.transform(geom["parts"], lambda p: F.transform(p, lambda r, i: signed(r, i, o))))
        zero = F.struct(*(F.lit(0.0).alias(k) for k in ("area", "mx", "my")))
        add = lambda t, m: F.struct(*((t[k] + m[k]).alias(k) for k in ("area", "mx", "my")))
        finish = lambda t: F.when(t["area"] > 0, F.struct((o["x"] + t["mx"] / F.nullif(t["area"], F.lit(0.0))).alias("x"), (o["y"] + t["my"] / F.nullif(t["area"], F.lit(0.0))).alias("y")))
        return F.aggregate(rings, zero, add, finish)

    area = F.when(is_area(geom), let(points[0], by_area))
    return F.when(F.size(points) > 0, F.coalesce(area, F.when(geom["type"] != "MultiPoint", by_length), by_point))


# Text -----------------------------------------------------------------------------------------


def number_text(n: Column) -> Column:
    """A JSON number as Python writes it (Spark writes exponents below 1e-3 and from 1e7)."""
    mantissa, exponent = F.regexp_extract(n, r"^(-?[0-9.]+)E", 1), F.regexp_extract(n, r"E(-?\d+)$", 1).cast("int")
    value = n.try_cast("double")
    plain = F.concat(F.expr("''"), F.regexp_replace(value.cast("decimal(38,20)").cast("string"), r"0+$", ""))
    plain = F.regexp_replace(plain, r"\.$", ".0")
    short = F.regexp_replace(mantissa, r"\.0$", "")
    scientific = F.concat(short, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    return F.when(~n.contains("E"), n).when((exponent >= -4) & (exponent < 16), plain).otherwise(scientific)


def wkt(text: Column) -> Column:
    """Well-known text of a GeoJSON geometry, 2-D; null for other types, no coordinates, a null ordinate, or text that is none."""
    return let(F.from_json(text, "type string, coordinates string"), lambda got: F.when(~got["coordinates"].contains("null"), _wkt(got)))


def _wkt(got: Column) -> Column:
    kind = F.upper(got["type"])

    def at(depth: int) -> Column:
        return F.from_json(F.concat(F.lit('{"c":'), got["coordinates"], F.lit("}")), "c " + "array<" * depth + "string" + ">" * depth)["c"]

    def bracketed(inner: Column, head: str = "") -> Column:
        """head(inner); null if inner is empty."""
        return let(inner, lambda t: F.when(F.length(t) > 0, F.concat(F.lit(f"{head}("), t, F.lit(")"))))

    def joined(items: Column) -> Column:
        return F.array_join(F.array_compact(items), ", ")

    pair = lambda v: F.concat_ws(" ", number_text(v[0]), number_text(v[1]))
    long = lambda line: F.filter(line, lambda v: F.size(v) >= 2)
    line = lambda c: F.array_join(F.transform(long(c), pair), ", ")
    rings = lambda c: joined(F.transform(c, lambda r: bracketed(line(r))))
    return (
        F.when(kind == "POINT", let(at(1), lambda c: F.when(F.size(c) >= 2, F.concat(F.lit("POINT("), pair(c), F.lit(")")))))
        .when(kind == "LINESTRING", bracketed(line(at(2)), "LINESTRING"))
        .when(kind == "POLYGON", bracketed(rings(at(3)), "POLYGON"))
        .when(kind == "MULTIPOINT", bracketed(joined(F.transform(long(at(2)), lambda v: bracketed(pair(v)))), "MULTIPOINT"))
        .when(kind == "MULTILINESTRING", bracketed(rings(at(3)), "MULTILINESTRING"))
        .when(kind == "MULTIPOLYGON", bracketed(joined(F.transform(at(4), lambda p: bracketed(rings(p)))), "MULTIPOLYGON"))
    )


def to_geojson(geom: Column) -> Column:
    """A GeoJSON geometry object as text."""
    lines = F.transform(geom["parts"], lambda p: F.transform(p, lambda r: F.transform(r, lambda v: F.array(v["x"], v["y"]))))
    flat = F.flatten(lines)
    empty = F.lit("[]")
    coordinates = (
        F.when(geom["type"] == "Point", F.to_json(F.flatten(flat)[0]))
        .when(geom["type"] == "LineString", F.to_json(flat[0]))
        .when(geom["type"] == "MultiPoint", F.to_json(F.flatten(flat)))
        .when(geom["type"] == "Polygon", F.to_json(lines[0]))
        .when(geom["type"] == "MultiLineString", F.to_json(flat))
        .when(geom["type"] == "MultiPolygon", F.to_json(lines))
    )
    return F.when(geom["parts"].isNotNull(), F.concat(F.lit('{"type":"'), geom["type"], F.lit('","coordinates":'), F.coalesce(coordinates, empty), F.lit("}")))
