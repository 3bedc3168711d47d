"""Layers from delimited text, and GeoJSON collections."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import geometry as G
from ..operators import schema
from ..operators.ids import layer_ids
from . import files

KEPT = ("id", "layer", "geom", "code_commune", "nom_commune", "original_coordinates")


def read_layer_csv(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Raw rows of a layer's file, all text, with the file's order. ";", UTF-8, quotes doubled inside quotes, line feeds allowed in them."""
    if not files.exists(spark, path):
        raise FileNotFoundError(path)
    raw = spark.read.csv(path, sep=";", header=True, encoding="UTF-8", quote='"', escape='"', multiLine=True)
    if "geo_shape" not in raw.columns:
        raise KeyError(f"{path} has no column geo_shape")
    return raw.withColumn("layer", F.lit(layer)).withColumn("__order", F.monotonically_increasing_id())


def parsed(raw: DataFrame) -> DataFrame:
    """Rows whose geometry parses."""
    return raw.withColumn("geom", G.parse(F.col("geo_shape"))).where(F.col("geom").isNotNull())


def features(raw: DataFrame, with_coordinates: bool = True) -> DataFrame:
    """Rows whose geometry parses, with dense ids in file order, and the columns kept as far as they are there."""
    shaped = parsed(raw)
    if with_coordinates:
        shaped = shaped.withColumn("original_coordinates", G.original_coordinates(F.col("geo_shape")))
    out = layer_ids(shaped, "__order")
    return out.select("ordinal", *[c for c in KEPT if c in out.columns])


def load_layer(spark: SparkSession, layer: str, source: str = "local", places: config.Places | None = None) -> DataFrame:
    """One layer in WGS84. ValueError for an unknown source or a layer without a valid geometry."""
    places = places or config.Places.from_env()
    roots = {"local": places.data, "cloud": places.cloud_data}
    if source.lower() not in roots:
        raise ValueError(f"unknown source {source!r}")
    raw = read_layer_csv(spark, f"{roots[source.lower()]}/{config.LAYERS[layer].csv_file}", layer)
    if parsed(raw).isEmpty():  # ends at the first good row: ids are not made for it
        raise ValueError(f"no valid geometry in layer {layer}")
    return features(raw, source.lower() == "local")


def load_all_layers(spark: SparkSession, source: str = "local", places: config.Places | None = None) -> DataFrame:
    """All layers as one table; the first bad layer fails the load."""
    return union([load_layer(spark, k, source, places) for k in config.LAYERS])


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole documents."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


#: The head of a document, up to the list of features, is looked for in so many lines, of at most so many characters.
HEAD_LINES, HEAD_CHARS = 100, 10_000
#: What monotonically_increasing_id leaves for the row in its partition.
_ROW_BITS = 33


def _head_lines(lines: list[str]) -> int | None:
    """How many first lines end with the opening of the list of features, which is the document's last member."""
    for n in range(1, len(lines) + 1):
        if lines[n - 1].rstrip().endswith("["):
            try:
                members = json.loads("\n".join(lines[:n]) + "]}", object_pairs_hook=list)
            except ValueError:
                continue
            names = [k for k, _ in members] if isinstance(members, list) and all(isinstance(x, tuple) for x in members) else []
            if names.count("features") == 1 and members[-1] == ("features", []):
                return n
    return None


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(position, feature): the features of one document, from 0.

    A document with one feature a line (as the sinks and common tools write) is many tasks' work, after one pass has proved its form: a head, lines
    that are one JSON value each with commas between them, and the closing. Any other document is parsed whole.
    """
    whole = schema.explode_features(read_geojson(spark, path)).select("position", "feature")
    lines = spark.read.text(path, lineSep="\n").select(F.monotonically_increasing_id().alias("row"), "value")
    first = [r[0] for r in lines.select(F.substring("value", 1, HEAD_CHARS)).limit(HEAD_LINES).collect()]
    head = _head_lines(first)
    if head is None:
        return whole
    part, inside = F.shiftright("row", _ROW_BITS), F.col("row").bitwiseAND((1 << _ROW_BITS) - 1)
    body = lines.where(~((part == 0) & (inside < head)))
    white = F.lit(" \t\r")
    bare = F.trim("value", white)
    closing = bare.isin("", "]", "}", "]}")
    leading, trailing = bare.startswith(","), bare.endswith(",")
    core = F.when(leading, F.substr(bare, F.lit(2))).otherwise(F.when(trailing, F.substr(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare))
    end = f"end{uuid.uuid4().hex}"  # no line knows it, so none can close the list itself
    wrapped = F.concat(F.lit('{"features":['), core, F.lit(f'],"{end}":1}}'))
    parsed_line = F.from_json(wrapped, f"features array<string>, {end} int")
    item = parsed_line["features"]
    one = F.coalesce((F.size(F.json_object_keys(wrapped)) == 2) & (F.size(item) == 1) & (parsed_line[end] == 1), F.lit(False))
    row_if = lambda c, f: f(F.when(c, F.col("row")))
    seen = body.groupBy(part.alias("part")).agg(
        F.max(inside).alias("last"), F.count_if(~closing).alias("n"), F.count_if(~closing & ~one).alias("bad"), F.count_if(~closing & leading).alias("leading"), F.count_if(~closing & trailing).alias("trailing"),
        row_if(~closing, F.min).alias("from"), row_if(~closing, F.max).alias("to"), row_if(closing, F.min).alias("closes"),
        row_if(~closing & ~leading, F.max).alias("no_leading"), row_if(~closing & ~trailing, F.min).alias("no_trailing"),
        F.sort_array(F.collect_list(F.when(closing & (bare != ""), F.struct("row", bare.alias("text"))))).alias("end"),
    ).orderBy("part").collect()  # fmt: skip  # a row for each partition of the file
    n, first_row = sum(r.n for r in seen), min((r["from"] for r in seen if r.n), default=None)
    last_row, closes = max((r.to for r in seen if r.n), default=None), min((r.closes for r in seen if r.closes is not None), default=None)
    by_leading = sum(r.leading for r in seen) == n - 1 and not sum(r.trailing for r in seen) and max((r.no_leading for r in seen if r.no_leading is not None), default=None) == first_row
    by_trailing = sum(r.trailing for r in seen) == n - 1 and not sum(r.leading for r in seen) and min((r.no_trailing for r in seen if r.no_trailing is not None), default=None) == last_row
    closed = "".join(x.text for r in seen for x in r.end) == "]}"
    if not n or any(r.bad for r in seen) or not closed or closes is None or closes < last_row or not (by_leading or by_trailing):
        return whole
    # Features lie without gaps between head and closing: a row's position is that in its partition and the features before.
    base, before = [0] * (max(r.part for r in seen) + 1), 0
    for r in seen:
        base[r.part], before = before - (head if r.part == 0 else 0), before + r.n
    position = (F.array(*map(F.lit, base))[part.cast("int")] + inside).cast("int")
    return body.where(~closing).select(position.alias("position"), item[0].alias("feature"))
