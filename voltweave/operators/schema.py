"""Schema inference and flattening of GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import values as V

FIXED = (("feature_id", "STRING"), ("feature_type", "STRING"), ("geometry_json", "JSON"), ("geometry", "GEOGRAPHY"))
PROPERTY_TYPES = ("STRING", "BOOLEAN", "INTEGER", "FLOAT", "JSON", "STRING REPEATED")
SPARK_TYPES = {"STRING": "string", "BOOLEAN": "boolean", "INTEGER": "bigint", "FLOAT": "double", "JSON": "string", "GEOGRAPHY": "string", "STRING REPEATED": "array<string>"}


def explode_features(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with position (from 0) and feature (JSON text) in place of the collection's text."""
    features = F.from_json(F.col(text), "features array<string>")["features"]
    rest = [c for c in documents.columns if c != text]
    return documents.select(*rest, F.posexplode(features).alias("position", "feature"))


def property_values(features: DataFrame, position: str = "position", feature: str = "feature") -> DataFrame:
    """(position, key, value): each property of each feature; properties that are no object have none."""
    spark = features.sparkSession
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    props = F.variant_get(F.try_parse_json(feature), "$.properties", "variant")
    shaped = features.select(F.col(position).alias("position"), props.alias("p")).where(F.schema_of_variant("p").startswith("OBJECT"))
    return spark.sql("SELECT t.position, e.key, e.value FROM {t} AS t, LATERAL variant_explode(t.p) AS e", t=shaped)


def _first_type() -> Column:
    """An aggregate: the place in PROPERTY_TYPES of the type that the first value has. A number, so that values are hashed by key and not sorted."""
    kind = V.property_type(F.schema_of_variant("value"))
    return F.min_by(F.array_position(F.array(*map(F.lit, PROPERTY_TYPES)), kind).cast("int"), "position")


def _type_at(place: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, PROPERTY_TYPES)), place)


def infer_types(values: DataFrame) -> DataFrame:
    """(key, type): the type that the first occurrence of each key has."""
    return values.groupBy("key").agg(_first_type().alias("place")).select("key", _type_at(F.col("place")).alias("type"))


def infer_schema(features: DataFrame) -> list[tuple[str, str, str]]:
    """(raw key or "", column, type): fixed columns, then properties by raw name. A few hundred rows reach the driver.

    Raises ValueError where two properties, or one and a fixed column, get the same name.
    """
    return columns(sorted((r.key, r.type) for r in infer_types(property_values(features)).collect()))


def inspect(features: DataFrame, position: str = "position", feature: str = "feature") -> tuple[int, int, int, list[tuple[str, str]]]:
    """Of one pass over the features: how many there are, how many are null and how many are no objects, and (key, type) of :func:`infer_types` by key."""
    spark, text = features.sparkSession, F.col(feature)
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    parsed = features.select(F.col(position).alias("position"), text.alias("text"), F.explode(F.array(F.try_parse_json(text))).alias("v"))
    null = F.coalesce(F.col("text"), F.lit("null")) == "null"
    shaped = parsed.select("position", null.alias("null"), (~_is_object(F.col("text"), F.col("v"))).alias("other"), F.variant_get("v", "$.properties", "variant").alias("p"))
    # A row for each property or item (an item has no key), and one for any other feature.
    each = spark.sql("SELECT t.*, coalesce(e.pos, 0) = 0 AS first, e.key, e.value FROM {t} AS t, LATERAL variant_explode_outer(t.p) AS e", t=shaped)
    first = F.col("first")
    counts = each.groupBy("key").agg(F.count_if(first).alias("n"), F.count_if(first & F.col("null")).alias("nulls"), F.count_if(first & F.col("other")).alias("others"), _first_type().alias("place"))
    rows = counts.select("*", _type_at(F.col("place")).alias("type")).collect()
    return sum(r.n for r in rows), sum(r.nulls for r in rows), sum(r.others for r in rows), sorted((r.key, r.type) for r in rows if r.key is not None)


def columns(found: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """:func:`infer_schema` of (key, type)."""
    out = [("", name, kind) for name, kind in FIXED] + [(k, k.translate(str.maketrans("- .", "___")), t) for k, t in found]
    seen: dict[str, str] = {}
    for raw, name, _ in out:
        if name.lower() in seen:
            raise ValueError(f"columns collide: {seen[name.lower()] or name!r} and {raw!r} are both {name!r}")
        seen[name.lower()] = raw
    return out


def _is_object(text: Column, parsed: Column) -> Column:
    """Whether a text, parsed, is an object: cheaper than its schema."""
    return F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith("{") & parsed.isNotNull(), F.lit(False))


def not_objects(features: DataFrame, feature: str = "feature") -> DataFrame:
    """The features that :func:`flatten` drops."""
    return features.where(~F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(feature))).startswith("OBJECT"), F.lit(False)))


def flatten(features: DataFrame, schema: list[tuple[str, str, str]], position: str = "position", feature: str = "feature") -> DataFrame:
    """One row for each feature: fixed columns, and one for each property of ``schema``. What is no object is dropped (see :func:`not_objects`)."""
    f, pos, v = F.col(feature), F.col(position), F.col("__once.parsed")
    # A generated column is parsed once: a filter on it, or columns of it, do not parse again.
    once = F.array(F.struct(F.try_parse_json(f).alias("parsed"), F.get_json_object(f, "$.geometry").alias("geometry")))
    out = features.select("*", F.explode(once).alias("__once")).where(_is_object(f, v))
    out = out.withColumn("__geometry", F.explode(F.array(V.some_geometry(F.col("__once.geometry")))))
    geometry = F.col("__geometry")
    columns = [V.feature_id(f, pos, v).alias("feature_id"), V.feature_type(f, v).alias("feature_type"), geometry.alias("geometry_json"), G.wkt(geometry).alias("geometry")]
    for raw, name, kind in schema[len(FIXED) :]:
        path = "$.properties[" + "'" + raw.replace("\\", "\\\\").replace("'", "\\'") + "'" + "]"
        value = F.try_variant_get(v, path, "variant")
        if kind == "JSON":
            value = F.when(~F.is_variant_null(value), F.to_json(value))
        else:
            value = F.try_variant_get(v, path, SPARK_TYPES[kind])
        columns.append(value.alias(name))
    return out.select(*columns)
