"""Names and JSON values of loaded documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: Column) -> Column:
    """A property's column name: "-", " " and "." become "_"; case is kept."""
    return F.translate(name, "- .", "___")


def table_name(path: Column) -> Column:
    """A file's table name: last part of the path, without its last extension, "-" and " " as "_", lower case."""
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    stem = F.when(base.rlike(r"^.+\.[^.]*$"), F.regexp_extract(base, r"^(.+)\.[^.]*$", 1)).otherwise(base)
    return F.lower(F.translate(stem, "- ", "__"))


def wanted_file(path: Column, contains: str = "reseau_souterrain_hta", suffix: str = ".geojson") -> Column:
    return path.contains(contains) & path.endswith(suffix)


def nested(text: Column, path: str, default: str | None = None) -> Column:
    """The value at a dotted path of a JSON text."""
    return F.coalesce(F.get_json_object(text, "$." + path), F.lit(default))


def feature_id(feature: Column, position: Column, parsed: Column | None = None) -> Column:
    """Text of "id"; an explicit null is "None"; a missing one is feature_ and the position from 0. ``parsed``: the feature as a variant, where it is at hand."""
    whole = F.try_parse_json(feature) if parsed is None else parsed
    v = F.variant_get(whole, "$.id", "variant")
    kind = F.schema_of_variant(v)
    plain = F.try_variant_get(whole, "$.id", "string")
    boolean = F.when(plain == "true", "True").otherwise("False")
    return F.when(v.isNull(), F.concat(F.lit("feature_"), position.cast("string"))).when(F.is_variant_null(v), "None").when(kind == "BOOLEAN", boolean).otherwise(plain)


def feature_type(feature: Column, parsed: Column | None = None) -> Column:
    """Text of "type"; "Feature" where it is missing, null where it is null. ``parsed``: as for :func:`feature_id`."""
    v = F.variant_get(F.try_parse_json(feature) if parsed is None else parsed, "$.type", "variant")
    return F.when(v.isNull(), "Feature").when(F.is_variant_null(v), None).otherwise(F.get_json_object(feature, "$.type"))


def geometry_json(feature: Column) -> Column:
    """Text of "geometry", compact and in its own key order; null where it is missing or empty."""
    return some_geometry(F.get_json_object(feature, "$.geometry"))


def some_geometry(text: Column) -> Column:
    """The text of "geometry"; null where it is empty."""
    return F.when(~text.isin("{}", "null", "[]", "", "false", "0"), text)


def property_type(kind: Column) -> Column:
    """Column type by a JSON value's type: STRING, BOOLEAN, INTEGER, FLOAT, JSON, and STRING REPEATED for lists of text."""
    return (
        F.when(kind.isin("VOID", "STRING"), "STRING")
        .when(kind == "BOOLEAN", "BOOLEAN")
        .when(kind == "BIGINT", "INTEGER")
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL") | (kind == "FLOAT"), "FLOAT")
        .when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), "STRING REPEATED")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), "JSON")
        .otherwise("STRING")
    )


def byte_text(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024.0:
            return f"{n:.2f} {unit}"
        n /= 1024.0
    return f"{n:.2f} TB"
