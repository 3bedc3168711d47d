"""Writers: GeoJSON, statistics, tables, checkpoints, the error log."""

from __future__ import annotations

import contextlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import geometry as G
from ..operators import statistics as S
from . import files


def feature_text(df: DataFrame) -> DataFrame:
    """One GeoJSON feature (text) for each row; every column but the geometry and the ordinal is a property."""
    rest = [c for c in df.columns if c not in ("geom", "ordinal")]
    properties = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})
    text = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), F.coalesce(G.to_geojson(F.col("geom")), F.lit("null")), F.lit("}"))
    return df.select(text.alias("value"))


def write_geojson(df: DataFrame, path: str) -> None:
    """One FeatureCollection document: features are written by tasks and their files joined by streaming."""
    spark, parts = df.sparkSession, f"{path}.parts"
    # Every line begins with a comma; the first one is left out when the parts are joined.
    feature_text(df).select(F.concat(F.lit(","), "value")).write.mode("overwrite").text(parts)
    files.concat(spark, parts, path, '{"type":"FeatureCollection","features":[\n', "]}", skip=1)
    files.delete(spark, parts)


def save_layer(df: DataFrame, layer: str, destination: str = "local", folder: str | None = None, places: config.Places | None = None) -> str:
    """Writes one layer (WGS84) as {folder}/{layer}.geojson and returns the path; ValueError on an unknown destination."""
    places = places or config.Places.from_env()
    folders = {"local": places.output, "cloud": places.processed}
    if destination.lower() not in folders:
        raise ValueError(f"unknown destination {destination!r}")
    path = f"{folder or folders[destination.lower()]}/{layer}.geojson"
    write_geojson(df, path)
    return path


def save_all_layers(df: DataFrame, destination: str = "local", places: config.Places | None = None, log=None) -> list[str]:
    """Each layer and combined_network. A layer's failure is raised; the combined file's is logged alone."""
    out = [save_layer(df.where(F.col("layer") == k), k, destination, places=places) for k in config.LAYERS]
    try:
        out.append(save_layer(df, "combined_network", destination, places=places))
    except Exception as e:  # noqa: BLE001
        if log:
            log(f"combined network not saved: {e}")
    return out


def write_canonical(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("layer").parquet(path)


def statistics_json(connected: DataFrame) -> dict:
    """Statistics by layer in configuration order, as they are written."""
    rows = {r.layer: r for r in S.statistics(connected).collect()}  # one row for each layer
    kinds = ("feature_count", "total_connections", "avg_connections")
    return {k: {x: rows[k][x] for x in kinds} | {"geometry_types": dict(rows[k].geometry_types)} for k in config.LAYERS if k in rows}


def write_statistics(connected: DataFrame, path: str) -> dict:
    stats = statistics_json(connected)
    files.write_text(connected.sparkSession, path, json.dumps(stats, indent=2))
    return stats


def save_checkpoint(df: DataFrame, folder: str, layer: str, fingerprint: str) -> None:
    """A layer's result with the fingerprint of the inputs that it came from; the mark is written last."""
    path = f"{folder}/{layer}"
    df.write.mode("overwrite").parquet(path)
    files.write_text(df.sparkSession, f"{path}.fingerprint", fingerprint)


def load_checkpoint(spark: SparkSession, folder: str, layer: str, fingerprint: str | None = None) -> DataFrame | None:
    """A layer's saved result; None where there is none, it can't be read, or came from other inputs."""
    path = f"{folder}/{layer}"
    try:
        if not files.exists(spark, f"{path}.fingerprint"):
            return None
        if fingerprint is not None and files.read_text(spark, f"{path}.fingerprint") != fingerprint:
            return None
        df = spark.read.parquet(path)
        df.limit(1).count()
        return df
    except Exception:  # noqa: BLE001  unreadable is as absent
        return None


def saved_layers(spark: SparkSession, folder: str, fingerprint: str | None = None) -> dict[str, DataFrame]:
    found = {k: load_checkpoint(spark, folder, k, fingerprint) for k in config.LAYERS}
    return {k: df for k, df in found.items() if df is not None}


def clean_checkpoints(spark: SparkSession, folder: str) -> int:
    """Deletes every layer's saved result and the folder if nothing else is in it; returns how many there were."""
    n = sum(files.exists(spark, f"{folder}/{k}") and files.delete(spark, f"{folder}/{k}") for k in config.LAYERS)
    for k in config.LAYERS:
        files.delete(spark, f"{folder}/{k}.fingerprint")
    p, fs = files._path(spark, folder)
    if fs.exists(p) and not fs.listStatus(p):
        fs.delete(p, False)
    return n


def replace_table(df: DataFrame, name: str) -> None:
    """Replaces a table whole. Rows are written to a table beside it, which then takes the name: a write that fails leaves the old table as it was."""
    spark, fresh = df.sparkSession, f"{name}__{uuid.uuid4().hex}"
    try:
        df.write.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def log_rows(messages: DataFrame, folder: str) -> None:
    """Appends a column ``message`` to the error log; its own failure is not raised."""
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    with contextlib.suppress(Exception):
        messages.select(F.lit(now).alias("ts"), "message").write.mode("append").json(folder)


def log_error(spark: SparkSession, folder: str, message: str) -> None:
    """Appends one message to the error log; its own failure is not raised."""
    with contextlib.suppress(Exception):
        log_rows(spark.createDataFrame([(message,)], "message string").coalesce(1), folder)
