"""GeoJSON files into tables: one table for each file, replaced whole, with the schema the file's features show."""

from __future__ import annotations

import time
import traceback
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import values as V
from ..operators import schema as S
from ..sources import files, layers, sinks


def now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


def file_table(spark: SparkSession, path: str) -> str:
    return spark.range(1).select(V.table_name(F.lit(path))).first()[0]


def load_file(spark: SparkSession, path: str, places: config.Places) -> dict:
    """Result of one file: file, status, rows_processed, error, processing_time. Errors are reported, not raised."""
    start = time.time()
    out = {"file": path, "status": "failed", "rows_processed": 0, "error": None, "processing_time": 0.0}
    try:
        features = layers.read_features(spark, path)
        n, nulls, others, found = S.inspect(features)
        if not n:
            raise ValueError(f"no features in {path}")
        if nulls:
            raise ValueError(f"a null feature in {path}")
        name = f"{places.database}.{file_table(spark, path)}"
        sinks.replace_table(S.flatten(features, S.columns(found)), name)
        out |= {"status": "success", "rows_processed": spark.table(name).count()}
        if others:
            said = F.concat(F.lit(f"{path}: dropped, no object, position "), F.col("position").cast("string"), F.lit(": "), F.substring("feature", 1, 200))
            sinks.log_rows(S.not_objects(features).select(said.alias("message")), f"{places.processed}/error_log")
    except Exception as e:  # noqa: BLE001
        out["error"] = str(e)
        sinks.log_error(spark, f"{places.processed}/error_log", f"{path}: {e}\n{traceback.format_exc()}")
    return out | {"processing_time": time.time() - start}


def summary(results: DataFrame) -> DataFrame:
    """Over results of files: rows loaded, time as "0.00 seconds", and "succeeded/all"."""
    ok = F.col("status") == "success"
    rows = F.coalesce(F.sum(F.when(ok, F.col("rows_processed"))), F.lit(0)).cast("long")
    seconds = F.format_string("%.2f seconds", F.coalesce(F.sum("processing_time"), F.lit(0.0)))
    rate = F.concat(F.count_if(ok).cast("string"), F.lit("/"), F.count("*").cast("string"))
    return results.agg(rows.alias("total_rows_processed"), seconds.alias("total_processing_time"), rate.alias("success_rate"))


def run(spark: SparkSession, places: config.Places | None = None, contains: str = "reseau_souterrain_hta") -> dict:
    """All wanted files of the processed folder. Always a dict: with message if there are none, with error if it broke."""
    places = places or config.Places.from_env()
    out: dict = {"processed_files": [], "failed_files": [], "total_files": 0, "start_time": now(), "folder": places.processed, "database": places.database}
    try:
        found = files.geojson_files(spark, places.processed, contains)
        out["total_files"] = len(found)
        if not found:
            return out | {"message": "No GeoJSON files found in the specified folder"}
        for path in found:
            result = load_file(spark, path, places)
            out["processed_files" if result["status"] == "success" else "failed_files"].append(result)
        rows = [(r["file"], r["status"], r["rows_processed"], r["error"], r["processing_time"]) for r in out["processed_files"] + out["failed_files"]]
        total = summary(spark.createDataFrame(rows, "file string, status string, rows_processed bigint, error string, processing_time double")).first()
        if out["failed_files"]:
            counts = f"{len(out['processed_files'])} files loaded, {len(out['failed_files'])} not, {total.total_rows_processed} rows"
            sinks.log_error(spark, f"{places.processed}/error_log", counts)
        return out | {"end_time": now(), "summary": total.asDict()}
    except Exception as e:  # noqa: BLE001
        sinks.log_error(spark, f"{places.processed}/error_log", f"{e}\n{traceback.format_exc()}")
        return out | {"error": str(e), "status": "error"}


def health(spark: SparkSession, places: config.Places | None = None) -> dict:
    places = places or config.Places.from_env()
    try:
        spark.sql("SELECT 1").collect()
        files.exists(spark, places.processed)
        return {"status": "healthy", "database": places.database, "folder": places.processed, "timestamp": now()}
    except Exception as e:  # noqa: BLE001
        return {"status": "unhealthy", "error": str(e)}


def describe(spark: SparkSession, places: config.Places | None = None) -> dict:
    places = places or config.Places.from_env()
    found = files.sample_files(spark, places.processed)
    return {"status": "ok", "config": {"folder": places.processed, "database": places.database}, "sample_files": found, "file_count": len(found)}
