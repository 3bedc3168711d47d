"""The network pipeline: load, connect, save, report."""

from __future__ import annotations

import hashlib
import os
import resource
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import crs
from ..functions.values import byte_text
from ..operators import connect as C
from ..operators import statistics as S
from ..sources import files, layers, sinks


def fingerprint(spark: SparkSession, source: str, places: config.Places) -> str:
    """Of the input files: path, length and time of change."""
    root = places.data if source.lower() == "local" else places.cloud_data
    parts = []
    for x in config.LAYERS.values():
        p, fs = files._path(spark, f"{root}/{x.csv_file}")
        status = fs.getFileStatus(p)
        parts.append(f"{p}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def join_frame(features: DataFrame) -> DataFrame:
    """Features with their geometry in the plane of the join (Web Mercator), straight from WGS84."""
    return features.withColumn("geom", crs.reproject(F.col("geom"), crs.web_mercator))


def connections(features: DataFrame) -> DataFrame:
    """``features`` (WGS84) with connections, all layers in one job."""
    flat = join_frame(features.select("id", "layer", "ordinal", "geom"))
    return C.adjacency(features, C.top_connections(C.distance_join(flat)))


def process(spark: SparkSession, features: DataFrame, folder: str, mark: str, resume: bool | str = True, log=print) -> DataFrame:
    """Connected features. Layers saved from the same inputs are taken as they are ("always": from any inputs).

    If the job fails, layers are tried one by one; one that fails has no connections and is not saved.
    """
    saved = sinks.saved_layers(spark, folder, None if resume == "always" else mark) if resume else {}
    pending = [k for k in config.LAYERS if k not in saved]
    parts = list(saved.values())
    if pending:
        done, fresh = connections(features), f"{folder}/.fresh"
        try:  # all layers are one job; what it wrote is then dealt to the layers
            done.where(F.col("layer").isin(pending)).write.mode("overwrite").parquet(fresh)
            done = spark.read.parquet(fresh)
        except Exception as e:  # noqa: BLE001
            log(f"layers are tried one by one: {e}")
        for k in pending:
            try:
                sinks.save_checkpoint(done.where(F.col("layer") == k), folder, k, mark)
                parts.append(sinks.load_checkpoint(spark, folder, k))
            except Exception as e:  # noqa: BLE001
                log(f"layer {k} failed: {e}")
                parts.append(features.where(F.col("layer") == k).withColumn("connections", F.array().cast("array<string>")))
        files.delete(spark, fresh)
    return layers.union(parts)


def run(spark: SparkSession, source: str = "local", destination: str = "local", places: config.Places | None = None, resume: bool | str = True, log=print) -> bool:
    """The whole pipeline; True if it ended well."""
    places = places or config.Places.from_env()
    start, steps = time.time(), {}
    report: dict = {"start_time": datetime.now(timezone.utc).isoformat()}

    def step(name: str, f):
        t = time.time()
        out = f()
        steps[name] = time.time() - t
        return out

    try:
        features = step("load", lambda: layers.load_all_layers(spark, source, places))
        mark = fingerprint(spark, source, places)
        connected = step("connect", lambda: process(spark, features, f"{places.output}/individual", mark, resume, log))
        out = places.output if destination.lower() == "local" else places.processed

        def save() -> dict:
            sinks.save_all_layers(connected, destination, places, log)
            return sinks.write_statistics(connected, f"{out}/network_statistics.json")

        stats = step("save", save)
        final, whole = (int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE"), os.sysconf("SC_PHYS_PAGES") * os.sysconf("SC_PAGE_SIZE")) if os.path.exists("/proc/self/statm") else (0, 1)
        peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024
        report |= {"end_time": datetime.now(timezone.utc).isoformat(), "total_duration": time.time() - start, "step_times": steps, "peak_memory": peak, "final_memory": final, "memory_percent": 100 * final / whole}
        report |= totals_of(stats)
        log(report_text(report))
        return True
    except Exception as e:  # noqa: BLE001
        log(f"pipeline failed: {e}")
        return False


def totals_of(stats: dict) -> dict:
    """The report's counts, from the statistics of layers. Geometry collections keep their row and have no connections."""
    total, found = sum(x["feature_count"] for x in stats.values()), sum(x["total_connections"] for x in stats.values())
    collections = sum(x["geometry_types"].get("GeometryCollection", 0) for x in stats.values())
    return {"layers_count": len(stats), "geometry_collections": collections, "total_features": total, "total_connections": found, "avg_connections_per_feature": found / total if total else 0}


def report_text(r: dict) -> str:
    lines = [f"start {r['start_time']}", f"end {r['end_time']}", f"total {r['total_duration']:.2f} seconds", *(f"  {k}: {v:.2f}s" for k, v in r["step_times"].items())]
    lines += [f"peak memory {byte_text(r['peak_memory'])}", f"final memory {byte_text(r['final_memory'])} ({r['memory_percent']:.1f}%)", f"layers {r['layers_count']}", f"geometry collections, left unconnected {r['geometry_collections']:,}", f"features {r['total_features']:,}", f"connections {r['total_connections']:,}", f"connections for each feature {r['avg_connections_per_feature']:.2f}"]
    return "\n".join(lines)


def totals(connected: DataFrame) -> DataFrame:
    return S.totals(connected)


def main(args: list[str]) -> int:
    """``python -m voltweave.plans.network [source] [destination]``"""
    spark = SparkSession.builder.appName("voltweave").getOrCreate()
    return 0 if run(spark, *(args[:2] or ["local"])) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
