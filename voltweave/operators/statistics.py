"""Statistics of a connected network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def layer_statistics(connected: DataFrame) -> DataFrame:
    """feature_count, total_connections and avg_connections of each layer."""
    n = F.coalesce(F.sum(F.size("connections").cast("long")), F.lit(0).cast("long"))
    return connected.groupBy("layer").agg(F.count("*").alias("feature_count"), n.alias("total_connections"), (n / F.count("*")).alias("avg_connections"))


def averaged(counts: DataFrame) -> DataFrame:
    """:func:`layer_statistics` of layers that are counted already."""
    return counts.withColumn("avg_connections", F.col("total_connections") / F.col("feature_count"))


def total_of_layers(counts: DataFrame) -> DataFrame:
    """:func:`totals` of layers that are counted already."""
    of = lambda k: F.coalesce(F.sum(k), F.lit(0).cast("long")).alias(k)
    return _totals(counts.agg(of("feature_count"), of("total_connections")).withColumnRenamed("feature_count", "total_features"))


def geometry_types(features: DataFrame) -> DataFrame:
    """How many features of each geometry type a layer has; null geometries are skipped."""
    return features.where(F.col("geom.type").isNotNull()).groupBy("layer", F.col("geom.type").alias("geometry_type")).agg(F.count("*").alias("n"))


def statistics(connected: DataFrame) -> DataFrame:
    """One row for each layer, with the geometry types as a map."""
    types = geometry_types(connected).groupBy("layer").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("geometry_type", "n")))).alias("geometry_types"))
    out = layer_statistics(connected).join(types, "layer", "left")
    return out.withColumn("geometry_types", F.coalesce("geometry_types", F.expr("cast(map() as map<string,bigint>)")))


def totals(connected: DataFrame) -> DataFrame:
    """Over all layers: features, connections, and connections for each feature (0 where there is none)."""
    n = F.coalesce(F.sum(F.size("connections").cast("long")), F.lit(0).cast("long"))
    return _totals(connected.agg(F.count("*").alias("total_features"), n.alias("total_connections")))


def _totals(sums: DataFrame) -> DataFrame:
    return sums.withColumn("avg_connections", F.when(F.col("total_features") > 0, F.col("total_connections") / F.nullif(F.col("total_features"), F.lit(0))).otherwise(0.0))


def layer_order(layers: DataFrame) -> DataFrame:
    """Layers by priority, those of one priority in configuration order."""
    return layers.select("layer", "priority", config.position_of(F.col("layer")).alias("pos")).orderBy("priority", "pos")
