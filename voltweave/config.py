"""Layers, radii, limits and places."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layer keys, files, radii, priorities and connection rules of the network model.
RADIUS_HIGH, RADIUS_MEDIUM, RADIUS_LOW = 50.0, 30.0, 10.0
HTA, S_HTA, BT, S_BT = "reseau_hta", "reseau_souterrain_hta", "reseau_bt", "reseau_souterrain_bt"
PS, PE, PG = "postes_source", "postes_electrique", "position_geographique"
TARGET_CRS = "EPSG:2154"


@dataclass(frozen=True)
class Layer:
    name: str
    csv_file: str
    radius: float
    priority: int
    can_connect_to: tuple[str, ...]


LAYERS: dict[str, Layer] = {
    PS: Layer("Source Substations", "poste-source.csv", RADIUS_HIGH, 1, (HTA, S_HTA)),
    PE: Layer("Electrical Substations", "poste-electrique.csv", RADIUS_MEDIUM, 2, (HTA, S_HTA, BT, S_BT)),
    PG: Layer("Electrical Poles", "position-geographique-des-poteaux-hta-et-bt.csv", RADIUS_MEDIUM, 3, (BT, HTA)),
    HTA: Layer("HTA Network", "reseau-hta.csv", RADIUS_MEDIUM, 4, (PS, PE, HTA, S_HTA, BT, S_BT)),
    S_HTA: Layer("Underground HTA Network", "reseau-souterrain-hta.csv", RADIUS_MEDIUM, 4, (PS, PE, S_HTA, HTA, BT, S_BT)),
    BT: Layer("BT Network", "reseau-bt.csv", RADIUS_MEDIUM, 5, (PE, PG, BT, S_BT, S_HTA, HTA)),
    S_BT: Layer("Underground BT Network", "reseau-souterrain-bt.csv", RADIUS_MEDIUM, 5, (PE, PG, S_BT, BT, S_HTA, HTA)),
}
MOST_RADIUS = max(x.radius for x in LAYERS.values())
#: Neighbours kept for a line's end, a substation, a low-voltage layer, anything else.
LIMIT_END, LIMIT_STATION, LIMIT_LOW, LIMIT_OTHER = 2, 100, 5, 20


@dataclass(frozen=True)
class Places:
    """Roots of inputs and outputs: any path that Spark's file systems know."""

    data: str = "../data"
    cloud_data: str = "downloaded/full"
    output: str = "../output"
    processed: str = "processed"
    database: str = "default"

    @classmethod
    def from_env(cls) -> Places:
        d = cls()
        return cls(*(os.environ.get(f"VOLTWEAVE_{k.upper()}", getattr(d, k)) for k in ("data", "cloud_data", "output", "processed", "database")))


def layer_table(spark: SparkSession) -> DataFrame:
    """One row for each layer, in configuration order (pos)."""
    rows = [(k, x.name, x.csv_file, x.radius, x.priority, list(x.can_connect_to), i) for i, (k, x) in enumerate(LAYERS.items())]
    return spark.createDataFrame(rows, "layer string, name string, csv_file string, radius double, priority int, can_connect_to array<string>, pos int")


def mutual_pairs(spark: SparkSession) -> DataFrame:
    """(src_layer, dst_layer): pairs of layers that each name the other."""
    rules = layer_table(spark).select(F.col("layer").alias("src_layer"), F.explode("can_connect_to").alias("dst_layer"))
    back = rules.select(F.col("dst_layer").alias("src_layer"), F.col("src_layer").alias("dst_layer"))
    return rules.join(F.broadcast(back), ["src_layer", "dst_layer"], "left_semi")


def mutual(layer: str) -> list[str]:
    return [x for x in LAYERS[layer].can_connect_to if layer in LAYERS[x].can_connect_to]


def lookup(values: dict, key, kind: str):
    """A constant of the layer as an expression: no join."""
    out = F.lit(None).cast(kind)
    for k, v in values.items():
        out = F.when(key == k, F.array(*map(F.lit, v)).cast(kind) if isinstance(v, list) else F.lit(v).cast(kind)).otherwise(out)
    return out


def radius_of(layer):
    return lookup({k: x.radius for k, x in LAYERS.items()}, layer, "double")


def priority_of(layer):
    return lookup({k: x.priority for k, x in LAYERS.items()}, layer, "int")


def position_of(layer):
    return lookup({k: i for i, k in enumerate(LAYERS)}, layer, "int")


def may_connect(src, dst):
    """Whether the two layers name each other."""
    out = F.lit(False)
    for k in LAYERS:
        out = F.when(src == k, dst.isin(mutual(k))).otherwise(out)
    return out


def positions_may_connect(src, dst):
    """:func:`may_connect` by the layers' positions: one look-up in a constant table."""
    n = len(LAYERS)
    allowed = [b in mutual(a) for a in LAYERS for b in LAYERS]
    return F.array(*map(F.lit, allowed))[src * n + dst]


def limit_of(layer: str, is_end: bool) -> int:
    """:func:`connection_limit` of a layer's name."""
    return LIMIT_END if is_end else LIMIT_STATION if layer.startswith("postes") else LIMIT_LOW if layer.endswith("bt") else LIMIT_OTHER


def connection_limit(layer, is_end):
    point = F.when(layer.startswith("postes"), LIMIT_STATION).when(layer.endswith("bt"), LIMIT_LOW).otherwise(LIMIT_OTHER)
    return F.when(is_end, LIMIT_END).otherwise(point)
