"""Ordinal identifiers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16


def with_ordinal(df: DataFrame, by: str, order: str, name: str = "ordinal", bits: int = BUCKET_BITS) -> DataFrame:
    """``df`` with the rank (from 1) of each row within ``by``, by the long column ``order``.

    Rows are ranked inside buckets of 2 ** bits consecutive order values and shifted by the counts of the buckets
    before, so that a large ``by`` group is many tasks' work. Only bucket counts are windowed over whole groups.
    """
    cut = df.withColumn("__bucket", F.shiftright(F.col(order).cast("long"), bits))
    counts = cut.groupBy(by, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(by, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(by, "__bucket").orderBy(order))
    out = cut.withColumn("__in", inside).join(counts, [by, "__bucket"])
    return out.withColumn(name, F.col("__before") + F.col("__in").cast("long")).drop("__bucket", "__in", "__before")


def layer_ids(df: DataFrame, order: str) -> DataFrame:
    """``df`` with id = layer_1, layer_2, ... in ``order`` within each layer, and the ordinal."""
    return with_ordinal(df, "layer", order).withColumn("id", F.concat_ws("_", "layer", F.col("ordinal").cast("string")))
