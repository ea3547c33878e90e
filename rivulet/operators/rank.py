"""Row numbers within groups that stay correct and balanced when one group is huge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import settle


def top_ranked(df: DataFrame, keys: list[str], order: list[Column], name: str, keep: int) -> DataFrame:
    """The first ``keep`` rows of each group; map tasks already drop everything past ``keep``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= keep)


def sliced_rank(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Number rows per group without ever holding a group in one task.

    Rows are range-partitioned by group and order, so a big group spans many slices. Each row is
    numbered in its slice, and the sizes of the earlier slices of its group are added. The slice id is
    written down with the row, so both branches below agree on it whatever happens to executors.
    With no keys the whole table is one group.
    """
    by_key = [F.col(f"`{k}`") for k in keys]
    sliced = settle(
        df.repartitionByRange(*by_key, *order).withColumn("_slice", F.spark_partition_id()), "rank"
    )
    groups = [*keys, "_slice"]
    sizes = sliced.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(f"`{g}`").alias(f"_{g}") for g in groups],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy(*groups).orderBy(*order)
    match = F.lit(True)
    for g in groups:
        match = match & F.col(f"`{g}`").eqNullSafe(F.col(f"`_{g}`"))
    return (
        sliced.withColumn(name, F.row_number().over(within))
        .join(offsets, match)
        .withColumn(name, F.col(name) + F.col("_offset"))
        .select(*df.columns, name)
    )
