"""Places of rows in an order, per group, without bringing a group together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import broadcast_if_small, scratch_path


def number_rows(rows: DataFrame, group: list[str], order: list[str], name: str = "_pos") -> DataFrame:
    """Rows with their place from 0 in their group, in the given order; group columns hold no nulls.

    Rows are sorted by ranges and stored with a number made of the partition and the place in it. A group's places then
    follow from the number of its rows in each partition, a table of one row per partition and group that meet.
    """
    spark = rows.sparkSession
    by = [*group, *order]
    path = scratch_path(spark, "numbered")
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    counts = stored.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_own"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_own").over(before), F.lit(0)) - F.col("_first")
    offsets_path = scratch_path(spark, "offsets")
    counts.select("_part", *group, offset.alias("_offset")).write.parquet(offsets_path)
    offsets = spark.read.parquet(offsets_path)
    placed = stored.join(broadcast_if_small(offsets, offsets.count()), ["_part", *group])
    return placed.select(*rows.columns, (F.col("_at") + F.col("_offset")).alias(name))
