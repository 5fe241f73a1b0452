"""Contiguous shards of near equal size, from prefix sums of sizes over all rows.

Only DataFrame functions. Rows are put in order of their key by ranges; each range partition's bytes and rows are added
up, the totals are summed in order, and with the running sum inside a partition every row knows how many bytes
stand before it. A row belongs to the shard in which its middle byte falls, so a shard differs from its equal share by
at most half of the row at either end.

A null text has no bytes and a null key comes first. Rows with equal keys are ordered by size and checksum, then by
arrival; equal rows may fill several partitions. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialize


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, `size` in bytes plus 1, `text_crc32`, `shard` from 0 and `slot`, the row's place in its shard."""
    if shards < 1:
        raise ValueError("there must be a shard")
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    sized = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_arrival"),
    )
    order = ["_key", "size", "text_crc32", "_arrival"]
    ranged = materialize(sized.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))

    # One row per partition.
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )

    inside = Window.partitionBy("_part").orderBy(*order)
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.col("_bytes_before") + F.col("_running") - F.col("size")
    middle = 2 * start + F.col("size")
    placed = (
        ranged.withColumns({"_running": running, "_row": F.row_number().over(inside) - 1})
        .join(F.broadcast(offsets), "_part")
        .select(
            F.col("_key"),
            "size",
            "text_crc32",
            F.least(F.floor(middle * shards / (2 * F.col("_total"))), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("_rows_before") + F.col("_row")).alias("_row"),
        )
    )
    placed = materialize(placed)
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("_row").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )
