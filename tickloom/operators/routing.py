"""Placement of symbols on shards by a stable hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.hashing import fnv1a64, shard_of
from tickloom.session import BROADCAST_ROWS, materialize


def symbol_shards(ticks: DataFrame, shards: int) -> DataFrame:
    """One row per symbol: hash, shard and tick count. The hash runs once per symbol."""
    symbols = ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("ticks"))
    return symbols.withColumns({"hash": fnv1a64(F.col("symbol")), "shard": shard_of(F.col("symbol"), shards)})


def with_shard(ticks: DataFrame, shards: int) -> DataFrame:
    """Add the shard number in place, with no shuffle."""
    return ticks.withColumn("shard", shard_of(F.col("symbol"), shards))


def with_shard_per_symbol(ticks: DataFrame, shards: int) -> DataFrame:
    """The same, with the hash run once per symbol: for ticks that are stored, as their symbols are read first.

    Symbols beyond the bound of a broadcast are hashed in place, row by row, so no symbol's ticks are brought together.
    """
    symbols = materialize(ticks.select("symbol").distinct())
    if symbols.count() > BROADCAST_ROWS:
        return with_shard(ticks, shards)
    # Nulls meet, so that a missing symbol stays in sight: its shard is an error.
    placed = F.broadcast(with_shard(symbols, shards).withColumnRenamed("symbol", "_symbol"))
    return ticks.join(placed, F.col("symbol").eqNullSafe(F.col("_symbol"))).select(*ticks.columns, "shard")


def shard_counts(ticks: DataFrame, shards: int) -> DataFrame:
    """Ticks per shard; counted per symbol first, so the hash runs once per symbol."""
    per_symbol = symbol_shards(ticks, shards)
    return per_symbol.groupBy("shard").agg(
        F.sum("ticks").alias("received"), F.count(F.lit(1)).alias("symbols")
    )


def route(ticks: DataFrame, shards: int) -> DataFrame:
    """Lay ticks out by shard, in arrival order within a symbol.

    The rebalance hint lets the engine cut a shard that holds far more rows than the others, so a
    hot symbol takes several tasks. This is a layout only: removing repeats partitions by the whole
    key, not by shard.
    """
    placed = with_shard(ticks, shards).hint("rebalance", F.col("shard"))
    return placed.sortWithinPartitions("shard", "symbol", "ingest_ts", "arrival_seq")
