"""Report of sources that stayed silent for longer than a timeout."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numbers import slot_of
from tickloom.schema import micros


def source_silence(frames: DataFrame, timeout: timedelta) -> DataFrame:
    """Gaps between consecutive arrivals of one source that exceed the timeout.

    Two arrivals more than a timeout apart never share a slot of that length, so first and last
    arrival per slot are enough. Only those small rows are ordered per source; a busy source
    costs no more than a quiet one.
    """
    width = micros(timeout)
    if width <= 0:
        raise ValueError("the timeout must be positive")
    arrivals = frames.select("source", F.unix_micros("ingest_ts").alias("t"))
    slots = arrivals.groupBy("source", slot_of(F.col("t"), width).alias("slot")).agg(
        F.min("t").alias("first"), F.max("t").alias("last")
    )
    by_time = Window.partitionBy("source").orderBy("slot")
    gaps = slots.withColumn("before", F.lag("last").over(by_time))
    return gaps.where(F.col("first") - F.col("before") > width).select(
        "source",
        F.timestamp_micros("before").alias("silent_from"),
        F.timestamp_micros("first").alias("silent_until"),
        (F.col("first") - F.col("before")).alias("gap_us"),
    )


def open_silence(frames: DataFrame, registry: DataFrame, timeout: timedelta, until: datetime) -> DataFrame:
    """Enabled sources that are silent at the instant `until`, for longer than the timeout.

    A source that never sent has a null `silent_from`. Names are compared without regard to case.
    """
    if micros(timeout) <= 0:
        raise ValueError("the timeout must be positive")
    arrived = frames.where(F.col("ingest_ts") <= F.lit(until))
    last = arrived.groupBy(F.lower("source").alias("_name")).agg(F.max("ingest_ts").alias("silent_from"))
    live = registry.where("enabled").select("name", F.lower("name").alias("_name"))
    gap = F.unix_micros(F.lit(until)) - F.unix_micros("silent_from")
    silent = live.join(last, "_name", "left").withColumn("gap_us", gap)
    return silent.where(F.col("gap_us").isNull() | (F.col("gap_us") > micros(timeout))).select(
        F.col("name").alias("source"), "silent_from", "gap_us"
    )
