"""Feed registry: which sources are live and which frame format each one sends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.formats import format_names
from tickloom.session import broadcast_if_small

REGISTRY_DDL = "name string, format string, url string, enabled boolean"


def check_registry(registry: DataFrame) -> int:
    """Raise on a bad enabled row and return the number of enabled rows.

    Enabled names must be present and differ without regard to case; their format must be
    registered. Disabled rows are not looked at.
    """
    live = registry.where("enabled")
    name = F.lower("name")
    blank = F.coalesce(F.length(F.regexp_replace("name", r"\s", "")) == 0, F.lit(True))
    known = F.coalesce(F.col("format").isin(format_names()), F.lit(False))
    per_name = live.groupBy(name.alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(blank.cast("int")).alias("blank"),
        F.min(F.when(~known, F.coalesce("format", F.lit("NULL")))).alias("unknown"),
    )
    found = per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.max("blank").alias("blank"),
        F.min(F.when((F.col("n") > 1) & (F.col("blank") == 0), F.col("key"))).alias("repeated"),
        F.min("unknown").alias("unknown"),
    ).first()
    problems = []
    if found["blank"]:
        problems.append("an enabled source has an empty name")
    if found["repeated"] is not None:
        problems.append(f"source name {found['repeated']!r} is enabled more than once")
    if found["unknown"] is not None:
        problems.append(f"unknown frame format: {found['unknown']!r}")
    if problems:
        raise ValueError("; ".join(problems))
    return found["rows"]


def with_registered_format(frames: DataFrame, registry: DataFrame) -> DataFrame:
    """Keep frames of enabled sources and add their `format`."""
    return tag_frames(frames, registry).where(F.col("skipped").isNull()).drop("skipped")


def tag_frames(frames: DataFrame, registry: DataFrame) -> DataFrame:
    """All frames with their `format`, and why a frame is `skipped`: its source is "disabled" or "unlisted".

    Names are compared without regard to case, as the registry is checked. A name that is enabled once and disabled
    elsewhere is enabled.
    """
    return join_registry(frames, registry, check_registry(registry))


def join_registry(frames: DataFrame, registry: DataFrame, enabled: int) -> DataFrame:
    """The same for a registry that was checked before; `enabled` is its number of enabled rows."""
    names = registry.where(F.col("name").isNotNull()).groupBy(F.lower("name").alias("_name")).agg(
        F.max(F.when(F.col("enabled"), F.col("format"))).alias("format")
    )
    known = names.withColumn("_listed", F.lit(True))
    joined = frames.withColumn("_name", F.lower("source")).join(broadcast_if_small(known, enabled), "_name", "left")
    skipped = F.when(F.col("_listed").isNull(), "unlisted").when(F.col("format").isNull(), "disabled")
    return joined.withColumn("skipped", skipped).drop("_name", "_listed")
