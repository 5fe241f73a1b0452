"""Raw frames: one message per row, with its source, arrival instant and arrival number."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import FRAME_SCHEMA


def read_frames(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Stored frames, with the schema given, not inferred."""
    return spark.read.schema(FRAME_SCHEMA).format(file_format).load(path)


def read_line_frames(spark: SparkSession, path: str, source: str, arrived: Column | datetime | None = None) -> DataFrame:
    """Text files of one source, one frame per line.

    `arrived` is the instant of arrival, as a value or an expression over `value` and `_metadata`; without it a file's
    time stands for its lines' arrival, which suits files that are read soon after they were written.
    """
    lines = spark.read.text(path)
    return _as_frames(lines, source, "value", arrived, "_metadata.file_modification_time")


def read_file_frames(spark: SparkSession, path: str, source: str, arrived: Column | datetime | None = None) -> DataFrame:
    """Files of one source, each one frame; the file's time is its arrival unless `arrived` says otherwise."""
    files = spark.read.format("binaryFile").load(path)
    return _as_frames(files, source, "content", arrived, "modificationTime")


def _as_frames(rows: DataFrame, source: str, frame: str, arrived: Column | datetime | None, file_time: str) -> DataFrame:
    instant = F.col(file_time) if arrived is None else F.lit(arrived)
    return rows.select(
        F.lit(source).alias("source"),
        F.col(frame).cast("binary").alias("frame"),
        instant.cast("timestamp").alias("ingest_ts"),
        # Follows the order of files and of lines within a file.
        F.monotonically_increasing_id().alias("arrival_seq"),
    )


def stream_frames(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    file_format: str = "parquet",
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Frames as they arrive in a folder, admitted a bounded number of files or of their bytes at a time.

    Bytes are those of the files as stored. A file larger than the bound is taken alone: files are not split
    between micro-batches, so a micro-batch holds at most the bound or one file.
    """
    if (max_files_per_trigger is None) == (max_bytes_per_trigger is None):
        raise ValueError("give a bound on files or on bytes")
    limit = ("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        limit = ("maxBytesPerTrigger", max_bytes_per_trigger)
    if limit[1] < 1:
        raise ValueError("the bound must be positive")
    return spark.readStream.schema(FRAME_SCHEMA).format(file_format).option(*limit).load(path)


def stream_broker_frames(
    spark: SparkSession, servers: str, topics: str, max_offsets_per_trigger: int
) -> DataFrame:
    """Frames from a message broker; needs the Kafka connector on the class path.

    The topic names the source, the broker's append time is the arrival instant. The arrival number is
    the offset with the partition above it: it orders the rows of a partition and differs between any two
    rows of a topic, so equal instants of one key are told apart even if the key changed its partition.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
    )
    return raw.selectExpr(
        "topic AS source",
        "value AS frame",
        "timestamp AS ingest_ts",
        "shiftleft(CAST(partition AS BIGINT), 44) + offset AS arrival_seq",
    )


def fan_in(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, matched by column name; nothing is removed."""
    if not feeds:
        raise ValueError("at least one feed is needed")
    return reduce(DataFrame.unionByName, feeds)
