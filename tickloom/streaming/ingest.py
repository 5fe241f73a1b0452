"""Streaming job with the same semantics as the batch job, exact across micro-batches and restarts.

State: what was admitted within the last window. The table holds the keys by day of arrival, so a micro-batch reads
those that arrived since `first arrival - window`, from that day on, and needs no state store of its own. A batch
only looks at batches stored before it, and is committed once under the stream's name and its id, so
replaying it after a failure gives the same rows and no repeats.
"""

from __future__ import annotations

import zlib
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.metrics import IntervalLog, MetricsLog
from tickloom.plans.ingest import ingest_batch
from tickloom.schema import KEY_COLS, IngestOptions
from tickloom.session import scratch_path
from tickloom.sources.registry import check_registry, join_registry
from tickloom.sources.tick_table import TickTable
from tickloom.streaming.counters import observed


def start_ingest(
    frames: DataFrame,
    registry: DataFrame,
    table: TickTable,
    checkpoint: str,
    options: IngestOptions | None = None,
    quarantine_path: str | None = None,
    metrics: MetricsLog | None = None,
    drain: bool = False,
    intervals: IntervalLog | None = None,
) -> StreamingQuery:
    """Start the job. With `drain` it takes everything available now and stops by itself.

    Source admission limits (files or offsets per trigger) keep a burst waiting at the source; no row
    is dropped for load. An error in a batch fails the query with that error.
    """
    options = options or IngestOptions()
    table.create()
    enabled = check_registry(registry)
    name = stream_name(checkpoint)
    # Each micro-batch overwrites the staged rows of the one before it.
    stage_path = scratch_path(frames.sparkSession, "staged")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = join_registry(batch, registry, enabled)
        ingest_batch(tagged, table, name, batch_id, options, quarantine_path, metrics, stage_path, intervals)

    writer = observed(frames).writeStream.queryName(name).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True).start()
    delay = options.batch_max_delay // timedelta(milliseconds=1)
    return writer.trigger(processingTime=f"{max(1, delay)} milliseconds").start()


def stream_name(checkpoint: str) -> str:
    """The stream's name as a writer and as a query; the checkpoint is what makes two runs the same stream."""
    return f"stream-{zlib.crc32(checkpoint.encode()):08x}"


def await_drain(query: StreamingQuery, timeout: timedelta) -> bool:
    """Wait for the end of input; after the timeout stop the query and return False.

    A stopped query has lost nothing: what it did not commit is read again from the checkpoint. A
    failed query raises its own error here.
    """
    if query.awaitTermination(timeout.total_seconds()):
        return True
    query.stop()
    return False


def backlog(query: StreamingQuery) -> list[dict]:
    """How far the query is behind, per reported micro-batch."""
    return [
        {
            "batch_id": p.batchId,
            "input_rows": p.numInputRows,
            "input_rows_per_second": p.inputRowsPerSecond,
            "processed_rows_per_second": p.processedRowsPerSecond,
            "sources": [dict(s.metrics) for s in p.sources],
        }
        for p in query.recentProgress
    ]


def approximate_dedup(ticks: DataFrame, window: timedelta) -> DataFrame:
    """Built-in streaming removal of repeats. NOT the exact rule: the engine's watermark decides when
    a key is forgotten, so it drops late rows and may hold a key for longer than the window."""
    seconds = window.total_seconds()
    marked = ticks.withWatermark("ingest_ts", f"{seconds} seconds")
    return marked.dropDuplicatesWithinWatermark(KEY_COLS)
