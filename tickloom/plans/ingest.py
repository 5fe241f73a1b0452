"""Batch job: frames to stored ticks, rejects to a quarantine folder, counters that balance."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.operators.dedup import drop_recently_admitted, first_per, refused_rows, sliding_window_dedup
from tickloom.operators.metrics import IntervalLog, MetricsLog, Snapshot, flow
from tickloom.operators.parse import classify_frames
from tickloom.schema import KEY_COLS, TICK_COLS, IngestOptions, micros
from tickloom.session import drop_path, materialize, scratch_path
from tickloom.sources.registry import tag_frames
from tickloom.sources.tick_table import TickTable


@dataclass(frozen=True)
class Staged:
    """Frames after one pass of parsing: accepted ticks and rejects, both stored, and how many there were."""

    ticks: DataFrame
    rejects: DataFrame
    frames: int
    received: int
    dropped: int


def stage_frames(frames: DataFrame, options: IngestOptions, path: str) -> Staged:
    """Parse and validate once, and store the outcome; later steps read columns from it."""
    spark = frames.sparkSession
    classified = classify_frames(frames, options.max_frame_bytes)
    ok = F.col("reason").isNull()
    # A tick's frame is not needed again; a reject keeps it for inspection.
    outcome = classified.select(
        *TICK_COLS,
        "arrival_seq",
        "source",
        "format",
        F.when(~ok, F.col("frame")).alias("frame"),
        "reason",
        ok.alias("accepted"),
    )
    counted = Observation()
    received = F.count_if("accepted").alias("received")
    # One narrow pass: the flag is a column, not a partition, as partitioning would sort every task.
    observed = outcome.observe(counted, F.count(F.lit(1)).alias("frames"), received)
    observed.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(outcome.schema).parquet(path)
    seen = counted.get
    return Staged(
        stored.where("accepted").select(*TICK_COLS, "arrival_seq"),
        stored.where("not accepted").select(
            "source", "format", "frame", "ingest_ts", "arrival_seq", "reason"
        ),
        seen["frames"],
        seen["received"],
        seen["frames"] - seen["received"],
    )


def admit(ticks: DataFrame, recent: DataFrame, last: int, first: int, window: timedelta, carried: int) -> DataFrame:
    """Ticks of one batch, arrived from `first` to `last` (epoch microseconds), that the sliding window admits, given the
    `carried` rows that were admitted within a window before."""
    open_again = drop_recently_admitted(ticks, recent, window, count=carried) if carried else ticks
    if last - first < micros(window):
        # No key can be admitted twice in such a batch.
        return first_per(open_again, KEY_COLS, ["ingest_ts", "arrival_seq"])
    # A long batch is read several times below; the join with earlier batches runs once. Without one, staged rows are read.
    return sliding_window_dedup(materialize(open_again) if carried else ticks, window)


def deduplicated(
    ticks: DataFrame, table: TickTable, writer: str, batch_id: int, options: IngestOptions
) -> tuple[DataFrame, int, int]:
    """Admitted ticks of a batch, how many there are, and how many were refused, each found by itself."""
    first, last = ticks.agg(*[F.unix_micros(f("ingest_ts")) for f in (F.min, F.max)]).first()
    if first is None:
        return ticks, 0, 0
    window = options.dedup_window
    recent = table.carried_keys(first - micros(window), writer, batch_id)
    carried = recent.count()
    admitted = materialize(admit(ticks, recent, last, first, window, carried))
    return admitted, admitted.count(), refused_rows(ticks, admitted, recent, window, count=carried).count()


def ingest_batch(
    tagged: DataFrame,
    table: TickTable,
    writer: str,
    batch_id: int,
    options: IngestOptions,
    quarantine_path: str | None,
    metrics: MetricsLog | None,
    staging_path: str,
    intervals: IntervalLog | None = None,
) -> Snapshot:
    """One batch of tagged frames, by the batch job and by each micro-batch of the stream.

    Counts are taken on the way: frames as they come in, ticks and rejects as they are staged, admissions at the
    dedup, written rows from the table's files. The batch becomes visible only if they balance.
    """
    arrived = Observation()
    skipped = F.count_if(F.col("skipped").isNotNull()).alias("skipped")
    seen = tagged.observe(arrived, F.count(F.lit(1)).alias("frames"), skipped)
    staged = stage_frames(seen.where(F.col("skipped").isNull()).drop("skipped"), options, staging_path)
    frames, left_out = arrived.get["frames"], arrived.get["skipped"]
    if frames != staged.frames + left_out:
        raise RuntimeError(f"frames lost before the table: {frames} frames, {staged.frames} staged, {left_out} skipped")
    admitted, passed, refused = deduplicated(staged.ticks, table, writer, batch_id, options)
    if passed + refused != staged.received:
        raise RuntimeError(f"ticks lost in the dedup: {staged.received} received, {passed} admitted, {refused} refused")
    commit = table.append(
        admitted, batch_id, writer, writers=options.writer_count, max_rows_per_file=options.batch_max_rows, expect=passed
    )
    if quarantine_path:
        target = f"{quarantine_path.rstrip('/')}/writer={writer}/batch_id={batch_id}"
        staged.rejects.write.mode("overwrite").parquet(target)
    counts = Snapshot(staged.received, refused + commit.repeated, commit.rows, staged.dropped, left_out)
    counts.check_conserved(frames)
    if intervals:
        outcome = staged.ticks.select("ingest_ts", F.lit(None).cast("string").alias("reason")).unionByName(
            staged.rejects.select("ingest_ts", "reason")
        )
        intervals.record(batch_id, flow(outcome, admitted, ["ingest_ts"]), writer)
    if metrics:
        metrics.record(batch_id, counts, writer)
    return counts


def run_ingest(
    frames: DataFrame,
    registry: DataFrame,
    table: TickTable,
    batch_id: int,
    options: IngestOptions | None = None,
    quarantine_path: str | None = None,
    metrics: MetricsLog | None = None,
    writer: str = "batch",
    intervals: IntervalLog | None = None,
) -> Snapshot:
    """Run one batch from end to end and return its counters.

    The window reaches back over batches stored before. `writer` and `batch_id` name the batch: run again with the same
    frames it changes nothing, with others it is refused. Parsed rows are staged next to the checkpoints and deleted.
    """
    table.create()
    path = scratch_path(frames.sparkSession, "staged")
    try:
        return ingest_batch(
            tag_frames(frames, registry), table, writer, batch_id, options or IngestOptions(), quarantine_path, metrics, path,
            intervals,
        )
    finally:
        drop_path(frames.sparkSession, path)
