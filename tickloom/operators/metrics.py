"""Counters of a run: received, deduplicated, written, dropped.

`received` counts ticks that passed parsing and validation; `dropped` counts frames that did not.
Counters are taken from stored rows, so a repeated task or batch cannot count twice.
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tickloom.session import materialize

COUNTERS = ["received", "deduplicated", "written", "dropped"]


@dataclass(frozen=True)
class Snapshot:
    """`skipped` counts frames of sources that are disabled or not registered; they are not parsed.

    `deduplicated` is counted at the dedup and `written` from the table's files, so `in_flight` shows a loss between.
    """

    received: int = 0
    deduplicated: int = 0
    written: int = 0
    dropped: int = 0
    skipped: int = 0

    @property
    def gap(self) -> int:
        """Received but not written; includes removed repeats."""
        return self.received - self.written

    @property
    def in_flight(self) -> int:
        """Neither written nor removed as a repeat; 0 after a drain."""
        return self.received - self.deduplicated - self.written

    def check_conserved(self, frames: int) -> None:
        """Every frame was received, dropped or skipped, every received tick written or removed."""
        if frames != self.received + self.dropped + self.skipped:
            raise RuntimeError(f"frames lost before the table: {frames} frames, {self}")
        if self.in_flight != 0:
            raise RuntimeError(f"ticks lost before the table: {self}")


def flow(classified: DataFrame, admitted: DataFrame, cols: list[str]) -> DataFrame:
    """One row per frame and one per admitted tick, each with a 1 in the counter it adds to."""
    ok = F.col("reason").isNull().cast("int")
    arrived = classified.select(
        *cols, ok.alias("received"), F.lit(0).alias("written"), (1 - ok).alias("dropped")
    )
    stored = admitted.select(
        *cols, F.lit(0).alias("received"), F.lit(1).alias("written"), F.lit(0).alias("dropped")
    )
    return arrived.unionByName(stored)


def counter_totals(flow_rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counters per group of a finished run, and the gap between received and written."""
    received, written = F.sum("received"), F.sum("written")
    return flow_rows.groupBy(*(by or [])).agg(
        received.alias("received"),
        (received - written).alias("deduplicated"),
        written.alias("written"),
        F.sum("dropped").alias("dropped"),
        (received - written).alias("gap"),
    )


def interval_counts(flow_rows: DataFrame, interval: timedelta, quiet: bool = False) -> DataFrame:
    """Per interval of arrival: what each counter gained, and its total so far.

    With `quiet`, intervals between the first and the last one in which nothing arrived are reported too.

    Running totals are taken within a day and added to the totals of earlier days, so no task orders
    more than one day's intervals or one row per day.
    """
    return interval_totals(interval_deltas(flow_rows, interval), interval, quiet)


def interval_deltas(flow_rows: DataFrame, interval: timedelta) -> DataFrame:
    """What each counter gained per interval of arrival; intervals without a row are left out."""
    length = f"{_whole_seconds(interval)} seconds"
    return (
        flow_rows.withColumn("interval_start", F.window("ingest_ts", length).start)
        .transform(counter_totals, ["interval_start"])
        .select("interval_start", *[F.col(c).alias(f"{c}_delta") for c in COUNTERS])
    )


def interval_totals(deltas: DataFrame, interval: timedelta, quiet: bool = False) -> DataFrame:
    """Totals so far beside what each interval gained; `deltas` holds an interval once."""
    seconds = _whole_seconds(interval)
    if quiet:
        deltas = _with_quiet(materialize(deltas), seconds)
    deltas = deltas.withColumn("_day", F.to_date("interval_start"))
    days = deltas.groupBy("_day").agg(*[F.sum(f"{c}_delta").alias(c) for c in COUNTERS])
    day_order = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    earlier = days.select(
        "_day", *[F.coalesce(F.sum(c).over(day_order), F.lit(0)).alias(f"_{c}") for c in COUNTERS]
    )
    in_day = (
        Window.partitionBy("_day")
        .orderBy("interval_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return deltas.join(earlier, "_day").select(
        "interval_start",
        *[f"{c}_delta" for c in COUNTERS],
        *[(F.sum(f"{c}_delta").over(in_day) + F.col(f"_{c}")).alias(c) for c in COUNTERS],
    )


def _whole_seconds(interval: timedelta) -> int:
    seconds = interval // timedelta(seconds=1)
    if seconds < 1 or interval != timedelta(seconds=seconds):
        raise ValueError("an interval must be a whole number of seconds")
    return seconds


def _with_quiet(deltas: DataFrame, seconds: int) -> DataFrame:
    """The intervals from the first to the last, all of them."""
    first, last = deltas.agg(*[F.unix_seconds(f("interval_start")) for f in (F.min, F.max)]).first()
    if first is None:
        return deltas
    every = deltas.sparkSession.range(first, last + 1, seconds)
    every = every.select(F.timestamp_seconds("id").alias("interval_start"))
    gained = [F.coalesce(f"{c}_delta", F.lit(0)).alias(f"{c}_delta") for c in COUNTERS]
    return every.join(deltas, "interval_start", "left").select("interval_start", *gained)


class IntervalLog:
    """What each interval of arrival gained, written batch by batch while a job or stream runs.

    A batch adds a small table of the intervals it touches and replaces its own when it runs again. A report merges
    those tables, so it costs intervals and batches, not ticks.
    """

    DDL = "interval_start timestamp, " + ", ".join(f"{c}_delta bigint" for c in COUNTERS)

    def __init__(self, spark: SparkSession, path: str, interval: timedelta) -> None:
        _whole_seconds(interval)
        self.spark, self.path, self.interval = spark, path.rstrip("/"), interval

    def record(self, batch_id: int, flow_rows: DataFrame, writer: str = "batch") -> None:
        folder = f"writer={re.sub('[^A-Za-z0-9]+', '-', writer)}/batch_id={batch_id}"
        gained = interval_deltas(flow_rows, self.interval)
        gained.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def report(self, quiet: bool = True) -> DataFrame:
        """Deltas and running totals per interval, by default with those in which nothing arrived."""
        try:
            stored = self.spark.read.schema(f"{self.DDL}, writer string, batch_id bigint").parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], self.DDL)
        merged = stored.groupBy("interval_start").agg(*[F.sum(f"{c}_delta").alias(f"{c}_delta") for c in COUNTERS])
        return interval_totals(merged, self.interval, quiet)


class MetricsLog:
    """Append-only counter rows, one per writer and batch; totals are sums and never go down.

    A repeated batch replaces its own row.
    """

    DDL = "received bigint, deduplicated bigint, written bigint, dropped bigint, skipped bigint"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, batch_id: int, counts: Snapshot, writer: str = "batch") -> None:
        row = self.spark.createDataFrame([tuple(asdict(counts).values())], self.DDL)
        folder = f"writer={re.sub('[^A-Za-z0-9]+', '-', writer)}/batch_id={batch_id}"
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def rows(self) -> DataFrame:
        schema = f"{self.DDL}, writer string, batch_id bigint"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def snapshot(self) -> Snapshot:
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*COUNTERS, "skipped"]]
        return Snapshot(**self.rows().agg(*sums).first().asDict())
