"""Counters of a running stream: what every trigger took and how far it is behind, written as it is reported."""

from __future__ import annotations

import json
import re
import time
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.utils import AnalysisException

OBSERVED = "arrived"
DDL = (
    "batch_id bigint, frames bigint, last_arrival_us bigint, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, behind bigint"
)


def observed(frames: DataFrame) -> DataFrame:
    """Streaming frames that report their number and newest arrival with every trigger."""
    return frames.observe(OBSERVED, F.count(F.lit(1)).alias("frames"), F.max(F.unix_micros("ingest_ts")).alias("last_us"))


class TriggerLog(StreamingQueryListener):
    """Writes a row per trigger that had a batch; a batch that runs again replaces its row.

    Attach it to the session before the query starts. `name` is the query's name; other queries are passed over.
    """

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.folder = f"stream={re.sub('[^A-Za-z0-9]+', '-', name)}"
        self.last = -1
        self.error: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        if progress.name != self.name or seen is None:
            return
        # Sources that know how much waits say so; files that wait are counted by their source.
        behind = [int(v) for s in progress.sources for k, v in dict(s.metrics).items() if k in ("maxOffsetsBehindLatest", "numFilesOutstanding")]
        row = (
            progress.batchId, seen.frames, seen.last_us, progress.numInputRows, progress.inputRowsPerSecond,
            progress.processedRowsPerSecond, max(behind, default=None),
        )
        names = [c.split()[0] for c in DDL.split(", ")]
        try:
            self._write(progress.batchId, json.dumps(dict(zip(names, row, strict=True))))
        except Exception as error:  # noqa: BLE001  the listener's thread has nobody to raise to; `settle` does
            self.error = error
        self.last = max(self.last, progress.batchId)

    def _write(self, batch_id: int, line: str) -> None:
        """One small file, wherever Spark keeps the log; no job runs in the listener's thread."""
        spark = self.spark.sparkContext
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.folder}/batch={batch_id}/row.json")
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(line.encode()))
        finally:
            out.close()

    def settle(self, query: StreamingQuery, timeout: timedelta = timedelta(seconds=60)) -> None:
        """Wait until what the query has reported is written."""
        reported = [p.batchId for p in query.recentProgress if p.observedMetrics.get(OBSERVED) is not None]
        until = time.monotonic() + timeout.total_seconds()
        while self.last < max(reported, default=-1) and self.error is None:
            if time.monotonic() > until:
                raise TimeoutError("the stream's reports were not written in time")
            time.sleep(0.1)
        if self.error is not None:
            raise self.error

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(f"{DDL}, stream string, batch bigint").json(self.path).drop("batch")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{DDL}, stream string")
