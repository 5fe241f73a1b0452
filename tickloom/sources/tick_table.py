"""The stored tick table: typed append in atomic batches, unique keys, pruned reads.

Layout: `data/folder=F/exchange_date=D/*.parquet` with a folder per batch, rows sorted by arrival inside a file. The log
holds an entry per batch: who wrote it under which id, its folder, bounds, row count and a checksum of its content. A
batch becomes visible when its entry exists, so a failed batch leaves the table as it was and a retry replaces its files.
Reads take the folders that entries name and the days that bounds allow; they never list the whole table.

Beside the data, `window/folder=F/slot=D` holds the key and the instant of arrival of every stored row, by day of arrival and in its
order: what a window needs to know of earlier batches. A batch reads only the days from its look-back on, however old the table is.

A batch is known by (writer, batch id). The same batch again is not written twice; the same id with other content is
refused. `compact` joins the data of many batches in one folder and the log in one file. One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.numbers import slot_of
from tickloom.operators.dedup import first_per
from tickloom.schema import KEY_COLS, TICK_COLS, TICK_SCHEMA
from tickloom.session import drop_path, materialize

DAY_US = 86_400_000_000
# How far back from the newest arrival `compact` keeps the keys of the window; look-backs beyond it read the data.
KEPT_DAYS = 8
STORED_SCHEMA = T.StructType(
    [
        T.StructField("batch_seq", T.LongType()),
        T.StructField("position", T.LongType()),
        *TICK_SCHEMA.fields,
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("exchange_date", T.DateType()),
    ]
)
# Instants in epoch microseconds: exact, and free of any time zone on their way through Python. `days` lists the
# exchange days of the batch. `content` is a sum of row hashes, which does not depend on the order of rows.
LOG_DDL = (
    "writer string, batch_id bigint, batch_seq bigint, folder string, n bigint, repeated bigint, content decimal(38,0), "
    "days array<int>, first_exchange_us bigint, last_exchange_us bigint, first_ingest_us bigint, last_ingest_us bigint"
)


class DuplicateKeyError(RuntimeError):
    """A batch holds a key twice, or one that the table already has."""


class BatchConflictError(RuntimeError):
    """A batch id was used before by the same writer, with other content."""


@dataclass(frozen=True)
class Commit:
    """`repeated` rows were left out because their key was there already ("ignore" only)."""

    writer: str
    batch_id: int
    rows: int
    repeated: int = 0


class TickTable:
    """`on_conflict`: "error" refuses a batch with a repeated key, "ignore" leaves out rows whose key
    is present already, "keep" stores every row (a log of admissions without a uniqueness rule)."""

    def __init__(self, spark: SparkSession, path: str, on_conflict: str = "error") -> None:
        if on_conflict not in ("error", "ignore", "keep"):
            raise ValueError(f"on_conflict must be error, ignore or keep, not {on_conflict!r}")
        self.spark, self.on_conflict = spark, on_conflict
        self._data = f"{path.rstrip('/')}/data"
        self._log = f"{path.rstrip('/')}/log"
        self._window = f"{path.rstrip('/')}/window"

    def create(self) -> TickTable:
        """Make the empty table when it does not exist; safe to repeat."""
        none = self.spark.createDataFrame([], LOG_DDL)
        none.write.mode("ignore").parquet(f"{self._log}/start")
        return self

    # -- write

    def append(
        self,
        ticks: DataFrame,
        batch_id: int,
        writer: str = "batch",
        writers: int | None = None,
        max_rows_per_file: int | None = None,
        expect: int | None = None,
    ) -> Commit:
        """Store one batch, all or nothing.

        The same rows under the same writer and id are stored once; other rows raise. With `expect`, a batch that
        reaches the files with another number of rows is refused before it becomes visible.
        """
        if batch_id < 0:
            raise ValueError("batch ids start at 0")
        log = self._entries()
        done = next((e for e in log if (e.writer, e.batch_id) == (writer, batch_id)), None)
        earlier = [e for e in log if done is None or e.batch_seq < done.batch_seq]
        rows, given = ticks, None
        if self.on_conflict == "ignore":
            given = expect if expect is not None else ticks.count()
            rows = self._without_stored(ticks, earlier)
        if done is not None:
            n, content = _stamped(rows).agg(*_content()).first()
            if (n, content or 0) != (done.n, done.content):
                raise BatchConflictError(f"batch {batch_id} of {writer!r} was stored with other content")
            return Commit(writer, batch_id, done.n, done.repeated)

        seq = 1 + max((e.batch_seq for e in log), default=-1)
        folder = f"{re.sub('[^A-Za-z0-9]+', '-', writer)}-{batch_id}-{seq}"
        self._write(rows, folder, seq, writers, max_rows_per_file)
        written = self._folders([folder])
        us = {n: F.unix_micros(n) for n in ("exchange_ts", "ingest_ts")}
        stats = _stamped(written).agg(
            *_content(),
            F.sort_array(F.collect_set(F.unix_date("exchange_date"))),
            *[f(us[n]) for n in ("exchange_ts", "ingest_ts") for f in (F.min, F.max)],
        ).first()
        repeated = 0 if given is None else given - stats[0]
        if expect is not None and stats[0] + repeated != expect:
            raise RuntimeError(f"ticks lost before the table: {expect} admitted, {stats[0]} written")
        if not stats[0] and not repeated:
            return Commit(writer, batch_id, 0)
        if self.on_conflict == "error":
            self._refuse_repeats(written, earlier, stats[2])
        self._write_window(written, folder)
        entry = (writer, batch_id, seq, folder, stats[0], repeated, stats[1] or 0, *stats[2:])
        self._add_to_log([entry], f"seq-{seq}")
        return Commit(writer, batch_id, stats[0], repeated)

    def compact(self) -> None:
        """Put all rows in one folder and all entries in one file, then delete what they replace.

        A failure on the way leaves the table readable: entries of the same batch count once, the newest first.
        """
        log = self._entries()
        if len(log) < 2:
            return
        folder = f"compacted-{max(e.batch_seq for e in log)}-{uuid.uuid4().hex[:8]}"
        stored = self.read()
        ordered = stored.hint("rebalance", F.col("exchange_date")).sortWithinPartitions("exchange_date", "exchange_ts")
        ordered.write.partitionBy("exchange_date").parquet(f"{self._data}/folder={folder}")
        newest = max((e.last_ingest_us for e in log if e.n), default=0)
        keys = self._window_rows(log).where(F.col("admitted_us") >= _kept_from(newest))
        keys.hint("rebalance", F.col("slot")).sortWithinPartitions("slot", "admitted_us").write.partitionBy("slot").parquet(
            f"{self._window}/folder={folder}"
        )
        before = self._log_files()
        moved = [(*e[:3], folder, *e[4:]) for e in log]
        self._add_to_log(moved, folder)
        for name in before:
            drop_path(self.spark, f"{self._log}/{name}")
        for name in {e.folder for e in log}:
            drop_path(self.spark, f"{self._data}/folder={name}")
            drop_path(self.spark, f"{self._window}/folder={name}")

    def _add_to_log(self, entries: list[tuple], name: str) -> None:
        rows = self.spark.createDataFrame(entries, LOG_DDL)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self._log}/{name}")

    def _write(
        self, rows: DataFrame, folder: str, seq: int, writers: int | None, max_rows_per_file: int | None
    ) -> None:
        arrival = F.col("arrival_seq") if "arrival_seq" in rows.columns else F.lit(None)
        dated = rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TICK_SCHEMA.fields],
            arrival.cast("bigint").alias("arrival_seq"),
            _utc_date(F.col("exchange_ts")).alias("exchange_date"),
        )
        # Rebalancing by date joins small pieces and cuts a date that holds most rows.
        spread = dated.repartition(writers) if writers else dated.hint("rebalance", F.col("exchange_date"))
        ordered = spread.sortWithinPartitions("exchange_date", "ingest_ts", "arrival_seq")
        # A row is known by its batch and its position there; neither grows with the age of the table.
        numbered = ordered.select(
            F.lit(seq).cast("bigint").alias("batch_seq"),
            F.monotonically_increasing_id().alias("position"),
            *TICK_COLS,
            "arrival_seq",
            "exchange_date",
        )
        writer = numbered.write.mode("overwrite").partitionBy("exchange_date")
        if max_rows_per_file:
            writer = writer.option("maxRecordsPerFile", max_rows_per_file)
        writer.parquet(f"{self._data}/folder={folder}")

    def _write_window(self, written: DataFrame, folder: str) -> None:
        arrived = F.unix_micros("ingest_ts")
        rows = written.select("batch_seq", *KEY_COLS, arrived.alias("admitted_us"), slot_of(arrived, DAY_US).alias("slot"))
        ordered = rows.sortWithinPartitions("slot", "admitted_us")
        ordered.write.mode("overwrite").partitionBy("slot").parquet(f"{self._window}/folder={folder}")

    def _window_rows(self, entries: list) -> DataFrame:
        named = sorted({f"{self._window}/folder={e.folder}" for e in entries if e.n})
        keys = [f for f in STORED_SCHEMA.fields if f.name in ("batch_seq", *KEY_COLS)]
        schema = T.StructType([*keys, T.StructField("admitted_us", T.LongType()), T.StructField("slot", T.LongType())])
        if not named:
            return _no_rows(self.spark, schema)
        whole = T.StructType([*schema.fields, T.StructField("folder", T.StringType())])
        return self.spark.read.schema(whole).option("basePath", self._window).parquet(*named).drop("folder")

    def _without_stored(self, ticks: DataFrame, earlier: list) -> DataFrame:
        hashed = ticks.withColumn("_h", F.xxhash64(*KEY_COLS))
        unique = materialize(first_per(hashed, ["_h", *KEY_COLS], ["ingest_ts", *_tie_break(ticks)]).drop("_h"))
        days = [r[0] for r in unique.select(F.unix_date(_utc_date(F.col("exchange_ts")))).distinct().collect()]
        return unique.join(self._on_days(earlier, days).select(*KEY_COLS), KEY_COLS, "left_anti")

    def _refuse_repeats(self, written: DataFrame, earlier: list, days: list[int]) -> None:
        """Repeats inside the batch, then stored keys among those of the batch, on the batch's days only."""
        inside = duplicate_keys(written).first()
        if inside is not None:
            raise DuplicateKeyError(f"key occurs {inside['copies']} times: { {k: inside[k] for k in KEY_COLS} }")
        stored = self._on_days(earlier, days).select(*KEY_COLS)
        again = stored.join(written.select(*KEY_COLS), KEY_COLS, "left_semi").first()
        if again is not None:
            raise DuplicateKeyError(f"key is stored already: {again.asDict()}")

    # -- read

    def commits(self) -> DataFrame:
        """An entry per batch."""
        logged = self.spark.read.schema(LOG_DDL).option("recursiveFileLookup", "true").parquet(self._log)
        # Between a compaction and its clean-up a batch has two entries.
        newest = F.max_by(F.struct(*logged.columns), F.struct(F.col("folder").startswith("compacted-"), "folder"))
        return logged.groupBy("writer", "batch_id").agg(newest.alias("_e")).select("_e.*")

    def read(self) -> DataFrame:
        return self._folders([e.folder for e in self._entries()])

    def time_range(self, first: datetime, last: datetime) -> DataFrame:
        """Ticks with `first <= exchange_ts <= last`, reading only the days in between."""
        return self.read().where(_in_range(F.lit(first), F.lit(last)))

    def arrived_since(self, instant_us: int, writer: str, batch_id: int) -> DataFrame:
        """Ticks of batches before the given one that arrived at or after the instant (epoch microseconds).

        Admissions before `first arrival - window` block nothing that arrives from now on.
        """
        log = self._entries()
        own = next((e.batch_seq for e in log if (e.writer, e.batch_id) == (writer, batch_id)), None)
        recent = [
            e for e in log if (own is None or e.batch_seq < own) and e.n and e.last_ingest_us >= instant_us
        ]
        rows = self._folders([e.folder for e in recent])
        # A compacted folder also holds batches that are not asked for.
        asked = F.col("batch_seq") < (2**62 if own is None else own)
        return rows.where(asked & (F.col("ingest_ts") >= F.timestamp_micros(F.lit(instant_us))))

    def carried_keys(self, instant_us: int, writer: str, batch_id: int) -> DataFrame:
        """Key and `ingest_ts` of ticks of batches before the given one that arrived at or after the instant.

        Reads the keys by day of arrival instead of the data; a look-back beyond what a compaction kept goes to the data.
        """
        log = self._entries()
        own = next((e.batch_seq for e in log if (e.writer, e.batch_id) == (writer, batch_id)), None)
        recent = [e for e in log if (own is None or e.batch_seq < own) and e.n and e.last_ingest_us >= instant_us]
        compacted = [e.last_ingest_us for e in log if e.n and e.folder.startswith("compacted-")]
        if compacted and instant_us < _kept_from(max(compacted)):
            return self.arrived_since(instant_us, writer, batch_id).select(*KEY_COLS, "ingest_ts")
        rows = self._window_rows(recent)
        asked = F.col("batch_seq") < (2**62 if own is None else own)
        later = (F.col("slot") >= instant_us // DAY_US) & (F.col("admitted_us") >= instant_us)
        return rows.where(asked & later).select(*KEY_COLS, F.timestamp_micros("admitted_us").alias("ingest_ts"))

    def register(self, name: str = "ticks") -> None:
        """Offer the committed rows to SQL under a name."""
        self.read().createOrReplaceTempView(name)

    def _entries(self) -> list:
        """The log on the driver: a short row per batch since the table began."""
        return sorted(self.commits().collect(), key=lambda e: e.batch_seq)

    def _log_files(self) -> list[str]:
        files = self.spark.read.schema(LOG_DDL).option("recursiveFileLookup", "true").parquet(self._log).inputFiles()
        return sorted({f.rsplit("/", 2)[1] for f in files})

    def _folders(self, folders: list[str]) -> DataFrame:
        named = [f"{self._data}/folder={f}" for f in sorted(set(folders))]
        if not named:
            return _no_rows(self.spark, STORED_SCHEMA)
        # A folder without rows has no files, which a given schema lets pass.
        schema = T.StructType([*STORED_SCHEMA.fields, T.StructField("folder", T.StringType())])
        return self.spark.read.schema(schema).option("basePath", self._data).parquet(*named).drop("folder")

    def _on_days(self, entries: list, days: list[int]) -> DataFrame:
        """Stored rows of the given exchange days (days since the epoch), from the batches that have some."""
        wanted = set(days)
        rows = self._folders([e.folder for e in entries if wanted & set(e.days)])
        seqs = F.col("batch_seq") <= max((e.batch_seq for e in entries), default=-1)
        dates = [F.date_from_unix_date(F.lit(d)) for d in sorted(wanted)]
        return rows.where(seqs & (F.col("exchange_date").isin(dates) if dates else F.lit(False)))


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the planner knows to be empty, so that a join with it moves no rows."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).where(F.lit(False))


def _kept_from(newest_us: int) -> int:
    return newest_us - KEPT_DAYS * DAY_US


def duplicate_keys(ticks: DataFrame, *extra: Column) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    copies = ticks.groupBy(*KEY_COLS).agg(F.count(F.lit(1)).alias("copies"), *extra)
    return copies.where(F.col("copies") > 1)


def _stamped(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("_hash", F.xxhash64(*[F.col(f.name).cast(f.dataType) for f in TICK_SCHEMA.fields]))


def _content() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("content")]


def _tie_break(ticks: DataFrame) -> list[str]:
    return ["arrival_seq"] if "arrival_seq" in ticks.columns else ["price", "volume"]


def _utc_date(instant: Column) -> Column:
    """Date of an instant in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(slot_of(F.unix_micros(instant), DAY_US).cast("int"))


def _in_range(first: Column, last: Column) -> Column:
    days = F.col("exchange_date").between(_utc_date(first), _utc_date(last))
    return days & F.col("exchange_ts").between(first, last)
