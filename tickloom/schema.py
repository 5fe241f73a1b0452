"""Row types shared by every stage: raw frame, tick, key and job parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Feed ids as stored in the `exchange` column.
EXCHANGES = {"Unknown": 0, "Binance": 1, "Kraken": 2, "Coinbase": 3, "Mock": 4}

# Bounds of a storable instant, in epoch milliseconds.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999

# Validator limits.
MAX_AMOUNT = 10**18
MAX_SYMBOL_CHARS = 32
MAX_PAST_SKEW = timedelta(days=7)
MAX_FUTURE_SKEW = timedelta(minutes=1)

# Fixed value: largest accepted message, in bytes.
MAX_FRAME_BYTES = 256 * 1024

AMOUNT = T.DecimalType(38, 18)

FRAME_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("frame", T.BinaryType(), False),
        T.StructField("ingest_ts", T.TimestampType(), False),
        T.StructField("arrival_seq", T.LongType(), False),
    ]
)

TICK_SCHEMA = T.StructType(
    [
        T.StructField("exchange", T.ShortType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", AMOUNT, False),
        T.StructField("volume", AMOUNT, False),
        T.StructField("exchange_ts", T.TimestampType(), False),
        T.StructField("source_id", T.LongType(), False),
        T.StructField("ingest_ts", T.TimestampType(), False),
    ]
)

TICK_COLS = [f.name for f in TICK_SCHEMA.fields]
KEY_COLS = ["exchange", "symbol", "exchange_ts", "source_id"]


def exchange_dimension(spark: SparkSession) -> DataFrame:
    """Five-row id/name table."""
    rows = [(i, name) for name, i in EXCHANGES.items()]
    return spark.createDataFrame(rows, "exchange smallint, exchange_name string")


def with_exchange_name(ticks: DataFrame) -> DataFrame:
    """Add the feed's name; the dimension always has five rows, so it is broadcast."""
    dim = F.broadcast(exchange_dimension(ticks.sparkSession))
    return ticks.join(dim, "exchange", "left")


def key_projection(ticks: DataFrame) -> DataFrame:
    return ticks.select(*KEY_COLS)


def tick_projection(ticks: DataFrame) -> DataFrame:
    """The seven stored columns in their fixed order and types."""
    return ticks.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TICK_SCHEMA.fields])


@dataclass(frozen=True)
class IngestOptions:
    """Job parameters; every count must be at least 1 and every duration positive.

    `writer_count` fixes the number of writing tasks of a batch; without it files follow the days and sizes of the
    batch. `batch_max_rows` cuts files at that many rows. `batch_max_delay` is the stream's trigger interval. How much a trigger takes is a source option.
    """

    writer_count: int | None = None
    batch_max_rows: int | None = None
    batch_max_delay: timedelta = timedelta(seconds=10)
    dedup_window: timedelta = timedelta(minutes=1)
    max_frame_bytes: int = MAX_FRAME_BYTES

    def __post_init__(self) -> None:
        for name in ("writer_count", "batch_max_rows", "max_frame_bytes"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1")
        for name in ("batch_max_delay", "dedup_window"):
            if getattr(self, name) <= timedelta(0):
                raise ValueError(f"{name} must be positive")


def micros(duration: timedelta) -> int:
    return duration // timedelta(microseconds=1)
