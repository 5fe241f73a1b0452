"""The `events` table rendered as the messages of three feeds.

Every event is sent by every feed. The number `k` in an event's properties decides what happens to
its messages on the way: nothing, a defect, or repeats at set delays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.barrier import evaluate_once
from tickloom.sources.registry import REGISTRY_DDL

# The defect of an event by its k.
DEFECTS = {
    "cut_short": 0,
    "negative_price": 1,
    "space_in_symbol": 2,
    "week_old": 3,
    "from_the_future": 4,
    "extra_element": 5,
    "trailing_text": 6,
    "exponent_price": 7,
    "plus_sign": 8,
    "huge_time": 9,
}

# Fixed values: (lowest k, highest k, delays of the repeats in milliseconds).
REPEATS = [
    (10, 19, [5_000]),
    (20, 29, [59_999]),
    (30, 39, [60_000]),
    (40, 49, [40_000, 80_000]),
]

ARRIVAL_DELAY_MS = 250
FEEDS = ["binance", "kraken", "csv"]
CHANNEL = 42


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table of few files to all cores; many rows follow from one here."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def feed_registry(spark: SparkSession, disabled: tuple[str, ...] = ()) -> DataFrame:
    rows = [(f"{f}-feed", f, f"wss://{f}.example/feed", f not in disabled) for f in FEEDS]
    return spark.createDataFrame(rows, REGISTRY_DDL)


def event_facts(events: DataFrame) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        "event_id",
        ms.alias("ts_ms"),
        F.upper("event_type").alias("base"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("price"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def _sent(events: DataFrame, repeats: bool) -> DataFrame:
    """What every feed sends, and how often."""
    facts = spread(event_facts(events))
    copies = _repeat_delays() if repeats else F.array(F.lit(0))
    return facts.select(
        "*", F.posexplode(F.array(*[F.lit(f) for f in FEEDS])).alias("feed_no", "format")
    ).select("*", F.posexplode(copies).alias("copy", "delay"))


def _arrival() -> Column:
    return F.timestamp_millis(F.col("ts_ms") + ARRIVAL_DELAY_MS + F.col("delay")).alias("ingest_ts")


def event_arrivals(events: DataFrame) -> DataFrame:
    """The instants at which the frames of all feeds arrive."""
    return _sent(events, repeats=True).select(_arrival())


def event_frames(events: DataFrame, defects: bool = True, repeats: bool = True) -> DataFrame:
    """Frames `(source, format, frame, ingest_ts, arrival_seq)` of all feeds."""
    sent = _sent(events, repeats)

    def defect(name: str) -> Column:
        return (F.col("k") == DEFECTS[name]) & F.lit(defects)

    suffix = F.when(F.col("format") == "binance", "USDT").when(F.col("format") == "kraken", "/USD")
    symbol = F.concat("base", suffix.otherwise("USD"))
    fields = sent.withColumns(
        {
            "symbol": F.when(defect("space_in_symbol"), F.concat(F.lit("A "), symbol)).otherwise(symbol),
            "price": F.when(defect("negative_price"), "-1")
            .when(defect("exponent_price"), "1e5")
            .when(defect("plus_sign"), F.concat(F.lit("+"), "price"))
            .otherwise(F.col("price")),
            "sent_ms": F.when(defect("week_old"), F.col("ts_ms") - 8 * 86_400_000)
            .when(defect("from_the_future"), F.col("ts_ms") + 3_600_000)
            .when(defect("huge_time"), F.lit(2**63 - 1))
            .otherwise(F.col("ts_ms")),
        }
    )
    message = _message(defect("extra_element"), defect("trailing_text"), defect("cut_short"))
    framed = evaluate_once(fields, F.struct(F.encode(message, "UTF-8").alias("frame")), replaced=[])
    return framed.select(
        F.concat("format", F.lit("-feed")).alias("source"),
        "format",
        "frame",
        _arrival(),
        ((F.col("event_id") * len(FEEDS) + F.col("feed_no")) * 10 + F.col("copy")).alias("arrival_seq"),
    )


def _repeat_delays() -> Column:
    out = None
    for low, high, delays in REPEATS:
        all_delays = F.array(*[F.lit(d) for d in [0, *delays]])
        hit = F.col("k").between(low, high)
        out = F.when(hit, all_delays) if out is None else out.when(hit, all_delays)
    return out.otherwise(F.array(F.lit(0)))


def _message(extra: Column, trailing: Column, cut: Column) -> Column:
    ms, ident, volume = (F.col(c).cast("string") for c in ("sent_ms", "event_id", "k"))
    millis = F.lpad((F.col("sent_ms") % 1000).cast("string"), 3, "0")
    seconds = F.concat_ws(".", F.expr("sent_ms div 1000").cast("string"), millis)
    tail = F.when(trailing, "x").otherwise("")

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    as_object = text(
        '{"s":"', F.col("symbol"), '",', F.when(extra, '"s":"TWICE",').otherwise(""),
        '"p":"', F.col("price"), '","q":"', volume, '","T":', ms, ',"a":', ident, "}", tail,
    )
    as_array = text(
        f'[{CHANNEL},["', F.col("price"), '","', volume, '","', seconds, '"],"trade","',
        F.col("symbol"), '",', ident, F.when(extra, ",999").otherwise(""), "]", tail,
    )
    as_line = F.concat_ws(",", F.col("symbol"), F.col("price"), volume, ms, ident)
    as_line = F.concat(as_line, F.when(extra, ",extra").otherwise(""), tail)
    # Without its last digit a line is still a good line, so a cut line loses its last comma.
    cut_line = F.concat(F.concat_ws(",", F.col("symbol"), F.col("price"), volume, ms), ident)

    def shortened(frame: Column) -> Column:
        return F.when(cut, F.substr(frame, F.lit(1), F.length(frame) - 1)).otherwise(frame)

    return (
        F.when(F.col("format") == "binance", shortened(as_object))
        .when(F.col("format") == "kraken", shortened(as_array))
        .otherwise(F.when(cut, cut_line).otherwise(as_line))
    )
