"""Every operator as a query over the given tables.

Tick queries read the `events` table rendered as feed messages (`event_feed`); keyed dedup and hashing
also run on `lineitem`, `customer` and `part`. Times are returned as epoch milliseconds and decimals as
text, which every SQL engine writes the same way.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.hashing import fnv1a64, shard_of
from tickloom.operators.aligned_batches import aligned_batches
from tickloom.operators.batching import write_batches
from tickloom.operators.dedup import duplicate_counts, sliding_window_dedup
from tickloom.operators.metrics import IntervalLog, MetricsLog, counter_totals, flow, interval_counts
from tickloom.operators.parse import accepted, classify_frames, parse_as, parse_frames, rejected
from tickloom.operators.routing import shard_counts, with_shard
from tickloom.operators.silence import open_silence, source_silence
from tickloom.plans.event_feed import event_arrivals, event_frames, feed_registry, load, spread
from tickloom.plans.ingest import Staged, run_ingest, stage_frames
from tickloom.schema import EXCHANGES, KEY_COLS, TICK_COLS, IngestOptions, with_exchange_name
from tickloom.session import materialize, scratch_path, stored
from tickloom.sources.frames import fan_in, stream_frames
from tickloom.sources.registry import REGISTRY_DDL, tag_frames, with_registered_format
from tickloom.sources.tick_table import TickTable, duplicate_keys
from tickloom.streaming.ingest import await_drain, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = timedelta(seconds=60)
# Longer than the longest repeat delay of the feed: no key is admitted twice.
LONG_WINDOW = timedelta(minutes=5)
SHARDS = 8
BATCH_ROWS = 3
BATCH_DELAY = timedelta(seconds=10)
FRAME_CAP = 64
RANGE_START = datetime(2024, 1, 5, tzinfo=timezone.utc)
RANGE_END = datetime(2024, 1, 9, 12, tzinfo=timezone.utc)

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The tables hold UTC instants without a zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def _ms(name: str) -> Column:
    return F.unix_millis(name).alias(name.replace("_ts", "_ms") if name.endswith("_ts") else name)


def _tick_columns(ticks: DataFrame) -> DataFrame:
    columns = [
        *_long("exchange"),
        "symbol",
        F.col("price").cast("string").alias("price"),
        F.col("volume").cast("string").alias("volume"),
        _ms("exchange_ts"),
        *_long("source_id"),
        _ms("ingest_ts"),
    ]
    if "arrival_seq" in ticks.columns:
        columns += _long("arrival_seq")
    return ticks.select(*columns)


def _frames(spark: SparkSession, sf_dir: str, repeats: bool = True, defects: bool = True) -> DataFrame:
    return event_frames(load(spark, sf_dir, "events"), defects=defects, repeats=repeats)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted ticks for a single reader, straight from the frames."""
    return accepted(classify_frames(_frames(spark, sf_dir)))


def _staged(spark: SparkSession, sf_dir: str) -> Staged:
    """Frames parsed once for several readers."""
    path = scratch_path(spark, "staged")
    return stage_frames(_frames(spark, sf_dir), IngestOptions(), path)


# Sources


@query
def source_registry_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir).drop("format")
    live = with_registered_format(frames, feed_registry(spark, disabled=("kraken",)))
    return live.groupBy("source", "format").agg(F.count(F.lit(1)).alias("frames"))


@query
def normalize_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir, repeats=False)
    return _tick_columns(parse_frames(frames).where(F.col("reason").isNull()))


@query
def frame_size_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir, defects=False)
    parsed = parse_frames(frames, max_frame_bytes=FRAME_CAP)
    return parsed.groupBy("format").agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(F.col("reason") == "frame_too_large").alias("too_large"),
        F.count_if(F.col("reason").isNull()).alias("parsed"),
    )


@query
def source_silence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = source_silence(_frames(spark, sf_dir), timedelta(minutes=10))
    return gaps.select(
        "source",
        F.unix_millis("silent_from").alias("from_ms"),
        F.unix_millis("silent_until").alias("until_ms"),
        F.expr("gap_us div 1000").alias("gap_ms"),
    )


@query
def source_silence_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that are silent a quarter of an hour after the last arrival, one of which never sent."""
    frames = _frames(spark, sf_dir)
    last = frames.agg(F.unix_micros(F.max("ingest_ts"))).first()[0]
    until = datetime.fromtimestamp((last or 0) / 1e6, timezone.utc) + timedelta(minutes=15)
    idle = spark.createDataFrame([("Idle-Feed", "csv", "wss://idle.example", True)], REGISTRY_DDL)
    silent = open_silence(frames, feed_registry(spark).unionByName(idle), timedelta(minutes=10), until)
    return silent.select("source", F.unix_millis("silent_from").alias("from_ms"), F.expr("gap_us div 1000").alias("gap_ms"))


# Parsers


@query
def parse_bad_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that are no text: in front of every third line, and behind every third array."""
    turn = F.expr("arrival_seq div 30 % 3")
    bad = F.when((F.col("format") == "csv") & (turn == 0), F.concat(F.unhex(F.lit("FF")), "frame"))
    bad = bad.when((F.col("format") == "kraken") & (turn == 1), F.concat("frame", F.unhex(F.lit("FFFE"))))
    parsed = parse_frames(_frames(spark, sf_dir).withColumn("frame", bad.otherwise(F.col("frame"))))
    return parsed.groupBy("format", "reason").agg(F.count(F.lit(1)).alias("frames"))


def _parsed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frames = _frames(spark, sf_dir, repeats=False).where(F.col("format") == name)
    return _tick_columns(parse_as(frames, name).where(F.col("reason").isNull()))


@query
def parse_binance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "binance")


@query
def parse_kraken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "kraken")


@query
def parse_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "csv")


@query
def parse_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_frames(_frames(spark, sf_dir))
    rejects = parsed.where(F.col("reason").isNotNull())
    return rejects.groupBy("format", "reason").agg(F.count(F.lit(1)).alias("frames"))


# Validation


@query
def validate_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tick_columns(_accepted(spark, sf_dir))


@query
def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = classify_frames(_frames(spark, sf_dir)).where(F.col("reason").isNotNull())
    return rejects.groupBy("format", "reason").agg(F.count(F.lit(1)).alias("frames"))


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = rejected(classify_frames(_frames(spark, sf_dir)))
    return rejects.select("source", "format", "reason", _ms("ingest_ts"), *_long("arrival_seq"))


# Routing


@query
def symbol_fnv1a64(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    names = names.unionByName(load(spark, sf_dir, "part").select(F.col("p_name").alias("name")))
    names = names.unionByName(_event_symbols(spark, sf_dir)).distinct()
    return names.select("name", fnv1a64(F.col("name")).cast("string").alias("hash"))


@query
def symbol_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spread(load(spark, sf_dir, "customer"))
    return customers.select(
        *_long("c_custkey"), shard_of(F.col("c_name"), SHARDS).cast("bigint").alias("shard")
    )


@query
def shard_tick_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = shard_counts(_accepted(spark, sf_dir), SHARDS)
    return counts.select(*_long("shard", "received", "symbols"))


@query
def ticks_with_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_shard(_accepted(spark, sf_dir), SHARDS)
    return placed.select(*_long("arrival_seq"), "symbol", *_long("shard"))


def _event_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = load(spark, sf_dir, "events").select(F.upper("event_type").alias("base")).distinct()
    return types.select(
        F.explode(F.array(*[F.concat("base", F.lit(s)) for s in ("USDT", "/USD", "USD")])).alias("name")
    )


# Dedup


@query
def dedup_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tick_columns(sliding_window_dedup(_staged(spark, sf_dir).ticks, WINDOW))


@query
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _staged(spark, sf_dir).ticks
    counts = duplicate_counts(ticks, sliding_window_dedup(ticks, WINDOW), ["exchange"])
    return counts.select(*_long("exchange", "received", "admitted", "deduplicated"))


@query
def dedup_window_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _staged(spark, sf_dir).ticks
    parts = []
    for width in (39_999, 40_000, 40_001, 59_999, 60_000, 60_001):
        kept = sliding_window_dedup(ticks, timedelta(milliseconds=width))
        parts.append(
            kept.groupBy("exchange")
            .agg(F.count(F.lit(1)).alias("admitted"))
            .select(F.lit(width).cast("bigint").alias("window_ms"), *_long("exchange", "admitted"))
        )
    return fan_in(*parts)


@query
def dedup_exact_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _staged(spark, sf_dir).ticks
    kept = sliding_window_dedup(ticks, LONG_WINDOW)
    return kept.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("admitted"), F.countDistinct("exchange_ts").alias("instants")
    )


@query
def dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    keys = ["l_orderkey", "l_linenumber"]
    order = [c for c in items.columns if c not in (*keys, "l_shipdate")]
    kept = sliding_window_dedup(items, timedelta(days=30), keys, "l_shipdate", order)
    return kept.select(
        *_long("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "l_extendedprice",
        F.unix_millis("l_shipdate").alias("ship_ms"),
    )


@query
def dedup_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys hold all rows; the bounds are lowered so that the split way is taken."""
    events = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    kept = sliding_window_dedup(
        events.select("event_type", "ts", "event_id", "user_id"),
        timedelta(hours=1),
        ["event_type"],
        "ts",
        ["event_id"],
        fold_rows=100,
        segment_rows=500,
    )
    return kept.select("event_type", F.unix_micros("ts").alias("ts_us"), *_long("event_id", "user_id"))


@query
def dedup_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule with a whole-number time and a short history per key (fold)."""
    events = load(spark, sf_dir, "events").withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp")))
    kept = sliding_window_dedup(
        events.select("user_id", "event_type", "ts_us", "event_id"),
        24 * 3_600_000_000,
        ["user_id", "event_type"],
        "ts_us",
        ["event_id"],
    )
    return kept.select(*_long("user_id"), "event_type", *_long("ts_us", "event_id"))


# Batches


@query
def write_batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir, {})


@query
def write_batches_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that open with a row and close after N rows or T."""
    # Both the dedup and the numbering read their input several times.
    admitted = materialize(sliding_window_dedup(_staged(spark, sf_dir).ticks, WINDOW))
    batched = aligned_batches(admitted, SHARDS, BATCH_ROWS, BATCH_DELAY)
    return batched.select(*_long("arrival_seq", "shard", "batch_no"))


@query
def write_batch_numbers_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers by the way taken for very large slots."""
    return _batches(spark, sf_dir, {"sort_rows": 1, "block": 64})


def _batches(spark: SparkSession, sf_dir: str, limits: dict[str, int]) -> DataFrame:
    # Numbering reads its input twice, first for the size of the largest slot.
    kept = materialize(sliding_window_dedup(_staged(spark, sf_dir).ticks, WINDOW))
    numbered = write_batches(kept, SHARDS, BATCH_ROWS, BATCH_DELAY, **limits)
    return numbered.select(*_long("arrival_seq", "shard", "batch_slot", "batch_no"))


# Counters


def _flow(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    staged = _staged(spark, sf_dir)
    admitted = sliding_window_dedup(staged.ticks, WINDOW)
    # Rejects have no trusted tick values; their feed's format stands for the exchange.
    exchange = F.when(F.col("format") == "binance", 1).when(F.col("format") == "kraken", 2).otherwise(3)
    rejects = staged.rejects.select(exchange.cast("smallint").alias("exchange"), "ingest_ts", "reason")
    received = staged.ticks.select("exchange", "ingest_ts", F.lit(None).cast("string").alias("reason"))
    return flow(received.unionByName(rejects), admitted, cols)


@query
def metrics_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = counter_totals(_flow(spark, sf_dir, ["exchange"]), ["exchange"])
    return totals.select(*_long("exchange", "received", "deduplicated", "written", "dropped", "gap"))


@query
def metrics_per_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = interval_counts(_flow(spark, sf_dir, ["ingest_ts"]), timedelta(hours=1))
    names = ["received", "deduplicated", "written", "dropped"]
    return rows.select(
        F.unix_millis("interval_start").alias("interval_ms"),
        *_long(*[f"{n}_delta" for n in names], *names),
    )


@query
def metrics_quiet_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ten minutes from the first arrival to the last, also those in which nothing arrived."""
    rows = interval_counts(_flow(spark, sf_dir, ["ingest_ts"]), timedelta(minutes=10), quiet=True)
    return rows.select(
        F.unix_millis("interval_start").alias("interval_ms"), *_long("received_delta", "received", "written", "dropped")
    )


@query
def conservation_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every frame, with one feed disabled and one not registered."""
    registry = feed_registry(spark, disabled=("kraken",)).where("name <> 'csv-feed'")
    frames = _frames(spark, sf_dir).drop("format")
    # Frames are rendered once and parsed once: the counts and the dedup read stored columns.
    tagged = stored(tag_frames(frames.withColumn("source", F.upper("source")), registry), "tagged")
    classified = classify_frames(tagged.where(F.col("skipped").isNull()).drop("skipped"))
    live = stored(classified.select(*TICK_COLS, "arrival_seq", "source", "reason"), "classified")
    ticks = live.where(F.col("reason").isNull()).select(*TICK_COLS, "arrival_seq", "source")
    admitted = sliding_window_dedup(ticks, WINDOW)
    counted = fan_in(
        tagged.select("source", F.lit("frames").alias("what")),
        tagged.where("skipped IS NOT NULL").select("source", F.col("skipped").alias("what")),
        live.select("source", F.when(F.col("reason").isNull(), "received").otherwise("dropped").alias("what")),
        admitted.select("source", F.lit("written").alias("what")),
    )
    kinds = ["frames", "unlisted", "disabled", "received", "dropped", "written"]
    return counted.groupBy("source").agg(*[F.count_if(F.col("what") == k).alias(k) for k in kinds])


# Stored table


def _stored(spark: SparkSession, sf_dir: str, window: timedelta, on_conflict: str) -> TickTable:
    table = TickTable(spark, scratch_path(spark, "ticks"), on_conflict)
    frames = _frames(spark, sf_dir).drop("format")
    run_ingest(frames, feed_registry(spark), table, 0, IngestOptions(dedup_window=window))
    return table


def _rows(table: TickTable) -> DataFrame:
    return _tick_columns(table.read().drop("arrival_seq"))


@query
def ingest_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(_stored(spark, sf_dir, LONG_WINDOW, "error"))


@query
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = TickTable(spark, scratch_path(spark, "ticks"))
    log = MetricsLog(spark, scratch_path(spark, "counters"))
    frames = _frames(spark, sf_dir).drop("format")
    options = IngestOptions(dedup_window=LONG_WINDOW)
    run_ingest(frames, feed_registry(spark), table, 0, options, metrics=log)
    return log.rows().select(*_long("batch_id", "received", "deduplicated", "written", "dropped"))


@query
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(_stored(spark, sf_dir, WINDOW, "ignore"))


def _cuts(spark: SparkSession, sf_dir: str, parts: int) -> list[datetime]:
    """Arrival instants that cut the frames into about equal parts, taken from the data; no message is rendered for them."""
    frames = event_arrivals(load(spark, sf_dir, "events"))
    shares = [i / parts for i in range(1, parts)]
    cuts = frames.agg(F.percentile_approx(F.unix_micros("ingest_ts"), shares).alias("q")).first().q
    # Without frames any instant will do.
    cuts = cuts or [0] * (parts - 1)
    return [datetime.fromtimestamp(us / 1e6, timezone.utc) for us in cuts]


def _drain(spark: SparkSession, feed: str, table: TickTable, progress: str, intervals: IntervalLog | None = None) -> None:
    running = start_ingest(
        stream_frames(spark, feed, max_files_per_trigger=1000),
        feed_registry(spark),
        table,
        progress,
        IngestOptions(dedup_window=WINDOW),
        drain=True,
        intervals=intervals,
    )
    if not await_drain(running, timedelta(minutes=30)):
        raise TimeoutError("the stream did not drain in time")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job, stopped and resumed as frames arrive in three stretches of time."""
    feed, progress = scratch_path(spark, "frames"), scratch_path(spark, "progress")
    table = TickTable(spark, scratch_path(spark, "ticks"), "keep")
    frames = _frames(spark, sf_dir).drop("format")
    low, high = _cuts(spark, sf_dir, 3)
    arrived = F.col("ingest_ts")
    for part in (arrived < low, (arrived >= low) & (arrived < high), arrived >= high):
        frames.where(part).write.mode("append").parquet(feed)
        _drain(spark, feed, table, progress)
    return _rows(table)


@query
def stream_quiet_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval totals that two runs of the stream wrote batch by batch, with the intervals in which nothing arrived."""
    feed, progress = scratch_path(spark, "frames"), scratch_path(spark, "progress")
    table = TickTable(spark, scratch_path(spark, "ticks"), "keep")
    log = IntervalLog(spark, scratch_path(spark, "intervals"), timedelta(minutes=10))
    frames = _frames(spark, sf_dir).drop("format")
    (cut,) = _cuts(spark, sf_dir, 2)
    for part in (F.col("ingest_ts") < cut, F.col("ingest_ts") >= cut):
        frames.where(part).write.mode("append").parquet(feed)
        _drain(spark, feed, table, progress, log)
    return log.report().select(
        F.unix_millis("interval_start").alias("interval_ms"), *_long("received_delta", "received", "written", "dropped")
    )


@query
def ingest_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the batch job, cut so that every repeat comes in the second."""
    table = TickTable(spark, scratch_path(spark, "ticks"), "keep")
    frames = _frames(spark, sf_dir).drop("format")
    first = F.col("arrival_seq") % 10 == 0
    for batch_id, part in enumerate((first, ~first)):
        run_ingest(frames.where(part), feed_registry(spark), table, batch_id, IngestOptions(dedup_window=WINDOW))
    return _rows(table)


@query
def batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the frames by the batch job, half by the stream, then the first batch once more and a compaction."""
    feed, progress = scratch_path(spark, "frames"), scratch_path(spark, "progress")
    table = TickTable(spark, scratch_path(spark, "ticks"), "keep")
    frames = _frames(spark, sf_dir).drop("format")
    (cut,) = _cuts(spark, sf_dir, 2)
    options = IngestOptions(dedup_window=WINDOW)
    early = frames.where(F.col("ingest_ts") < cut)
    run_ingest(early, feed_registry(spark), table, 0, options)
    frames.where(F.col("ingest_ts") >= cut).write.parquet(feed)
    _drain(spark, feed, table, progress)
    run_ingest(early, feed_registry(spark), table, 0, options)
    table.compact()
    return _rows(table)


@query
def stored_arrival_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows keep the number under which they arrived."""
    stored = _stored(spark, sf_dir, WINDOW, "keep").read()
    return stored.select(*_long("arrival_seq"), "symbol", *_long("source_id"))


@query
def offset_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants given with an offset of three hours are stored as what they are, on their day in UTC."""
    ts = F.col("ts").cast("timestamp")
    local = F.date_format(ts + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    ticks = load(spark, sf_dir, "events").select(
        F.lit(EXCHANGES["Mock"]).alias("exchange"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.lit(1).alias("volume"),
        F.to_timestamp(F.concat(local, F.lit("+03:00"))).alias("exchange_ts"),
        F.col("event_id").alias("source_id"),
        ts.alias("ingest_ts"),
    )
    table = TickTable(spark, scratch_path(spark, "ticks"), "keep").create()
    table.append(ticks, 0)
    day = F.unix_date("exchange_date").cast("bigint").alias("day")
    return table.read().select(*_long("source_id"), F.unix_millis("exchange_ts").alias("exchange_ms"), day)


@query
def ticks_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored(spark, sf_dir, WINDOW, "keep")
    return table.read().agg(
        F.count(F.lit(1)).alias("ticks"), F.countDistinct(F.struct(*KEY_COLS)).alias("keys")
    )


@query
def ticks_distinct_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    _stored(spark, sf_dir, LONG_WINDOW, "error").register("ticks")
    return spark.sql("SELECT DISTINCT CAST(exchange AS BIGINT) AS exchange FROM ticks")


@query
def ticks_by_exchange_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_exchange_name(_stored(spark, sf_dir, LONG_WINDOW, "error").read())
    return named.groupBy("exchange_name").agg(F.count(F.lit(1)).alias("ticks"))


@query
def ticks_point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir, LONG_WINDOW, "error").read()
    return stored.where(F.col("symbol") == "CLICK/USD").select(
        "symbol",
        F.col("price").cast("string").alias("price"),
        F.col("volume").cast("string").alias("volume"),
        *_long("source_id"),
    )


@query
def ticks_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored(spark, sf_dir, LONG_WINDOW, "error")
    rows = table.time_range(RANGE_START, RANGE_END)
    return rows.select(*_long("exchange"), "symbol", _ms("exchange_ts"), *_long("source_id"))


@query
def duplicate_tick_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeated = duplicate_keys(_accepted(spark, sf_dir))
    return repeated.select(
        *_long("exchange"), "symbol", _ms("exchange_ts"), *_long("source_id", "copies")
    )
