"""What a running stream tells: silent sources, counters per trigger, intervals."""

import random
import time
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_jobs import LONG, frame_rows, make_frames, registry  # noqa: F401

from conftest import NOON
from tickloom.operators.metrics import IntervalLog, MetricsLog, flow, interval_counts
from tickloom.operators.parse import accepted, classify_frames
from tickloom.operators.silence import source_silence
from tickloom.plans.ingest import run_ingest
from tickloom.schema import FRAME_SCHEMA
from tickloom.sources.frames import stream_frames
from tickloom.sources.registry import tag_frames
from tickloom.sources.tick_table import TickTable
from tickloom.streaming.counters import TriggerLog
from tickloom.streaming.ingest import await_drain, start_ingest, stream_name
from tickloom.streaming.silence import silent_sources, stretches


def test_stretches_are_cut_at_pauses():
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randint(0, 400)) for _ in range(60)]
    names, at = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for name in "ab":
        own = sorted(t for n, t in rows if n == name)
        pauses = [(x, y) for x, y in zip(own, own[1:], strict=False) if y - x > 9]
        found = [(a, b) for n, a, b in stretches(names, at, 9) if n == name]
        assert [(x[1], y[0]) for x, y in zip(found, found[1:], strict=False)] == pauses
        assert found[0][0] == own[0] and found[-1][1] == own[-1]


def _feed(spark, path, rows):
    """(source, second) frames in one file."""
    data = [(s, bytearray(b"x"), NOON + timedelta(seconds=at), i) for i, (s, at) in enumerate(rows)]
    spark.createDataFrame(data, FRAME_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_a_source_that_stops_is_reported_while_the_stream_runs(spark, tmp_path):
    feed = str(tmp_path / "feed")
    _feed(spark, feed, [("a", 0), ("a", 1), ("b", 0), ("b", 9), ("b", 10)])
    report = silent_sources(stream_frames(spark, feed, 1), timedelta(seconds=3))
    query = (
        report.writeStream.format("memory").queryName("silent_now").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(processingTime="200 milliseconds").start()
    )

    def told(count):
        until = time.monotonic() + 120
        while spark.table("silent_now").count() < count and time.monotonic() < until and query.isActive:
            time.sleep(0.3)
        rows = spark.table("silent_now").collect()
        return {(r.source, (r.from_ts - first).seconds, r.until_ts and (r.until_ts - first).seconds) for r in rows}

    first = NOON.replace(tzinfo=None)
    try:
        # A pause in the data, and two that last.
        assert told(3) == {("b", 0, 9), ("a", 1, None), ("b", 10, None)}
        _feed(spark, feed, [("a", 21)])
        assert told(5) == {("b", 0, 9), ("a", 1, None), ("b", 10, None), ("a", 1, 21), ("a", 21, None)}
    finally:
        query.stop()
    with pytest.raises(ValueError):
        silent_sources(report, timedelta(0))


def test_closed_pauses_equal_the_report_over_the_table(spark, tmp_path):
    rng = random.Random(5)
    feed, rows = str(tmp_path / "feed"), []
    at = 0
    for _ in range(4):
        part = []
        for _ in range(50):
            at += rng.choice([0, 1, 1, 2, 8, 30])
            part.append((rng.choice("abc"), at))
        rng.shuffle(part)
        _feed(spark, feed, part)
        rows += part
    idle = timedelta(seconds=20)
    query = (
        silent_sources(stream_frames(spark, feed, 1), idle).writeStream.format("memory").queryName("closed_pauses")
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(processingTime="100 milliseconds").start()
    )
    try:
        # Triggers go on without frames, to look at the clock.
        until = time.monotonic() + 60
        while sum(p.numInputRows for p in query.recentProgress) < len(rows) and time.monotonic() < until:
            time.sleep(0.3)
        found = {(r.source, r.from_ts, r.until_ts) for r in spark.table("closed_pauses").where("until_ts is not null").collect()}
    finally:
        query.stop()
    data = [(s, bytearray(b"x"), NOON + timedelta(seconds=t), i) for i, (s, t) in enumerate(rows)]
    expected = source_silence(spark.createDataFrame(data, FRAME_SCHEMA), idle).collect()
    assert found == {(r.source, r.silent_from, r.silent_until) for r in expected} and found


def test_triggers_are_logged_over_a_restart(spark, tmp_path, registry):  # noqa: F811
    feed, progress = str(tmp_path / "feed"), str(tmp_path / "progress")
    table, counts = TickTable(spark, str(tmp_path / "ticks")), MetricsLog(spark, str(tmp_path / "counts"))
    log = TriggerLog(spark, str(tmp_path / "triggers"), stream_name(progress))
    assert log.rows().count() == 0
    spark.streams.addListener(log)
    try:
        for start in (0, 40):
            for i in range(2):
                rows = frame_rows([(start + i * 10 + k, k % 3) for k in range(10)], start + i * 10)
                make_frames(spark, rows + [("off", bytearray(b"-"), NOON, 9000 + start + i)]).coalesce(1).write.mode("append").parquet(feed)
            query = start_ingest(stream_frames(spark, feed, 1), registry, table, progress, LONG, metrics=counts, drain=True)
            assert await_drain(query, timedelta(seconds=240))
            log.settle(query)
    finally:
        spark.streams.removeListener(log)
    logged = {r.batch_id: r for r in log.rows().collect()}
    totals = counts.snapshot()
    assert len(logged) == 4 and sum(r.frames for r in logged.values()) == totals.received + totals.dropped + totals.skipped == 44
    assert all(r.frames == r.input_rows == 11 for r in logged.values())
    assert max(r.last_arrival_us for r in logged.values()) == int((NOON + timedelta(seconds=2)).timestamp() * 1e6)


def test_intervals_merge_over_batches_and_replays(spark, tmp_path, registry):  # noqa: F811
    rows = frame_rows([(i % 50, 7 * i) for i in range(120)]) + [("lines", bytearray(b"junk"), NOON + timedelta(seconds=4000), 500)]
    interval = timedelta(seconds=60)
    log = IntervalLog(spark, str(tmp_path / "intervals"), interval)
    assert log.report().count() == 0
    table = TickTable(spark, str(tmp_path / "ticks"), "keep")
    parts = rows[::2], rows[1::2]
    for batch, part in enumerate(parts):
        run_ingest(make_frames(spark, part), registry, table, batch, LONG, intervals=log)
    run_ingest(make_frames(spark, parts[0]), registry, table, 0, LONG, intervals=log)
    frames = tag_frames(make_frames(spark, rows), registry).drop("skipped")
    whole = classify_frames(frames)
    expected = interval_counts(flow(whole, table.read(), ["ingest_ts"]), interval, quiet=True)
    assert sorted(log.report().collect()) == sorted(expected.select(*log.report().columns).collect())
    assert accepted(whole).count() == 120
    with pytest.raises(ValueError):
        IntervalLog(spark, "x", timedelta(milliseconds=1))
