"""Batches, silence, counters, registry."""

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import NOON
from tickloom.operators.batching import write_batches
from tickloom.operators.metrics import MetricsLog, Snapshot, counter_totals, flow, interval_counts
from tickloom.operators.silence import open_silence, source_silence
from tickloom.schema import FRAME_SCHEMA
from tickloom.operators.parse import parse_as
from tickloom.sources.frames import fan_in, read_file_frames, read_frames, read_line_frames
from tickloom.sources.registry import REGISTRY_DDL, check_registry, tag_frames, with_registered_format


@pytest.mark.parametrize("limits", [{}, {"sort_rows": 1, "block": 3}])
def test_write_batches(make_ticks, limits):
    rng = random.Random(1)
    ticks = make_ticks(
        [{"symbol": f"S{rng.randrange(3)}", "source_id": i, "at": rng.randrange(40) / 20} for i in range(300)]
    )
    rows = write_batches(ticks, 2, 4, timedelta(milliseconds=500), **limits).collect()
    assert sorted(r.arrival_seq for r in rows) == list(range(300))
    batches = defaultdict(list)
    for r in rows:
        batches[r.shard, r.batch_slot, r.batch_no].append(r)
    slots = defaultdict(list)
    for (shard, slot, no), members in batches.items():
        assert len(members) <= 4
        times = [m.ingest_ts for m in members]
        assert max(times) - min(times) < timedelta(milliseconds=500)
        slots[shard, slot].append(no)
    for (shard, slot), numbers in slots.items():
        assert sorted(numbers) == list(range(1, len(numbers) + 1))
        full = [len(batches[shard, slot, n]) for n in sorted(numbers)]
        assert all(n == 4 for n in full[:-1])
        arrivals = [
            (m.ingest_ts, m.arrival_seq, n) for n in numbers for m in batches[shard, slot, n]
        ]
        assert [a[2] for a in sorted(arrivals)] == sorted(a[2] for a in arrivals)


def test_write_batches_guards(make_ticks):
    with pytest.raises(ValueError):
        write_batches(make_ticks([{}]), 1, 0, timedelta(seconds=1))
    with pytest.raises(ValueError):
        write_batches(make_ticks([{}]), 1, 1, timedelta(0))


def _frames(spark, rows):
    data = [(s, bytearray(b"x"), NOON + timedelta(seconds=t), i) for i, (s, t) in enumerate(rows)]
    return spark.createDataFrame(data, FRAME_SCHEMA)


def test_source_silence(spark):
    frames = _frames(spark, [("a", 0), ("a", 60), ("a", 121), ("a", 119), ("b", 5), ("b", 300), ("c", 1)])
    gaps = source_silence(frames, timedelta(seconds=60)).collect()
    assert [(r.source, r.gap_us) for r in gaps] == [("b", 295_000_000)]
    rng = random.Random(2)
    times = sorted(rng.randrange(4000) for _ in range(120))
    want = [b - a for a, b in zip(times, times[1:]) if b - a > 45]
    found = source_silence(_frames(spark, [("z", t) for t in times]), timedelta(seconds=45))
    assert sorted(r.gap_us // 1_000_000 for r in found.collect()) == sorted(want)


def test_open_silence(spark):
    frames = _frames(spark, [("a", 0), ("A", 100), ("b", 5), ("d", 130)])
    registry = _registry(spark, [("A", "csv", True), ("B", "csv", True), ("never", "csv", True), ("d", "csv", True), ("c", "csv", False)])
    until = NOON + timedelta(seconds=120)
    found = open_silence(frames, registry, timedelta(seconds=20), until).collect()
    assert sorted((r.source, r.gap_us) for r in found if r.gap_us) == [("B", 115_000_000)]
    # What arrives after the instant does not count.
    assert {r.source for r in found if r.gap_us is None} == {"never", "d"}


def test_quiet_intervals_are_reported(make_ticks):
    ticks = make_ticks([{"source_id": i, "at": at} for i, at in enumerate((0, 1, 7))])
    rows = flow(ticks.withColumn("reason", F.lit(None).cast("string")), ticks, ["exchange", "ingest_ts"])
    steps = interval_counts(rows, timedelta(seconds=2), quiet=True).orderBy("interval_start").collect()
    assert [(r.received_delta, r.received) for r in steps] == [(2, 2), (0, 2), (0, 2), (1, 3)]
    assert interval_counts(rows.limit(0), timedelta(seconds=2), quiet=True).count() == 0
    with pytest.raises(ValueError):
        interval_counts(rows, timedelta(milliseconds=1500))


def test_tagging_names_every_frame(spark):
    frames = _frames(spark, [("ONE", 0), ("one", 1), ("Two", 2), ("three", 3)])
    registry = _registry(spark, [("One", "csv", True), ("one", "kraken", False), ("two", "csv", False)])
    found = {(r.source, r.format, r.skipped) for r in tag_frames(frames, registry).collect()}
    assert found == {("ONE", "csv", None), ("one", "csv", None), ("Two", None, "disabled"), ("three", None, "unlisted")}
    assert with_registered_format(frames, registry).count() == 2


def test_snapshot_and_log(spark, tmp_path):
    counts = Snapshot(5, 2, 3, 1)
    assert counts.gap == 2 and counts.in_flight == 0
    counts.check_conserved(6)
    with pytest.raises(RuntimeError):
        counts.check_conserved(7)
    with pytest.raises(RuntimeError):
        Snapshot(5, 2, 2, 1).check_conserved(6)
    log = MetricsLog(spark, str(tmp_path / "log"))
    assert log.snapshot() == Snapshot()
    log.record(0, counts)
    log.record(1, Snapshot(1, 0, 1, 0))
    log.record(1, Snapshot(1, 0, 1, 0))
    assert log.snapshot() == log.snapshot() == Snapshot(6, 2, 4, 1)


def test_totals_and_intervals(make_ticks):
    ticks = make_ticks([{"source_id": i, "at": i * 30_000} for i in range(6)])
    classified = ticks.withColumn("reason", F.when(F.col("source_id") == 5, "price_range"))
    admitted = ticks.where("source_id < 4")
    rows = flow(classified, admitted, ["exchange", "ingest_ts"])
    total = counter_totals(rows).first()
    assert (total.received, total.deduplicated, total.written, total.dropped, total.gap) == (5, 1, 4, 1, 1)
    steps = interval_counts(rows, timedelta(seconds=1)).orderBy("interval_start").collect()
    assert [r.received_delta for r in steps] == [1, 1, 1, 1, 1, 0]
    assert [r.received for r in steps] == [1, 2, 3, 4, 5, 5]
    assert steps[-1].dropped == 1 and steps[-1].deduplicated == 1 and steps[-1].written == 4


def _registry(spark, rows):
    return spark.createDataFrame([(n, f, "wss://x", e) for n, f, e in rows], REGISTRY_DDL)


def test_registry_checks(spark):
    good = [("A", "binance", True), ("b", "csv", True), ("a", "csv", False), ("", "fix", False)]
    assert check_registry(_registry(spark, good)) == 2
    assert check_registry(_registry(spark, [("x", "csv", False)])) == 0
    for rows, message in (
        ([("A", "csv", True), ("a", "kraken", True)], "more than once"),
        ([("  ", "csv", True)], "empty name"),
        ([("x", "fix", True)], "unknown frame format"),
    ):
        with pytest.raises(ValueError, match=message):
            check_registry(_registry(spark, rows))


def test_only_enabled_sources_pass(spark):
    frames = _frames(spark, [("a", 0), ("b", 0), ("c", 0), ("a", 1)])
    registry = _registry(spark, [("a", "csv", True), ("b", "csv", False)])
    kept = with_registered_format(frames, registry).collect()
    assert [(r.source, r.format) for r in kept] == [("a", "csv")] * 2


def test_fan_in_keeps_everything(spark, tmp_path):
    a, b = _frames(spark, [("a", 0), ("a", 0)]), _frames(spark, [("b", 0)])
    both = fan_in(a, b.select("arrival_seq", "frame", "source", "ingest_ts"))
    assert both.count() == 3
    both.write.parquet(str(tmp_path / "frames"))
    assert read_frames(spark, str(tmp_path / "frames")).count() == 3
    with pytest.raises(ValueError):
        fan_in()


def test_text_and_binary_sources(spark, tmp_path):
    lines = ["ETHUSD,1,1,1700000000000,1", "junk", "ETHUSD,2,1,1700000000000,2"]
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(lines) + "\n")
    parsed = parse_as(read_line_frames(spark, str(folder), "lines"), "csv").orderBy("arrival_seq")
    rows = parsed.collect()
    assert [r.source_id for r in rows if r.reason is None] == [1, 2]
    assert bytes(rows[1].frame) == b"junk" and rows[1].ingest_ts is not None
    whole = parse_as(read_file_frames(spark, str(folder), "files"), "csv").collect()
    assert len(whole) == 1 and whole[0].reason == "malformed_frame"
