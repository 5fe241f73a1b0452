import random
from datetime import timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.operators.dedup import (
    drop_recently_admitted,
    duplicate_counts,
    first_per,
    refused_rows,
    sliding_window_dedup,
)
from tickloom.operators.hot_chain import combine_steps, walk_steps
from tickloom.schema import KEY_COLS


def simulate(rows, width):
    """Arrivals (t, seq, key) one after another; returns the sequence numbers let through."""
    expiry, kept = {}, set()
    for t, seq, key in sorted(rows):
        if key not in expiry or expiry[key] <= t:
            expiry[key] = t + width
            kept.add(seq)
    return kept


@pytest.mark.parametrize(
    "arrivals,window,admitted",
    [
        ([0, 0], 60, [0]),
        ([0, 11], 10, [0, 11]),
        ([0, 5], 10, [0]),
        ([0, 11, 16], 10, [0, 11]),
        ([0, 10], 10, [0, 10]),
        ([0, 6, 12, 22], 10, [0, 12, 22]),
        ([0, 15, 40, 41, 100], 10, [0, 15, 40, 100]),
    ],
)
@pytest.mark.parametrize("fold_rows", [1000, 1])
def test_window_rule(make_ticks, arrivals, window, admitted, fold_rows):
    ticks = make_ticks([{"at": a} for a in arrivals])
    kept = sliding_window_dedup(ticks, timedelta(seconds=window), fold_rows=fold_rows, segment_rows=1)
    seconds = [r.ingest_ts.second + 60 * r.ingest_ts.minute for r in kept.collect()]
    assert sorted(seconds) == admitted


def test_key_is_exact_and_first_payload_wins(make_ticks):
    ticks = make_ticks(
        [
            {"source_id": 1, "price": "10", "at": 1, "arrival_seq": 7},
            {"source_id": 1, "price": "20", "at": 1, "arrival_seq": 3},
            {"source_id": 2},
            {"source_id": 1, "exchange": 2},
            {"source_id": 1, "symbol": "ETHUSDT"},
        ]
    )
    kept = sliding_window_dedup(ticks, timedelta(seconds=60)).collect()
    assert sorted((r.exchange, r.symbol, r.source_id, int(r.price)) for r in kept) == [
        (1, "BTCUSDT", 1, 20),
        (1, "BTCUSDT", 2, 50000),
        (1, "ETHUSDT", 1, 50000),
        (2, "BTCUSDT", 1, 50000),
    ]


def test_window_must_be_positive(make_ticks):
    for width in (timedelta(0), timedelta(seconds=-1)):
        with pytest.raises(ValueError):
            sliding_window_dedup(make_ticks([{}]), width)


@pytest.mark.parametrize("fold_rows,segment_rows", [(10_000, 1), (20, 40), (1, 7), (0, 1_000_000)])
def test_random_arrivals_match_simulation(spark, fold_rows, segment_rows):
    rng = random.Random(fold_rows)
    # A third of all rows in one key; the others are short.
    rows = [
        (rng.randrange(3000), i, None if i % 3 == 0 else rng.randrange(400)) for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "t bigint, seq bigint, key bigint").repartition(5)
    kept = sliding_window_dedup(
        df, 10, ["key"], "t", ["seq"], fold_rows=fold_rows, segment_rows=segment_rows
    )
    got = [r.seq for r in kept.collect()]
    assert len(got) == len(set(got))
    assert set(got) == simulate([(t, s, k if k is not None else -1) for t, s, k in rows], 10)


def test_lateness_bound_finds_every_key(spark):
    """Keys with a time of their own; some clocks are far off, some arrivals come much later."""
    rng = random.Random(9)
    rows = []
    for i in range(4000):
        key = rng.randrange(1500)
        own = key * 3
        late = rng.choice([0, 1, 2, 9, 10, 11, 40]) - (500 if key % 97 == 0 else 0)
        rows.append((own + late, i, key, own))
    df = spark.createDataFrame(rows, "t bigint, seq bigint, key bigint, own bigint")
    want = simulate([(t, s, k) for t, s, k, _ in rows], 10)
    for anchor in ("own", None):
        kept = sliding_window_dedup(df, 10, ["key", "own"], "t", ["seq"], fold_rows=3, anchor_col=anchor)
        assert {r.seq for r in kept.collect()} == want


def test_hot_key_over_many_segments(spark):
    # One key holds everything; several levels of segments are combined.
    rng = random.Random(5)
    rows = [(rng.randrange(20_000), i, 1) for i in range(12_000)]
    df = spark.createDataFrame(rows, "t bigint, seq bigint, key bigint")
    kept = sliding_window_dedup(df, 100, ["key"], "t", ["seq"], fold_rows=10, segment_rows=50)
    assert {r.seq for r in kept.collect()} == simulate(rows, 100)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True),
    st.integers(1, 60),
    st.lists(st.integers(0, 400), max_size=5),
)
def test_combined_steps_equal_the_rule(instants, width, cuts):
    """Cut a key's instants anywhere, combine the pieces, and compare with the plain rule."""
    instants = sorted(instants)
    hi, out = [], []
    edges = [-1, *sorted(cuts), 401]
    for low, high in zip(edges, edges[1:]):
        piece = np.array([t for t in instants if low < t <= high], dtype=np.int64)
        if len(piece):
            h, o = combine_steps(piece, piece + width, width)
            hi.extend(h)
            out.extend(o)
    hi, out = np.array(hi), np.array(out)

    def free_after(entry):
        for t in instants:
            if t >= entry:
                entry = t + width
        return entry

    # What may come in is at most one window after an arrival before these, or after the first one.
    for entry in range(instants[0] + width + 1):
        met, incoming = walk_steps(hi, out, entry)
        last = int(out[met[-1]]) if met else entry
        assert last == free_after(entry)


def test_first_arrival_is_found_before_the_shuffle(spark, tmp_path, make_ticks, capsys):
    make_ticks([{"source_id": i % 3} for i in range(9)]).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    first_per(stored, KEY_COLS, ["ingest_ts", "arrival_seq"]).explain()
    plan = capsys.readouterr().out
    shuffle = plan.index("Exchange hashpartitioning(exchange")
    assert plan.count("Exchange ") == 1
    assert "Final" in plan[:shuffle] and "Partial" in plan[shuffle:]


def test_counts(make_ticks):
    # Eight producers send the same keys.
    ticks = make_ticks([{"source_id": i % 50, "at": i // 50} for i in range(400)])
    admitted = sliding_window_dedup(ticks, timedelta(seconds=60))
    row = duplicate_counts(ticks, admitted, ["exchange"]).first()
    assert (row.received, row.admitted, row.deduplicated) == (400, 50, 350)


def test_carried_window(make_ticks):
    earlier = make_ticks([{"source_id": 1, "at": 0}, {"source_id": 2, "at": 5}])
    later = make_ticks(
        [{"source_id": 1, "at": 9}, {"source_id": 1, "at": 10}, {"source_id": 2, "at": 14}, {"source_id": 3}]
    )
    left = drop_recently_admitted(later, earlier, timedelta(seconds=10)).collect()
    assert sorted((r.source_id, r.ingest_ts.second) for r in left) == [(1, 10), (3, 0)]


def test_refused_rows_lie_in_a_window(make_ticks):
    rng = random.Random(8)
    rows = [{"source_id": rng.randint(0, 5), "at": rng.randint(0, 200)} for _ in range(300)]
    ticks = make_ticks([r | {"arrival_seq": i} for i, r in enumerate(rows)])
    before = make_ticks([{"source_id": 1, "at": 30}, {"source_id": 2, "at": 150}])
    window = timedelta(seconds=10)
    admitted = sliding_window_dedup(drop_recently_admitted(ticks, before, window), window)
    kept = {r.arrival_seq for r in admitted.collect()}
    refused = {r.arrival_seq for r in refused_rows(ticks, admitted, before, window).collect()}
    assert not kept & refused and kept | refused == set(range(300))
    # A row that was lost on the way is in neither.
    (some,) = admitted.where("source_id = 3").orderBy(F.desc("ingest_ts")).limit(1).collect()
    short = admitted.where(F.col("arrival_seq") != some.arrival_seq)
    assert some.arrival_seq not in {r.arrival_seq for r in refused_rows(ticks, short, before, window).collect()}
