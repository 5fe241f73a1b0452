import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import aligned_batches as ab
from tickloom.operators.numbering import number_rows


def walk(instants, max_rows, width):
    """Batch of each row, one row after another."""
    out, number, first, count = [], 0, None, 0
    for t in instants:
        if first is None or count == max_rows or t >= first + width:
            number, first, count = number + 1, t, 0
        count += 1
        out.append(number)
    return out


def instants_of(seed, count):
    rng = random.Random(seed)
    t, out = 0, []
    for _ in range(count):
        t += rng.choice([0, 0, 1, 2, 3, 5, 40])
        out.append(t)
    return out


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("max_rows,width", [(1, 5), (3, 10), (7, 4), (9, 1000), (20, 30)])
def test_functions_of_segments_give_the_walk(seed, max_rows, width):
    instants = np.array(instants_of(seed, 150))
    size = 25
    cuts = range(0, len(instants), size)
    functions = [
        ab.segment_steps(instants[a : a + size + max_rows], min(size, len(instants) - a), max_rows, width) for a in cuts
    ]
    entries = ab.chain(functions, np.array([0]))
    numbers, before = [], 0
    for a, entry in zip(cuts, entries, strict=False):
        own = instants[a : a + size]
        starts = ab.batch_starts(own, int(entry[0]), max_rows, width)
        numbers += (before + np.searchsorted(starts, np.arange(len(own)), "right")).tolist()
        before += len(starts)
    assert numbers == walk(instants.tolist(), max_rows, width)


@pytest.mark.parametrize("segment", [4, 11, 1000])
def test_batches_of_ticks_by_a_walk(make_ticks, segment):
    rng = random.Random(segment)
    rows = []
    for at in instants_of(segment, 400):
        rows.append({"symbol": rng.choice(["A", "B", "B", "B", "C"]), "at": at, "source_id": len(rows)})
    rows = [row | {"arrival_seq": i} for i, row in enumerate(rows)]
    ticks = make_ticks(rows).withColumn("extra", F.lit("kept"))
    found = ab.aligned_batches(ticks, 2, 3, timedelta(seconds=10), segment_rows=segment)
    assert found.columns == [*ticks.columns, "shard", "batch_no"]
    by_shard = {}
    for r in sorted(found.collect(), key=lambda r: (r.ingest_ts, r.arrival_seq)):
        by_shard.setdefault(r.shard, []).append(r)
    assert sum(map(len, by_shard.values())) == len(rows)
    for own in by_shard.values():
        seconds = [r.ingest_ts.timestamp() for r in own]
        assert [r.batch_no for r in own] == walk(seconds, 3, 10)


def test_guards_and_empty_ticks(make_ticks):
    none = make_ticks([])
    assert ab.aligned_batches(none, 2, 3, timedelta(seconds=1)).count() == 0
    for max_rows, delay in ((0, timedelta(seconds=1)), (1, timedelta(0))):
        with pytest.raises(ValueError):
            ab.aligned_batches(none, 2, max_rows, delay)


def test_places_in_groups(spark):
    rows = [("a" if i % 3 else "b", (i * 37) % 101, i) for i in range(300)]
    found = number_rows(spark.createDataFrame(rows, "g string, k int, i int"), ["g"], ["k", "i"]).collect()
    for name in "ab":
        own = sorted(((r.k, r.i, r._pos) for r in found if r.g == name))
        assert [p for *_, p in own] == list(range(len(own)))
