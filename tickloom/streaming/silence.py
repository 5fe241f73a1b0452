"""Silence of sources while a stream runs: reported when it has lasted long enough, and again with its end when it is over."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.schema import micros

# The helpers below travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "source string, from_ts timestamp, until_ts timestamp"
_STRETCHES = "source string, first_us long, last_us long"


def stretches(sources: np.ndarray, instants: np.ndarray, idle: int) -> list[tuple[str, int, int]]:
    """Arrivals as (source, first, last) of stretches without a pause longer than `idle`."""
    out = []
    for source in np.unique(sources):
        own = np.sort(instants[sources == source])
        cuts = np.flatnonzero(np.diff(own) > idle)
        firsts, lasts = own[np.append(0, cuts + 1)], own[np.append(cuts, len(own) - 1)]
        out += [(str(source), int(a), int(b)) for a, b in zip(firsts, lasts, strict=True)]
    return out


def silent_sources(frames: DataFrame, idle: timedelta) -> DataFrame:
    """A streaming report of pauses longer than `idle`: with `until_ts` when the source is back, without it when nothing
    came for that long by the clock. Names are compared as they come; null sources are left out.

    Each task reduces its frames to stretches first, so a busy source sends a few rows per task to its state, which is one instant.
    A stream needs a processing-time trigger; then it looks at the clock at every trigger, with or without frames.
    """
    width = micros(idle)
    if width <= 0:
        raise ValueError("the pause must be positive")

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = np.array(batch.column("source").to_pylist(), object)
                rows = stretches(names.astype(str), batch.column("at_us").to_numpy(), width)
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["source", "first_us", "last_us"])

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = []
        if state.hasTimedOut:
            # The state stays, so the end of the pause is reported too.
            rows.append((last, None))
            state.update((last,))
        else:
            own = pd.concat(list(parts)).sort_values("first_us")
            for first, end in zip(own["first_us"].tolist(), own["last_us"].tolist(), strict=True):
                if last is not None and first - last > width:
                    rows.append((last, first))
                last = end if last is None else max(last, end)
            state.update((last,))
            state.setTimeoutDuration(max(1, width // 1000))
        if rows:
            begin, until = ([pd.Timestamp(us, unit="us", tz="UTC") if us is not None else pd.NaT for us in c] for c in zip(*rows, strict=True))
            yield pd.DataFrame({"source": key[0], "from_ts": begin, "until_ts": pd.Series(until, dtype="datetime64[ns, UTC]")})

    arrivals = frames.where(F.col("source").isNotNull()).select("source", F.unix_micros("ingest_ts").alias("at_us"))
    grouped = arrivals.mapInArrow(reduced, _STRETCHES).groupBy("source")
    return grouped.applyInPandasWithState(follow, SCHEMA, "last_us long", "append", GroupStateTimeout.ProcessingTimeTimeout)
