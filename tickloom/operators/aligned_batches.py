"""Write batches that start at the data: a batch opens with a row and closes after N rows or T after that row's arrival.

Where a batch ends depends on where it began, and so on all batches of its shard before it. Rows are numbered per shard
in order of arrival and cut into segments of more than N rows. A batch that is open at the end of a segment ends at most N rows further, so a
segment acts as a function on 0..N-1: given how far into it the first new batch opens, it says how far into the next segment
the first one opens there. These functions only rise, and are kept as steps. Functions of neighbours are combined in groups until
one is left, and then walked down again from the shard's first row, which tells every segment where its batches open. No task
holds more than a segment and the N rows behind it, or one group of step lists.
"""

from __future__ import annotations

import sys
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.numbering import number_rows
from tickloom.operators.routing import with_shard_per_symbol
from tickloom.schema import micros
from tickloom.session import materialize

# The helpers below travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_ROWS = 1 << 16
# Functions combined at a time.
FAN_IN = 8

_STEPS = "shard int, _seg bigint, _child bigint, _hi bigint, _out bigint"


def next_starts(instants: np.ndarray, max_rows: int, width: int) -> np.ndarray:
    """For a batch opened by each row, the place of the row that opens the next one (past the end, if none)."""
    by_time = np.searchsorted(instants, instants + width, "left")
    return np.minimum(np.arange(len(instants)) + max_rows, by_time)


def segment_steps(instants: np.ndarray, length: int, max_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The function of a segment of `length` rows, given with the rows behind it: steps (up to, leads to)."""
    jump = next_starts(instants, max_rows, width)
    while True:
        inside = np.flatnonzero(jump < length)
        if not len(inside):
            break
        # Every row jumps as far as the row it lands on does.
        jump[inside] = jump[jump[inside]]
    out = jump[:max_rows] - length
    last = np.flatnonzero(np.append(out[1:] != out[:-1], True))
    # Beyond the shard's last row nothing opens any more.
    return np.append(last[:-1], max_rows - 1), out[last]


def chain(functions: list[tuple[np.ndarray, np.ndarray]], start: np.ndarray) -> list[np.ndarray]:
    """Where the given starts lead before each function, and after the last."""
    at = [start]
    for hi, out in functions:
        at.append(out[np.searchsorted(hi, at[-1], "left")])
    return at


def batch_starts(instants: np.ndarray, first: int, max_rows: int, width: int) -> np.ndarray:
    """Places at which batches open, from the first one on."""
    following, found = next_starts(instants, max_rows, width), []
    while first < len(instants):
        found.append(first)
        first = int(following[first])
    return np.array(found, np.int64)


def aligned_batches(
    ticks: DataFrame, shards: int, max_rows: int, max_delay: timedelta, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Add `shard` and `batch_no` (from 1 in each shard) to unique ticks. No row is lost and no batch is empty.

    Ticks are read several times (their symbols, the bounds of the ranges, the rows) and should be stored.
    """
    if max_rows < 1:
        raise ValueError("a batch must hold at least one row")
    width = micros(max_delay)
    if width <= 0:
        raise ValueError("the batch delay must be positive")
    size = max(segment_rows, max_rows + 1)
    timed = with_shard_per_symbol(ticks, shards).withColumn("shard", F.col("shard").cast("int")).withColumn("_t", F.unix_micros("ingest_ts"))
    placed = number_rows(timed, ["shard"], ["_t", "arrival_seq"]).withColumn("_seg", F.expr(f"_pos div {size}"))
    last = placed.agg(F.max("_seg")).first()[0]
    if last is None:
        return placed.select(*ticks.columns, "shard", F.lit(1).cast("bigint").alias("batch_no"))
    entries = _entries(placed.select("shard", "_pos", "_t", "_seg"), size, last, max_rows, width)
    numbered = _open_batches(placed, entries, size, max_rows, width)
    path = materialize(numbered)
    # A row per segment.
    opened = path.groupBy("shard", "_seg").agg(F.max("_local").alias("_opened"))
    before = Window.partitionBy("shard").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = opened.select("shard", "_seg", F.coalesce(F.sum("_opened").over(before), F.lit(0)).alias("_before"))
    number = (F.col("_before") + F.col("_local")).cast("bigint").alias("batch_no")
    return path.join(offsets, ["shard", "_seg"]).select(*ticks.columns, "shard", number)


def _entries(placed: DataFrame, size: int, last: int, max_rows: int, width: int) -> DataFrame:
    """How far into each segment its first new batch opens."""
    ahead = placed.where((F.col("_seg") > 0) & (F.col("_pos") % size < max_rows)).withColumn("_seg", F.col("_seg") - 1)

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        segment = int(pdf["_seg"].iloc[0])
        hi, out = segment_steps(pdf["_t"].to_numpy(), min(size, len(pdf)), max_rows, width)
        return pd.DataFrame({"shard": int(pdf["shard"].iloc[0]), "_seg": segment // FAN_IN, "_child": segment, "_hi": hi, "_out": out})

    whole = placed.unionByName(ahead)
    levels = [materialize(whole.groupBy("shard", "_seg").applyInPandas(steps, _STEPS))]
    groups = last // FAN_IN
    while groups > 0:
        levels.append(materialize(levels[-1].groupBy("shard", "_seg").applyInPandas(_combined, _STEPS)))
        groups //= FAN_IN
    entries = placed.select("shard").distinct().select("shard", F.lit(0).cast("bigint").alias("_seg"), F.lit(0).cast("bigint").alias("_in"))
    for level in reversed(levels):
        walked = level.groupBy("shard", "_seg").cogroup(entries.groupBy("shard", "_seg"))
        entries = materialize(walked.applyInPandas(_walked, "shard int, _seg bigint, _in bigint"))
    return entries


def _functions(pdf: pd.DataFrame) -> tuple[list[int], list[tuple[np.ndarray, np.ndarray]]]:
    pdf = pdf.sort_values(["_child", "_hi"])
    parts = [(int(child), own) for child, own in pdf.groupby("_child", sort=True)]
    return [c for c, _ in parts], [(own["_hi"].to_numpy(), own["_out"].to_numpy()) for _, own in parts]


def _combined(pdf: pd.DataFrame) -> pd.DataFrame:
    """One function for a group of neighbours."""
    _, functions = _functions(pdf)
    hi = functions[0][0]
    out = chain(functions, hi)[-1]
    keep = np.append(out[1:] != out[:-1], True)
    segment = int(pdf["_seg"].iloc[0])
    return pd.DataFrame(
        {"shard": int(pdf["shard"].iloc[0]), "_seg": segment // FAN_IN, "_child": segment, "_hi": hi[keep], "_out": out[keep]}
    )


def _walked(key: tuple, pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    """From a group's entry to those of its members."""
    children, functions = _functions(pdf)
    at = chain(functions, entry["_in"].to_numpy()[:1])
    return pd.DataFrame({"shard": key[0], "_seg": children, "_in": [int(a[0]) for a in at[: len(children)]]})


def _open_batches(placed: DataFrame, entries: DataFrame, size: int, max_rows: int, width: int) -> DataFrame:
    """Rows with `_local`, how many batches have opened in their segment up to them."""
    schema = T.StructType([*placed.schema.fields, T.StructField("_local", T.LongType())])

    def opened(rows: pa.Table, entry: pa.Table) -> pa.Table:
        rows = rows.sort_by("_pos")
        starts = batch_starts(rows.column("_t").to_numpy(), entry.column("_in")[0].as_py(), max_rows, width)
        local = np.searchsorted(starts, np.arange(rows.num_rows), "right")
        return rows.append_column("_local", pa.array(local, pa.int64()))

    grouped = placed.groupBy("shard", "_seg").cogroup(entries.groupBy("shard", "_seg"))
    return grouped.applyInArrow(opened, schema)
