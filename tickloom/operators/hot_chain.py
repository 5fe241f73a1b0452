"""Later admissions for keys with very long histories, spread over many tasks.

A stretch of arrivals acts on the open window as a function: given the instant at which the key
becomes free again, it says when the key is free after the stretch. Such a function is a list of
steps (hi, out): an incoming instant up to `hi` leaves as `out`; beyond the last `hi` it passes
unchanged. A single arrival at t is the one step (t, t + window). Functions of neighbouring
stretches combine into one, so a key's history is cut into segments, combined upwards in groups
until one is left, and then walked down again from the known start, each segment on its own.

No task holds more than one segment or one group of step lists. Before all that, arrivals at the
same instant are reduced to the first one, combined before the shuffle.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import broadcast_if_small, materialize

# The helpers below travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Segments per group when functions are combined.
FAN_IN = 8
# Cells per window; cells are the unit from which segments are made up.
CELLS_PER_WINDOW = 64
# Neighbouring cells whose counts are summed in one sort.
CELLS_PER_BLOCK = 4096

_STEPS = "_kid bigint, _seg bigint, _child bigint, _hi bigint, _out bigint"


def combine_steps(hi: np.ndarray, out: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """One step list for a run of neighbouring step lists, given sorted by `hi`.

    Only steps that an incoming instant can meet are kept: it lies at most one window after the
    last earlier arrival, so nothing beyond the first step past `hi[0] + width` is reachable.
    """
    n = len(hi)
    nxt = np.searchsorted(hi, out, side="left")
    while True:
        live = np.flatnonzero(nxt < n)
        if len(live) == 0:
            break
        to = nxt[live]
        out, nxt = out.copy(), nxt.copy()
        out[live], nxt[live] = out[to], nxt[to]
    reach = int(np.searchsorted(hi, hi[0] + width, side="right")) + 1
    hi, out = hi[:reach], out[:reach]
    last_of_run = np.append(out[1:] != out[:-1], True)
    return hi[last_of_run], out[last_of_run]


def walk_steps(hi: np.ndarray, out: np.ndarray, entry: int) -> tuple[list[int], list[int]]:
    """Positions of the steps met from `entry` on, and the incoming instant at each."""
    met, incoming = [], []
    i = int(np.searchsorted(hi, entry, side="left"))
    while i < len(hi):
        met.append(i)
        incoming.append(entry)
        entry = int(out[i])
        i = int(np.searchsorted(hi, entry, side="left"))
    return met, incoming


def later_admissions_split(
    rows: DataFrame, keys: list[str], order: list[str], width: int, segment_rows: int
) -> DataFrame:
    """All admissions but the first, with every column of `rows`; `_t` is the arrival instant."""
    from tickloom.operators.dedup import first_per

    # A short number stands for each key, so that only numbers travel through the steps below.
    ids = rows.groupBy(*keys).agg(F.min("_t").alias("_first"))
    ids = materialize(ids.withColumn("_kid", F.monotonically_increasing_id()))
    # Keys may be wide, so their text is measured beside their number.
    wide = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(8))
    id_count, id_bytes = ids.agg(F.count(F.lit(1)), F.sum(wide)).first()
    renamed = ids.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_kid")
    same_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    numbered = rows.join(broadcast_if_small(renamed, id_count, id_bytes or 0), same_key).select(*rows.columns, "_kid")
    instants = materialize(first_per(numbered, ["_kid", "_t"], order))

    leaves = materialize(_assign_segments(instants, width, segment_rows))
    levels = [
        leaves.select(
            "_kid",
            "_seg",
            F.lit(0).cast("bigint").alias("_child"),
            F.col("_t").alias("_hi"),
            (F.col("_t") + F.lit(width)).alias("_out"),
        )
    ]
    last_segment = leaves.agg(F.max("_seg")).first()[0] or 0
    while last_segment > 0:
        levels.append(materialize(_combine_groups(levels[-1], width)))
        last_segment //= FAN_IN

    entries = ids.select(
        "_kid", F.lit(0).cast("bigint").alias("_seg"), (F.col("_first") + F.lit(width)).alias("_in")
    )
    for steps in reversed(levels[1:]):
        met = _walk_groups(steps, entries)
        entries = materialize(
            met.select("_kid", F.col("_child").alias("_seg"), F.col("_in"))
        )
    admitted = _walk_groups(levels[0], entries).select("_kid", F.col("_hi").alias("_t"))
    return instants.join(admitted, ["_kid", "_t"], "left_semi").drop("_kid", "_t")


def _assign_segments(instants: DataFrame, width: int, segment_rows: int) -> DataFrame:
    """Number segments of about `segment_rows` instants along each key's time.

    Running counts are taken over cells, of which a key has at most its time span divided by the
    cell width, however many rows it has. Cells are counted within blocks of neighbouring cells first and
    blocks then, so no task orders all cells of a key.
    """
    cell_width = max(1, width // CELLS_PER_WINDOW)
    with_cell = instants.select("_kid", "_t", F.expr(f"_t div {cell_width}").alias("_cell"))
    cells = with_cell.groupBy("_kid", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.withColumn("_block", F.expr(f"_cell div {CELLS_PER_BLOCK}"))

    def before(*group: str, order: str) -> Window:
        return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def running(over: Window) -> Column:
        return F.coalesce(F.sum("_n").over(over), F.lit(0))

    blocks = cells.groupBy("_kid", "_block").agg(F.sum("_n").alias("_n"))
    starts = blocks.select("_kid", "_block", running(before("_kid", order="_block")).alias("_start"))
    inside = cells.withColumn("_inside", running(before("_kid", "_block", order="_cell")))
    numbered = inside.join(starts, ["_kid", "_block"]).select(
        "_kid", "_cell", F.expr(f"(_start + _inside) div {segment_rows}").alias("_seg")
    )
    return with_cell.join(numbered, ["_kid", "_cell"]).select("_kid", "_t", "_seg")


def _combine_groups(steps: DataFrame, width: int) -> DataFrame:
    """Combine the steps of each segment, then put neighbouring segments into one group."""

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_hi")
        hi, out = combine_steps(pdf["_hi"].to_numpy(), pdf["_out"].to_numpy(), width)
        segment = int(pdf["_seg"].iloc[0])
        return pd.DataFrame(
            {
                "_kid": int(pdf["_kid"].iloc[0]),
                "_seg": segment // FAN_IN,
                "_child": segment,
                "_hi": hi,
                "_out": out,
            }
        )

    return steps.groupBy("_kid", "_seg").applyInPandas(combine, _STEPS)


def _walk_groups(steps: DataFrame, entries: DataFrame) -> DataFrame:
    """Follow the chain through each entered group."""

    def walk(key: tuple, pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        columns = {"_kid": [], "_child": [], "_in": [], "_hi": []}
        if len(entry) and len(pdf):
            pdf = pdf.sort_values("_hi")
            hi = pdf["_hi"].to_numpy()
            met, incoming = walk_steps(hi, pdf["_out"].to_numpy(), int(entry["_in"].iloc[0]))
            columns = {
                "_kid": [key[0]] * len(met),
                "_child": pdf["_child"].to_numpy()[met],
                "_in": incoming,
                "_hi": hi[met],
            }
        return pd.DataFrame(columns)

    return (
        steps.groupBy("_kid", "_seg")
        .cogroup(entries.groupBy("_kid", "_seg"))
        .applyInPandas(walk, "_kid bigint, _child bigint, _in bigint, _hi bigint")
    )
