"""Sliding-window removal of repeats with an exact composite key.

Rule: the first arrival of a key is admitted and blocks the key for one window. Arrivals inside the
window are dropped and do not prolong it; the first one at or after its end is admitted and starts
the next window.

Plan:
1. Narrow profile per key hash (count, first and last arrival; combined before the shuffle) finds
   the keys whose arrivals reach beyond one window. The hash only routes rows; a collision sends a
   key down a longer but equally exact way. When the key holds a time of its own, only keys with a
   late arrival are profiled (see `_late_hashes`), which normally are few.
2. The first arrival of every key is admitted: a row-number filter, which the planner also applies
   before the shuffle, so a key with a third of all rows leaves one row per task.
3. Only for keys found in step 1, later admissions are added: short histories by a fold over the
   key's sorted arrivals, long ones by `hot_chain`, which spreads one key over many tasks.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.hot_chain import later_admissions_split
from tickloom.schema import KEY_COLS, micros
from tickloom.session import BROADCAST_ROWS, broadcast_if_small, materialize

# Longest history that one fold may hold; gathering positions copies them at each admission.
FOLD_ROWS = 4_000
# Groups of keys that share one bound on lateness.
LATENESS_GROUPS = 4096


def first_per(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def sliding_window_dedup(
    rows: DataFrame,
    window: timedelta | int,
    keys: list[str] | None = None,
    time_col: str = "ingest_ts",
    order_cols: list[str] | None = None,
    fold_rows: int = FOLD_ROWS,
    segment_rows: int = 500_000,
    anchor_col: str | None = None,
) -> DataFrame:
    """Admitted rows, all columns kept.

    Arrivals are ordered by `time_col`, then `order_cols`, which must tell apart the arrivals of one
    key at one instant. A timestamp column takes a timedelta window; a whole-number column takes a
    whole-number window in its unit. `anchor_col` is a key column of the same kind as `time_col` that
    arrivals normally follow closely; for ticks it is the exchange time. Runs the profile when called.
    """
    if keys is None:
        keys, anchor_col = KEY_COLS, "exchange_ts"
    width = micros(window) if isinstance(window, timedelta) else int(window)
    if width <= 0:
        raise ValueError("the dedup window must be positive")
    if anchor_col and anchor_col not in keys:
        raise ValueError("anchor_col must be one of the key columns")
    order = order_cols or ["arrival_seq"]

    timed = rows.withColumn("_t", _instant(rows, time_col, window))
    hashed = timed.withColumn("_h", F.xxhash64(*keys))
    # The hash in front of the key spares most comparisons of whole keys, whose first columns may have few values; keys
    # are still compared in full.
    heads = first_per(hashed, ["_h", *keys], ["_t", *order]).drop("_h", "_t")
    suspects = hashed
    if anchor_col:
        lateness = F.col("_t") - _instant(rows, anchor_col, window)
        late = materialize(_late_hashes(hashed.select("_h", lateness.alias("_late")), width))
        late_count = late.count()
        if late_count == 0:
            return heads
        if late_count <= BROADCAST_ROWS:
            suspects = hashed.join(F.broadcast(late), "_h", "left_semi")

    profile = (
        suspects.select("_h", "_t")
        .groupBy("_h")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
        .where(F.col("_hi") - F.col("_lo") >= width)
        .select("_h", "_n")
    )
    profile = materialize(profile)
    found = profile.agg(
        F.count_if(F.col("_n") <= fold_rows).alias("few"),
        F.count_if(F.col("_n") > fold_rows).alias("many"),
    ).first()

    def routed(condition: Column, count: int) -> DataFrame:
        side = broadcast_if_small(profile.where(condition).select("_h"), count)
        return hashed.join(side, "_h", "left_semi")

    result = heads
    if found.few:
        few = routed(F.col("_n") <= fold_rows, found.few)
        result = result.unionByName(_later_admissions_fold(few, keys, order, width, rows.columns))
    if found.many:
        many = routed(F.col("_n") > fold_rows, found.many).drop("_h")
        split = later_admissions_split(many, keys, order, width, segment_rows)
        result = result.unionByName(split.select(*rows.columns))
    return result


def drop_recently_admitted(
    rows: DataFrame,
    admitted: DataFrame,
    window: timedelta,
    keys: list[str] | None = None,
    time_col: str = "ingest_ts",
    count: int | None = None,
) -> DataFrame:
    """Remove rows that fall into a window opened by earlier admissions.

    `count` is the number of earlier admissions, if they were counted: a few of them go to the rows, not the rows to them.

    What is left can go through `sliding_window_dedup` on its own: its first row per key is at or
    after the end of the earlier window. The join leaves rows partitioned by key, which the dedup
    after it uses. Key columns hold no NULLs, as in the stored table.
    """
    keys = keys or KEY_COLS
    expiry = admitted.groupBy(*keys).agg((F.max(time_col) + F.lit(window)).alias("_expiry"))
    if count is not None:
        expiry = broadcast_if_small(expiry, count)
    open_again = F.col("_expiry").isNull() | (F.col(time_col) >= F.col("_expiry"))
    return rows.join(expiry, keys, "left").where(open_again).select(*rows.columns)


def refused_rows(
    rows: DataFrame,
    admitted: DataFrame,
    earlier: DataFrame,
    window: timedelta,
    keys: list[str] | None = None,
    time_col: str = "ingest_ts",
    order_col: str = "arrival_seq",
    count: int | None = None,
) -> DataFrame:
    """Rows that lie in a window opened by another row: one admitted from among them, or an earlier admission.

    This looks for the window itself instead of subtracting, so a row that the dedup lost is neither admitted nor refused.
    Rows and the windows opened among them meet in cells as long as a window: a window touches two, and a cell holds two of a
    key at most. An earlier admission blocks whatever arrives before its window ends; `count` is the number of those, if
    they were counted. Hashes only put keys in an order that is quick to compare.
    """
    keys, width = keys or KEY_COLS, micros(window)
    opened = F.unix_micros(time_col)
    before = earlier.groupBy(*keys).agg((F.max(opened) + width).alias("_until"))
    if count is not None:
        before = broadcast_if_small(before, count)
    timed = rows.withColumn("_t", opened).join(before, keys, "left")
    blocked = F.coalesce(F.col("_t") < F.col("_until"), F.lit(False))
    cells = F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_from") + (width - 1)) / width))
    windows = admitted.select(*[F.col(k).alias(f"_{k}") for k in keys], opened.alias("_from"), F.col(order_col).alias("_after"))
    windows = windows.select(F.xxhash64(*[f"_{k}" for k in keys]).alias("_at"), "*", F.explode(cells).alias("_of"))
    after = (F.col("_t") > F.col("_from")) | ((F.col("_t") == F.col("_from")) & (F.col(order_col) > F.col("_after")))
    same = [F.xxhash64(*keys) == F.col("_at"), F.floor(F.col("_t") / width) == F.col("_of")]
    same += [F.col(k) == F.col(f"_{k}") for k in keys]
    repeated = timed.where(~blocked).join(windows, [*same, after, F.col("_t") < F.col("_from") + width], "left_semi")
    return timed.where(blocked).unionByName(repeated).select(*rows.columns)


def duplicate_counts(rows: DataFrame, admitted: DataFrame, by: list[str]) -> DataFrame:
    """Arrived, admitted and dropped rows per group, counted before the shuffle."""
    arrived = rows.select(*by, F.lit(1).alias("_r"), F.lit(0).alias("_a"))
    kept = admitted.select(*by, F.lit(0).alias("_r"), F.lit(1).alias("_a"))
    totals = arrived.unionByName(kept).groupBy(*by).agg(
        F.sum("_r").alias("received"), F.sum("_a").alias("admitted")
    )
    return totals.withColumn("deduplicated", F.col("received") - F.col("admitted"))


def _late_hashes(arrivals: DataFrame, width: int) -> DataFrame:
    """Hashes of all keys that may have arrivals a window apart, without shuffling the arrivals.

    Arrivals of one key share its own time, so two that lie a window apart differ in lateness by a
    window, and the later one is at least a window above the smallest lateness of any group of keys
    that holds this key. The minimum per group is a table of a few thousand rows; taking many groups
    keeps one wrong clock from making every key look late.
    """
    grouped = arrivals.withColumn("_group", F.pmod("_h", F.lit(LATENESS_GROUPS)))
    floors = grouped.groupBy("_group").agg(F.min("_late").alias("_floor"))
    late = grouped.join(F.broadcast(floors), "_group").where(F.col("_late") - F.col("_floor") >= width)
    return late.select("_h").distinct()


def _instant(rows: DataFrame, time_col: str, window: timedelta | int) -> Column:
    kind = rows.schema[time_col].dataType
    if isinstance(window, timedelta):
        if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            raise TypeError(f"{time_col} must be a timestamp for a timedelta window")
        return F.unix_micros(F.col(time_col).cast("timestamp"))
    return F.col(time_col).cast("bigint")


def _later_admissions_fold(
    rows: DataFrame, keys: list[str], order: list[str], width: int, columns: list[str]
) -> DataFrame:
    """All admissions but the first, for keys whose history fits one array."""
    payload = [c for c in columns if c not in keys and c not in order]
    # Groups are sorted here too.
    arrivals = rows.groupBy("_h", *keys).agg(
        F.sort_array(F.collect_list(F.struct("_t", *order, *payload))).alias("_a")
    )
    start = F.struct(
        F.lit(None).cast("bigint").alias("expiry"),
        F.lit(0).alias("i"),
        F.array().cast("array<int>").alias("at"),
    )

    # Only positions are gathered, so the cost is one step per arrival and one append per admission.
    def step(state: Column, row: Column) -> Column:
        free = state.expiry.isNull() | (row["_t"] >= state.expiry)
        return F.struct(
            F.when(free, row["_t"] + F.lit(width)).otherwise(state.expiry).alias("expiry"),
            (state.i + 1).alias("i"),
            F.when(free, F.concat(state["at"], F.array(state.i))).otherwise(state["at"]).alias("at"),
        )

    positions = F.aggregate("_a", start, step, lambda s: F.slice(s["at"], 2, F.size(s["at"])))
    later = arrivals.withColumn("_at", positions).where(F.size("_at") > 0)
    picked = F.transform("_at", lambda i: F.get(F.col("_a"), i))
    return later.select(*keys, F.inline(picked)).select(*columns)
