"""Write batches of at most N rows that span less than T."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.numbers import slot_of
from tickloom.operators.routing import with_shard_per_symbol
from tickloom.schema import micros

# Largest shard/slot pair that is numbered by one sort; larger ones are numbered block by block.
SORT_ROWS = 1_000_000
# Stretches of a slot that are numbered apart.
PARTS = 256
# Arrival numbers per block.
BLOCK = 65_536


def write_batches(
    ticks: DataFrame,
    shards: int,
    max_rows: int,
    max_delay: timedelta,
    sort_rows: int = SORT_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Add `shard`, `batch_slot` and `batch_no` (from 1) to unique ticks.

    Slots start at multiples of T since the epoch. Within a shard and slot, rows are numbered in
    arrival order and cut every `max_rows`; no row is lost and no batch is empty. Ticks are read several times and
    should be stored.
    """
    if max_rows < 1:
        raise ValueError("a batch must hold at least one row")
    width = micros(max_delay)
    if width <= 0:
        raise ValueError("the batch delay must be positive")
    slotted = with_shard_per_symbol(ticks, shards).withColumn(
        "batch_slot", slot_of(F.unix_micros("ingest_ts"), width)
    )
    group = ["shard", "batch_slot"]
    largest = slotted.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if largest <= sort_rows:
        in_order = Window.partitionBy(*group).orderBy("ingest_ts", "arrival_seq")
        ranked = slotted.withColumn("_rank", F.row_number().over(in_order))
    else:
        ranked = _rank_by_blocks(slotted, group, block, width)
    return ranked.withColumn(
        "batch_no", F.expr(f"(_rank + {max_rows} - 1) div {max_rows}")
    ).drop("_rank")


def _rank_by_blocks(slotted: DataFrame, group: list[str], block: int, width: int) -> DataFrame:
    """Row numbers for groups too large for one sort.

    A block is one instant and a range of arrival numbers, so blocks follow the arrival order and
    hold at most `block` rows. Block sizes are summed within each of PARTS stretches of the slot and
    over the stretches then, which gives each block's first number without ordering a whole slot.
    """
    into_slot = F.unix_micros("ingest_ts") - F.col("batch_slot") * width
    cut = slotted.withColumn("_into", into_slot).withColumns(
        {
            "_block": F.expr(f"arrival_seq div {block}"),
            "_part": F.expr(f"_into div {-(-width // PARTS)}").cast("int"),
        }
    ).drop("_into")
    cell = [*group, "_part", "ingest_ts", "_block"]
    sizes = cut.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    parts = sizes.groupBy(*group, "_part").agg(F.sum("_n").alias("_n"))

    def earlier(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    in_part = Window.partitionBy(*group, "_part").orderBy("ingest_ts", "_block")
    starts = parts.withColumn("_start", earlier(Window.partitionBy(*group).orderBy("_part"))).drop("_n")
    placed = sizes.withColumn("_inside", earlier(in_part)).join(starts, [*group, "_part"])
    within = Window.partitionBy(*cell).orderBy("arrival_seq")
    joined = cut.join(placed.drop("_n"), cell).withColumn("_row", F.row_number().over(within))
    return joined.withColumn("_rank", F.col("_start") + F.col("_inside") + F.col("_row")).drop(
        "_start", "_inside", "_row", "_block", "_part"
    )
