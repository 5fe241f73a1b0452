"""Value checks for ticks of an untrusted feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schema import (
    AMOUNT,
    MAX_AMOUNT,
    MAX_FUTURE_SKEW,
    MAX_PAST_SKEW,
    MAX_SYMBOL_CHARS,
)

# \z, not $: the latter would let a trailing newline through.
SYMBOL = rf"\A[A-Za-z0-9/._-]{{1,{MAX_SYMBOL_CHARS}}}\z"


def _amount(value: int) -> Column:
    return F.lit(value).cast(AMOUNT)


def price_ok(price: Column) -> Column:
    return (price > _amount(0)) & (price <= _amount(MAX_AMOUNT))


def volume_ok(volume: Column) -> Column:
    return (volume >= _amount(0)) & (volume <= _amount(MAX_AMOUNT))


def symbol_ok(symbol: Column) -> Column:
    return symbol.rlike(SYMBOL)


def time_ok(exchange_ts: Column, now: Column) -> Column:
    return exchange_ts.between(now - F.lit(MAX_PAST_SKEW), now + F.lit(MAX_FUTURE_SKEW))


def validation_reason(now: str = "ingest_ts") -> Column:
    """Name of the first failed check, NULL for a valid tick."""

    def fails(check: Column) -> Column:
        return ~F.coalesce(check, F.lit(False))

    return (
        F.when(fails(price_ok(F.col("price"))), "price_range")
        .when(fails(volume_ok(F.col("volume"))), "volume_range")
        .when(fails(symbol_ok(F.col("symbol"))), "bad_symbol")
        .when(fails(time_ok(F.col("exchange_ts"), F.col(now))), "time_skew")
    )


def with_validation(ticks: DataFrame, now: str = "ingest_ts") -> DataFrame:
    """Fill `reason`; an earlier parse reason wins."""
    if "reason" in ticks.columns:
        return ticks.withColumn("reason", F.coalesce("reason", validation_reason(now)))
    return ticks.withColumn("reason", validation_reason(now))
