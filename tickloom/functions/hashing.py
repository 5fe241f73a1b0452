"""FNV-1a 64 over UTF-8 bytes, stable across runs and machines."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# FNV-1a 64 parameters.
FNV_OFFSET = 14695981039346656037
FNV_PRIME = 1099511628211

_LOW32 = 0xFFFFFFFF
# The prime is 2^40 + 435. With the state held as two 32-bit halves, multiplying by 435 never
# leaves a BIGINT, and the 2^40 term only moves the low half up by 8 bits.
_PRIME_LOW = FNV_PRIME - (1 << 40)


def fnv1a64(text: Column) -> Column:
    """Hash as DECIMAL(20,0), which holds every unsigned 64-bit value."""
    digits = F.hex(F.encode(text, "UTF-8"))
    start = F.struct(
        F.lit(FNV_OFFSET >> 32).cast("bigint").alias("hi"),
        F.lit(FNV_OFFSET & _LOW32).cast("bigint").alias("lo"),
    )

    def byte_at(i: Column) -> Column:
        return F.conv(F.substr(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("bigint")

    def step(state: Column, i: Column) -> Column:
        low = state.lo.bitwiseXOR(byte_at(i))
        product = low * F.lit(_PRIME_LOW)
        high = state.hi * F.lit(_PRIME_LOW) + F.shiftrightunsigned(product, 32) + F.shiftleft(low, 8)
        return F.struct(
            high.bitwiseAND(F.lit(_LOW32)).alias("hi"),
            product.bitwiseAND(F.lit(_LOW32)).alias("lo"),
        )

    def finish(state: Column) -> Column:
        wide = state.hi.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + state.lo
        return wide.cast("decimal(20,0)")

    positions = F.sequence(F.lit(0), F.octet_length(text) - 1)
    return (
        F.when(text.isNull(), F.lit(None))
        .when(F.octet_length(text) == 0, F.lit(Decimal(FNV_OFFSET)).cast("decimal(20,0)"))
        .otherwise(F.aggregate(positions, start, step, finish))
    )


def shard_of(text: Column, shards: int) -> Column:
    """Shard number in [0, shards); an empty text is an error."""
    if shards < 1:
        raise ValueError("the shard count must be at least 1")
    number = (fnv1a64(text) % F.lit(shards).cast("decimal(10,0)")).cast("int")
    empty = F.raise_error(F.lit("cannot place an empty symbol on a shard"))
    return F.when(F.octet_length(text) > 0, number).otherwise(empty.cast("int"))
