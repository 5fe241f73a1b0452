"""Frames to ticks: decode, check, and split into accepted ticks and rejects with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.barrier import evaluate_once
from tickloom.functions.formats import FrameFormat, format_names, get_format
from tickloom.functions.numbers import (
    epoch_ms_in_range,
    epoch_ms_to_timestamp,
    exact_epoch_ms,
    number_grammar,
    strict_decimal,
)
from tickloom.functions.validation import with_validation
from tickloom.schema import MAX_FRAME_BYTES, TICK_COLS


def parse_frames(
    frames: DataFrame,
    formats: list[str] | None = None,
    max_frame_bytes: int = MAX_FRAME_BYTES,
) -> DataFrame:
    """Add the tick columns and `reason` to frames that carry a `format` column.

    `reason` is NULL for a parsed frame. Everything is a column expression in one narrow stage, and
    a bad frame never fails the job; a format that nobody registered does.
    """
    chosen = [get_format(name) for name in (formats or format_names())]

    # Bytes that are not UTF-8 become U+FFFD, which no symbol or number may contain. Elsewhere in a
    # frame they do no harm.
    text = F.when(
        F.octet_length("frame") <= max_frame_bytes, F.make_valid_utf8(F.col("frame").cast("string"))
    )
    decoded = evaluate_once(
        frames.withColumn("_text", text),
        F.struct("_text", *[_decode(f).alias(f"_doc_{f.name}") for f in chosen]),
        replaced=["_text"],
    )
    extracted = evaluate_once(
        decoded, _dispatch(chosen), replaced=["_text", *[f"_doc_{f.name}" for f in chosen]]
    )
    numbers = F.struct(
        strict_decimal(F.col("_price_text")).alias("price"),
        strict_decimal(F.col("_volume_text")).alias("volume"),
        exact_epoch_ms(F.col("_epoch_ms"), F.col("_seconds_text")).alias("_ms"),
    )
    parsed = evaluate_once(extracted, numbers, replaced=["_epoch_ms", "_seconds_text"]).withColumns(
        {
            "exchange_ts": epoch_ms_to_timestamp(F.col("_ms")),
            "reason": _parse_reason(max_frame_bytes),
        }
    )
    return parsed.drop("_shape", "_price_text", "_volume_text", "_ms")


def parse_as(
    frames: DataFrame, format_name: str, max_frame_bytes: int = MAX_FRAME_BYTES
) -> DataFrame:
    """Parse frames that all have one format."""
    tagged = frames.withColumn("format", F.lit(format_name))
    return parse_frames(tagged, [format_name], max_frame_bytes)


def classify_frames(frames: DataFrame, max_frame_bytes: int = MAX_FRAME_BYTES) -> DataFrame:
    """Parse and validate; the first failure is the frame's `reason`."""
    return with_validation(parse_frames(frames, max_frame_bytes=max_frame_bytes))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull()).select(*TICK_COLS, "arrival_seq")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNotNull()).select(
        "source", "format", "frame", "ingest_ts", "arrival_seq", "reason"
    )


def _decode(fmt: FrameFormat) -> Column:
    return F.when(F.col("format") == fmt.name, fmt.decode(F.col("_text")))


def _or_null(value: Column | None, kind: str) -> Column:
    return F.lit(None).cast(kind) if value is None else value


def _dispatch(formats: list[FrameFormat]) -> Column:
    out = None
    for fmt in formats:
        x = fmt.extract(F.col(f"_doc_{fmt.name}"), F.col("_text"))
        fields = F.struct(
            F.lit(fmt.exchange).cast("smallint").alias("exchange"),
            x.symbol.alias("symbol"),
            x.source_id.alias("source_id"),
            x.shape.alias("_shape"),
            x.price_text.alias("_price_text"),
            x.volume_text.alias("_volume_text"),
            _or_null(x.epoch_ms, "bigint").alias("_epoch_ms"),
            _or_null(x.seconds_text, "string").alias("_seconds_text"),
        )
        is_format = F.col("format") == fmt.name
        out = F.when(is_format, fields) if out is None else out.when(is_format, fields)
    message = F.concat(F.lit("unknown frame format: "), F.coalesce("format", F.lit("NULL")))
    return out.otherwise(F.raise_error(message))


def _parse_reason(max_frame_bytes: int) -> Column:
    has_shape = (
        F.coalesce(F.col("_shape"), F.lit(False))
        & F.coalesce(F.octet_length("symbol") > 0, F.lit(False))
        & F.col("_price_text").isNotNull()
        & F.col("_volume_text").isNotNull()
        & F.col("source_id").isNotNull()
    )

    def no_number(text: str, reason: str) -> Column:
        return F.when(number_grammar(F.col(text)), "out_of_range").otherwise(reason)

    replaced_bytes = F.concat("symbol", "_price_text", "_volume_text").contains("\ufffd")
    broken_text = ~F.is_valid_utf8(F.col("frame").cast("string"))
    return (
        F.when(F.octet_length("frame") > max_frame_bytes, "frame_too_large")
        .when(~has_shape, F.when(broken_text, "invalid_utf8").otherwise("malformed_frame"))
        .when(replaced_bytes & broken_text, "invalid_utf8")
        .when(F.col("price").isNull(), no_number("_price_text", "bad_price"))
        .when(F.col("volume").isNull(), no_number("_volume_text", "bad_volume"))
        .when(~epoch_ms_in_range(F.col("_ms")), "bad_time")
    )
