"""Frame formats. A format turns one message into the raw texts of one tick.

`decode` runs once per frame; `extract` reads several values from its result. Adding a feed
format means registering one more pair with `register_format`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.numbers import strict_bigint
from tickloom.schema import EXCHANGES


@dataclass(frozen=True)
class Extracted:
    """What a format reads from a frame.

    A value that is absent or of the wrong type is NULL, which rejects the frame; `shape` holds the
    checks that no value stands for. Time is either epoch milliseconds or a text of epoch seconds.
    """

    shape: Column
    symbol: Column
    price_text: Column
    volume_text: Column
    source_id: Column
    epoch_ms: Column | None = None
    seconds_text: Column | None = None


@dataclass(frozen=True)
class FrameFormat:
    name: str
    exchange: int
    decode: Callable[[Column], Column]
    extract: Callable[[Column, Column], Extracted]


_FORMATS: dict[str, FrameFormat] = {}


def register_format(fmt: FrameFormat) -> None:
    _FORMATS[fmt.name] = fmt


def get_format(name: str) -> FrameFormat:
    if name not in _FORMATS:
        raise ValueError(f"unknown frame format: {name!r}")
    return _FORMATS[name]


def format_names() -> list[str]:
    return sorted(_FORMATS)


def _kind(doc: Column, path: str) -> Column:
    """JSON type at the path: NULL when absent, VOID for an explicit null."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def _text(doc: Column, path: str) -> Column:
    """String at the path; NULL when it is absent or of another type."""
    return F.when(_kind(doc, path) == "STRING", F.try_variant_get(doc, path, "string"))


# JSON object: {"s": symbol, "p": price, "q": volume, "T": epoch ms, "a": id}


def _object_decode(frame: Column) -> Column:
    # The JSON parser stops after the first value, so text behind the object must be looked for.
    # When the only closing brace is the last character, nothing can follow the object.
    ends_there = F.instr(frame, "}") == F.length(frame)
    # Otherwise the frame and its own digest go into one array: leftovers break the array or push the
    # digest out of place, and no frame can contain its own digest.
    digest = F.sha2(frame, 256)
    pair = F.try_parse_json(F.concat(F.lit("["), frame, F.lit(',"'), digest, F.lit('"]')))
    alone = F.try_variant_get(pair, "$[1]", "string") == digest
    return F.when(ends_there, F.try_parse_json(frame)).when(
        alone, F.try_variant_get(pair, "$[0]", "variant")
    )


def _object_extract(doc: Column, frame: Column) -> Extracted:
    def whole_number(path: str) -> Column:
        kind = _kind(doc, path)
        return F.when(kind.isNull(), F.lit(0).cast("bigint")).when(
            kind == "BIGINT", F.try_variant_get(doc, path, "bigint")
        )

    symbol, price, volume = (_text(doc, f"$.{k}") for k in "spq")
    # A frame that is no object has no texts and is rejected for that.
    return Extracted(
        doc.isNotNull(),
        symbol,
        price,
        volume,
        whole_number("$.a"),
        epoch_ms=whole_number("$.T"),
    )


# JSON array: [channel, [price, volume, epoch seconds], text, symbol, id]


def _array_decode(frame: Column) -> Column:
    return F.try_parse_json(frame)


def _array_extract(doc: Column, frame: Column) -> Extracted:
    trade = F.try_variant_get(doc, "$[1]", "array<string>")
    shape = (
        (F.size(F.try_variant_get(doc, "$", "array<variant>")) == 5)
        & _kind(doc, "$[0]").rlike(r"\A(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")
        & (_kind(doc, "$[1]") == "ARRAY<STRING>")
        & (F.size(trade) == 3)
        & (_kind(doc, "$[2]") == "STRING")
    )
    return Extracted(
        shape,
        _text(doc, "$[3]"),
        F.get(trade, F.lit(0)),
        F.get(trade, F.lit(1)),
        F.when(_kind(doc, "$[4]") == "BIGINT", F.try_variant_get(doc, "$[4]", "bigint")),
        seconds_text=F.get(trade, F.lit(2)),
    )


# Text line: symbol,price,volume,epoch ms,id


def _line_decode(frame: Column) -> Column:
    return F.split(frame, ",", -1)


def _line_extract(parts: Column, frame: Column) -> Extracted:
    symbol, price, volume, epoch, ident = (F.get(parts, F.lit(i)) for i in range(5))
    return Extracted(
        F.size(parts) == 5, symbol, price, volume, strict_bigint(ident), strict_bigint(epoch)
    )


register_format(FrameFormat("binance", EXCHANGES["Binance"], _object_decode, _object_extract))
register_format(FrameFormat("kraken", EXCHANGES["Kraken"], _array_decode, _array_extract))
register_format(FrameFormat("csv", EXCHANGES["Coinbase"], _line_decode, _line_extract))
