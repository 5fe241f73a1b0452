from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import NOON
from tickloom.functions.formats import FrameFormat, Extracted, get_format, register_format
from tickloom.operators.parse import parse_as, parse_frames
from tickloom.schema import FRAME_SCHEMA

LONGEST = 2**63 - 1
LAST_MS = 253402300799999


def as_object(drop=(), tail="", lead="", **fields):
    """An object message; a value is written as it stands, text in quotes by `text`."""
    full = {"s": text("NOVA9"), "p": text("7.25"), "q": text("3"), "T": 1650000000123, "a": 41} | fields
    body = ",".join(f'"{k}":{v}' for k, v in full.items() if k not in drop)
    return f"{lead}{{{body}}}{tail}"


def as_array(channel=8, numbers=None, kind='"print"', symbol='"NOV/A"', ident=41, more="", tail=""):
    numbers = numbers or [text("7.25"), text("3"), text("1650000000.123")]
    return f"[{channel},[{','.join(map(str, numbers))}],{kind},{symbol},{ident}{more}]{tail}"


def as_line(symbol="NOVA", price="7.25", volume="3", ms="1650000000123", ident="41", more=""):
    return ",".join([symbol, price, volume, ms, ident]) + more


def text(value):
    return f'"{value}"'


def numbers(price="7.25", volume="3", seconds="1650000000.123"):
    return [text(price), text(volume), text(seconds)]


BAD = "malformed_frame"
# Each rule of a format as (what is sent, the reason it is refused for or None).
OBJECTS = [
    # White space around, unknown fields and braces inside text do no harm; time and id may be missing.
    (as_object(), None),
    (as_object(lead="\t", tail="\n"), None),
    (as_object(extra='[{"deep":null}]'), None),
    (as_object(drop="T"), None),
    (as_object(drop="a"), None),
    (as_object(s=text("NO]}VA")), None),
    # Not one object.
    *[(frame, BAD) for frame in ("plain words", "", "true", '"text"', "[7]", "{}")],
    *[(as_object(tail=tail), BAD) for tail in ("!", as_object(), ",", "]", '"')],
    # Names count their case; symbol, price and volume must be text, and the symbol not empty.
    (as_object(drop="s", S=text("NOVA9")), BAD),
    *[(as_object(s=value), BAD) for value in ("null", text(""), "5", "[]")],
    *[(as_object(**{name: value}), BAD) for name in ("p", "q") for value in ("null", "7", "{}")],
    (as_object(drop="p"), BAD),
    (as_object(s=text("NOVA9") + ',"s":' + text("OTHER")), BAD),
    # Numbers: digits with a point, no exponent, within 38 digits.
    *[(as_object(p=text(value)), "bad_price") for value in ("seven", "7e2", "7.2.5", "0x7")],
    (as_object(q=text("three")), "bad_volume"),
    (as_object(p=text("9" * 21)), "out_of_range"),
    # Time is a whole number within the calendar, the id a 64-bit one.
    (as_object(T=LAST_MS), None),
    *[(as_object(T=value), "bad_time") for value in (LAST_MS + 1, LONGEST, -LONGEST - 1, "null", "2.0", "2e2", text("2"), text("noon"))],
    (as_object(a=LONGEST), None),
    (as_object(a=LONGEST + 1), BAD),
]
ARRAYS = [
    # The channel is any number and the kind any text; what follows the array is not read.
    (as_array(), None),
    (as_array(tail=" and more"), None),
    (as_array(channel=-0.5, kind='""', ident=-41), None),
    # Numbers may be grouped and padded.
    (as_array(numbers=numbers("9,007.25", " 3 ")), None),
    (as_array(numbers=numbers(seconds="253402300799.999")), None),
    # Not five elements of the right kinds, or not three texts inside.
    *[(frame, BAD) for frame in ("plain words", "", '{"a":[8]}', "[]")],
    (as_array(channel=text("8")), BAD),
    (as_array(numbers=numbers()[:1]), BAD),
    (as_array(numbers=[*numbers(), text("4")]), BAD),
    (as_array(numbers=[7.25, *numbers()[1:]]), BAD),
    (as_array(kind="3"), BAD),
    (as_array(symbol=text("")), BAD),
    *[(as_array(ident=value), BAD) for value in (text("41"), "41.0")],
    (as_array(more=",0"), BAD),
    (as_array(numbers=numbers("seven")), "bad_price"),
    (as_array(numbers=numbers(volume="three")), "bad_volume"),
    # Seconds become whole milliseconds within the calendar.
    *[(as_array(numbers=numbers(seconds=value)), "bad_time") for value in ("9" * 17, "253402300799.9996", "noon")],
    # Broken bytes matter only where a value holds them.
    (as_array(symbol='"#"').encode().replace(b"#", b"\xc3"), "invalid_utf8"),
    (as_array(numbers=numbers("#")).encode().replace(b"#", b"\x80\x80"), "invalid_utf8"),
    (as_array().encode() + b"\xc3", None),
]
LINES = [
    (as_line(), None),
    (as_line(ms="+1650000000123", ident="-41"), None),
    (as_line(ident=str(LONGEST)), None),
    # Five fields, the first not empty.
    *[(frame, BAD) for frame in ("", "NOVA", "NOVA,7.25,3", as_line(symbol=""), as_line(more=","), as_line(more=",41"))],
    *[(as_line(ident=value), BAD) for value in ("41x", "", str(LONGEST + 1))],
    (as_line(price="seven"), "bad_price"),
    (as_line(volume="three"), "bad_volume"),
    *[(as_line(ms=value), "bad_time") for value in (str(LONGEST), str(LONGEST + 1), str(LAST_MS + 1), "1650000000123s", " 7", "")],
    (as_line(symbol="NO#VA").encode().replace(b"#", b"\xff"), "invalid_utf8"),
]
FRAMES = [
    (name, frame, reason)
    for name, cases in (("binance", OBJECTS), ("kraken", ARRAYS), ("csv", LINES))
    for frame, reason in cases
]


def _frames(spark, frames, fmt=None):
    rows = [
        ("feed", f.encode() if isinstance(f, str) else f, NOON, i) for i, f in enumerate(frames)
    ]
    return spark.createDataFrame([(r[0], bytearray(r[1]), r[2], r[3]) for r in rows], FRAME_SCHEMA)


@pytest.mark.parametrize("fmt", ["binance", "kraken", "csv"])
def test_accept_and_reject_tables(spark, fmt):
    cases = [(f, reason) for name, f, reason in FRAMES if name == fmt]
    parsed = parse_as(_frames(spark, [f for f, _ in cases]), fmt)
    got = {r["arrival_seq"]: r["reason"] for r in parsed.select("arrival_seq", "reason").collect()}
    wrong = [(f, reason, got[i]) for i, (f, reason) in enumerate(cases) if got[i] != reason]
    assert wrong == []


def test_values(spark):
    sent = {
        "binance": as_object(p=text("0007.2500")),
        "kraken": as_array(numbers=numbers("9,007.25", seconds="1650000000.1239")),
        "csv": as_line(volume="3-"),
    }
    rows = {}
    for name, frame in sent.items():
        parsed = parse_as(_frames(spark, [frame]), name)
        rows[name] = parsed.withColumn("ms", F.unix_millis("exchange_ts")).first()
    b, k, c = rows["binance"], rows["kraken"], rows["csv"]
    assert (b.exchange, b.symbol, b.price, b.volume, b.ms, b.source_id) == (
        1, "NOVA9", Decimal("7.25"), Decimal(3), 1650000000123, 41,
    )
    assert (k.exchange, k.symbol, k.price, k.ms, k.source_id) == (2, "NOV/A", Decimal("9007.25"), 1650000000123, 41)
    assert (c.exchange, c.symbol, c.volume, c.ms, c.source_id) == (3, "NOVA", Decimal(-3), 1650000000123, 41)


def test_absent_time_and_id_are_zero(spark):
    row = parse_as(_frames(spark, [as_object(drop=("T", "a"))]), "binance").first()
    assert row.reason is None and row.source_id == 0 and row.exchange_ts.year == 1970


def test_frame_size_cap_is_inclusive(spark):
    padded = as_line(price="0" * (5000 - len(as_line())) + "7.25")
    assert len(padded) == 5000
    frames = _frames(spark, [padded, "0" + padded])
    reasons = [r.reason for r in parse_as(frames, "csv", 5000).orderBy("arrival_seq").collect()]
    assert reasons == [None, "frame_too_large"]


def test_unknown_format_fails(spark):
    with pytest.raises(ValueError, match="unknown frame format"):
        get_format("fix")
    frames = _frames(spark, ["x"]).withColumn("format", F.lit("fix"))
    with pytest.raises(Exception, match="unknown frame format"):
        parse_frames(frames).collect()


def test_registered_format_is_dispatched(spark):
    def extract(parts, frame):
        return Extracted(
            F.size(parts) == 3,
            F.get(parts, F.lit(0)),
            F.get(parts, F.lit(1)),
            F.lit("0"),
            F.lit(5).cast("bigint"),
            seconds_text=F.get(parts, F.lit(2)),
        )

    register_format(FrameFormat("pipes", 4, lambda f: F.split(f, r"\|", -1), extract))
    row = parse_as(_frames(spark, ["NOVA|2.5|10.25"]), "pipes").first()
    assert (row.exchange, row.symbol, row.price, row.reason) == (4, "NOVA", Decimal("2.5"), None)
