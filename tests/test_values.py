"""Numbers, validation and hashing."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import NOON
from tickloom.functions.hashing import FNV_OFFSET, FNV_PRIME, fnv1a64, shard_of
from tickloom.functions.numbers import slot_of, strict_bigint, strict_decimal
from tickloom.functions.validation import with_validation
from tickloom.operators.routing import route, shard_counts, with_shard
from tickloom.schema import IngestOptions

NUMBERS = {
    "1": "1", " 1 ": "1", "\t1\r\n": "1", "+1": "1", "-1": "-1", "1-": "-1", "1 +": "1", "1,000.5": "1000.5",
    "1,,0": "10", ".5": "0.5", "5.": "5", "-.5": "-0.5", "1\x00": "1", "000000000000000000000000001": "1",
    "1000000000000000000": "1000000000000000000", "0.0000000000000000005": "0.000000000000000001",
    "": None, " ": None, ".": None, "1e5": None, "0x10": None, "--1": None, "-1-": None, "- 1": None,
    ",1": None, "1.2.3": None, "1.2,3": None, "$1": None, "(1)": None, "NaN": None, "Infinity": None,
    "1 2": None, "١": None, "100000000000000000000": None,
}


def test_strict_decimal(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    got = {r.t: r.d for r in df.select("t", strict_decimal(F.col("t")).alias("d")).collect()}
    want = {t: None if v is None else Decimal(v) for t, v in NUMBERS.items()}
    assert got == want


def test_strict_bigint(spark):
    cases = {"17": 17, "-17": -17, "+17": 17, "007": 7, " 17": None, "17 ": None, "1.0": None, "": None,
             "17\n": None, "9223372036854775807": 2**63 - 1, "9223372036854775808": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.d for r in df.select("t", strict_bigint(F.col("t")).alias("d")).collect()}
    assert got == cases


def test_slots_cover_negative_times(spark):
    df = spark.createDataFrame([(t,) for t in (-11, -10, -1, 0, 9, 10)], "t bigint")
    got = [r.s for r in df.orderBy("t").select(slot_of(F.col("t"), 10).alias("s")).collect()]
    assert got == [-2, -1, -1, 0, 0, 1]


VALIDATOR = [
    ({}, None),
    ({"price": "0"}, "price_range"),
    ({"price": "-1"}, "price_range"),
    ({"price": "1000000000000000000", "volume": "1000000000000000000"}, None),
    ({"price": "1000000000000000000.000000000000000001"}, "price_range"),
    ({"volume": "-1"}, "volume_range"),
    ({"volume": "0"}, None),
    ({"volume": "1000000000000000001"}, "volume_range"),
    ({"symbol": ""}, "bad_symbol"),
    ({"symbol": "A" * 32}, None),
    ({"symbol": "A" * 33}, "bad_symbol"),
    *[({"symbol": s}, "bad_symbol") for s in ("A B", "A'B", "A\v", "\rA", "Ж", "ＡＢ")],
    *[({"symbol": s}, None) for s in ("Q", "q9", "A/B", "A-B", "A_B", "A.B", "9/-_.z")],
    ({"exchange_ts": NOON - timedelta(days=8)}, "time_skew"),
    ({"exchange_ts": NOON - timedelta(days=7)}, None),
    ({"exchange_ts": NOON - timedelta(days=7, milliseconds=1)}, "time_skew"),
    ({"exchange_ts": NOON + timedelta(minutes=1)}, None),
    ({"exchange_ts": NOON + timedelta(minutes=1, milliseconds=1)}, "time_skew"),
    ({"price": "-1", "volume": "-1", "symbol": ""}, "price_range"),
]


def test_validator(make_ticks):
    rows = with_validation(make_ticks([r for r, _ in VALIDATOR])).orderBy("arrival_seq").collect()
    assert [r.reason for r in rows] == [reason for _, reason in VALIDATOR]


def _fnv(text: str) -> int:
    h = FNV_OFFSET
    for b in text.encode():
        h = (h ^ b) * FNV_PRIME % 2**64
    return h


def test_fnv_goldens_and_any_text(spark):
    goldens = {"": 14695981039346656037, "BTCUSDT": 4495733446125262380, "ETHUSDT": 9177286476152214768}
    assert {t: _fnv(t) for t in goldens} == goldens
    texts = [*goldens, "бтс", "€/USD", "😀", "A" * 300, *[f"SYM{i}" for i in range(2000)]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: int(r.h) for r in df.select("t", fnv1a64(F.col("t")).alias("h")).collect()}
    assert got == {t: _fnv(t) for t in texts}


def test_shards(spark, make_ticks):
    df = spark.createDataFrame([(f"SYM{i}",) for i in range(20_000)], "symbol string")
    got = df.select("symbol", shard_of(F.col("symbol"), 7).alias("s")).collect()
    assert all(r.s == _fnv(r.symbol) % 7 for r in got)
    with pytest.raises(ValueError):
        shard_of(F.col("symbol"), 0)
    empty = spark.createDataFrame([("",)], "symbol string")
    with pytest.raises(Exception, match="empty symbol"):
        empty.select(shard_of(F.col("symbol"), 4)).collect()

    ticks = make_ticks([{"symbol": f"S{i % 20}", "source_id": i} for i in range(200)])
    counts = shard_counts(ticks, 4).collect()
    assert sum(r.received for r in counts) == 200 and sum(r.symbols for r in counts) == 20
    placed = route(ticks, 4)
    assert placed.count() == 200
    assert with_shard(ticks, 4).exceptAll(placed.select(*with_shard(ticks, 4).columns)).isEmpty()


def test_options_guard():
    for bad in (
        {"writer_count": 0}, {"max_frame_bytes": 0}, {"batch_max_delay": timedelta(0)}, {"dedup_window": timedelta(seconds=-1)},
    ):
        with pytest.raises(ValueError):
            IngestOptions(**bad)
    assert IngestOptions(writer_count=3).writer_count == 3
    assert datetime(2026, 5, 29, 12, tzinfo=NOON.tzinfo) == NOON
