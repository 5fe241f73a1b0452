import zlib

import pytest

from tickloom.llm.byte_shards import shard_by_bytes
from tickloom.llm.queries import op8_byte_shards

from .conftest import DATA


def brute(rows, shards):
    """Shard and slot of each (id, text) in order."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode())))
    sizes = [len((t or "").encode()) + 1 for _, t in order]
    total, before, slots, made = sum(sizes), 0, {}, []
    for (doc, text), size in zip(order, sizes, strict=True):
        shard = min((2 * before + size) * shards // (2 * total), shards - 1)
        slots[shard] = slots.get(shard, -1) + 1
        made.append((doc, size, zlib.crc32((text or "").encode()), shard, slots[shard]))
        before += size
    return made


def as_rows(frame, key="doc_id"):
    return sorted((tuple(r[c] for c in (key, "size", "text_crc32", "shard", "slot")) for r in frame.collect()), key=lambda r: (r[3], r[4]))


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_against_a_running_sum(spark, shards):
    rows = [(i, "é" * (i * 37 % 90)) for i in range(300)] + [(None, None), (None, ""), (None, "x" * 5000), (7, "x"), (7, "x"), (9, "long " * 40_000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, shard string")
    assert as_rows(shard_by_bytes(frame, shards)) == brute(rows, shards)


def test_a_hot_null_key_and_empty_tables(spark):
    rows = [(None, "same")] * 400 + [(1, "one")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(shard_by_bytes(frame, 5)) == brute(rows, 5)
    assert shard_by_bytes(frame.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        shard_by_bytes(frame, 0)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = op8_byte_shards(spark, DATA)
    assert as_rows(found) == brute(rows, 16)
    assert {(r.law, r.grown_shard) for r in found.collect()} == {("bytes", None)}
    plan = found._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
