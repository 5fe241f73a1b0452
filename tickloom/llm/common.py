"""Helpers shared by the text operators: reading tables and Arrow passes over text in bounded slices."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text handled at a time inside a task; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Workers of a session that began before this package was on the path are told where it is."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_text(name: str):
    """A text column without nulls; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def map_text(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """One narrow Arrow pass: the kept columns, and `fields` made from whole texts (null: empty).

    `make` is called once per task and gives a function from a slice of texts to one array per field.
    Other columns of `df` are left out, so their names cannot clash; a kept column named like a new
    one is refused.
    """
    clash = {f.name for f in fields} & set(keep)
    if clash:
        raise ValueError(f"columns would clash: {sorted(clash)}")
    source = df.select(*keep, as_text(text).alias("_text"))
    schema = T.StructType([*source.select(*keep).schema.fields, *fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, "_text"):
                kept = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *work(part.column("_text"))], names)

    return source.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about SLICE_BYTES of text each."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(np.diff(text_buffers(batch.column(text))[1]))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column without nulls."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def byte_texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def list_array(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def hashed_sample(docs: DataFrame, text: str, count: int) -> DataFrame:
    """(h, text): the distinct texts with the `count` smallest hashes, whatever the layout of the rows.

    Only hashes are sorted, so what moves is `count` numbers a task and the sample itself.
    """
    hashed = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    least = hashed.select("h").distinct().orderBy("h").limit(count).agg(F.max("h")).first()[0]
    return hashed.where(F.col("h") <= F.lit(least)).dropDuplicates(["h"])
