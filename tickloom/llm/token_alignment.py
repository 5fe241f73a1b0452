"""How the ids of two tokenizers correspond, by the bytes they stand for.

Ids of tokenizer A are mapped beforehand to the id of B that has the same bytes (the identity map). A text is encoded by both,
and the byte offsets at which tokens of both end cut it into groups. A group of one id of A and its identity needs no pair: the
number of documents that hold it is added up in a vector as long as A's vocabulary. Only what irregular groups link,
pairs of ids whose bytes overlap, is counted by pairs in Spark, once per document.

Texts go through one Arrow pass in blocks of a bounded number of bytes. A block is stored as one row: what is known of its
documents, its distinct pairs, and which document holds which link how often, as compressed arrays. The corpus-wide counts of a
block's pairs come back to it by a join, those of identities as the vector, whose length is the vocabulary's.

The leading space that B puts before a text is part of it for both. Names of special tokens in a text are plain text. Null or empty
texts, and texts that either tokenizer does not give back byte for byte, have no tokens. Rows with equal or null keys are documents of
their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import as_text, slices
from tickloom.llm.piece_codec import MARK, load_codec
from tickloom.llm.tier_packing import _byte_letters, load_ids
from tickloom.session import broadcast_if_small, scratch_path

# Text bytes after which a block is closed; one longer text makes a block of its own.
BLOCK_BYTES = 8 << 20
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Pool:
    """Byte strings by id, laid end to end."""

    def __init__(self, strings: list[bytes]) -> None:
        self.raw = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        stops = np.cumsum(sizes)
        return self.raw[np.repeat(self.starts[ids] - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)]


class Digits:
    """Ids as decimal text in cells of equal width, to be strung together with one mark behind each."""

    def __init__(self, count: int) -> None:
        texts = [str(i).encode() for i in range(count)]
        self.width = max(map(len, texts)) + 1
        self.cells = np.frombuffer(b"".join(t.ljust(self.width, b"\0") for t in texts), np.uint8).reshape(count, -1)
        self.sizes = np.array([len(t) for t in texts], np.int64)

    def strung(self, ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text, and where each id with its mark ends."""
        cells, sizes = self.cells[ids], self.sizes[ids]
        cells[np.arange(len(ids)), sizes] = marks
        return cells[np.arange(self.width) <= sizes[:, None]].tobytes(), np.cumsum(sizes + 1)


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self.encode_a = load_ids(path_a, added=False)
        self.codec = load_codec(path_b)
        with open(path_a, encoding="utf-8") as file:
            made = json.load(file)
        letters = _byte_letters()
        # Added tokens never appear in a text that is taken as plain; they keep their name as bytes.
        names = made["model"]["vocab"] | {t["content"]: t["id"] for t in made.get("added_tokens", [])}
        a = [b""] * (max(names.values()) + 1)
        for name, at in names.items():
            a[at] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        codec = self.codec
        b = [
            bytes([int(p[3:5], 16)]) if codec.is_byte[i] else p.replace(MARK, " ").encode() for i, p in enumerate(codec.pieces)
        ]
        self.a, self.b = Pool(a), Pool(b)
        # The lowest id with these bytes, but a byte piece only where nothing else has them.
        by_bytes = {x: i for i, x in reversed(list(enumerate(b))) if codec.is_byte[i]}
        by_bytes |= {x: i for i, x in reversed(list(enumerate(b))) if x and not codec.is_byte[i]}
        self.identity = np.array([by_bytes.get(x, -1) for x in a], np.int64)
        self.digits = Digits(max(len(a), len(b)))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both for each text, none where they do not give the text back."""
        raw = self.encode_a.encode([f" {t}" if t else "" for t in texts])
        a = [np.frombuffer(x, "<u4").astype(np.int64) for x in raw]
        ids, _, counts = self.codec.encode_many(texts)
        ids = ids.astype(np.int64)
        stops = np.cumsum(counts)
        b = [ids[i:j] for i, j in zip(np.append(0, stops), stops, strict=False)]
        # All texts at once; only if they differ are they compared one by one.
        whole = "".join(f" {t}" for t in texts if t).encode()
        if self.a.joined(np.concatenate(a)).tobytes() != whole or self.b.joined(ids).tobytes() != whole:
            none = np.empty(0, np.int64)
            for i, text in enumerate(texts):
                own = f" {text}".encode() if text else b""
                if self.a.joined(a[i]).tobytes() != own or self.b.joined(b[i]).tobytes() != own:
                    a[i] = b[i] = none
        return a, b


@lru_cache(maxsize=2)
def load_aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class Slice:
    """The alignment of some texts, taken as one run of bytes: documents end where both have an end."""

    def __init__(self, aligner: Aligner, texts: list[str]) -> None:
        docs = len(texts)
        per_a, per_b = aligner.encode(texts)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (per_a, per_b))
        a, b = np.concatenate(per_a), np.concatenate(per_b)
        ends_a, ends_b = np.cumsum(aligner.a.sizes[a]), np.cumsum(aligner.b.sizes[b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        in_a, in_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        in_a[ends_a], in_b[ends_b] = True, True
        # Between two ends of either side one id of A meets one of B: that is a link.
        ends = np.flatnonzero(in_a | in_b)
        at_a, at_b = in_a[ends], in_b[ends]
        link_a, link_b = np.cumsum(at_a) - at_a, np.cumsum(at_b) - at_b
        closing = at_a & at_b
        group = np.cumsum(closing) - closing
        groups = int(closing.sum())
        doc_ends = np.append(0, ends_a)[np.cumsum(n_a)]
        doc = np.searchsorted(doc_ends, ends, "left")
        group_doc = doc[closing]
        self.counts = {
            "n_a": n_a, "n_b": n_b,
            "n_groups": np.bincount(group_doc, minlength=docs), "n_links": np.bincount(doc, minlength=docs),
        }
        self.texts = self._groups_text(aligner, a, b, link_a, link_b, group, groups, np.cumsum(n_a + n_b))
        ids_a, ids_b = a[link_a], b[link_b]
        same = aligner.identity[ids_a] == ids_b
        vocabulary = len(aligner.identity)
        # (document, id of A, how often) of links to the identity; (document, pair, how often) of the others.
        keys, self.same_often = np.unique(doc[same] * vocabulary + ids_a[same], return_counts=True)
        self.same_doc, self.same_id = np.divmod(keys, vocabulary)
        self.pairs, place = np.unique(ids_a[~same] << 32 | ids_b[~same], return_inverse=True)
        width = max(1, len(self.pairs))
        keys, self.other_often = np.unique(doc[~same] * width + place, return_counts=True)
        self.other_doc, self.other_pair = np.divmod(keys, width)

    @staticmethod
    def _groups_text(aligner, a, b, link_a, link_b, group, groups, doc_stops) -> list[bytes]:
        """Each document's `a1,a2|b1;a3|b2`."""
        if not len(a):
            return [b""] * len(doc_stops)
        group_a, group_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
        group_a[link_a], group_b[link_b] = group, group
        many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        place_a = np.arange(len(a)) + (np.cumsum(many_b) - many_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(many_a)[group_b]
        ids = np.empty(len(a) + len(b), np.int64)
        ids[place_a], ids[place_b] = a, b
        marks = np.full(len(ids), ord(","), np.uint8)
        marks[np.cumsum(many_a + many_b) - many_b - 1] = ord("|")
        marks[np.cumsum(many_a + many_b) - 1] = ord(";")
        text, stops = aligner.digits.strung(ids, marks)
        bounds = np.append(0, stops)[np.append(0, doc_stops)]
        return [text[i : j - 1] if j > i else b"" for i, j in zip(bounds, bounds[1:], strict=False)]


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers below 2**32, compressed; lengths first."""
    heads = np.array([len(arrays), *map(len, arrays)], "<u4")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype("<u4").tobytes() for x in (heads, *arrays)))


def _unpacked(blob: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4").astype(np.int64)
    stops = np.cumsum(flat[1 : 1 + flat[0]]) + 1 + flat[0]
    return [flat[i:j] for i, j in zip(np.append(1 + flat[0], stops), stops, strict=False)]


class _Block:
    def __init__(self) -> None:
        self.keys: list[pa.Array] = []
        self.slices: list[Slice] = []
        self.docs = self.bytes = 0

    def add(self, keys: pa.Array, part: Slice, size: int) -> None:
        self.keys.append(keys)
        self.slices.append(part)
        self.docs += len(keys)
        self.bytes += size

    def row(self, vocabulary: int) -> dict:
        """Keys, counts and digests of the documents, the block's distinct pairs and identities with the number of its
        documents that hold them, and its links: document, id or place of the pair, how often."""
        parts, first = self.slices, np.cumsum([0, *(len(k) for k in self.keys)])
        pairs = np.unique(np.concatenate([p.pairs for p in parts]))
        same_doc = np.concatenate([p.same_doc + at for p, at in zip(parts, first, strict=False)])
        same_id = np.concatenate([p.same_id for p in parts])
        other_doc = np.concatenate([p.other_doc + at for p, at in zip(parts, first, strict=False)])
        other = np.concatenate([np.searchsorted(pairs, p.pairs)[p.other_pair] for p in parts])
        held = np.bincount(same_id, minlength=vocabulary)
        links = [
            np.bincount(same_doc, minlength=self.docs), same_id, np.concatenate([p.same_often for p in parts]),
            np.bincount(other_doc, minlength=self.docs), other, np.concatenate([p.other_often for p in parts]),
        ]
        return {
            "keys": pa.concat_arrays(self.keys),
            **{n: np.concatenate([p.counts[n] for p in parts]) for n in COUNTS},
            "digests": [hashlib.sha256(t).hexdigest() if t else "" for p in parts for t in p.texts],
            "pairs": pairs,
            "pair_docs": np.bincount(other, minlength=len(pairs)),
            "ids": np.flatnonzero(held),
            "id_docs": held[held > 0],
            "links": _packed(links),
        }


LISTS = (*COUNTS, "pairs", "pair_docs", "ids", "id_docs")


def measured_blocks(docs: DataFrame, path_a: str, path_b: str, key: str, text: str) -> DataFrame:
    source = docs.select(F.col(key).alias("_key"), as_text(text).alias("_text"))
    kind = source.schema["_key"].dataType
    longs = T.ArrayType(T.LongType(), False)
    schema = T.StructType(
        [
            T.StructField("block", T.LongType(), False),
            T.StructField("keys", T.ArrayType(kind)),
            *(T.StructField(n, longs, False) for n in LISTS),
            T.StructField("digests", T.ArrayType(T.StringType(), False), False),
            T.StructField("links", T.BinaryType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load_aligner(path_a, path_b)
        vocabulary = len(aligner.identity)
        number = TaskContext.get().partitionId() << 32
        block = _Block()

        def closed() -> pa.RecordBatch:
            nonlocal block, number
            row = block.row(vocabulary)
            columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, block.docs], row["keys"])]
            columns += [pa.ListArray.from_arrays([0, len(row[n])], pa.array(row[n], pa.int64())) for n in LISTS]
            columns += [pa.array([row["digests"]], pa.list_(pa.string())), pa.array([row["links"]], pa.binary())]
            block, number = _Block(), number + 1
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            for part in slices(batch, "_text"):
                texts = part.column("_text").to_pylist()
                block.add(part.column("_key"), Slice(aligner, texts), sum(map(len, texts)))
                if block.bytes >= BLOCK_BYTES:
                    yield closed()
        if block.docs:
            yield closed()

    return source.mapInArrow(run, schema)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: the key, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best` (links whose pair is in as many documents
    as any of its id of A), `count_sum` (documents of a link's pair, over all links) and `groups_sha256`."""
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned-blocks")
    measured_blocks(docs, path_a, path_b, key, text).write.parquet(path)
    blocks = spark.read.parquet(path)
    exploded = blocks.select("block", F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
    path = scratch_path(spark, "pair-counts")
    exploded.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("docs")).write.parquet(path)
    pairs = spark.read.parquet(path)
    # Vectors over A's vocabulary: documents that hold an id's identity, and the most that hold any of its pairs.
    vocabulary = len(load_aligner(path_a, path_b).identity)
    same = blocks.select(F.explode(F.arrays_zip("ids", "id_docs")).alias("p")).groupBy("p.ids").agg(F.sum("p.id_docs"))
    most = pairs.groupBy(F.shiftright("pair", 32).alias("id")).agg(F.max("docs"))
    same_docs, best = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
    for at, count in same.collect():
        same_docs[at] = best[at] = count
    for at, count in most.collect():
        best[at] = max(best[at], count)
    vectors = spark.sparkContext.broadcast((same_docs, best))
    own = blocks.select("block", F.explode("pairs").alias("pair"))
    counted = own.join(broadcast_if_small(pairs, pairs.count()), "pair")
    back = counted.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pair", "docs"))).alias("counted"))
    whole = blocks.select("block", "keys", *COUNTS, "digests", "links").join(back, "block", "left")
    kind = docs.schema[key].dataType
    fields = [T.StructField(n, T.LongType(), False) for n in (*COUNTS, "n_best", "count_sum")]
    schema = T.StructType([T.StructField(key, kind), *fields, T.StructField("groups_sha256", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same_docs, best = vectors.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                known = row.column("counted").flatten()
                pair, docs = (known.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("pair", "docs"))
                same_many, same_id, same_often, many, place, often = _unpacked(row.column("links")[0].as_py())
                of = np.concatenate([np.repeat(np.arange(len(m)), m) for m in (same_many, many)])
                often = np.concatenate([same_often, often])
                counts = np.concatenate([same_docs[same_id], docs[place]])
                top = counts == np.concatenate([best[same_id], best[pair[place] >> 32]])
                n_best, total = np.zeros(len(many), np.int64), np.zeros(len(many), np.int64)
                np.add.at(n_best, of[top], often[top])
                np.add.at(total, of, often * counts)
                columns = [row.column(n).flatten() for n in ("keys", *COUNTS)]
                columns += [pa.array(n_best), pa.array(total), row.column("digests").flatten()]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return whole.drop("block").mapInArrow(run, schema)
