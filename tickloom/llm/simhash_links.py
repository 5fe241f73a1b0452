"""Near copies by SimHash: fingerprints of word shingles, linked when few bits differ, and their components.

The join. A fingerprint's 64 bits are 32 segments of two bits, and its embedding counts the bits of each segment. The
Manhattan distance of two embeddings never exceeds the number of differing bits. Segments are dealt into `max_bits` + j
blocks; if the distance is at most `max_bits`, at least j blocks have equal counts throughout. So every choice of j
blocks is a grid whose cells are the counts in them, and near fingerprints meet in a cell of at least one grid, whatever
j is. More equal blocks make more grids of smaller cells: j is the number with which moving the counted fingerprints to
their cells and comparing them there is expected to cost least. Pairs of a cell are held against the Manhattan bound first and the bits then.
Counts 0, 1, 2 are written 00, 01, 11, which makes the Manhattan distance the number of differing bits of the two codes.

Cells are counted first. One of up to TILE fingerprints is compared inside one task; those of a larger one get a tile by
hash and are sent to each pair of tiles, so that no pair is left out and no task holds or writes a whole large cell. A
task passes on a tree of links per component it sees, not all links.

A text without words has fingerprint zero. Fewer words than a shingle make one shingle of all. Null keys are
linked like others and count for a component's smallest key only if it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import byte_texts, map_text
from tickloom.session import broadcast_if_small, materialize

SEED = 42
SEGMENTS = 32
TILE = 8192
# What it costs to move a fingerprint to a cell, in comparisons of two expected by chance. It is set low, as real
# fingerprints meet more often than chance has it.
MOVE = 8
# How often two segments agree by chance: counts 0, 1 and 2 come up one, two and one times in four.
AGREE = 3 / 8
# Shingles whose bits are counted at a time.
CHUNK = 1 << 15
_LOW = np.uint64(0x5555555555555555)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(raw: bytes, size: int = 4) -> int:
    """Unsigned fingerprint: each bit is set if more than half of the shingles' hashes have it."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    last = len(words) - size + 1
    spans = zip(starts[:last].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, last)
    ones = np.zeros(64, np.int64)
    for at in range(0, last, CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > last, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """The key and `fingerprint` as a signed number."""

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            made = np.array([fingerprint(raw, size) for raw in byte_texts(column)], np.uint64)
            return [pa.array(made.view(np.int64))]

        return work

    return map_text(docs, text, [key], [T.StructField("fingerprint", T.LongType(), False)], make)


def embedding(prints: np.ndarray) -> np.ndarray:
    """Bit counts of all segments, each written with as many low bits as it counts."""
    any_bit = (prints | prints >> np.uint64(1)) & _LOW
    both = prints & prints >> np.uint64(1) & _LOW
    return any_bit | both << np.uint64(1)


def equal_blocks(prints: int, max_bits: int) -> int:
    """How many blocks a grid compares, for that many distinct fingerprints."""
    if not 0 <= max_bits <= SEGMENTS - 2:
        raise ValueError(f"max_bits must be 0 to {SEGMENTS - 2}")

    def cost(equal: int) -> float:
        blocks = max_bits + equal
        return comb(blocks, equal) * (MOVE + prints * AGREE ** (SEGMENTS * equal / blocks))

    return min(range(2, SEGMENTS - max_bits + 1), key=cost)


def grid_masks(max_bits: int, equal: int = 2) -> list[int]:
    """For each choice of `equal` blocks, the embedding bits of their segments."""
    blocks = max_bits + equal
    if max_bits < 0 or equal < 1 or blocks > SEGMENTS:
        raise ValueError(f"at most {SEGMENTS} blocks")
    owner = [segment * blocks // SEGMENTS for segment in range(SEGMENTS)]
    masks = [sum(3 << 2 * s for s in range(SEGMENTS) if owner[s] == b) for b in range(blocks)]
    return [sum(chosen) for chosen in combinations(masks, equal)]


# Fingerprints whose cells are written in one batch, and cells that a task is to write.
CELL_ROWS = 1024
TASK_CELLS = 1 << 20


def _cells(prints: DataFrame, max_bits: int, equal: int) -> DataFrame:
    """(cell, fp) for every grid."""
    masks = np.array(grid_masks(max_bits, equal), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(len(masks), dtype=np.uint64) * _SPREAD
        for batch in batches:
            whole = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(whole), CELL_ROWS):
                own = whole[at : at + CELL_ROWS]
                key = (embedding(own)[:, None] & masks) ^ number
                key = (key ^ key >> np.uint64(31)) * _SPREAD
                key ^= key >> np.uint64(29)
                columns = [key.ravel().view(np.int64), np.repeat(own, len(masks)).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "fp"])

    return prints.mapInArrow(run, "cell long, fp long")


def _settle(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels after joining the given pairs; a label is the smallest row of its component."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return label
        left, right = left[apart], right[apart]
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(label, high, low)
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


def linked(prints: np.ndarray, stop: np.ndarray, start: np.ndarray, max_bits: int) -> np.ndarray:
    """Component labels of rows, where row i is compared with rows start[i] up to stop[i], all behind it."""
    code = embedding(prints)
    label = np.arange(len(prints))
    left, right, pending = [], [], 0
    near = max_bits
    alive = np.flatnonzero(start < stop)
    step = 0
    while len(alive):
        other = start[alive] + step
        close = np.bitwise_count(code[alive] ^ code[other]) <= near
        a, b = alive[close], other[close]
        close = np.bitwise_count(prints[a] ^ prints[b]) <= near
        a, b = a[close], b[close]
        apart = label[a] != label[b]
        if apart.any():
            left.append(a[apart])
            right.append(b[apart])
            pending += len(left[-1])
        if pending > 200_000:
            label = _settle(label, np.concatenate(left), np.concatenate(right))
            left, right, pending = [], [], 0
        step += 1
        alive = alive[start[alive] + step < stop[alive]]
    return _settle(label, np.concatenate(left), np.concatenate(right)) if left else label


LINK_DDL = "a long, b long"


def _tree(prints: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """Links from each row to the first row of its component."""
    rows = np.flatnonzero(label != np.arange(len(label)))
    ends = [prints[rows].view(np.int64), prints[label[rows]].view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in ends], ["a", "b"])


def _compare_cells(max_bits: int):
    """Rows sorted by cell to links."""

    def done(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(first, len(cell)))
        prints = fp.view(np.uint64)
        stop = np.repeat(np.cumsum(size), size)
        return _tree(prints, linked(prints, stop, np.arange(1, len(prints) + 1), max_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_cell, kept_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            cell = np.concatenate([kept_cell, batch.column(0).to_numpy()])
            fp = np.concatenate([kept_fp, batch.column(1).to_numpy()])
            # The last cell may go on in the next batch.
            whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if whole > 1 << 18:
                yield done(cell[:whole], fp[:whole])
                cell, fp = cell[whole:], fp[whole:]
            kept_cell, kept_fp = cell, fp
        if len(kept_cell):
            yield done(kept_cell, kept_fp)

    return run


def _compare_tiles(max_bits: int):
    """Rows sorted by cell and pair of tiles, first tile first, to links."""

    def compare(fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        prints = fp.view(np.uint64)
        split = int((side == 0).sum())
        size = len(prints)
        if split == size:
            start = np.arange(1, size + 1)
        else:
            start = np.where(np.arange(size) < split, split, size)
        return _tree(prints, linked(prints, np.full(size, size), start, max_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(n).to_numpy() for n in ("cell", "low", "high", "side", "fp")]
            if kept is not None:
                columns = [np.concatenate(pair) for pair in zip(kept, columns, strict=True)]
            keys, side, fp = np.stack(columns[:3]), columns[3], columns[4]
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist()]
            for a, b in zip(edges, edges[1:], strict=False):
                yield compare(fp[a:b], side[a:b])
            kept = [c[edges[-1] :] for c in columns]
        if kept is not None and len(kept[0]):
            yield compare(kept[4], kept[3])

    return run


def tile_pairs(cells: DataFrame, sizes: DataFrame, tile: int) -> DataFrame:
    """(cell, low, high, side, fp): fingerprints of large cells, once per pair of tiles that theirs belongs to."""
    tiles = F.ceil(F.col("n") / tile)
    rows = cells.join(sizes, "cell").select("cell", "fp", tiles.alias("tiles"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), "tiles"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    return rows.select("cell", low, high, (F.col("own") > F.col("other")).cast("int").alias("side"), "fp")


def links(prints: DataFrame, max_bits: int, tile: int = TILE, equal: int | None = None) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (column `fingerprint`) just as all near pairs would."""
    distinct = materialize(prints.select("fingerprint").distinct())
    n = distinct.count()
    equal = equal or equal_blocks(n, max_bits)
    # Few narrow rows become many cells, so they are spread over tasks by what they become.
    tasks = -(-n * comb(max_bits + equal, equal) // TASK_CELLS)
    cells = _cells(distinct.repartition(max(tasks, 1), "fingerprint"), max_bits, equal)
    sizes = materialize(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile))
    large = sizes.count()
    if not large:
        dealt = cells.repartition("cell").sortWithinPartitions("cell")
        return dealt.mapInArrow(_compare_cells(max_bits), LINK_DDL).distinct()
    sizes = broadcast_if_small(sizes, large)
    dealt = cells.join(sizes, "cell", "left_anti").repartition("cell").sortWithinPartitions("cell")
    found = dealt.mapInArrow(_compare_cells(max_bits), LINK_DDL)
    pairs = tile_pairs(cells, sizes, tile)
    pairs = pairs.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "side")
    return found.unionByName(pairs.mapInArrow(_compare_tiles(max_bits), LINK_DDL)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b): the root is the smallest node of the component.

    Each round hangs a node's larger neighbours, then its smaller ones, on the smallest, until only stars are left.
    """
    least = F.least("a", "b").alias("low")
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), least).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()
        if before == tuple(state):
            return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                now.select("low", "low").distinct().toDF("node", "root")
            )
        before = tuple(state)
        # Larger neighbours of a node move to the smallest node it knows, itself included. The minima are stored, so
        # that both sides of the join are plain exchanges and a node of very many neighbours can be split.
        smallest = materialize(now.groupBy(F.col("high").alias("low")).agg(F.min("low").alias("m")))
        hung = now.join(smallest, "low", "left").select("high", F.coalesce("m", "low").alias("low")).distinct()
        # The smaller neighbours of a node move to the smallest of them, and the node with them.
        hung = materialize(hung)
        smallest = materialize(hung.groupBy("high").agg(F.min("low").alias("m")))
        both = hung.join(smallest, "high")
        now = materialize(
            both.where("low <> m")
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
            .unionByName(both.select("high", F.col("m").alias("low")))
            .distinct()
        )


def link_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4, tile: int = TILE
) -> DataFrame:
    """The key, its `fingerprint` (signed) and `component`, the smallest key reachable over links."""
    own = materialize(fingerprints(docs, key, text, shingle))
    groups = materialize(own.groupBy("fingerprint").agg(F.min(key).alias("_first")))
    roots = components(links(groups, max_bits, tile)).withColumnRenamed("node", "fingerprint")
    rooted = groups.join(roots, "fingerprint", "left").select(
        "fingerprint", "_first", F.coalesce("root", "fingerprint").alias("_root")
    )
    # Both sides of the join are stored, so that a component of very many fingerprints can be split.
    rooted = materialize(rooted)
    firsts = materialize(rooted.groupBy("_root").agg(F.min("_first").alias("component")))
    named = rooted.join(firsts, "_root").select("fingerprint", "component")
    return own.join(named, "fingerprint").select(F.col(key), "fingerprint", "component")


def as_hex(value) -> F.Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
