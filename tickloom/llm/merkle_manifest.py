"""A Merkle manifest of a table: a tree of digests per group of rows, a tree over the groups' roots, and proofs.

Every row is a leaf; each group's leaves, in order of their key, are hashed in pairs until one digest is left, and the
groups' digests, in order of the group, likewise. Leaves get their place by ranges and prefix sums, so no task sees a whole group.

Aligned runs of `2**BLOCK_HEIGHT` nodes of one level make a block: a row that holds a whole subtree in van Emde Boas order, that
is, cut at half its height again and again, upper part first, then the lower subtrees one after another. Addresses in
it follow from (depth, index) alone; construction writes and proofs read through them. Block roots are the nodes of the
next level of blocks, so a tree over n leaves has log(n) / BLOCK_HEIGHT such levels, each built by one job.

A node without a neighbour is hashed alone. Null groups come first and are a group of their own; null keys come first in a group.
Rows with equal keys are ordered by digest, then by arrival. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import broadcast_if_small, scratch_path

BLOCK_HEIGHT = 10
DIGEST = 32
STEP = DIGEST + 1
# How a step of a path joins its node: nothing beside it, neighbour behind it, neighbour before it.
ALONE, BEHIND, BEFORE = 0, 1, 2


def digest_of(*columns: Column) -> Column:
    """Digest of a row's columns: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def joined(*digests: bytes) -> bytes:
    """Digest over digests as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def veb_address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes at `depth` (the root is at 0) of a full tree of so many levels in van Emde Boas order."""
    base = np.zeros_like(index)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower = levels - upper
        below = depth - upper
        base = base + (2**upper - 1) + (index >> below) * (2**lower - 1)
        index = index & ((1 << below) - 1)
        levels, depth = lower, below
    return base


@lru_cache(maxsize=32)
def addresses(height: int) -> list[list[int]]:
    """For each depth of a tree of this height, the address of every index."""
    return [veb_address(height + 1, d, np.arange(2**d, dtype=np.int64)).tolist() for d in range(height + 1)]


def build_block(digests: list[bytes], height: int) -> bytes:
    """Nodes of the subtree over the digests in van Emde Boas order; places beside a ragged edge stay zero."""
    place = addresses(height)
    nodes = bytearray(DIGEST * (2 ** (height + 1) - 1))
    row = digests
    for depth in range(height, -1, -1):
        if depth < height:
            row = [joined(*row[i : i + 2]) for i in range(0, len(row), 2)]
        at = place[depth]
        for i, digest in enumerate(row):
            nodes[DIGEST * at[i] : DIGEST * (at[i] + 1)] = digest
    return bytes(nodes)


def block_paths(nodes: bytes, count: int, height: int) -> list[bytes]:
    """For each of the block's leaves, the steps from it to the block's root."""
    place = addresses(height)
    steps: list[list[bytes]] = []
    for depth in range(height, 0, -1):
        at = place[depth]
        row = []
        for i in range(count):
            mate = i ^ 1
            if mate >= count:
                row.append(bytes([ALONE]) + bytes(DIGEST))
            else:
                row.append(bytes([BEHIND if mate > i else BEFORE]) + nodes[DIGEST * at[mate] : DIGEST * (at[mate] + 1)])
        steps.append(row)
        count = (count + 1) // 2
    return [b"".join(row[i >> up] for up, row in enumerate(steps)) for i in range(len(steps[0]) if steps else count)]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for at in range(0, len(path), STEP):
        kind, mate = path[at], path[at + 1 : at + STEP]
        leaf = joined(leaf) if kind == ALONE else joined(leaf, mate) if kind == BEHIND else joined(mate, leaf)
    return leaf


def siblings(path: bytes) -> list[bytes]:
    return [path[at + 1 : at + STEP] for at in range(0, len(path), STEP) if path[at] != ALONE]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def number_leaves(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with `tree`, and beside them `index` in their tree in the given order and the tree's size `n`."""
    ranged = rows.withColumn("_arrival", F.monotonically_increasing_id())
    by = ["tree", *order, "_arrival"]
    # The number holds the partition above 33 bits and the row's place in it below; it is stored before anything reads it.
    ranged = ranged.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ranged = _stored(ranged.drop("_arrival"), "merkle-ranged").withColumn("_part", F.shiftright("_at", 33))
    # A row per partition and tree that meet; a large tree has one per partition, in which its rows stand together.
    counts = ranged.groupBy("_part", "tree").agg(F.count(F.lit(1)).alias("_own"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("tree")
    offsets = counts.select(
        F.col("_part").alias("_from"),
        F.col("tree").alias("_tree"),
        "_first",
        F.coalesce(F.sum("_own").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_own").over(whole).alias("n"),
    )
    offsets = _stored(offsets, "merkle-offsets")
    same = (F.col("_part") == F.col("_from")) & F.col("tree").eqNullSafe(F.col("_tree"))
    placed = ranged.join(broadcast_if_small(offsets, offsets.count()), same)
    index = (F.col("_before") + F.col("_at") - F.col("_first")).cast("long")
    return placed.withColumn("index", index).drop("_part", "_at", "_from", "_tree", "_first", "_before")


def _heights(n: Column, level: int) -> tuple[Column, Column]:
    """Height of a tree over n leaves, and of its blocks on a level."""
    whole = F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)
    return whole, F.least(whole - level * BLOCK_HEIGHT, F.lit(BLOCK_HEIGHT))


def _blocks(nodes: DataFrame, level: int) -> DataFrame:
    """Blocks over `tree`, `index`, `digest`, `n` (leaves of the whole tree) and `payload` of one level."""
    gathered = nodes.groupBy("tree", F.shiftright("index", BLOCK_HEIGHT).alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("index", "digest", "payload"))).alias("own")
    )
    whole, height = _heights(F.col("n"), level)
    source = gathered.select("tree", "block", "n", whole.alias("whole"), height.cast("int").alias("height"), "own")
    kind = source.schema["own"].dataType.elementType["payload"].dataType.simpleString()
    tree = source.schema["tree"].dataType.simpleString()
    schema = f"tree {tree}, block long, n long, whole int, height int, payloads array<{kind}>, nodes binary, root binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("own")
            flat, offsets = own.flatten(), own.offsets.to_numpy()
            offsets = offsets - offsets[0]
            digests, heights = flat.field("digest").to_pylist(), batch.column("height").to_pylist()
            made = [build_block(digests[a:b], h) for a, b, h in zip(offsets, offsets[1:], heights, strict=False)]
            payloads = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat.field("payload"))
            kept = [batch.column(c) for c in ("tree", "block", "n", "whole", "height")]
            roots = pa.array([m[:DIGEST] for m in made], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*kept, payloads, pa.array(made, pa.binary()), roots],
                ["tree", "block", "n", "whole", "height", "payloads", "nodes", "root"],
            )

    return source.mapInArrow(run, schema)


class Forest:
    """Trees over the nodes of a DataFrame `tree`, `index`, `n`, `digest`, `payload`: stored blocks, level by level."""

    def __init__(self, leaves: DataFrame) -> None:
        self.levels: list[DataFrame] = []
        nodes, level = leaves, 0
        while True:
            blocks = _stored(_blocks(nodes, level), f"merkle-level{level}")
            self.levels.append(blocks)
            level += 1
            higher = blocks.where(F.col("whole") > level * BLOCK_HEIGHT)
            if higher.isEmpty():
                break
            nodes = higher.select(
                "tree", F.col("block").alias("index"), "n", F.col("root").alias("digest"), F.lit(None).cast("int").alias("payload")
            )

    def roots(self) -> DataFrame:
        """`tree` and its `digest`."""
        parts = [
            blocks.where(F.col("whole") <= (level + 1) * BLOCK_HEIGHT).select("tree", F.col("root").alias("digest"))
            for level, blocks in enumerate(self.levels)
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def with_paths(self, above: DataFrame) -> DataFrame:
        """Lowest blocks with `path`, from the block's root to the end of the path `above` its tree.

        `above` has `tree`, `path` and columns to carry along.
        """
        carried = [c for c in above.columns if c not in ("tree", "path")]
        kinds = [above.schema[c].dataType.simpleString() for c in ["tree", *carried]]
        schema = ", ".join(f"`{c}` {k}" for c, k in zip(["tree", *carried], kinds, strict=True)) + ", block long, path binary"
        paths = above.withColumnRenamed("tree", "_tree")
        low = None
        for level in range(len(self.levels) - 1, -1, -1):
            blocks = self.levels[level]
            same = F.col("tree").eqNullSafe(F.col("_tree"))
            # Blocks that are whole trees take the path of their tree, the others that of their own place.
            tops = blocks.where(F.col("whole") <= (level + 1) * BLOCK_HEIGHT).join(paths, same).drop("_tree")
            if low is not None:
                under = low.withColumnsRenamed({"tree": "_tree", "block": "_block"})
                rest = blocks.where(F.col("whole") > (level + 1) * BLOCK_HEIGHT)
                tops = tops.unionByName(rest.join(under, same & (F.col("block") == F.col("_block"))).drop("_tree", "_block"))
            if level == 0:
                return tops
            low = tops.select("tree", *carried, "block", "payloads", "height", "nodes", "path").mapInArrow(_spread(carried), schema)
        raise AssertionError("a forest has a level")


def _spread(carried: list[str]):
    """From a block with its path to each of its nodes with theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, blocks, paths = [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("block", "height", "nodes", "path")), strict=True)
            sizes = np.diff(batch.column("payloads").offsets.to_numpy()).tolist()
            for i, (block, height, nodes, above) in enumerate(rows):
                for k, own in enumerate(block_paths(nodes, sizes[i], height)):
                    owner.append(i)
                    blocks.append((block << BLOCK_HEIGHT) + k)
                    paths.append(own + above)
            take = pa.array(owner, pa.int64())
            kept = [batch.column(c).take(take) for c in ["tree", *carried]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(blocks, pa.int64()), pa.array(paths, pa.binary())], ["tree", *carried, "block", "path"]
            )

    return run


def _forest_of(rows: DataFrame, order: list[str]) -> Forest:
    return Forest(_stored(number_leaves(rows, order), "merkle-leaves"))


def prove_rows(rows: DataFrame, key: str, tree: str, digest: Column, claimed: Column) -> DataFrame:
    """A row per row: the key, `leaf`, `subroot`, `root`, `proof` (the neighbours' digests on the way up, as hex text),
    `folded_root` (where the claimed digest and the proof lead) and `verified` (whether that is the root)."""
    leaves = rows.select(
        F.col(tree).alias("tree"), F.col(key).alias("_key"), digest.alias("digest"),
        F.struct(F.col(key).alias("key"), claimed.alias("claimed")).alias("payload"),
    )
    forest = _forest_of(leaves, ["_key", "digest"])
    subroots = forest.roots().select(
        F.lit(0).alias("tree"), F.struct(F.col("tree").alias("name")).alias("_key"), "digest",
        F.struct(F.col("tree").alias("name"), F.col("digest").alias("subroot")).alias("payload"),
    )
    crown = _forest_of(subroots, ["_key"])
    empty = crown.roots().select("tree", F.lit(b"").alias("path"), F.col("digest").alias("top"))
    crowned = crown.with_paths(empty)
    name = leaves.schema["tree"].dataType.simpleString()
    above = crowned.select("payloads", "height", "nodes", "path", "top").mapInArrow(
        _leaf_paths, f"tree {name}, subroot binary, top binary, path binary"
    )
    kind = rows.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"
    )
    proven = forest.with_paths(_stored(above, "merkle-above"))
    return proven.select("payloads", "height", "nodes", "path", "subroot", "top").mapInArrow(_proofs(key), schema)


def _leaf_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the forest below a crown's blocks, with their way to the root."""
    for batch in batches:
        flat, sizes = batch.column("payloads").flatten(), np.diff(batch.column("payloads").offsets.to_numpy())
        tops, paths = [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("height", "nodes", "path", "top")), strict=True)
        for size, (height, nodes, above, top) in zip(sizes.tolist(), rows, strict=True):
            paths += [own + above for own in block_paths(nodes, size, height)]
            tops += [top] * size
        yield pa.RecordBatch.from_arrays(
            [flat.field("name"), flat.field("subroot"), pa.array(tops, pa.binary()), pa.array(paths, pa.binary())],
            ["tree", "subroot", "top", "path"],
        )


def _proofs(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = batch.column("payloads").flatten(), np.diff(batch.column("payloads").offsets.to_numpy())
            claims = iter(flat.field("claimed").to_pylist())
            out: list[list] = [[], [], [], [], [], []]
            rows = zip(*(batch.column(c).to_pylist() for c in ("height", "nodes", "path", "subroot", "top")), strict=True)
            for size, (height, nodes, above, subroot, top) in zip(sizes.tolist(), rows, strict=True):
                at = addresses(height)[height]
                hexes = subroot.hex(), top.hex()
                for i, own in enumerate(block_paths(nodes, size, height)):
                    path = own + above
                    folded = fold(next(claims), path)
                    proof = "".join(d.hex() for d in siblings(path))
                    leaf = nodes[DIGEST * at[i] : DIGEST * (at[i] + 1)].hex()
                    for column, value in zip(out, (leaf, *hexes, proof, folded.hex(), folded == top), strict=True):
                        column.append(value)
            kinds = [pa.string()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [flat.field("key"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
                [key, "leaf", "subroot", "root", "proof", "folded_root", "verified"],
            )

    return run
