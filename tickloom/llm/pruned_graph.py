"""Nearest neighbours by cosine over robust-pruned directed graphs, one per shard.

Equal vectors are one node that carries its smallest ids, as many as an answer can use. Nodes are dealt to shards by a hash
of the vector, about SHARD to a shard, so every row is indexed and shards stay even. In a shard, nodes enter the graph in
batches: a greedy beam search from the middle node proposes neighbours, and pruning walks them from near to far and drops
those that a kept one is closer to by the factor ALPHA, so that kept edges point different ways. Edges are then offered
backwards and crowded nodes pruned again. Queries stream through every shard; a beam search finds their nearest nodes,
which are scored in double precision on the original vectors.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an
id. Vectors of different length are never compared. Repeated rows count once. With fewer candidates than asked for, all
that the searches reach are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialize

SHARD = 4096
DEGREE, BEAM, ALPHA = 24, 64, 1.2
BATCH = 256
FAR = np.float32(np.inf)


class PrunedGraph:
    """Directed graph over unit vectors; `edges` holds neighbours per node, -1 where there is none."""

    def __init__(self, unit: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 5) -> None:
        self.unit, self.degree, self.beam, self.reach = unit, degree, beam, alpha * alpha
        self.edges = np.full((len(unit), degree), -1, np.int64)
        self.middle = int(np.argmax(unit @ unit.mean(0)))
        order = np.random.default_rng(seed).permutation(len(unit))
        order = order[order != self.middle]
        at, size = 0, 1
        while at < len(order):
            self._insert(order[at : at + size])
            at += size
            size = min(BATCH, 2 * size)

    def _distance(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distance of each row's point to each of its nodes; FAR for node -1."""
        found = 2 - 2 * np.einsum("bd,bnd->bn", points, self.unit[nodes])
        return np.where(nodes < 0, FAR, np.maximum(found, 0)).astype(np.float32)

    def search(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes found for each point and their squared distances, near to far, -1 where there are fewer."""
        rows = len(points)
        nodes = np.full((rows, beam), -1, np.int64)
        nodes[:, 0] = self.middle
        near = np.full((rows, beam), FAR, np.float32)
        near[:, 0] = self._distance(points, nodes[:, :1])[:, 0]
        opened = np.zeros((rows, beam), bool)
        live = np.arange(rows)
        while len(live):
            waiting = np.where(opened[live] | (nodes[live] < 0), FAR, near[live])
            best = waiting.argmin(1)
            todo = waiting[np.arange(len(live)), best] < FAR
            live, best = live[todo], best[todo]
            if not len(live):
                break
            opened[live, best] = True
            fresh = self.edges[nodes[live, best]]
            fresh = np.where((fresh[:, :, None] == nodes[live][:, None, :]).any(2), -1, fresh)
            far = self._distance(points[live], fresh)
            both = np.concatenate([near[live], far], 1)
            order = np.argsort(both, 1, kind="stable")[:, :beam]
            near[live] = np.take_along_axis(both, order, 1)
            nodes[live] = np.take_along_axis(np.concatenate([nodes[live], fresh], 1), order, 1)
            opened[live] = np.take_along_axis(np.concatenate([opened[live], np.zeros(fresh.shape, bool)], 1), order, 1)
        return np.where(near < FAR, nodes, -1), near

    def _prune(self, own: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Up to `degree` diverse neighbours of each node out of its candidates (-1: none, no repeats)."""
        nodes = np.where(nodes == own[:, None], -1, nodes)
        near = self._distance(self.unit[own], nodes)
        order = np.argsort(near, 1, kind="stable")
        nodes, near = np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)
        open_ = nodes >= 0
        kept = np.full((len(own), self.degree), -1, np.int64)
        rows = np.arange(len(own))
        for place in range(self.degree):
            some = open_.any(1)
            if not some.any():
                break
            first = open_.argmax(1)
            chosen = np.where(some, nodes[rows, first], -1)
            kept[:, place] = chosen
            between = self._distance(self.unit[chosen], nodes)
            open_ &= (self.reach * between > near) & some[:, None]
            open_[rows, first] = False
        return kept

    def _insert(self, own: np.ndarray) -> None:
        found, _ = self.search(self.unit[own], self.beam)
        if len(own) > 1:
            # Points of one batch do not see each other in the graph yet.
            peers = 2 - 2 * self.unit[own] @ self.unit[own].T
            np.fill_diagonal(peers, FAR)
            most = min(self.degree // 2, len(own) - 1)
            found = np.concatenate([found, own[np.argpartition(peers, most - 1, 1)[:, :most]]], 1)
        self.edges[own] = self._prune(own, found)
        source = np.repeat(own, self.degree)
        target = self.edges[own].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, size = np.unique(target, return_index=True, return_counts=True)
        offered = np.full((len(nodes), int(size.max(initial=0))), -1, np.int64)
        row = np.repeat(np.arange(len(nodes)), size)
        offered[row, np.arange(len(target)) - np.repeat(first, size)] = source
        now = self.edges[nodes]
        offered = np.where((offered[:, :, None] == now[:, None, :]).any(2), -1, offered)
        room = (now >= 0).sum(1) + (offered >= 0).sum(1) <= self.degree
        both = np.concatenate([now, offered], 1)
        packed = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)[:, : self.degree]
        self.edges[nodes[room]] = packed[room]
        if not room.all():
            self.edges[nodes[~room]] = self._prune(nodes[~room], both[~room])


def usable(vector: str) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _search_shards(k: int, beam: int):
    """Rows sorted by shard, nodes before queries, to each query's `k` nearest ids of the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        vectors: list[np.ndarray] = []
        members: list[list[int]] = []
        built: tuple | None = None

        def answer(part: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal built
            if built is None:
                whole = np.concatenate(vectors)
                # Divided by the largest component first, so that no square overflows.
                scaled = whole / np.abs(whole).max(1, keepdims=True)
                unit = (scaled / np.linalg.norm(scaled, axis=1)[:, None]).astype(np.float32)
                built = whole, PrunedGraph(unit)
            whole, graph = built
            asked = _matrix(part.column("vector"))
            scaled = asked / np.abs(asked).max(1, keepdims=True)
            unit = (scaled / np.linalg.norm(scaled, axis=1)[:, None]).astype(np.float32)
            nodes = np.concatenate([graph.search(unit[i : i + BATCH], beam)[0] for i in range(0, len(unit), BATCH)])
            # One more than asked for, as the query's own vector is a node too.
            nodes = nodes[:, : max(4 * k, k + 1)]
            found = whole[nodes]
            scores = np.einsum("bd,bnd->bn", asked, found) / (
                np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(found, axis=2)
            )
            rows = []
            own = zip(part.column("id").to_pylist(), part.column("query").to_pylist(), strict=True)
            for at, (ident, query) in enumerate(own):
                near = sorted(
                    (-s, m) for s, n in zip(scores[at].tolist(), nodes[at].tolist(), strict=True) if n >= 0 for m in members[n] if m != ident
                )
                rows += [(ident, query, m, -s) for s, m in near[:k]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["query_id", "query", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column("dim").to_numpy(), batch.column("shard").to_numpy(), batch.column("asks").to_numpy()])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part, (dim, number, asks) = batch.slice(a, b - a), keys[:, a].tolist()
                if (dim, number) != shard:
                    shard, vectors, members, built = (dim, number), [], [], None
                if not asks:
                    vectors.append(_matrix(part.column("vector")))
                    members += part.column("members").to_pylist()
                elif vectors:
                    yield answer(part)

    return run


def nearest(
    rows: DataFrame, queries: Column, k: int, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD, beam: int = BEAM
) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id` and `score`: the `k` rows of largest cosine found for each row that `queries` picks."""
    valid = rows.where(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asks")
    )
    valid = valid.dropDuplicates(["id", "vector"])
    same = Window.partitionBy("vector").orderBy("id")
    # The rank filter is applied before rows move, so copies of one vector do not meet in one task.
    kept = valid.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
    nodes = kept.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("members"))
    nodes = materialize(nodes.select("vector", "members", F.size("vector").alias("dim"), F.xxhash64("vector").alias("hash")))
    # One row per vector length.
    shards = {r.dim: -(-r.n // shard_rows) for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shards:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = F.create_map(*[F.lit(int(v)) for pair in shards.items() for v in pair])
    index = nodes.select(
        "dim", F.pmod("hash", count[F.col("dim")].cast("long")).cast("int").alias("shard"), F.lit(0).alias("asks"), "members", "vector",
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("query"),
    )
    asked = valid.where("asks").withColumn("dim", F.size("vector"))
    asked = asked.select(
        "dim", F.explode(F.sequence(F.lit(0), count[F.col("dim")] - 1)).alias("shard"), F.lit(1).alias("asks"),
        F.lit(None).cast("array<long>").alias("members"), "vector", "id", F.xxhash64("vector").alias("query"),
    )
    # By ranges, shards spread evenly over as many tasks; by hash, several would meet in one.
    dealt = index.unionByName(asked).repartitionByRange(sum(shards.values()), "dim", "shard")
    dealt = dealt.sortWithinPartitions("dim", "shard", "asks")
    found = dealt.mapInArrow(_search_shards(k, beam), "query_id long, query long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
