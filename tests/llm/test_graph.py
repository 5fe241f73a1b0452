import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import pruned_graph as pg
from tickloom.llm.queries import op9_pruned_graph

from .conftest import DATA


def brute(rows, k, pick):
    """Query id to its (id, score), nearest first."""
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    fine = list({(i, tuple(v)): (i, v) for i, v in fine}.values())
    found = {}
    for q, x in fine:
        if pick(q):
            near = sorted((-(x @ v) / (np.linalg.norm(x) * np.linalg.norm(v)), i) for i, v in fine if i != q and len(v) == len(x))
            found[q] = [(i, -s) for s, i in near[:k]]
    return found


def as_lists(frame):
    found = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(found.setdefault(r.query_id, [])) + 1
        found[r.query_id].append((r.vec_id, r.score))
    return found


def test_odd_vectors_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)] + [(200, rows[1][1]), (200, rows[1][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [math.nan] * 8), (304, [1.0, None] * 4), (305, [math.inf] * 8), (None, [1.0] * 8)]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 4.0]), (402, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, shard string")
    found = as_lists(pg.nearest(frame, F.col("vec_id") % 2 == 0, 5, shard_rows=16))
    want = brute(rows, 5, lambda i: i % 2 == 0)
    assert found.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in found[q]] == [i for i, _ in near], q
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in near], abs=1e-12)
    assert pg.nearest(frame.limit(0), F.lit(True), 5).count() == 0


def test_recall_of_one_graph():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(3000, 48)).astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    graph = pg.PrunedGraph(unit)
    found, _ = graph.search(unit[:300], pg.BEAM)
    want = np.argsort(-(unit[:300] @ unit.T), 1)[:, :6]
    assert np.mean([len(set(a) & set(b[:6].tolist())) / 6 for a, b in zip(want.tolist(), found, strict=True)]) > 0.9
    assert ((graph.edges >= 0).sum(1) > 0).all()


def test_query_recall(spark):
    sf_dir = DATA.replace("0.001", "0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, 5, lambda i: i % 50 == 0)
    found = as_lists(op9_pruned_graph(spark, sf_dir))
    assert found.keys() == want.keys()
    hits = [len({i for i, _ in found[q]} & {i for i, _ in near}) for q, near in want.items()]
    assert sum(hits) >= 0.9 * sum(map(len, want.values()))
    exact = {i: np.array(v, float) for i, v in rows}
    for q, near in found.items():
        for i, score in near:
            a, b = exact[q], exact[i]
            assert score == pytest.approx(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)), abs=1e-14)
