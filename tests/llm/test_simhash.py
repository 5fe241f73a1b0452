import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash_links as sh
from tickloom.llm.queries import op5_simhash_links

from .conftest import DATA, prose


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most):
    """Smallest index reachable over near pairs, for each."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def clusters(seed, groups=25, most=25):
    """Fingerprints that walk away from a few starts by up to four bits at a time."""
    rng = random.Random(seed)
    made = set()
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, most)):
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            made.add(value)
    return sorted(made)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints():
    for text in ["", " \t\n", "A", "a b c", "a b c d", "É é A\x85b c d e", prose(1), prose(2, 3000), "x " * 500]:
        assert sh.fingerprint(text.encode()) == plain_print(text), text


def test_embedding_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, (2, 4000), dtype=np.uint64)
    counts = [[bin(int(x) >> 2 * s & 3).count("1") for s in range(32)] for x in (a[0], b[0])]
    assert int(np.bitwise_count(sh.embedding(a)[0] ^ sh.embedding(b)[0])) == sum(abs(p - q) for p, q in zip(*counts, strict=True))
    assert (np.bitwise_count(sh.embedding(a) ^ sh.embedding(b)) <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("equal", [2, 3, 4, 6])
@pytest.mark.parametrize("most", [0, 1, 4])
def test_near_pairs_share_a_grid_cell(most, equal):
    rng = random.Random(most)
    masks = sh.grid_masks(most, equal)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), most):
            b ^= 1 << bit
        one, two = (int(sh.embedding(np.array([x], np.uint64))[0]) for x in (a, b))
        assert any(one & m == two & m for m in masks)


def test_meetings_do_not_grow_with_the_fingerprints():
    rng = np.random.default_rng(6)
    chosen = []
    for n in (50_000, 200_000, 800_000):
        prints = rng.integers(0, 2**64, n, dtype=np.uint64)
        chosen.append(sh.equal_blocks(n, 4))
        met = 0
        for mask in sh.grid_masks(4, chosen[-1]):
            size = np.unique(sh.embedding(prints) & np.uint64(mask), return_counts=True)[1].astype(np.int64)
            met += int((size * (size - 1)).sum())
        assert met / n <= 16 * sh.MOVE
    assert chosen == sorted(chosen) and chosen[0] < chosen[-1]
    assert sh.equal_blocks(0, 4) == 2
    # Neither rows to move nor comparisons run away for a thousand times as many.
    equal = sh.equal_blocks(10**9, 4)
    grids = math.comb(4 + equal, equal)
    assert equal > chosen[-1] and grids <= 250 and grids * 10**9 * sh.AGREE ** (32 * equal / (4 + equal)) < 5000
    assert len(sh.grid_masks(30, sh.equal_blocks(10**9, 30))) == 496


@pytest.mark.parametrize("tile", [5, 40])
def test_tiles_meet_once_per_pair_and_none_is_large(spark, tile):
    """Every two fingerprints of a large cell meet in one pair of tiles; a pair of tiles holds few rows."""
    cells = spark.range(300).select((F.col("id") % 2).alias("cell"), F.col("id").alias("fp"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    groups = {}
    for r in sh.tile_pairs(cells, sizes, tile).collect():
        groups.setdefault((r.cell, r.low, r.high), []).append((r.side, r.fp))
    met = {}
    for (_, low, high), rows in groups.items():
        assert len(rows) <= 5 * tile
        left, right = ([fp for side, fp in rows if side == s] for s in (0, 1))
        pairs = [(a, b) for a in left for b in left if a < b] if low == high else [(min(a, b), max(a, b)) for a in left for b in right]
        for pair in pairs:
            met[pair] = met.get(pair, 0) + 1
    assert met == {(a, b): 1 for a in range(300) for b in range(a + 2, 300, 2)}


@pytest.mark.parametrize("equal", [None, 3, 5])
@pytest.mark.parametrize("tile", [8192, 7])
def test_components_against_all_pairs(spark, tile, equal):
    prints = clusters(3)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint long")
    roots = {r.node: r.root for r in sh.components(sh.links(frame, 4, tile, equal)).collect()}
    want = plain_components(prints, 4)
    groups, own = {}, {}
    for p, w in zip(prints, want, strict=True):
        groups.setdefault(w, set()).add(signed(p))
        own.setdefault(roots.get(signed(p), signed(p)), set()).add(signed(p))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))
    assert all(min(members) == root for root, members in own.items())


def test_components_of_long_chains(spark):
    order = list(range(300))
    random.Random(2).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(0, 299) if i != 150]
    found = {r.node: r.root for r in sh.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (order[:151], order[151:]):
        assert {found[n] for n in part} == {min(part)}


def test_documents_with_nulls_copies_and_ties(spark):
    base = prose(5, 400)
    near = base.replace(" ", "  ", 3).upper()
    rows = [(7, base), (3, near), (3, near), (9, None), (4, ""), (5, " \n"), (None, base), (None, prose(8)), (11, prose(9))]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, fingerprint string")
    found = sh.link_documents(frame).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add(r.component)
    assert by_id == {7: {3}, 3: {3}, 9: {4}, 4: {4}, 5: {4}, None: {3, None}, 11: {11}}
    assert sh.link_documents(frame.limit(0)).count() == 0


def test_query_against_all_pairs(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    prints = [plain_print(t) for _, t in rows]
    want = plain_components(prints, 4)
    found = {r.doc_id: r for r in op5_simhash_links(spark, DATA).collect()}
    assert len(found) == len(rows)
    for (doc, _), value, root in zip(rows, prints, want, strict=True):
        assert found[doc].fingerprint == f"{value:016x}"
        assert found[doc].component_id == rows[root][0]
