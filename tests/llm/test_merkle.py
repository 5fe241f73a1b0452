import hashlib
import zlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOC_DDL
from tickloom.llm import merkle_manifest as mm
from tickloom.llm.queries import proofs_of

DDL = DOC_DDL


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def rise(nodes):
    """All levels from the nodes up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i : i + 2]) for i in range(0, len(row), 2)])
    return levels


def climb(levels, at, node):
    """Neighbours on the way up, and where `node` in place of the own one leads."""
    mates = []
    for row in levels[:-1]:
        run = [*row[at // 2 * 2 : at // 2 * 2 + 2]]
        mates += [x for i, x in enumerate(run) if i != at % 2]
        run[at % 2] = node
        node, at = h(*run), at // 2
    return mates, node


def brute(rows):
    """Fields in the order of the digest: doc_id, source, lang, n_chars, text."""
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    rows.sort(key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r)))
    groups = [list(g) for _, g in groupby(rows, key=lambda r: r[2])]
    trees = [rise([leaf_of(r) for r in g]) for g in groups]
    crown = rise([t[-1][0] for t in trees])
    out = []
    for at, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for i, row in enumerate(group):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            claimed = leaf_of((*row[:3], row[3] + 1, row[4])) if bad else leaf_of(row)
            low, node = climb(tree, i, claimed)
            high, top = climb(crown, at, node)
            out.append((row[0], leaf_of(row), tree[-1][0], crown[-1][0], h("".join(low + high)), top, top == crown[-1][0]))
    return out


def ran(df):
    return [tuple(r) for r in proofs_of(df).collect()]


def key(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_are_a_layout(levels):
    seen = np.concatenate([mm.veb_address(levels, d, np.arange(2**d)) for d in range(levels)])
    assert sorted(seen.tolist()) == list(range(2**levels - 1))
    # Subtrees below the cut lie together, each in one run.
    upper = levels // 2
    for s in range(2**upper if levels > 1 else 0):
        own = np.concatenate([mm.veb_address(levels, d, (s << d - upper) + np.arange(2 ** (d - upper))) for d in range(upper, levels)])
        assert own.max() - own.min() == len(own) - 1 == 2 ** (levels - upper) - 2


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13, 16])
def test_blocks_hold_the_plain_tree(count):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(count)]
    height = (count - 1).bit_length()
    nodes = mm.build_block(leaves, height)
    levels = rise([x.hex() for x in leaves])
    assert nodes[:32].hex() == levels[-1][0]
    for i, path in enumerate(mm.block_paths(nodes, count, height)):
        mates, top = climb(levels, i, leaves[i].hex())
        assert [m.hex() for m in mm.siblings(path)] == mates
        assert mm.fold(leaves[i], path).hex() == top == levels[-1][0]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_any_block_height_gives_the_plain_proofs(spark, monkeypatch, height):
    monkeypatch.setattr(mm, "BLOCK_HEIGHT", height)
    rows = [(i * 3 % 41, f"text {i} é", ["en", "de", None, "é", "z"][min(i % 9, 4)], "s", i) for i in range(41)]
    assert sorted(ran(spark.createDataFrame(rows, DDL)), key=key) == sorted(brute(rows), key=key)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (7, "", "en", None, 0), (7, "", "en", None, 0), (7, "b", "en", "x", 1),
        (3, "word " * 200_000, "de", "s", 1_000_000), (52, None, "", "s", None), (None, "t", "en", "s", 2),
    ]
    df = spark.createDataFrame(rows, DDL).withColumns({"tree": F.lit(1), "digest": F.lit("d"), "path": F.lit(b"p")})
    assert sorted(ran(df), key=key) == sorted(brute(rows), key=key)


def test_a_group_per_row_and_one_group(spark):
    rows = [(i, f"t{i}", f"l{i}", "s", i) for i in range(30)]
    assert sorted(ran(spark.createDataFrame(rows, DDL))) == sorted(brute(rows))
    rows = [(i, f"t{i}", "en", "s", i) for i in range(33)]
    assert sorted(ran(spark.createDataFrame(rows, DDL))) == sorted(brute(rows))


def test_empty_table(spark):
    assert ran(spark.createDataFrame([], DDL)) == []


def test_the_whole_table(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = ran(sample)
    assert sorted(found) == sorted(brute(rows))
    assert 0 < sum(not r[-1] for r in found) < len(rows) / 3
