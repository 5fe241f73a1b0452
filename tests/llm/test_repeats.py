import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tickloom.llm import repeat_tree as rt
from tickloom.llm.queries import op13_repeat_tree

LAST = 2**63 - 1


def brute(rows, size=50):
    """(key, bytes, removed spans, kept) by a table of all windows."""
    rows = [(k, (t or "").encode()) for k, t in rows]
    first = {}
    for key, raw in rows:
        rank = LAST if key is None else key
        for i in range(len(raw) - size + 1):
            window = raw[i : i + size]
            first[window] = min(first.get(window, LAST), rank)
    out = []
    for key, raw in rows:
        covered = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            if first[raw[i : i + size]] < (LAST if key is None else key):
                covered[i : i + size] = b"\1" * size
        spans, at = [], 0
        while (begin := covered.find(1, at)) >= 0:
            at = covered.find(0, begin)
            at = len(raw) if at < 0 else at
            spans.append((begin, at))
        out.append((key, len(raw), spans, bytes(b for b, c in zip(raw, covered, strict=True) if not c)))
    return out


def ran(df, **more):
    return [(r[0], r[1], [tuple(s) for s in r[2]], bytes(r[3])) for r in rt.remove_repeats(df, **more).collect()]


def same(found, expected):
    assert sorted(found, key=str) == sorted(expected, key=str)


def mixed_rows(seed, count=60):
    """Documents that share passages of many lengths, whole copies, runs of one character and short texts."""
    rng = random.Random(seed)
    shared = [prose(1000 + i, 40)[: rng.choice([40, 49, 50, 51, 63, 120, 200])] for i in range(12)]
    rows = []
    for i in range(count):
        parts = [prose(seed * 100 + i, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            parts += [rng.choice(shared), rng.choice(["", " ", "\n"]), prose(rng.randint(0, 10**6), rng.randint(0, 12))]
        if i % 9 == 0:
            parts.append("a" * rng.randint(0, 300))
        if i % 11 == 0:
            parts.append("abcab" * rng.randint(5, 60))
        rows.append((rng.randint(0, 10**6), "".join(parts)))
    return rows + [(rng.randint(0, 10**6), rows[j][1]) for j in (3, 3, 17, 25)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_by_a_table_of_windows(spark, seed):
    rows = mixed_rows(seed)
    same(ran(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), brute(rows))


def test_small_blocks_buckets_and_turns(spark, monkeypatch):
    rows = mixed_rows(4)
    for name, value in (("BLOCK_BYTES", 500), ("BUCKET_BYTES", 700), ("SORTED", 60), ("CHUNK", 333), ("WINDOWS", 5)):
        monkeypatch.setattr(rt, name, value)
    same(ran(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)), brute(rows))


def test_split_hot_hashes_give_the_same(spark, monkeypatch):
    rows = mixed_rows(5)
    monkeypatch.setattr(rt, "HOT", 3)
    monkeypatch.setattr(rt, "BLOCK_BYTES", 3000)
    same(ran(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)), brute(rows))


def test_other_sizes(spark):
    rows = mixed_rows(6, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (17, 64, 301):
        same(ran(df, size=size), brute(rows, size))
    with pytest.raises(ValueError):
        rt.remove_repeats(df, size=16)


def test_nulls_empty_repeats_and_clashing_columns(spark):
    passage = prose(7, 30)
    rows = [
        (None, passage), (None, None), (1, None), (2, ""), (3, "x" + passage), (3, passage + "é漢" * 40), (3, "x" + passage),
        (-5, "é漢" * 30), (9, passage[:49]), (10, passage[:50]), (11, "z" * 1000), (12, "z" * 49),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("k"), "block": F.lit(1), "kept": F.lit(2)})
    same(ran(df), brute(rows))


def test_empty_table_and_only_empty_texts(spark):
    assert ran(spark.createDataFrame([], "doc_id long, text string")) == []
    same(ran(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")), [(1, 0, [], b""), (2, 0, [], b"")])


def test_long_text(spark):
    long = prose(8, 120_000)
    rows = [(5, long), (6, prose(9, 30) + long[300_000:300_700] + prose(10, 30)), (4, long[-100:])]
    found = {r[0]: r for r in ran(spark.createDataFrame(rows, "doc_id long, text string"))}
    same([found[4], found[6]], [r for r in brute([rows[0], rows[1], rows[2]]) if r[0] in (4, 6)])
    assert found[5][2][-1][1] == len(long) and found[5][1] - len(found[5][3]) >= 100


def all_maximal(strings, least):
    """(substring, its places) that occur twice or more and that no byte before all of them extends; ends are open."""
    places = defaultdict(set)
    for s, text in enumerate(strings):
        for i in range(len(text)):
            for j in range(i + least, len(text) + 1):
                places[text[i:j]].add((s, i))
    out = set()
    for sub, where in places.items():
        # A prefix that every longer one shares is not maximal: what follows must differ, or a string must end.
        after = {strings[s][i + len(sub) : i + len(sub) + 1] for s, i in where}
        before = {strings[s][i - 1 : i] if i else b"" for s, i in where}
        if len(where) > 1 and (len(after) > 1 or after == {b""}) and (len(before) > 1 or before == {b""}):
            out.add((sub, frozenset(where)))
    return out


@pytest.mark.parametrize("seed", range(12))
def test_groups_are_all_maximal_repeats(seed):
    rng = random.Random(seed)
    strings = sorted({bytes(rng.choice(b"ab\0") for _ in range(rng.randint(4, 40))) for _ in range(rng.randint(1, 12))})
    sizes = np.array([len(s) for s in strings])
    low = np.array([rng.randint(0, 99) for _ in strings])
    raw = np.frombuffer(b"".join(strings), np.uint8)
    starts = np.cumsum(sizes) - sizes
    none = np.zeros(len(strings), bool)
    string, offset, length, least, group = rt.interval_groups(raw, starts, sizes, low, none, 4)
    found = defaultdict(set)
    for s, o, n, k, g in zip(string.tolist(), offset.tolist(), length.tolist(), least.tolist(), group.tolist(), strict=True):
        found[g].add((strings[s][o : o + n], s, o, k))
    for members in found.values():
        assert len({m[0] for m in members}) == len({m[3] for m in members}) == 1
        assert next(iter(members))[3] == min(low[m[1]] for m in members)
    got = {(next(iter(m))[0], frozenset((s, o) for _, s, o, _ in m)) for m in found.values()}
    assert got == all_maximal(strings, 4)


def test_suffixes_are_in_order():
    rng = random.Random(3)
    raw = bytes(rng.choice(b"\0ab\xff") for _ in range(3000))
    at = np.array([rng.randint(0, 2800) for _ in range(600)])
    sizes = np.array([rng.randint(10, 130) for _ in range(600)])
    order, shared = rt.sorted_suffixes(np.frombuffer(raw, np.uint8), at, sizes, 10)
    cut = [raw[at[i] : at[i] + sizes[i]] for i in order]
    assert cut == sorted(cut)
    for i in range(1, len(cut)):
        n = next((k for k, (x, y) in enumerate(zip(cut[i - 1], cut[i], strict=False)) if x != y), min(len(cut[i - 1]), len(cut[i])))
        assert shared[i] == (n if n >= 10 else 0)


def test_listed_groups_hold_equal_bytes_and_cover_what_is_removed(spark):
    rows = [(i, t) for i, (_, t) in enumerate(mixed_rows(7))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {k: t.encode() for k, t in rows}
    groups = defaultdict(set)
    for r in rt.repeat_groups(df).collect():
        groups[r.group].add((r.doc_id, r.start, texts[r.doc_id][r.start : r.start + r.length]))
    covered = {k: bytearray(len(t)) for k, t in texts.items()}
    for members in groups.values():
        assert len({m[2] for m in members}) == 1 and len(next(iter(members))[2]) >= 50
        # All occurrences of a group are in it.
        raw = next(iter(members))[2]
        for key, at, _ in members:
            if key > min(m[0] for m in members):
                covered[key][at : at + len(raw)] = b"\1" * len(raw)
    for key, _, spans, _ in brute(rows):
        expected = bytearray(len(texts[key]))
        for a, b in spans:
            expected[a:b] = b"\1" * (b - a)
        assert covered[key] == expected


def test_the_whole_table(spark, sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    found = [tuple(r) for r in op13_repeat_tree(spark, "/root/testdata/sf0.001").collect()]
    expected = [(k, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for k, n, spans, kept in brute(rows)]
    assert sorted(found) == sorted(expected)
    assert sum(r[2] for r in found) > 1000
