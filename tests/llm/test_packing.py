import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import tier_packing as tp
from tickloom.llm.queries import BYTE_TOKENIZER, op6_tier_packing

from .conftest import DATA, prose


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(BYTE_TOKENIZER)
    return made


def test_ids_are_those_of_the_library(library):
    rng = random.Random(3)
    texts = ["", " ", "\n\n a", "it's we'll 'tis ''s", "<|endoftext|> x", prose(1), "a" * 3000, " " * 300 + "x"]
    texts += ["".join(rng.choice(" \n\t\r'sabé1٣日😀.,\xa0\x85\x1c ²½ªĳ_-×") for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    texts += [" " * 399 + "x", " " * 401 + "x", "\n" * 2000]
    made = tp.load_ids(BYTE_TOKENIZER)
    assert made.fast is not None
    found = made.encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_in_a_text_are_those_of_the_plain_call(spark):
    plain = Tokenizer.from_file(BYTE_TOKENIZER)
    texts = {1: "a<|endoftext|> x", 2: "<|endoftext|>", 3: f"{prose(2)}<|endoftext|>{prose(3)}", 4: "<|endof", 5: prose(4), 6: "é日<|endoftext|>"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = tp.pack_documents(frame, BYTE_TOKENIZER).collect()
    for doc, text in texts.items():
        own = b"".join(r.ids for r in sorted((r for r in pieces if r.doc_id == doc), key=lambda r: r.start))
        assert np.frombuffer(own, "<u4").tolist() == [*plain.encode(text, add_special_tokens=False).ids, tp.END_ID]


@pytest.mark.parametrize("seed", range(30))
def test_windows_are_full_and_hold_every_id_once(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, rng.choice([3, 200, 1500, 9000])) for _ in range(rng.randint(0, 150))]
    windows = tp.pack_block(sizes)
    seen = [np.zeros(s, int) for s in sizes]
    for size, pieces in windows:
        assert size & size - 1 == 0 and size <= 1024
        assert sum(length for *_, length in pieces) == size
        for doc, start, length in pieces:
            seen[doc][start : start + length] += 1
    assert all((s == 1).all() for s in seen)
    groups = tp.step_groups(windows, 8)
    counts = np.bincount(groups) if groups else np.zeros(1, int)
    assert counts.max() - counts.min() <= 1


def test_short_documents_go_to_short_tiers():
    windows = tp.pack_block([100] * 64 + [300] * 8)
    assert {size for size, _ in windows} <= {512, 128, 64, 32, 16, 8, 4, 2, 1}
    assert any(size == 512 for size, _ in windows)


def check_rows(rows, texts, library):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            own = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(own)
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == pieces[0].tier


def test_query_round_trip(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    check_rows(op6_tier_packing(spark, DATA).collect(), texts, library)


def test_rows_with_nulls_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, "x " * 3000), (None, "y"), (2, "")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, tier string")
    found = tp.pack_documents(frame, public_tokenizers.path("byte_bpe_50k.json"), block=2).collect()
    assert sum(r.length for r in found if r.doc_id in (1, 2)) == 3
    assert sum(r.length for r in found if r.doc_id is None) == 2
    assert all(r.length * 4 == len(r.ids) for r in found)
    assert tp.pack_documents(frame.limit(0), BYTE_TOKENIZER).count() == 0
    with pytest.raises(ValueError, match="powers of two"):
        tp.pack_documents(frame, BYTE_TOKENIZER, tiers=(1000, 10))


def test_blocks_are_bounded_by_ids(spark):
    """Blocks closed by their ids, however long the texts, hold every id once in gapless sequences."""
    texts = {i: prose(i, 40 + 900 * (i % 5 == 0)) for i in range(40)} | {90: None, 91: ""}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    plain = Tokenizer.from_file(BYTE_TOKENIZER)
    for bound in (1, 3000, tp.BLOCK_IDS):
        pieces = tp.pack_documents(frame, BYTE_TOKENIZER, block_ids=bound).collect()
        sequences = {}
        for r in pieces:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
        for rows in sequences.values():
            rows.sort()
            assert [o for o, *_ in rows] == [sum(n for _, n, _ in rows[:i]) for i in range(len(rows))]
            assert sum(n for _, n, _ in rows) == rows[0][2]
        for doc, text in texts.items():
            own = sorted((r.start, r.ids) for r in pieces if r.doc_id == doc)
            assert np.frombuffer(b"".join(ids for _, ids in own), "<u4").tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, tp.END_ID]
