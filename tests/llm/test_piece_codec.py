import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_pb2

from tickloom.llm.piece_codec import MARK, Normalizer, _fields, decode_pieces, encode_pieces, load_codec
from tickloom.llm.queries import op1_piece_codec

from .conftest import DATA

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(count=600):
    rng = random.Random(4)
    made = ["", " ", "  ", "\n", MARK, f"{MARK} {MARK}", f" {MARK}a", "<s>", "<0x0A>", "a\x00b", "é" * 4, "x" * 4000]
    return made + ["".join(rng.choice(f" {MARK}aé日😀\n\x00x<>/0") for _ in range(rng.randint(0, 25))) for _ in range(count)]


def test_ids_and_spans_are_those_of_the_library(library):
    texts = odd_texts()
    ids, ends, counts = load_codec(MODEL).encode_many(texts)
    stops = np.cumsum(counts)
    for text, a, b in zip(texts, stops - counts, stops, strict=True):
        want = sentencepiece_pb2.SentencePieceText()
        want.ParseFromString(library.encode(text, out_type="serialized_proto"))
        assert ids[a:b].tolist() == [p.id for p in want.pieces], text
        assert ends[a:b].tolist() == [p.end for p in want.pieces], text


def test_decoding_is_that_of_the_library(library):
    rng = random.Random(5)
    runs = [[rng.randrange(0, 259) if rng.random() < 0.6 else rng.randrange(32000) for _ in range(9)] for _ in range(800)]
    runs += [[], [2], [0], [198], [172, 198], [1, 2]]
    codec = load_codec(MODEL)
    want = [library.decode(r) for r in runs]
    assert [codec.decode(r) for r in runs] == want
    flat = np.array([i for r in runs for i in r], np.int32)
    assert codec.decode_many(flat, np.cumsum([0, *map(len, runs)])).to_pylist() == want


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("collapse", [True, False])
def test_normalisation_follows_the_compiled_map(rule, collapse):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=collapse, escape_whitespaces=True
    )
    own = Normalizer(dict(_fields(library.serialized_model_proto()))[3])
    for text in [*odd_texts(200), "ﬁ ① ㍿ Å", "  a   b  ", "㌔ x"]:
        made, source = own(text.encode())
        assert made.decode() == library.normalize(text), text
        assert len(source) == len(made) + 1
        assert (np.diff(source) >= 0).all()


def test_round_trip_with_nulls_repeats_and_other_columns(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Two  words\n", "y"), (3, "Two  words\n", "y"), (None, "日本", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = decode_pieces(encode_pieces(frame, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in found) == sorted((r[0] or 0, r[1] or "") for r in rows)
    spans = {r.doc_id: (r.ids, r.begins, r.ends) for r in encode_pieces(frame, MODEL).collect()}
    assert spans[1] == ([2], [0], [0])
    assert spans[None][2][-1] == len("日本".encode())
    with pytest.raises(ValueError, match="clash"):
        encode_pieces(frame, MODEL, keep=["ids"])
    assert encode_pieces(frame.limit(0), MODEL).count() == 0


def test_query_digests(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = op1_piece_codec(spark, DATA).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = [*library.encode(texts[r.doc_id]), library.eos_id()]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r.covered_bytes == len(texts[r.doc_id].encode())
