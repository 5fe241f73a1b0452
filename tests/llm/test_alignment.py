import hashlib
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import token_alignment as ta
from tickloom.llm.queries import BYTE_TOKENIZER, PIECE_MODEL

MARK = "▁"


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    # The byte-level alphabet: printable bytes for themselves, the others moved up in order.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in own}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in own)}
    return a, b, letters


def tokens(tools, text):
    """(id, bytes) of both sides, or nothing."""
    a, b, letters = tools
    if not text:
        return [], []
    own = (" " + text).encode()
    side_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    side_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        side_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace(MARK, " ").encode()))
    if any(b"".join(x for _, x in side) != own for side in (side_a, side_b)):
        return [], []
    return side_a, side_b


def spans(side):
    out, at = [], 0
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(tools, rows):
    parts, held = [], Counter()
    for key, text in rows:
        a, b = map(spans, tokens(tools, text))
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [
            ",".join(str(i) for i, _, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, _, e in b if lo < e <= hi)
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        held.update(set(links))
        parts.append((key, len(a), len(b), groups, links))
    best = Counter()
    for (i, _), count in held.items():
        best[i] = max(best[i], count)
    return [
        (
            key, a, b, len(groups), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for key, a, b, groups, links in parts
    ]


def ran(df):
    return sorted((tuple(r) for r in ta.align_tokenizers(df, BYTE_TOKENIZER, PIECE_MODEL).collect()), key=str)


ODD = [
    (1, None), (2, ""), (3, "plain words here"), (3, "plain words here"), (None, "no key"), (4, " leading  and   runs "),
    (5, "a<|endoftext|> b </s> <s> <unk>"), (6, f"mark {MARK} inside"), (7, "tab\tline\n\nnul\x00 \U0001f600 漢字 éé"),
    (8, "ﬁ Ω ½ full　width"), (9, "xxxxxxxxxxxxxxxxxxxx xxxxx x 1234567 !!!???"), (10, "\r\n ​﻿"),
    (11, "Zusammengehörigkeitsgefühl prêt-à-porter mañana"),
]


def test_odd_texts(spark, docs, tools):
    df = docs(ODD).withColumns({"pairs": F.lit(1), "block": F.lit("b"), "_text": F.lit("t")})
    assert ran(df) == sorted(brute(tools, ODD), key=str)


def test_blocks_do_not_matter(spark, docs, tools, monkeypatch):
    rows = [(i, text) for i, (_, text) in enumerate(ODD * 3)]
    expected = sorted(brute(tools, rows), key=str)
    monkeypatch.setattr(ta, "BLOCK_BYTES", 20)
    assert ran(docs(rows).repartition(5)) == expected


def test_empty_table(docs):
    assert ran(docs([])) == []


def test_long_text(docs, tools):
    text = "word and more, " * 60_000
    (row,) = ran(docs([(1, text)]))
    a, b = tokens(tools, text)
    assert row[1:3] == (len(a), len(b)) and row[5] == row[6] == row[4]


def test_given_documents(spark, sample, tools):
    rows = [tuple(r) for r in sample.select("doc_id", "text").where(F.length("text") < 3000).collect()]
    assert len(rows) > 100
    found = ran(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == sorted(brute(tools, rows), key=str)


def test_identity_map_has_equal_bytes():
    aligner = ta.load_aligner(BYTE_TOKENIZER, PIECE_MODEL)
    known = [(i, j) for i, j in enumerate(aligner.identity.tolist()) if j >= 0]
    assert len(known) > 10_000
    for i, j in known[::500]:
        cut = [pool.raw[pool.starts[at] : pool.starts[at] + pool.sizes[at]].tobytes() for pool, at in ((aligner.a, i), (aligner.b, j))]
        assert cut[0] == cut[1]
