import re

import pytest

from tickloom.llm import license_templates as lt
from tickloom.llm.queries import op10_license_templates

from .conftest import DATA, prose


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def places(text):
    own, found = words(text), []
    for phrase, label in lt.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(own)) if own[i : i + len(p)] == p]
    return found


def as_pattern(template):
    """The template as a regular expression over words with one space behind each."""
    made = ""
    for at, part in enumerate(re.split(r"<<(.*?)>>", template)):
        if at % 2 == 0:
            made += "".join(re.escape(w) + " " for w in words(part))
        else:
            made += {"b": "(?:", "e": ")?"}.get(part[0]) or r"(?:\S+ ){0,%s}" % part.rpartition("=")[2]
    return re.compile(r"(?:^|(?<= ))" + made)


CASES = [
    "", "CC BY", "cc by cc by", "ccby cc-by CC.BY", "all rights reserved", "General PUBLIC license version 3",
    "Released under the MIT License.", "under the terms of the MIT license", "under the MIT-like license",
    "Licensed under the Apache License, Version 2.0.", "licensed under the apache license 2.0 the license", "licensed under the apache license 3.0",
    "Licensed under CC BY-NC 4.0.", "licensed under a Creative Commons CC BY NC 4.0 international license", "licensed under a CC BY NC 4.0",
    "licensed under creative commons cc by nc 4 0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "GNU General Public License, version 2", "GNU general public license as published by a b c d e f g version 3",
    "copyright (c) 2020 Some One, all rights reserved", "copyright " + "x " * 13 + "all rights reserved", "copyright all rights reserved",
    "éCC BY", "cc\x00by", "permission is hereby granted free of charge to any person obtaining a copy of this software and more words "
    "the software is provided as is without warranty of any kind",
]


def test_scanner_against_regular_expressions():
    scanner = lt.LicenseScanner(lt.TEMPLATES, lt.PHRASES)
    patterns = {k: as_pattern(t) for k, t in lt.TEMPLATES.items()}
    for text in [*CASES, " ".join(CASES), prose(1) + " Released under the MIT License. " + prose(2)]:
        n, base, own = scanner.scan(text.encode())
        assert n == len(words(text))
        assert sorted((a, label) for a, _, label in base) == sorted(places(text)), text
        joined = "".join(w + " " for w in words(text))
        want = {k for k, p in patterns.items() if p.search(joined)}
        assert {label for *_, label in own} == want, text


def test_passages_are_leftmost_and_longest():
    made = lt.compile_template("t", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> <<endOptional>>d <<var;max=2>> e")
    run = lambda text: lt.passages(made, lt.words_of(text.encode()))
    assert run("x a d e y a b c d z z e") == [(1, 4), (5, 12)]
    assert run("a c d e") == []
    assert run("a d z z z e") == []
    assert run("a d e e e") == [(0, 5)]
    for bad in ("<<endOptional>> a", "<<beginOptional>> a", "<<what>> a", "<<var;max=3>>"):
        with pytest.raises(ValueError):
            lt.compile_template("bad", bad)


def test_long_texts_take_linear_time():
    scanner = lt.LicenseScanner(lt.TEMPLATES, lt.PHRASES)
    scanner.scan(("copyright " * 100_000 + "all rights reserved").encode())
    scanner.scan(b"cc by " * 100_000)


def test_rows_nulls_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, "CC BY x"), (3, "CC BY x"), (None, "under the MIT license")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, score string")
    found = lt.scan_licenses(frame).collect()
    assert sorted((r.doc_id or 0, r.n_words, round(r.score, 3)) for r in found) == [(0, 4, 1.0), (1, 0, 0.0), (2, 0, 0.0), (3, 3, 0.667), (3, 3, 0.667)]
    assert lt.scan_licenses(frame.limit(0)).count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    patterns = {k: as_pattern(t) for k, t in lt.TEMPLATES.items()}
    found = op10_license_templates(spark, DATA).collect()
    assert len(found) == len(texts)
    for r in found:
        spots = places(texts[r.doc_id])
        own = words(texts[r.doc_id])
        starts = [a for a, _ in spots]
        assert (r.n_words, r.n_base) == (len(own), len(spots))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        base = {label for _, label in spots}
        assert r.base_labels == ",".join(sorted(base))
        joined = "".join(w + " " for w in own)
        assert r.labels == ",".join(sorted(base | {k for k, p in patterns.items() if p.search(joined)}))
        assert 0 <= r.score <= 1
