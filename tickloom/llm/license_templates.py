"""License notices in whole texts: phrases, and marked-up templates compiled to automata over words.

A template is wording with two kinds of markup: `<<beginOptional>> ... <<endOptional>>` may be absent, also
nested, and `<<var;max=N>>` stands for any N words or fewer. Everything else is mandatory. A template accepts a
passage anywhere in a text if the mandatory wording matches word by word.

Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. Null or empty texts have no
words, no places and a score of 0. Equal texts have equal results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.common import byte_texts, map_text

# Phrases and labels of the plain search.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TEMPLATES = {
    "mit-notice": "<<beginOptional>>released<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> MIT license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "<<var;max=120>> the software is provided as is without warranty of any kind",
    "apache-2.0": "licensed under the Apache license <<beginOptional>>version<<endOptional>> 2 0"
    "<<beginOptional>> the license <<endOptional>>",
    "cc-by-nc-4.0": "licensed under <<beginOptional>>a <<beginOptional>>creative commons<<endOptional>> <<endOptional>>"
    "CC BY NC 4 0 <<beginOptional>>international license<<endOptional>>",
    "gpl-3.0": "GNU general public license <<beginOptional>>as published by <<var;max=6>><<endOptional>> "
    "<<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>of the license<<endOptional>>",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met",
    "copyright-notice": "copyright <<beginOptional>>c<<endOptional>> <<var;max=12>> all rights reserved",
}

_KEPT = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if _KEPT.match(bytes([c])) else 32 for c in range(256))
_MARKUP = re.compile(r"<<(.*?)>>", re.S)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Automaton:
    """States count words read; `steps[s][word]` and `any_step[s]` lead on, `skips[s]` cost no word."""

    label: str
    steps: list[dict[bytes, int]] = field(default_factory=list)
    any_step: list[int | None] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    needed: set[bytes] = field(default_factory=set)
    closures: list[tuple[int, ...]] = field(default_factory=list)
    final: int = 0

    def state(self) -> int:
        self.steps.append({})
        self.any_step.append(None)
        self.skips.append([])
        return len(self.steps) - 1


def compile_template(label: str, template: str) -> Automaton:
    made = Automaton(label)
    at = made.state()
    opened: list[int] = []
    for place, part in enumerate(_MARKUP.split(template)):
        if place % 2 == 0:
            for word in words_of(part.encode()):
                new = made.state()
                made.steps[at][word] = new
                at = new
                if not opened:
                    made.needed.add(word)
        elif part == "beginOptional":
            # A state of its own, so that the way around starts nowhere else.
            new = made.state()
            made.skips[at].append(new)
            opened.append(new)
            at = new
        elif part == "endOptional":
            if not opened:
                raise ValueError(f"{label}: endOptional without beginOptional")
            new = made.state()
            made.skips[at].append(new)
            made.skips[opened.pop()].append(new)
            at = new
        elif found := re.fullmatch(r"var;max=([0-9]+)", part):
            gap = [at, *(made.state() for _ in range(int(found[1])))]
            after = made.state()
            for one, two in zip(gap, gap[1:], strict=False):
                made.any_step[one] = two
            for one in gap:
                made.skips[one].append(after)
            at = after
        else:
            raise ValueError(f"{label}: unknown markup {part!r}")
    if opened:
        raise ValueError(f"{label}: beginOptional without endOptional")
    if not made.needed:
        raise ValueError(f"{label}: no mandatory wording")
    made.final = at
    for state in range(len(made.steps)):
        seen, todo = {state}, [state]
        while todo:
            for new in made.skips[todo.pop()]:
                if new not in seen:
                    seen.add(new)
                    todo.append(new)
        made.closures.append(tuple(sorted(seen)))
    return made


def passages(made: Automaton, words: list[bytes]) -> list[tuple[int, int]]:
    """Word ranges [first, end) that the template accepts, leftmost and longest, not overlapping.

    Each active state remembers the earliest word at which its passage may have begun.
    """
    start = made.closures[0]
    first_words = {w for s in start for w in made.steps[s]}
    wild = any(made.any_step[s] is not None for s in start)
    ends: dict[int, int] = {}
    active: dict[int, int] = {}
    for place, word in enumerate(words):
        if wild or word in first_words:
            for s in start:
                active.setdefault(s, place)
        elif not active:
            continue
        moved: dict[int, int] = {}
        for s, begun in active.items():
            for new in (made.steps[s].get(word), made.any_step[s]):
                if new is not None:
                    for reach in made.closures[new]:
                        if begun < moved.get(reach, place + 1):
                            moved[reach] = begun
        active = moved
        if made.final in active:
            ends[active[made.final]] = place + 1
    found, done = [], 0
    for begun in sorted(ends):
        if begun >= done:
            found.append((begun, ends[begun]))
            done = ends[begun]
    return found


class LicenseScanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]) -> None:
        self.automata = [compile_template(k, v) for k, v in templates.items()]
        self.phrases = [(f" {p} ".encode(), label, len(p.split())) for p, label in phrases.items()]
        self.rarest = [sorted((b" " + w + b" " for w in a.needed), key=len, reverse=True) for a in self.automata]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Number of words; places of phrases and of templates as (first word, end, label)."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base, own = [], []
        for phrase, label, size in self.phrases:
            at = joined.find(phrase)
            place, counted = 0, 0
            while at >= 0:
                place += joined.count(b" ", counted, at)
                counted = at
                base.append((place, place + size, label))
                at = joined.find(phrase, at + 1)
        for made, needed in zip(self.automata, self.rarest, strict=True):
            if all(w in joined for w in needed):
                own += [(a, b, made.label) for a, b in passages(made, words)]
        return len(words), base, own


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Kept columns, `n_words`, `places` (first word, end, label, by_phrase; by place) and `score`.

    The score is the share of words inside any place.
    """
    place = T.StructType(
        [
            T.StructField("first_word", T.LongType(), False),
            T.StructField("end_word", T.LongType(), False),
            T.StructField("label", T.StringType(), False),
            T.StructField("by_phrase", T.BooleanType(), False),
        ]
    )
    fields = [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("places", T.ArrayType(place, False), False),
        T.StructField("score", T.DoubleType(), False),
    ]
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases

    def make():
        scanner = LicenseScanner(templates, phrases)

        def work(column: pa.Array) -> list[pa.Array]:
            counts, rows, scores = [], [], []
            for raw in byte_texts(column):
                n, base, own = scanner.scan(raw)
                spots = sorted([(*b, True) for b in base] + [(*o, False) for o in own])
                covered = done = 0
                for a, b, *_ in spots:
                    covered += max(0, b - max(a, done))
                    done = max(done, b)
                counts.append(n)
                rows.append(spots)
                scores.append(covered / n if n else 0.0)
            flat = [s for own in rows for s in own]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            struct = pa.StructArray.from_arrays(
                [pa.array([s[i] for s in flat], k) for i, k in enumerate(kinds)],
                fields=[pa.field(f.name, k, False) for f, k in zip(place.fields, kinds, strict=True)],
            )
            offsets = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
            return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, struct), pa.array(scores, pa.float64())]

        return work

    return map_text(docs, text, keep or ["doc_id"], fields, make)
