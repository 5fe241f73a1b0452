"""Personal data in whole texts: plain rules, and a character BiLSTM-CRF for forms that the rules miss.

The tagger is trained on the driver from labelled spans: spans that the rules find in a bounded sample of
text pieces, and written variants (spelt-out addresses, defanged numbers, other separators) put into them, next
to numbers that are no personal data. Training stops on a score over held-out windows, and a tagger under a stated score is refused.
It reads fixed overlapping windows of the whole text, but for windows without any digit, '@', opening bracket and word "at" or "dot", in
either case: reading those too would take a hundred times longer, and nothing it has learnt to tag goes without one.
Spans of overlapping windows are reconciled over the whole text: pieces cut by a window's edge are joined, then the span
farthest from its window's edges wins. A tagged span touches no span of the rules. It is cut down to the passage in it that has one
of the known written forms; without such a passage it stands as it is if the tagger is sure of each of its tags.

Null or empty texts have no spans; equal texts have equal spans.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.char_tagger import CharTagger, classes
from tickloom.llm.common import as_text, hashed_sample, map_text
from tickloom.llm.pii_base import KINDS, address_parts, base_spans, card_number, digits

WINDOW, STRIDE = 96, 48
LENGTH = 64
# Share of held-out windows that a tagger must get right, and how sure it must be of a span without a known form.
LEAST_SCORE = 0.9
SURE = 0.98
TAGS = 1 + 2 * len(KINDS)
SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("end", T.LongType(), False),
        T.StructField("by_rule", T.BooleanType(), False),
    ]
)
# What every form below holds, or the word "dot" of a form that began a window earlier.
_TRIGGER = re.compile(r"[0-9@\[({]|(?<!\S)(?:at|dot)(?!\S)", re.IGNORECASE)


def _allowed() -> np.ndarray:
    """Tag 0 is outside, 1 + 2k opens kind k and 2 + 2k goes on; only an opened kind goes on."""
    ok = np.ones((TAGS, TAGS), bool)
    for kind in range(len(KINDS)):
        ok[:, 2 + 2 * kind] = False
        ok[[1 + 2 * kind, 2 + 2 * kind], 2 + 2 * kind] = True
    return ok


def _variant(rng: np.random.Generator, words: list[str]) -> tuple[str, int | None]:
    """A written form and its kind, or a form that is no personal data. Names are the text's own words or random letters."""

    def num(count: int) -> str:
        return "".join(str(d) for d in rng.integers(0, 10, count))

    def word() -> str:
        if words and rng.random() < 0.5:
            return words[rng.integers(len(words))]
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))

    def pick(*options: str) -> str:
        return options[rng.integers(len(options))]

    case = rng.integers(0, 13)
    if case >= 10:
        name = word() + pick("", "", ".", "_") + pick("", num(2), word())
        return f"{name} at {word()} dot {pick('com', 'org', 'net', 'example dot com', word())}", 0
    if case < 2:
        at, dot = (" [at] ", " [dot] ") if rng.random() < 0.4 else (pick(" (at) ", "(at)", "{at}", " @ ", "[at]"), pick(".", " . ", "(dot)", "[.]"))
        name = word() + pick("", ".", "_") + pick("", num(2), word())
        return name + at + word() + dot + pick("com", "org", "net", "example.com"), 0
    if case < 4:
        gap = pick("[.]", " . ", "(.)", "[.]")
        return gap.join(str(v) for v in rng.integers(1, 256, 4)), 1
    if case < 6:
        body = num(15)
        check = next(c for c in "0123456789" if card_number(body + c))
        gap = pick(".", "/", "_", " - ", "  ")
        return gap.join((body + check)[i : i + 4] for i in range(0, 16, 4)), 2
    if case < 8:
        a, b, c = num(3), num(3), num(4)
        return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{num(2)} {a} {b} {c}", f"0{a} {b} {c}"), 3
    other = (
        f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}.{num(2)}.{num(4)}", f"{num(2)}/{num(2)}/{num(4)}",
        f"{rng.integers(1, 20)}.{rng.integers(0, 20)}", f"{num(3)},{num(3)}.{num(2)}", num(rng.integers(1, 12)), num(16),
        "".join("0123456789abcdef"[d] for d in rng.integers(0, 16, 40)), f"({word()})", f"[{num(2)}]", f"{num(2)}:{num(2)}:{num(2)}",
        f"@{word()}", f"{num(1)}.{num(1)}.{num(1)}", f"{{{word()} {num(3)}}}", f"({num(4)})", f"{num(4)}-{num(4)}",
        f"{word()} at {word()} {word()}", f"{word()} dot {word()}", f"{word()} at {word()}.{pick('com', 'org')}",
    )
    return other[rng.integers(len(other))], None


# The bare words of spelt-out addresses; the tagger reads them as the signs they stand for.
_SPELT = re.compile(r"(?<!\S)(?:at|dot)(?!\S)", re.IGNORECASE)


def _points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    for word in _SPELT.finditer(text):
        points[word.start() : word.end()] = ord("@" if word[0].lower() == "at" else ".")
    return points


def labelled_windows(carriers: list[str], count: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character classes and their tags: carrier text with a written form put in, and the rules' spans."""
    rng = np.random.default_rng(seed)
    carriers = [c for c in carriers if c.strip()] or ["a text without any personal data in it at all"]
    words = sorted({w.lower() for c in carriers for w in re.findall("[A-Za-z]{2,12}", c)})
    text, gold = np.zeros((count, LENGTH), np.int64), np.zeros((count, LENGTH), np.int64)
    for row in range(count):
        carrier = carriers[rng.integers(len(carriers))]
        start = int(rng.integers(0, max(1, len(carrier) - LENGTH)))
        piece = carrier[start : start + LENGTH]
        spans = []
        if rng.random() < 0.85:
            form, kind = _variant(rng, words)
            cut = int(rng.integers(0, len(piece) + 1))
            left = piece[:cut].rstrip("0123456789@.+") + " " * (rng.random() < 0.9)
            if left and left[-1].isalnum():
                left += " "
            right = ("", " ", ".", ",", "\n")[rng.integers(5)] + " " + piece[cut:].lstrip("0123456789@.-")
            piece = left + form + right
            if rng.random() < 0.3:
                # Texts may end soon after a form, and windows are padded then.
                piece = piece[: len(left) + len(form) + int(rng.integers(0, 30))]
            if kind is not None:
                spans.append((kind, len(left), len(left) + len(form)))
            shift = int(rng.integers(0, max(1, len(piece) - LENGTH + 1)))
            piece = piece[shift : shift + LENGTH]
            spans = [(k, a - shift, b - shift) for k, a, b in spans if a >= shift and b - shift <= LENGTH]
        for kind, name in enumerate(KINDS):
            for a, b in base_spans(piece)[name]:
                if not any(a < end and first < b for _, first, end in spans):
                    spans.append((kind, a, b))
        text[row, : len(piece)] = classes(_points(piece))
        for kind, a, b in spans:
            gold[row, a:b] = 2 + 2 * kind
            gold[row, a] = 1 + 2 * kind
    return text, gold


def fitted(carriers: list[str], windows: int = 8000, steps: int = 900, least: float = LEAST_SCORE, seed: int = 7) -> CharTagger:
    """A tagger that gets the share `least` of held-out windows right in every tag; up to three starts are tried."""
    data, held = labelled_windows(carriers, windows, seed=3), labelled_windows(carriers, 512, seed=5)
    scores = []
    for start in range(seed, seed + 3):
        tagger = CharTagger(TAGS, _allowed(), seed=start)
        scores.append(tagger.fit(*data, held, steps))
        if scores[-1] >= least:
            return tagger
    raise RuntimeError(f"no tagger reached {least} on held-out windows: {scores}")


def train_tagger(
    docs: DataFrame, text: str = "text", sample_pieces: int = 400, windows: int = 8000, steps: int = 900, least: float = LEAST_SCORE
) -> CharTagger:
    """Fit the tagger on `windows` labelled windows made from at most `sample_pieces` pieces of text.

    The pieces are those with the smallest hashes, so the sample does not depend on how rows are laid out.
    """
    chosen = hashed_sample(docs.select(as_text(text)), text, sample_pieces)
    room = F.greatest(F.length("text") - 4 * LENGTH, F.lit(1))
    piece = F.substring(F.col("text"), (1 + F.pmod("h", room)).cast("int"), F.lit(4 * LENGTH))
    rows = chosen.select("h", piece.alias("piece")).orderBy("h").collect()
    return fitted([r.piece for r in rows], windows, steps, least)


# How each kind is written when the rules miss it; a tagged span is cut down to its longest passage of this form.
_AT = r"(?:\s*[\[({]\s*(?:[Aa][Tt]|@)\s*[\])}]\s*|\s?@\s?|\s+[Aa][Tt]\s+)"
_DOT = r"(?:\s*[\[({]\s*(?:[Dd][Oo][Tt]|\.)\s*[\])}]\s*|\s\.\s|\.|\s+[Dd][Oo][Tt]\s+)"
FORMS = (
    re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"),
    re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])"),
    re.compile(r"(?<![0-9])[0-9](?:[\x20./_-]{0,3}[0-9])+"),
    re.compile(r"(?<![0-9])(?:\([0-9]{2,4}\)|[0-9]{2,5})(?:[\x20.-][0-9]{2,5}){2,4}(?![0-9])"),
)
_DATE = re.compile(r"[0-9]{4}([.-])[0-9]{2}\1[0-9]{2}|[0-9]{2}([.-])[0-9]{2}\2[0-9]{4}")
CHECKS = (
    lambda text: True,
    lambda text: address_parts(".".join(re.findall("[0-9]+", text))),
    card_number,
    lambda text: 9 <= len(digits(text)) <= 15 and not _DATE.fullmatch(text),
)


def _signs(text: str) -> bool:
    """Whether a sign for "at" stands between letters, and one for "dot" behind it."""
    read = "".join(map(chr, _points(text)))
    return re.search(r"[A-Za-z0-9].*@.*[A-Za-z0-9].*\..*[A-Za-z0-9]", read, re.DOTALL) is not None


# What a span without a known form must hold.
HOLDS = (_signs, lambda text: len(re.findall("[0-9]+", text)) == 4 and CHECKS[1](text), CHECKS[2], CHECKS[3])


def _written(kind: int, text: str, a: int, b: int) -> tuple[int, int] | None:
    """The longest passage of the kind's form in a tagged span that passes the kind's check."""
    found = [m.span() for m in FORMS[kind].finditer(text, a, b) if CHECKS[kind](m[0])]
    return max(found, key=lambda s: s[1] - s[0], default=None)


def reconcile(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end, margin) of all windows to spans that do not overlap; the widest margin wins.

    A span that a window's edge cut (margin 0) is first joined with spans of its kind that it meets.
    """
    joined: list[list[int]] = []
    for kind, start, end, margin in sorted(found, key=lambda s: (s[0], s[1], s[2])):
        last = joined[-1] if joined else None
        if last and last[0] == kind and start <= last[2] and (margin == 0 or last[3] == 0):
            last[2], last[3] = max(last[2], end), max(last[3], margin)
        else:
            joined.append([kind, start, end, margin])
    taken: list[tuple[int, int, int]] = []
    reach: dict[int, tuple[int, int]] = {}
    for kind, start, end, _ in sorted(joined, key=lambda s: (-s[3], s[1], s[2], s[0])):
        cells = range(start // WINDOW, (end - 1) // WINDOW + 1)
        near = {span for cell in cells for span in reach.get(cell, ())}
        if all(end <= a or b <= start for a, b in near):
            taken.append((kind, start, end))
            for cell in cells:
                reach[cell] = (*reach.get(cell, ()), (start, end))
    return sorted(taken, key=lambda s: s[1])


def tagged_spans(tagger: CharTagger, texts: list[str], rows: int = 100) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans (kind, start, end) of each text, as tagged."""
    found: list[list] = [[] for _ in texts]
    stock: list[tuple[int, int, int, np.ndarray]] = []

    def read() -> None:
        # Windows are read in blocks of fixed shape; a shorter last window is padded.
        block = np.zeros((len(stock), WINDOW), np.int64)
        for row, (_, _, _, piece) in enumerate(stock):
            block[row, : len(piece)] = piece
        for (doc, first, size, piece), path in zip(stock, tagger.decode(block), strict=True):
            opens = np.flatnonzero(path[: len(piece)] % 2 == 1)
            for start in opens:
                inside = path[start] + 1
                end = start + 1
                while end < len(piece) and path[end] == inside:
                    end += 1
                margin = min(int(start) if first else WINDOW, len(piece) - end if first + len(piece) < size else WINDOW)
                found[doc].append((int(path[start]) // 2, int(first + start), int(first + end), margin))
        stock.clear()

    for doc, text in enumerate(texts):
        if not _TRIGGER.search(text):
            continue
        points = _points(text)
        cells = np.unique([m.start() // STRIDE for m in _TRIGGER.finditer(text)])
        for cell in np.unique(np.concatenate([cells, np.maximum(cells - 1, 0)])):
            first = int(cell) * STRIDE
            stock.append((doc, first, len(points), classes(points[first : first + WINDOW])))
            if len(stock) == rows:
                read()
    if stock:
        read()
    return [reconcile(own) for own in found]


def _whole_words(text: str, a: int, b: int) -> tuple[int, int]:
    """The span, widened by at most a window to where words begin and end."""
    first, last = max(0, a - WINDOW), min(len(text), b + WINDOW)
    while a > first and text[a].isalnum() and (text[a - 1].isalnum() or text[a - 1] in "._"):
        a -= 1
    while b < last and text[b - 1].isalnum() and text[b].isalnum():
        b += 1
    return a, b


def _sure(tagger: CharTagger, asked: list[tuple[str, int, int, int]], rows: int = 64) -> list[bool]:
    """Whether the tagger, with the span (text, kind, start, end) in the middle of a window, is sure of all its tags."""
    out = []
    for at in range(0, len(asked), rows):
        block = np.zeros((min(rows, len(asked) - at), WINDOW), np.int64)
        places = []
        for row, (text, kind, a, b) in enumerate(asked[at : at + rows]):
            first = max(0, min(a - (WINDOW - b + a) // 2, len(text) - WINDOW))
            piece = classes(_points(text[first : first + WINDOW]))
            block[row, : len(piece)] = piece
            places.append((kind, a - first, b - first))
        chance = tagger.posterior(block)
        for row, (kind, a, b) in enumerate(places):
            tags = np.array([1 + 2 * kind] + [2 + 2 * kind] * (b - a - 1))
            out.append(b <= WINDOW and float(chance[np.arange(a, b), row, tags].min()) >= SURE)
    return out


def spans_of(tagger: CharTagger, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text: kind, start, end, and whether the rules found it; by kind, then start."""
    result, asked = [], []
    for text, tagged in zip(texts, tagged_spans(tagger, texts), strict=True):
        base = base_spans(text)
        taken = sorted(s for own in base.values() for s in own)
        ends = np.maximum.accumulate([b for _, b in taken]) if taken else []
        starts = [a for a, _ in taken]
        spans = {kind: [(a, b, True) for a, b in base[kind]] for kind in KINDS}
        for kind, a, b in tagged:
            passage = _written(kind, text, *_whole_words(text, a, b))
            formless = passage is None
            if formless and not (b - a <= WINDOW and HOLDS[kind](text[a:b])):
                continue
            a, b = passage or (a, b)
            # The last rule span that starts before this one ends is the only kind that can reach into it.
            before = int(np.searchsorted(starts, b))
            if before and ends[before - 1] > a:
                continue
            if formless:
                asked.append((spans, text, kind, a, b))
            else:
                spans[KINDS[kind]].append((a, b, False))
        result.append(spans)
    for (spans, _, kind, a, b), sure in zip(asked, _sure(tagger, [x[1:] for x in asked]), strict=True):
        # A passage with a form may have grown over it.
        if sure and all(b <= x or y <= a for own in spans.values() for x, y, _ in own):
            spans[KINDS[kind]].append((a, b, False))
    return [[(kind, *span) for kind in KINDS for span in sorted(spans[kind])] for spans in result]


def find_pii(docs: DataFrame, tagger: CharTagger, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns and `spans`: kind, start, end in code points, by_rule; ordered by kind as listed, then start."""

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            rows = spans_of(tagger, column.to_pylist())
            flat = [s for own in rows for s in own]
            parts = [[s[i] for s in flat] for i in range(4)]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
            struct = pa.StructArray.from_arrays(
                [pa.array(p, k) for p, k in zip(parts, kinds, strict=True)],
                fields=[pa.field(f.name, k, False) for f, k in zip(SPAN.fields, kinds, strict=True)],
            )
            offsets = np.cumsum([0, *map(len, rows)])
            return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)]

        return work

    field = T.StructField("spans", T.ArrayType(SPAN, False), False)
    return map_text(docs, text, keep or ["doc_id"], [field], make)


def redact(docs: DataFrame, tagger: CharTagger, text: str = "text") -> DataFrame:
    """The same rows and columns, each span of personal data replaced by its kind in brackets; null text stays null.

    Spans that overlap are replaced as one, named after the first.
    """
    columns = docs.columns

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            texts = column.to_pylist()
            out = []
            for whole, spans in zip(texts, spans_of(tagger, texts), strict=True):
                parts, done = [], 0
                for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
                    if a >= done:
                        parts += [whole[done:a], f"[{kind.upper()}]"]
                    done = max(done, b)
                out.append("".join([*parts, whole[done:]]))
            return [pa.array(out, pa.string())]

        return work

    kept = [f"_{i}" for i in range(len(columns))]
    renamed = docs.toDF(*kept)
    own = kept[columns.index(text)]
    cleaned = map_text(renamed, own, kept, [T.StructField("_clean", T.StringType(), False)], make)
    new = F.when(F.col(own).isNotNull(), F.col("_clean")).alias(text)
    return cleaned.select(*[new if k == own else F.col(k).alias(c) for k, c in zip(kept, columns, strict=True)])
