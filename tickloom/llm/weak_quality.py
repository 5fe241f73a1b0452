"""Quality without gold labels: overlapping rough labellers, their accuracies by EM, and a hashed linear scorer.

Each labeller votes good, bad or nothing on a whole text. Spark counts every combination of votes over all texts (at
most 3**labellers); expectation-maximisation on those counts gives each labeller's vote rates on good and on bad texts
and with them the chance that a text is good. A logistic model over hashed words and word shapes is then fitted to these
chances on a bounded sample and scores every text. A text is kept if its score reaches `threshold`.

Null or empty texts get the abstaining combination, have no features and are scored by the bias alone. Equal texts
have equal scores. Samples are the texts with the smallest hashes, whatever the layout of the rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import as_text, byte_texts, hashed_sample, map_text
from tickloom.llm.text_counts import repeated_words, symbol_count, word_ids

GOOD, BAD, NONE = 1, 2, 0
BUCKET_BITS = 14
SAMPLE_TEXTS = 4000
# Good and bad texts weigh the same in training, so a low bar spares good texts that look odd.
THRESHOLD = 0.1
# Letters beyond ASCII count as small ones; runs of the same kind count as one.
_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_RUNS = re.compile(rb"([aA0])\1+")
_NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
_NOT_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)
_ODD = frozenset(b"#*$%&|<>=~^_+/\\@")


def _vote(good: bool, bad: bool) -> int:
    return BAD if bad else GOOD if good else NONE


@dataclass(frozen=True)
class Facts:
    """What the labellers look at; all but the first are shares of the words, or of the visible characters."""

    words: int
    distinct: float
    top: float
    stutter: float
    repeats: float
    symbols: float
    odd_ends: float
    letters: float
    bare: float
    capitals: float
    shouted: float
    loud: float


def facts_of(raw: bytes, words: list[bytes], counts: Counter) -> Facts:
    n = max(len(words), 1)
    visible = max(len(raw.translate(None, b" \t\n\x0b\x0c\r")), 1)
    letters = len(raw.translate(None, _NOT_LETTERS))
    ids = word_ids(words)
    return Facts(
        words=len(words),
        distinct=len(counts) / n,
        top=max(counts.values(), default=0) / n,
        stutter=int((ids[1:] == ids[:-1]).sum()) / n,
        repeats=repeated_words(ids) / n,
        symbols=symbol_count(raw) / n,
        odd_ends=sum(c for w, c in counts.items() if w[-1] in _ODD) / n,
        letters=letters / visible,
        bare=sum(c for w, c in counts.items() if not w.translate(None, _NOT_LETTERS)) / n,
        capitals=len(raw.translate(None, _NOT_CAPITALS)) / max(letters, 1),
        shouted=sum(c for w, c in counts.items() if len(w) > 1 and w == w.upper() != w.lower()) / n,
        loud=raw.count(b"!") / n,
    )


# Shares over few words say little: nobody votes on texts of fewer words.
LONG = 12
LABELLERS = {
    "variety": lambda f: _vote(f.distinct > 0.3, f.distinct < 0.12),
    "common": lambda f: _vote(f.top < 0.15, f.top > 0.4),
    "stutter": lambda f: _vote(f.stutter < 0.05, f.stutter > 0.3),
    "repeats": lambda f: _vote(f.repeats < 0.2, f.repeats > 0.5),
    "symbols": lambda f: _vote(f.symbols < 0.05, f.symbols > 0.2),
    "odd_ends": lambda f: _vote(f.odd_ends < 0.05, f.odd_ends > 0.2),
    "letters": lambda f: _vote(f.letters > 0.9, f.letters < 0.86),
    "bare": lambda f: _vote(f.bare < 0.05, f.bare > 0.2),
    "capitals": lambda f: _vote(f.capitals < 0.2, f.capitals > 0.5),
    "shouted": lambda f: _vote(f.shouted < 0.1, f.shouted > 0.4),
    "loudness": lambda f: _vote(f.loud < 0.1, f.loud > 0.3),
}


def votes_of(raw: bytes, words: list[bytes], counts: Counter) -> int:
    """The combination of votes as one number in base 3; short texts get no votes."""
    if len(words) < LONG:
        return 0
    facts = facts_of(raw, words, counts)
    code = 0
    for vote in LABELLERS.values():
        code = 3 * code + vote(facts)
    return code


def unpack(codes: np.ndarray) -> np.ndarray:
    """Votes by combination and labeller."""
    places = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return codes[:, None] // places % 3


@dataclass(frozen=True)
class VoteModel:
    """`rates[y, labeller, vote]`: of the votes cast on bad (0) and good (1) texts; and the share of good texts.

    Holding back a vote says nothing about a text.
    """

    prior: float
    rates: np.ndarray

    def chance(self, codes: np.ndarray) -> np.ndarray:
        """Chance that a text with this combination is good."""
        votes = unpack(codes)
        each = np.log(self.rates)[:, np.arange(votes.shape[1]), votes].sum(2)
        lean = each[1] - each[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(lean, -50, 50)))

    def accuracies(self) -> dict[str, float]:
        """Mean share of right votes on good and on bad texts."""
        right = (self.rates[1, :, GOOD] + self.rates[0, :, BAD]) / 2
        return dict(zip(LABELLERS, right.tolist(), strict=True))


def fit_votes(codes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> VoteModel:
    """Expectation-maximisation; a bad text is first taken to get a bad vote from two labellers in five.

    One pseudo-count per rate keeps a vote that never occurs from deciding alone.
    """
    votes = unpack(codes)
    cast = np.stack([votes == v for v in range(3)], 2).astype(float)
    start = np.array([[1.0, 0.6, 0.4], [1.0, 0.98, 0.02]])
    model = VoteModel(0.9, np.repeat(start[:, None, :], votes.shape[1], 1))
    for _ in range(rounds):
        good = model.chance(codes) * counts
        weight = np.stack([counts - good, good])
        rates = np.einsum("yc,clv->ylv", weight, cast) + 1
        rates /= rates[:, :, [GOOD, BAD]].sum(2, keepdims=True)
        rates[:, :, NONE] = 1
        model = VoteModel(float(np.clip((good.sum() + 1) / (counts.sum() + 2), 0.01, 0.99)), rates)
    return model


def features_of(raw: bytes, words: list[bytes], counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text's words, word shapes and immediate repeats; each family has length 1."""
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    shapes = Counter(_RUNS.sub(rb"\1", raw.translate(_SHAPE)).split())
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    families = [
        (counts, 1),
        (shapes, 2),
        ({b"same" if stutter > 0.1 * len(words) else b"other": 1}, 3),
        ({b"%d" % int(10 * len(counts) / len(words)): 1}, 4),
    ]
    buckets, weights = [], []
    for family, seed in families:
        buckets.append(np.array([xxhash.xxh32_intdigest(k, seed) for k in family], np.int64) >> (32 - BUCKET_BITS))
        size = np.log1p(np.fromiter(family.values(), float, len(family)))
        weights.append(size / np.sqrt((size * size).sum()))
    return np.concatenate(buckets), np.concatenate(weights)


def fit_scorer(rows: list[np.ndarray], weights: list[np.ndarray], target: np.ndarray, rounds: int = 150, rate: float = 3.0, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on chances as targets, by gradient steps with momentum; the last weight is the bias."""
    size = 1 << BUCKET_BITS
    model, speed = np.zeros(size + 1), np.zeros(size + 1)
    if not rows:
        return model
    at = np.concatenate(rows)
    value = np.concatenate(weights)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # Good and bad texts weigh the same in all.
    good = target.mean()
    balance = np.where(target > 0.5, 0.5 / max(good, 1e-3), 0.5 / max(1 - good, 1e-3))
    for _ in range(rounds):
        lean = np.bincount(row, model[at] * value, len(rows)) + model[-1]
        gap = balance * (1 / (1 + np.exp(-lean)) - target) / len(rows)
        step = np.append(np.bincount(at, gap[row] * value, size), gap.sum()) + decay * np.append(model[:-1], 0)
        speed = 0.9 * speed - rate * step
        model = model + speed
    return model


def _parsed(raw: bytes) -> tuple[bytes, list[bytes], Counter]:
    words = raw.split()
    return raw, words, Counter(words)


def vote_codes(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns and `votes`, the combination as a number."""

    def make():
        return lambda column: [pa.array([votes_of(*_parsed(t)) for t in byte_texts(column)], pa.int32())]

    return map_text(docs, text, keep or [], [T.StructField("votes", T.IntegerType(), False)], make)


def train_votes(docs: DataFrame, text: str = "text") -> VoteModel:
    """Labeller accuracies from the combinations of all texts; at most 3**labellers counts reach the driver."""
    table = vote_codes(docs, text).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").toArrow()
    return fit_votes(table.column("votes").to_numpy().astype(np.int64), table.column("n").to_numpy().astype(float))


def train_scorer(docs: DataFrame, votes: VoteModel, text: str = "text", sample_texts: int = SAMPLE_TEXTS) -> np.ndarray:
    """Fit the scorer on the chances of at most `sample_texts` texts, those with the smallest hashes.

    A text has at most 2**BUCKET_BITS features after hashing, which bounds what reaches the driver.
    """
    fields = [
        T.StructField("votes", T.IntegerType(), False),
        T.StructField("buckets", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("weights", T.ArrayType(T.FloatType(), False), False),
    ]

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            codes, buckets, weights = [], [], []
            for raw in byte_texts(column):
                parsed = _parsed(raw)
                at, value = features_of(*parsed)
                distinct, place = np.unique(at, return_inverse=True)
                codes.append(votes_of(*parsed))
                buckets.append(distinct.astype(np.int32))
                weights.append(np.bincount(place, value, len(distinct)).astype(np.float32))
            return [
                pa.array(codes, pa.int32()),
                pa.array(buckets, pa.list_(pa.int32())),
                pa.array(weights, pa.list_(pa.float32())),
            ]

        return work

    chosen = hashed_sample(docs.select(as_text(text)).where(F.length(text) > 0), text, sample_texts)
    table = map_text(chosen, "text", ["h"], fields, make).toArrow().sort_by("h")
    if not table.num_rows:
        return np.zeros((1 << BUCKET_BITS) + 1)
    target = votes.chance(table.column("votes").to_numpy().astype(np.int64))
    rows = [np.array(x, np.int64) for x in table.column("buckets").to_pylist()]
    return fit_scorer(rows, [np.array(x) for x in table.column("weights").to_pylist()], target)


def judge_texts(
    docs: DataFrame, votes: VoteModel, scorer: np.ndarray, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Kept columns, `votes`, `posterior` (from the votes), `score` (from the scorer) and `kept`."""
    fields = [
        T.StructField("votes", T.IntegerType(), False),
        T.StructField("posterior", T.DoubleType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("kept", T.BooleanType(), False),
    ]

    def make():
        def work(column: pa.Array) -> list[pa.Array]:
            codes, lean = [], []
            for raw in byte_texts(column):
                parsed = _parsed(raw)
                at, value = features_of(*parsed)
                codes.append(votes_of(*parsed))
                lean.append(float(scorer[at] @ value) + scorer[-1])
            score = 1 / (1 + np.exp(-np.clip(np.array(lean), -50, 50)))
            chance = votes.chance(np.array(codes, np.int64))
            return [pa.array(codes, pa.int32()), pa.array(chance), pa.array(score), pa.array(score >= threshold)]

        return work

    return map_text(docs, text, keep or ["doc_id"], fields, make)


def classify_quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Train on the texts themselves and judge them."""
    votes = train_votes(docs, text)
    scorer = train_scorer(docs, votes, text)
    return judge_texts(docs, votes, scorer, text, keep, threshold)


def keep_quality(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that `classify_quality` keeps, with the columns they came with, whatever their names."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    judged = classify_quality(docs.toDF(*names), names[docs.columns.index(text)], names, threshold)
    return judged.where("kept").select(*names).toDF(*docs.columns)
