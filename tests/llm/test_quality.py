import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import kneser_ney as kn
from tickloom.llm import text_counts, weak_quality
from tickloom.llm.queries import op3_weak_quality, op4_perplexity_rules

from .conftest import DATA, prose

SPACE = "\x20\t\n\x0b\x0c\r"


def plain_counts(text):
    words = re.findall(rf"[^{SPACE}]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search(rf"[^{SPACE}]", line):
            repeated += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeated, len(inside)
    )


def own_counts(text):
    raw = text.encode()
    words = raw.split()
    return (
        len(words), text_counts.word_chars(raw), text_counts.symbol_count(raw), text_counts.duplicate_lines(raw),
        text_counts.repeated_words(text_counts.word_ids(words)),
    )


def test_plain_counts_of_odd_texts():
    cases = ["", " ", "a", "a a a", "a a a a", "x y z x y z", "é\x85ü b", "l1\nl1\n\n\n l1\nl1\r\nl1\r", "#*$ %&|<> #", "a\x1cb c", "日本　語 x"]
    cases += ["a b a b a b " * 50, prose(3), f"{prose(4)}\n{prose(4)}"]
    for text in cases:
        assert own_counts(text) == plain_counts(text), text


def test_repeated_words_with_many_distinct_words():
    ids = np.concatenate([np.arange(1 << 20 | 9), np.arange(3)])
    assert text_counts.repeated_words(ids) == 6


def brute_model(rows, order):
    """Modified Kneser-Ney over bytes, worked out with dictionaries."""
    tops = Counter()
    for lang, text in rows:
        raw = b"\0" * (order - 1) + text.encode()
        for i in range(order - 1, len(raw)):
            tops[lang, raw[i - order + 1 : i + 1]] += 1
    types = {order: tops}
    for size in range(order - 1, 0, -1):
        types[size] = Counter((lang, gram[1:]) for lang, gram in types[size + 1])
    model = {}
    for size in range(1, order + 1):
        n = [sum(c == k for c in types[size].values()) for k in (1, 2, 3, 4)]
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            made = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.0]
            cut = [min(max(d, 0.05), most) for d, most in zip(made, (0.95, 1.9, 2.9), strict=True)]
        else:
            cut = [0.5, 0.75, 0.9]
        total, back = Counter(), Counter()
        for (lang, gram), c in types[size].items():
            total[lang, gram[:-1]] += c
            back[lang, gram[:-1]] += cut[min(c, 3) - 1]
        model[size] = {}
        for (lang, gram), c in types[size].items():
            context = lang, gram[:-1]
            lower = 1 / 256 if size == 1 else model[size - 1][lang, gram[1:]]
            own = 0 if c == 1 and size == order else c - cut[min(c, 3) - 1]
            model[size][lang, gram] = (own + back[context] * lower) / total[context]
    return model[order]


@pytest.mark.parametrize("stretch", [kn.STRETCH])
def test_perplexity_against_dictionaries(spark, docs, stretch):
    rows = [("en", prose(i, 30)) for i in range(12)] + [("de", prose(50 + i, 25)) for i in range(8)] + [("en", "zqx 7"), ("en", "é")]
    frame = docs([(i, t, lang) for i, (lang, t) in enumerate(rows)])
    model = kn.train_model(frame)
    found = {r.doc_id: r.log_perplexity for r in kn.score_texts(frame, model, keep=["doc_id"]).collect()}
    brute = brute_model(rows, kn.ORDER)
    for i, (lang, text) in enumerate(rows):
        raw = b"\0" * (kn.ORDER - 1) + text.encode()
        each = [math.log(brute[lang, raw[k : k + kn.ORDER]]) for k in range(len(raw) - kn.ORDER + 1)]
        parts = max(len(each) // stretch, 1)
        cuts = [p * len(each) // parts for p in range(parts + 1)]
        middle = float(np.median([-np.mean(each[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]))
        assert found[i] == pytest.approx(middle, rel=1e-4), text


def test_many_sequences_keep_their_own_values(spark, docs):
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    texts = ["".join(rng.choice(letters, 6000)) for _ in range(30)]
    rows = [("en", t) for t in [*texts, *texts[:15]]]
    frame = docs([(i, t, lang) for i, (lang, t) in enumerate(rows)])
    model = kn.train_model(frame)
    brute = brute_model(rows, kn.ORDER)
    raw = np.frombuffer(texts[0].encode(), np.uint8)
    found = own_log_probs(spark, model, raw, "en")
    padded = b"\0" * (kn.ORDER - 1) + texts[0].encode()
    want = [math.log(brute["en", padded[i : i + kn.ORDER]]) for i in range(len(raw))]
    assert np.allclose(found, want, rtol=1e-4)


def test_languages_are_whole_tags(spark, docs):
    tagged = {"en-US": 0, "pt-BR": 100, "zh-Hans": 200, "Norsk": 300}
    rows = [(tag, prose(seed + i, 70 + seed // 10) if tag != "zh-Hans" else "語言文字日本" * (60 + i)) for tag, seed in tagged.items() for i in range(8)]
    frame = docs([(i, t, lang) for i, (lang, t) in enumerate(rows)])
    brute = brute_model(rows, kn.ORDER)
    found = {r.doc_id: r for r in kn.judge_quality(frame, keep=["doc_id", "lang"]).collect()}
    assert len({(r.lower_band, r.upper_band) for r in found.values()}) == len(tagged)
    model = kn.train_model(frame)
    for tag, text in (rows[0], rows[9], rows[17], rows[25]):
        raw = np.frombuffer(text.encode(), np.uint8)
        made = own_log_probs(spark, model, raw, tag)
        padded = b"\0" * (kn.ORDER - 1) + text.encode()
        assert np.allclose(made, [math.log(brute[tag, padded[i : i + kn.ORDER]]) for i in range(len(raw))], rtol=1e-4)


def kn_language(spark, tag):
    return spark.createDataFrame([(tag,)], "lang string").select(kn.language_id("lang")).first()[0]


def own_log_probs(spark, model, raw, tag):
    """Log probability of each byte, from the values that the model gives for the text's distinct sequences."""
    lang, wanted = kn_language(spark, tag), np.unique(kn.grams(raw, np.array([0, len(raw)]))).astype(np.int64)
    frame = spark.createDataFrame([(lang, int(g)) for g in wanted], "lang long, gram long")
    values = {r.gram: r.v for r in model.values(frame).collect()}
    block = kn.BlockValues(np.full(len(wanted), lang), wanted, np.array([values[g] for g in wanted.tolist()]))
    return block.log_probs(raw, np.array([0, len(raw)]), np.array([lang]))


def test_blocks_of_any_size_give_the_same_scores(spark, docs, monkeypatch):
    rows = [(i, prose(i, 40 + 7 * i), ("en", "de", None)[i % 3]) for i in range(30)] + [(90, None), (91, ""), (92, prose(1, 9000)), (92, "x")]
    frame = docs(rows)
    whole = sorted(tuple(r) for r in kn.judge_quality(frame, keep=["doc_id", "text", "lang"]).collect() if r.text)
    monkeypatch.setattr(kn, "BLOCK_BYTES", 2000)
    small = kn.judge_quality(frame, keep=["doc_id", "text", "lang"]).collect()
    tagged = [(i, t, *(lang or ["en"])) for i, t, *lang in rows]
    assert sorted(map(str, tagged)) == sorted(str((r.doc_id, r.text, r.lang)) for r in small)
    left = sorted(tuple(r) for r in small if r.text)
    for one, two in zip(whole, left, strict=True):
        assert one[:-3] == two[:-3] and one[-3:] == pytest.approx(two[-3:], rel=1e-6)


def test_unseen_values_against_dictionaries(spark, docs):
    """Falling back by joins gives what the model's own tables say for shorter sequences."""
    model = kn.train_model(docs([(i, prose(i, 60)) for i in range(6)]))
    lang = kn_language(spark, "en")
    made = {size: {r.gram: r.p for r in rows.collect()} for size, rows in model.made.items()}
    backs = {size - 1: {r.context: r.back for r in rows.collect()} for size, rows in model.made.items()}
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"etaqzZ9 .", np.uint8)
    wanted = sorted({int.from_bytes(rng.choice(letters, 4).tobytes(), "big") for _ in range(400)} - made[4].keys())
    frame = spark.createDataFrame([(lang, g) for g in wanted], "lang long, gram long")
    found = {r.gram: r.v for r in model.unseen_values(frame).collect()}
    for g in wanted:
        value = 1 / 256
        for size in range(1, 5):
            own, context = g & (1 << 8 * size) - 1, g >> 8 & (1 << 8 * (size - 1)) - 1
            value = made[size].get(own, backs[size - 1].get(context, 1.0) * value)
        assert found[g] == pytest.approx(math.log(value), rel=1e-5)


def test_unseen_sequences_fall_back(spark, docs):
    model = kn.train_model(docs([(i, prose(i, 60)) for i in range(10)]))
    other = kn.score_texts(docs([(1, prose(99, 60)), (2, "QWXZ @@ 8459 " * 20)]), model, keep=["doc_id"])
    near, far = [r.log_perplexity for r in other.orderBy("doc_id").collect()]
    assert near < 2.5 < far < math.log(256 * 50)


def test_bands_reject_noise_and_keep_prose(spark, docs):
    rows = [(i, prose(i)) for i in range(60)] + [(100, " ".join(f"%{i * 7919 % 9973}$#Q{i}" for i in range(90)))]
    rows += [(101, None), (102, ""), (103, "too short"), (104, "same words here " * 60), (105, prose(7)), (105, prose(7))]
    judged = {r.doc_id: r for r in kn.judge_quality(docs(rows)).collect()}
    assert all(judged[i].kept for i in [*range(60), 105])
    assert not judged[100].kept and not judged[100].base_failed
    assert all(judged[i].base_failed and not judged[i].kept for i in (101, 102, 103, 104))
    assert judged[101].n_words == 0 and judged[101].perplexity == 1.0
    assert kn.judge_quality(docs([])).count() == 0


def test_filters_return_the_columns_they_got(spark):
    rows = [(i, prose(i), None if i % 2 else "en", "c", True) for i in range(20)]
    frame = spark.createDataFrame(rows, "lang_id long, text string, lang string, votes string, kept boolean")
    for keep in (kn.keep_quality, weak_quality.keep_quality):
        left = keep(frame)
        assert left.schema == frame.schema
        assert left.count() == 20


def test_labellers_learn_accuracies_without_gold():
    rng = np.random.default_rng(2)
    labellers = len(weak_quality.LABELLERS)
    good = rng.random(8000) < 0.85
    reach = rng.uniform(0.3, 0.7, labellers)
    votes = np.where(good[:, None], np.where(rng.random((8000, labellers)) < 0.99, 1, 2), np.where(rng.random((8000, labellers)) < reach, 2, 1))
    votes[rng.random(votes.shape) < 0.1] = 0
    codes, counts = np.unique(votes @ 3 ** np.arange(labellers - 1, -1, -1), return_counts=True)
    model = weak_quality.fit_votes(codes, counts.astype(float))
    assert model.prior == pytest.approx(0.85, abs=0.02)
    assert model.rates[0, :, weak_quality.BAD] == pytest.approx(reach, abs=0.08)
    chance = model.chance(votes @ 3 ** np.arange(labellers - 1, -1, -1))
    assert ((chance > 0.5) == good).mean() > 0.97


def test_query_of_the_classifier_against_labels(spark):
    sf_dir = DATA.replace("0.001", "0.01")
    judged = op3_weak_quality(spark, sf_dir)
    assert judged.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labelled = judged.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    rates = {r.quality: r.kept for r in labelled.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.98
    assert rates[0] < 0.1


def test_classifier_rows(spark, docs):
    rows = [(i, prose(i)) for i in range(30)] + [(i, "WORD!! " * 90) for i in range(40, 46)] + [(50, None), (51, ""), (None, prose(1))]
    judged = weak_quality.classify_quality(docs(rows)).collect()
    assert len(judged) == len(rows)
    by_id = {r.doc_id: r for r in judged}
    assert by_id[50].votes == by_id[51].votes == 0
    assert by_id[None].score == by_id[1].score
    assert all(by_id[i].posterior < 0.5 for i in range(40, 46))
    assert weak_quality.classify_quality(docs([])).count() == 0


def test_query_of_the_rules_against_plain_counts(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = op4_perplexity_rules(spark, DATA).collect()
    assert len(found) == len(texts)
    for r in found:
        want = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed
        inside = r.lower_band <= r.perplexity <= r.upper_band
        assert r.kept == (not failed and inside)


def plain_em(rows, rounds=60):
    """The label model by loops over texts and labellers: (prior, rates[y][labeller][vote])."""
    n = len(rows[0])
    rates = [[{1: 0.6, 2: 0.4} for _ in range(n)], [{1: 0.98, 2: 0.02} for _ in range(n)]]
    prior = 0.9

    def chance(votes):
        good, bad = prior, 1 - prior
        for at, vote in enumerate(votes):
            if vote:
                good, bad = good * rates[1][at][vote], bad * rates[0][at][vote]
        return good / (good + bad)

    for _ in range(rounds):
        chances = [chance(votes) for votes in rows]
        fresh = []
        for y in (0, 1):
            fresh.append([])
            for at in range(n):
                cast = {v: 1 + sum(c if y else 1 - c for c, votes in zip(chances, rows, strict=True) if votes[at] == v) for v in (1, 2)}
                fresh[y].append({v: x / sum(cast.values()) for v, x in cast.items()})
        prior, rates = min(max((sum(chances) + 1) / (len(rows) + 2), 0.01), 0.99), fresh
    return prior, rates, [chance(votes) for votes in rows]


def test_votes_against_plain_em():
    rng = random.Random(12)
    labellers = len(weak_quality.LABELLERS)
    rows = []
    for _ in range(400):
        good = rng.random() < 0.8
        rows.append([rng.choices([0, 1, 2], [2, 9, 1] if good else [2, 4, 6])[0] for _ in range(labellers)])
    packed = [sum(v * 3 ** (labellers - 1 - at) for at, v in enumerate(votes)) for votes in rows]
    codes, counts = np.unique(packed, return_counts=True)
    model = weak_quality.fit_votes(codes, counts.astype(float))
    prior, rates, chances = plain_em(rows)
    assert model.prior == pytest.approx(prior, rel=1e-9)
    for y in (0, 1):
        for at in range(labellers):
            assert [model.rates[y, at, v] for v in (1, 2)] == pytest.approx([rates[y][at][v] for v in (1, 2)], rel=1e-9)
    assert model.chance(np.array(packed)) == pytest.approx(chances, abs=1e-9)


def test_scorer_against_plain_gradients():
    """Momentum steps on the loss whose gradient is taken by differences, feature by feature."""
    rng = np.random.default_rng(7)
    used = np.array([3, 50, 777, 9000])
    rows = [rng.choice(used, rng.integers(1, 4), replace=False) for _ in range(30)]
    weights = [rng.uniform(0.2, 1, len(r)) for r in rows]
    target = rng.uniform(0, 1, 30)
    decay, rate = 1e-4, 3.0
    found = weak_quality.fit_scorer(rows, weights, target, rounds=12, rate=rate, decay=decay)
    share = target.mean()
    balance = [0.5 / share if t > 0.5 else 0.5 / (1 - share) for t in target]

    def loss(model):
        value = sum(decay / 2 * model[b] ** 2 for b in used)
        for r, w, t, c in zip(rows, weights, target, balance, strict=True):
            lean = model["bias"] + sum(model[b] * x for b, x in zip(r, w, strict=True))
            value += c * (math.log1p(math.exp(-lean)) * t + math.log1p(math.exp(lean)) * (1 - t)) / len(rows)
        return value

    names = [*used.tolist(), "bias"]
    model, speed = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0)
    for _ in range(12):
        slope = {n: (loss(model | {n: model[n] + 1e-5}) - loss(model | {n: model[n] - 1e-5})) / 2e-5 for n in names}
        speed = {n: 0.9 * speed[n] - rate * slope[n] for n in names}
        model = {n: model[n] + speed[n] for n in names}
    assert [found[b] for b in used] == pytest.approx([model[b] for b in used], abs=1e-6)
    assert found[-1] == pytest.approx(model["bias"], abs=1e-6)
    assert np.count_nonzero(found[:-1]) <= len(used)


def plain_shapes(text):
    kinds = ["a" if ord(c) >= 128 or "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in text]
    return "".join(c for i, c in enumerate(kinds) if not (i and c == kinds[i - 1] and c in "aA0")).split()


def test_scores_of_rows_against_plain_sums(spark, docs):
    """A row's score from words, shapes, repeats and variety counted one by one."""
    texts = {i: prose(i, 30 + i) for i in range(12)} | {20: "WORD!! " * 60, 21: "x x x y", 22: "", 23: None, 24: "Aa1 bB22 ## é É" * 3}
    rng = np.random.default_rng(3)
    scorer = rng.normal(0, 0.4, (1 << weak_quality.BUCKET_BITS) + 1)
    codes = np.array([0, 5, 3**11 - 1])
    votes = weak_quality.fit_votes(codes, np.array([5.0, 4.0, 3.0]))
    judged = weak_quality.judge_texts(docs(list(texts.items())), votes, scorer).collect()
    assert len(judged) == len(texts)
    for r in judged:
        words = re.findall("[^\x20\x09-\x0d]+", texts[r.doc_id] or "")
        lean = scorer[-1]
        if words:
            same = sum(a == b for a, b in zip(words, words[1:], strict=False))
            families = [words, plain_shapes(texts[r.doc_id]), ["same" if same > 0.1 * len(words) else "other"], [str(int(10 * len(set(words)) / len(words)))]]
            for seed, family in enumerate(families, 1):
                size = {k: math.log1p(family.count(k)) for k in family}
                norm = math.sqrt(sum(x * x for x in size.values()))
                lean += sum(scorer[xxhash.xxh32_intdigest(k.encode(), seed) >> 18] * x / norm for k, x in size.items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-lean)), rel=1e-9)
        assert r.kept == (r.score >= weak_quality.THRESHOLD)
