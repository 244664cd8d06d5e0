"""Language filters: prediction against sets of n-grams, samples of long texts, many languages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filmgrain.llm import langid


def tongue(seed):
    """Texts of an invented language: words from its own syllables."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(25)]
    return lambda n: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def by_sets(texts, counts):
    """Prediction with exact sets in place of the filter."""
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    top = {}
    for lang, c in counts.items():
        for g, n in c.items():
            top[g] = max(top.get(g, 0), n / totals[lang])
    own = {lang: {g for g, n in c.items() if n / totals[lang] >= langid.RIVAL * top[g]} for lang, c in counts.items()}
    for text in texts:
        grams = [int(g) for part in langid.grams(text or "") for g in part]
        share = {lang: sum(g in own[lang] for g in grams) / len(grams) for lang in sorted(own)} if grams else {}
        best = max(share, key=lambda lang: share[lang], default=None)
        yield (best, share[best]) if best is not None else ("und", 0.0)


def test_predictions_by_sets_of_grams(spark):
    speak = {f"l{i}": tongue(i) for i in range(4)}
    rows = [(lang, say(60)) for lang, say in speak.items() for _ in range(20)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    counts = {}
    for lang, text in set(rows):
        for part in langid.grams(text):
            for g in part:
                counts.setdefault(lang, {}).setdefault(int(g), 0)
                counts[lang][int(g)] += 1
    texts = [say(n) for say in speak.values() for n in (1, 3, 50)] + [None, "", "12 34", "l0 " + speak["l1"](4)]
    texts += [speak["l0"](6) + " " + speak["l2"](6)]
    for text, (lang, score) in zip(texts, by_sets(texts, counts)):
        got = model.decide(text)
        assert got[0] == lang and got[1] == pytest.approx(score, abs=0.01), text


def test_ties_go_to_the_first_language():
    gram = np.arange(1000, dtype=np.uint64)
    model = langid.build(["b", "c"], np.repeat([0, 1], 1000), np.concatenate([gram, gram]), np.ones(2000))
    model2 = langid.Filter(("b", "c"), np.full_like(model.masks, 3), np.zeros(2))
    assert model2.decide("any words") == ("b", 1.0)


def test_a_hundred_languages(spark):
    speak = {f"x{i:03}": tongue(1000 + i) for i in range(100)}
    rows = [(lang, say(80)) for lang, say in speak.items() for _ in range(3)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert len(model.languages) == 100 and model.masks.shape[1] == 2 and (model.filled > 0).all()
    assert sum(model.decide(say(40))[0] == lang for lang, say in speak.items()) >= 98


def test_languages_of_a_few_long_texts_have_their_sample(spark):
    """Three texts far longer than the sample, beside many copies of one text; no language is left without n-grams."""
    a, b = tongue(5), tongue(6)
    rows = [("long", a(60_000)) for _ in range(3)] + [("copies", b(300))] * 400 + [("copies", b(300)) for _ in range(5)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"), sample_chars=30_000)
    assert (model.filled > 0).all()
    assert [model.decide(say(50))[0] for say in (a, b)] == ["long", "copies"]


def test_texts_beyond_a_piece(spark, monkeypatch):
    speak = {f"l{i}": tongue(i) for i in range(2)}
    rows = [(lang, say(60)) for lang, say in speak.items() for _ in range(5)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    model = langid.fit(frame)
    long_ = speak["l1"](200_000)
    whole = model.decide(long_)
    assert len(long_) > langid.PIECE and whole[0] == "l1"
    monkeypatch.setattr(langid, "PIECE", 1000)
    assert model.decide(long_) == whole
    got = frame.limit(0).select(langid.predict(spark, model, F.col("text")).alias("p")).collect()
    assert got == []
