from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickcredit.llm import langid as G

SCHEMA = "doc_id bigint, text string, lang string"
SYLLABLES = {"aa": "ka mo ti ru sen lo pa ne".split(), "bb": "sch ung ei ge ber tz ach pf".split(),
             "cc": "ção nhe lhã ões ir que as dor".split()}


def text_in(lang, seed, words=60):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def folded(text):
    out = []
    for c in text:
        kind = unicodedata.category(c)[0]
        low = c.lower()
        out.append((low if len(low) == 1 else c) if kind in "LM" else " ")
    return "".join(out).split()


@pytest.mark.parametrize("text", ["", " ", "12 34!", "Ab--Cd  é", "!x", "x!", "İ ǅ", "नमस्ते दुनिया", "a\x00b", "\U0001f600a\U00010400"])
def test_folding(text):
    codes = "".join(map(chr, G.codes_of(text).tolist()))
    has_letter = any(unicodedata.category(c)[0] == "L" for c in text)
    assert codes == (" ".join(folded(text)) if has_letter else "")


def brute_model(texts, langs, order):
    """Interpolated Kneser-Ney by its formula, over dictionaries."""
    grams = {lang: Counter() for lang in langs}
    for lang, t in texts:
        padded = [0] * (order - 1) + G.codes_of(t).tolist()
        grams[lang].update(tuple(padded[i:i + order]) for i in range(len(padded) - order + 1))
    alphabet = len({c for g in grams.values() for x in g for c in x}) + 1
    levels = []
    for k in range(order, 0, -1):
        if k < order:
            shorter = {lang: Counter() for lang in langs}
            for lang in langs:
                for x in grams[lang]:
                    shorter[lang][x[1:]] += 1
            grams = shorter
        ones = sum(n == 1 for g in grams.values() for n in g.values())
        twos = sum(n == 2 for g in grams.values() for n in g.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        total, kinds = defaultdict(Counter), defaultdict(Counter)
        for lang in langs:
            for x, n in grams[lang].items():
                total[lang][x[:-1]] += n
                kinds[lang][x[:-1]] += 1
        levels.append((k, grams, total, kinds, d))

    def p(lang, x):
        for k, g, total, kinds, d in levels:
            if k == len(x):
                h = x[:-1]
                lower = p(lang, x[1:]) if k > 1 else 1 / alphabet
                if not total[lang][h]:
                    return lower
                return (max(g[lang][x] - d, 0) + d * kinds[lang][h] * lower) / total[lang][h]

    def entropy(lang, text):
        padded = [0] * (order - 1) + G.codes_of(text).tolist()
        n = len(padded) - order + 1
        return -sum(math.log2(p(lang, tuple(padded[i:i + order]))) for i in range(n)) / n
    return entropy


def counted(texts, langs, order):
    c = Counter()
    for lang, t in texts:
        padded = [0] * (order - 1) + G.codes_of(t).tolist()
        c.update((langs.index(lang), *padded[i:i + order]) for i in range(len(padded) - order + 1))
    rows = np.array([*c], np.int64)
    return rows[:, 0], rows[:, 1:].astype(np.int32), np.array([*c.values()])


def test_entropies_are_those_of_the_formula():
    langs, order = ["aa", "bb", "cc"], 4
    texts = [(lang, text_in(lang, k, 25)) for lang in langs for k in range(4)]
    model = G.fit(langs, *counted(texts, langs, order))
    entropy = brute_model(texts, langs, order)
    new = [text_in("aa", 99, 8), text_in("cc", 98, 5), "Zebra xylophone ka", "k", "日本"]
    got = model.entropies([G.codes_of(t) for t in new])
    for t, row in zip(new, got, strict=True):
        assert row.tolist() == pytest.approx([entropy(lang, t) for lang in langs], rel=1e-5)


def test_very_long_texts_carry_their_context_over(monkeypatch):
    langs = ["aa", "bb"]
    texts = [(lang, text_in(lang, k)) for lang in langs for k in range(3)]
    model = G.fit(langs, *counted(texts, langs, 4))
    long = G.codes_of(text_in("aa", 5, 4000))
    whole = model.entropies([long])
    monkeypatch.setattr(G, "_CHUNK", 1000)
    assert model.entropies([long]) == pytest.approx(whole, rel=1e-6)
    assert model.entropies([long[:50], long, long[:70]])[1] == pytest.approx(whole[0], rel=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, text_in(lang, k), lang) for lang in SYLLABLES for k in range(150)] + [(900, "123", "aa"), (901, None, "bb"), (902, "x y", None)]
    return G.train(spark.createDataFrame(rows, SCHEMA))


def test_held_out_accuracy_and_rejection(spark, model):
    rows = [(k, text_in(lang, 1000 + k, 3 + k % 50), lang) for lang in SYLLABLES for k in range(100)]
    junk = [(2000 + k, t, None) for k, t in enumerate(
        ["qxjw vzqk wxq jzvq xkqz qqvw zzxj wqkx jvxq zkwq " * 4, "日本語の文章です。これは何でしょう" * 3, "Это русский текст, и его модель не знает " * 3])]
    got = {r.id: r for r in G.identify(spark.createDataFrame(rows + junk, SCHEMA), model).collect() if r.id >= 2000}
    assert all(r.rejected for r in got.values())
    told = G.identify(spark.createDataFrame(rows, SCHEMA).selectExpr("concat(doc_id, ' ', lang) doc_id", "text", "lang"), model).collect()
    right = sum(r.id.endswith(r.lang_pred) for r in told)
    assert right >= 0.98 * len(rows) and sum(r.rejected for r in told) <= 1
    assert all(0 <= r.score <= 1 for r in told) and np.mean([r.score for r in told]) > 0.95


def test_odd_rows(odd, nothing, model):
    got = G.identify(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        if r.id in (1, 2, 3):
            assert (r.lang_pred, r.score, r.entropy, r.n_letters, r.rejected) == ("und", 0.0, None, 0, True)
        else:
            assert r.lang_pred in SYLLABLES and r.n_letters > 0
    kept = G.keep_identified(odd, model)
    assert kept.schema == odd.schema
    keep = sorted(repr(r.id) for r in got if not r.rejected)
    assert sorted(repr(r.doc_id) for r in kept.collect()) == keep
    assert G.identify(nothing, model).collect() == [] and G.keep_identified(nothing, model).collect() == []


def test_nothing_to_learn_from(nothing, odd):
    untrained = G.train(nothing)
    assert {(r.lang_pred, r.rejected) for r in G.identify(odd, untrained).collect()} == {("und", True)}
    assert G.train(odd.where("doc_id = 3")).languages == []
