from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from clickcredit.llm import toxicity as M
from clickcredit.llm.words import NOT_ALNUM, word_hashes, word_prefixes

from .conftest import documents, prose


def test_prefixes_hash_like_the_words_they_are():
    text = "Word words wo abcdefgh é漢字漢字 x".lower().encode()
    starts, hashes = word_prefixes(text, (4, 5), NOT_ALNUM)
    again, whole = word_hashes(text, NOT_ALNUM)
    assert (starts == again).all() and (hashes[:, 0] == whole).all()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text)
    for row, w in zip(hashes, words, strict=True):
        for k, n in enumerate((4, 5), 1):
            expected = int(word_hashes(w[:n], NOT_ALNUM)[1][0]) ^ 1 if len(w) > n else 0
            assert int(row[k]) == expected


def plain_score(model, text):
    """The machine by its formula, pair by pair."""
    words = set(re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode()))
    terms = set()
    for w in words:
        terms.add(int(word_hashes(w, NOT_ALNUM)[1][0]) >> 32)
        terms |= {(int(word_hashes(w[:n], NOT_ALNUM)[1][0]) ^ 1) >> 32 for n in M.PREFIXES if len(w) > n}
    own = [i for i, t in enumerate(model.terms.tolist()) if t in terms]
    x = model.bias + sum(model.weights[i] for i in own)
    x += sum(float(model.factors[i] @ model.factors[j]) for a, i in enumerate(own) for j in own[a + 1:])
    return 1 / (1 + math.exp(-x)), len(own)


def labelled(spark, rows):
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, toxic int")


def corpus(seed, count):
    """Texts of which those with an insult word, in some form, are toxic."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = prose(seed + i, rng.randint(3, 60)).split()
        toxic = rng.random() < 0.3
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Fool", "fool,", "(FOOL)", "grubbling", "grubbled!", "grubbler"])
        rows.append((seed + i, " ".join(words), int(toxic)))
    return rows


def test_scores_by_the_formula_and_held_out(spark):
    learned, asked = corpus(0, 1200), corpus(50_000, 300)
    docs, labels = labelled(spark, learned)
    model = M.train(docs, labels)
    assert 0 < len(model.terms) <= M.MAX_TERMS + M.FREQUENT and (np.diff(model.terms) > 0).all()
    texts = [(i, t) for i, t, _ in asked] + [(1, None), (2, ""), (3, "FOOL " * 100_000), (4, "grubbly")]
    got = {r.id: r for r in M.score(documents(spark, texts), model).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        p, n = plain_score(model, t)
        assert (got[i].score, got[i].n_terms) == (pytest.approx(p, abs=1e-9), n)
    right = sum((got[i].score >= 0.3) == (x == 1) for i, _, x in asked)
    assert right >= 0.97 * len(asked)
    assert got[1].score < 0.3 and got[2].score == got[1].score
    assert got[3].score >= 0.3 and got[4].score >= 0.3


def test_pairs_that_no_sum_of_weights_can_tell(spark):
    """Toxic is just one of two words and neither: what a linear score can't learn."""
    rng = random.Random(5)
    rows = []
    for i in range(1600):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = prose(i, 6).split() + ["slurring"] * insult + ["neighbours"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult == group)))
    docs, labels = labelled(spark, rows[:1200])
    model = M.train(docs, labels)
    got = {r.id: r.score for r in M.score(documents(spark, [(i, t) for i, t, _ in rows[1200:]]), model).collect()}
    assert sum((got[i] >= 0.5) == (x == 1) for i, _, x in rows[1200:]) >= 0.95 * 400


def test_labels_are_bounded_and_odd_ones_defined(spark):
    rows = [(k, k % 2) for k in range(3000)] + [(None, 1), (7, None), (8, 1), (8, 0), (8, None)]
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    drawn = M.sampled_labels(labels, max_rows=300).collect()
    assert 200 <= len(drawn) <= 400 and len({r.id for r in drawn}) == len(drawn)
    everything = {r.id: r.label for r in M.sampled_labels(labels).collect()}
    assert len(everything) == 3000 and everything[7] == 1.0 and everything[8] == 1.0 and everything[2] == 0.0


def test_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    for labels in (none, spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, toxic int")):
        model = M.train(odd, labels)
        got = M.score(odd, model).collect()
        assert len(got) == odd.count() and all(r.score == pytest.approx(0.0, abs=1e-8) for r in got)
        assert M.score(nothing, model).collect() == []
    assert len(M.train(nothing, none).terms) == 0
    some = spark.createDataFrame([(4, 0), (5, 1), (6, 1), (7, 0), (8, 0)], "doc_id bigint, toxic int")
    model = M.train(odd, some)
    got = M.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
