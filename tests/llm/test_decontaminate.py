from __future__ import annotations

import random
import re

import numpy as np
import pytest

from clickcredit.llm import decontaminate as D
from clickcredit.llm.words import NOT_ALNUM, text_words

from .conftest import documents, prose

ITEM_SCHEMA = "item_id bigint, text string"


def words_of(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def align(item, doc):
    """Plain Smith-Waterman over words."""
    best, above = 0, [0] * (len(doc) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(doc, 1):
            row.append(max(0, above[j - 1] + (2 if a == b else -1), above[j] - 1, row[j - 1] - 1))
        best, above = max(best, *row), row
    return best / (2 * len(item))


def brute(docs, items):
    out = {}
    for i, t in docs:
        for k, x in items:
            a, b = words_of(x), words_of(t)
            if len(a) >= 5 and (s := align(a, b)) >= D.MIN_SIMILARITY:
                out[i, k] = round(s, 9)
    return out


def edited(rng, text, share):
    out = []
    for w in text.split():
        x = rng.random()
        if x < share / 3:
            continue
        out.append("changed" if x < 2 * share / 3 else w)
        if 2 * share / 3 <= x < share:
            out.append("added")
    return " ".join(out)


def test_exact_edited_and_clean_documents(spark):
    rng = random.Random(4)
    items = [(k, prose(100 + k, 20 + k)) for k in range(12)] + [(50, prose(100, 20)), (51, "too short item"), (52, None), (None, "")]
    docs = [(i, prose(500 + i, 150)) for i in range(30)]
    for i, (k, x) in enumerate(items[:12]):
        body = prose(700 + i, 100)
        docs.append((1000 + i, f"{body[:300]} {x.upper()}! {body[300:]}"))
        docs.append((2000 + i, f"{body} {edited(rng, x, 0.2)} {body}"))
        docs.append((3000 + i, f"{body} {' '.join(x.split()[:6])} {body}"))  # a few words of it: clean
    docs += [(4000, items[3][1] + " " + prose(1, 50) + " " + items[4][1]), (4001, (prose(9, 40) + " ") * 200 + items[5][1]),
             (4002, "A.B," + re.sub(" ", "...\n", items[6][1]))]
    got = {(r.id, r.item_id): round(r.similarity, 9) for r in
           D.matches(documents(spark, docs), spark.createDataFrame(items, ITEM_SCHEMA)).collect()}
    expected = brute(docs, items)
    assert got == expected
    assert {(1000 + i, i) for i in range(12)} <= set(got) and (4000, 3) in got and (4000, 4) in got
    assert sum((2000 + i, i) in got for i in range(12)) >= 11
    assert not any(i < 1000 or 3000 <= i < 4000 for i, _ in got)


def test_span_is_that_of_the_copy(spark):
    item = prose(31, 25)
    docs = documents(spark, [(1, f"{prose(32, 40)} {item} {prose(33, 40)}")])
    row = D.matches(docs, spark.createDataFrame([(7, item)], ITEM_SCHEMA)).first()
    assert (row.word_start, row.word_end, row.item_words, row.similarity) == (40, 65, 25, 1.0)


def test_a_frequent_passage_is_found_in_every_document(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = documents(spark, [(i, f"{prose(i, 20)} {item} {prose(i + 500, 20)}") for i in range(300)])
    assert D.matches(docs, spark.createDataFrame([(1, item)], ITEM_SCHEMA)).count() == 300


def test_blocks_of_the_benchmark_change_nothing(spark):
    items = [(k, prose(100 + k, 30)) for k in range(9)]
    docs = documents(spark, [(k, f"{prose(k, 30)} {x}") for k, x in items])
    bench = spark.createDataFrame(items, ITEM_SCHEMA)
    one = sorted(map(tuple, D.matches(docs, bench).collect()))
    assert len(one) == 9 and one == sorted(map(tuple, D.matches(docs, bench, block_words=300).collect()))


def test_alignment_scores():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 6, (40, 9)).astype(np.uint64) + np.uint64(5), rng.integers(0, 6, (40, 15)).astype(np.uint64) + np.uint64(5)
    best, _ = D.smith_waterman(a, b)
    assert [x / 18 for x in best.tolist()] == pytest.approx([align(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)])


def test_words_of_many_texts():
    texts = ["", " a b\tc", "ab", "x" * 3_000_000 + " y", "é à", "a" * 1_048_576 + " b", " ".join(map(str, range(400_000)))]
    hashes, bounds = text_words([t.encode() for t in texts])
    assert np.diff(bounds).tolist() == [len(t.split()) for t in texts]
    every = {w: h for t, lo, hi in zip(texts, bounds, bounds[1:], strict=False)
             for w, h in zip(t.split(), hashes[lo:hi].tolist(), strict=True)}
    assert len(set(every.values())) == len(every)
    assert text_words([b"b,a a"], NOT_ALNUM)[0].tolist() == [every["b"], every["a"], every["a"]]


def test_odd_rows(spark, odd, nothing):
    bench = spark.createDataFrame([(1, prose(2, 80)), (None, prose(3, 80)), (2, None), (3, "")], ITEM_SCHEMA)
    kept = D.decontaminate(odd, bench)
    assert kept.schema == odd.schema
    gone = {prose(2, 80), prose(3, 80)}
    expected = [tuple(r) for r in odd.collect() if r.text not in gone]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(expected, key=repr)
    assert D.decontaminate(nothing, bench).collect() == []
    assert D.decontaminate(odd, bench.limit(0)).count() == odd.count()


def plain(docs, items):
    """All pairs aligned, whatever seeds they have."""
    pairs = ((i, k, words_of(t), words_of(x)) for i, t in docs for k, x in items)
    return {(i, k): round(s, 9) for i, k, b, a in pairs if len(a) >= 5 and (s := align(a, b)) >= D.MIN_SIMILARITY}


def matched(spark, docs, items):
    return {(r.id, r.item_id): round(r.similarity, 9) for r in
            D.matches(documents(spark, docs), spark.createDataFrame(items, ITEM_SCHEMA)).collect()}


def test_copies_without_five_words_in_a_row(spark):
    items = [(k, prose(100 + k, n)) for k, n in enumerate((40, 40, 40, 40, 23, 11, 7, 5))]
    docs = [(i, prose(500 + i, 60)) for i in range(10)]
    for k, x in items:
        own = x.split()
        for e, (step, replaced) in enumerate(((2, 0), (3, 0), (4, 0), (4, 1), (5, 1), (1, 0))):
            out = [w if not replaced or j % step else f"new{j}" for j, w in enumerate(own, 1)]
            if not replaced:
                out = [y for j, w in enumerate(own, 1) for y in ([w] if j % step or j == len(own) else [w, f"new{j}"])]
            docs.append((1000 + 10 * k + e, f"{prose(k, 30)} {' '.join(out)} {prose(k + 50, 30)}"))
    docs.append((9000, items[0][1]))  # an intact copy beside the edited ones
    expected = plain(docs, items)
    assert {(1000 + e, 0) for e in range(5)} | {(1070 + e, 7) for e in (0, 5)} <= set(expected)
    assert matched(spark, docs, items) == expected


def test_copies_with_long_insertions_and_deletions(spark):
    items = [(k, prose(100 + k, n)) for k, n in enumerate((40, 40, 25, 12))]
    docs = []
    for k, x in items:
        own, n = x.split(), len(x.split())
        for e, share in enumerate((0.3, 0.5, 0.75, 0.9)):
            more = prose(800 + 10 * k + e, int(share * n)).split()
            docs.append((100 * k + e, " ".join([prose(k, 30), *own[:n // 2], *more, *own[n // 2:], prose(k + 9, 30)])))
            thirds = [*own[:n // 3], *more[::2], *own[n // 3:2 * n // 3], *more[1::2], *own[2 * n // 3:]]
            docs.append((100 * k + 10 + e, " ".join([prose(k + 20, 30), *thirds])))
        docs.append((100 * k + 20, " ".join(own[:n // 3] + own[n // 2:])))
    expected = plain(docs, items)
    assert {0, 1, 2, 10, 11, 12, 20} <= {i for i, _ in expected} and not {3, 13} & {i for i, _ in expected}
    assert expected[1, 0] == 0.75
    assert matched(spark, docs, items) == expected
