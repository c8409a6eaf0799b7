from __future__ import annotations

import random

import numpy as np
import pytest

from clickcredit.llm import hard_negatives as M

SCHEMA = "vec_id bigint, vec array<bigint>, label int, is_anchor boolean"


def brute(rows, positives=5, negatives=5, low=80, high=100, scale=100):
    """By the definition, over all pairs."""
    out = []
    rows = [(i, v, x, a, n) for n, (i, v, x, a) in enumerate(rows) if None not in (i, v, x)]

    def dot(a, b):
        return sum(p * q for p, q in zip(a, b, strict=False))

    for i, v, x, is_anchor, n in rows:
        if not is_anchor:
            continue
        same = sorted((-dot(v, w), j, m) for j, w, y, _, m in rows if y == x and m != n)[:positives]
        others = sorted((-dot(v, w), j, m) for j, w, y, _, m in rows if y != x)
        for p, j, _ in same:
            inside = [(s, k) for s, k, _ in others if low * -p <= scale * -s <= high * -p][:negatives]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(inside, 1)]
    return sorted(out)


def vectors(seed, count, dims=8, clusters=6, spread=12):
    rng = random.Random(seed)
    centres = [[rng.randint(-60, 60) for _ in range(dims)] for _ in range(clusters)]
    return [(i, [c + rng.randint(-spread, spread) for c in rng.choice(centres)], rng.randrange(4), i % 10 == 0)
            for i in range(count)]


def mined(spark, rows, **kw):
    return sorted(tuple(r) for r in M.mine(spark.createDataFrame(rows, SCHEMA), "is_anchor", **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"fanout": 3, "depth": 4, "sample_rows": 60, "anchor_block": 7},
                                {"fanout": 1, "depth": 1}, {"sample_rows": 1}])
def test_as_over_all_pairs(spark, kw):
    rows = vectors(1, 400)
    expected = brute(rows)
    assert len(expected) > 200 and mined(spark, rows, **kw) == expected


def test_other_counts_and_windows(spark):
    rows = vectors(2, 200)
    for kw in ({"positives": 2, "negatives": 9}, {"low": 50, "high": 95}, {"low": 0, "high": 1, "scale": 1}):
        assert mined(spark, rows, **kw) == brute(rows, **kw)


def test_ties_repeats_and_a_hot_vector(spark):
    rng = random.Random(3)
    rows = vectors(3, 200, dims=3, clusters=3, spread=2)
    hot = [20, -10, 5]
    rows += [(1000 + i, hot, rng.randrange(3), i % 25 == 0) for i in range(150)]
    rows += [rows[0], rows[0], rows[10], (10, [1, 2, 3], 0, True), (10, [1, 2, 3], 1, True)]
    rows += [(2000, [0, 0, 0], 0, True), (2001, [-20, 10, -5], 3, True), (2002, [], 1, True), (2003, [7], 2, True)]
    expected = brute(rows)
    got = mined(spark, rows)
    # anchors that share an id and differ are rows of their own: compare as multisets
    assert got == expected
    assert mined(spark, rows, fanout=4, depth=3, anchor_block=3) == expected


def test_scores_beyond_float_precision(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-2**27, 2**27) for _ in range(6)], i % 3, i % 6 == 0) for i in range(80)]
    expected = brute(rows)
    assert max(r[4] for r in expected) > 2**53 and mined(spark, rows) == expected


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, [0.5, float("nan")], 1), (2, [0.5, float("inf")], 1), (3, [0.5, None], 1), (4, None, 1), (5, [0.1, 0.2], None),
         (None, [0.1, 0.2], 1), (6, [0.25, -0.3], 1), (7, [], 2)], "vec_id bigint, vec array<float>, label int")
    left = M.usable(df, "vec", "vec_id", "label").select("vec_id", M.quantised(df["vec"]).alias("vec")).collect()
    assert {r.vec_id: r.vec for r in left} == {6: [64, -77], 7: []}
    assert mined(spark, []) == []
    assert mined(spark, [(None, [1], 1, True), (1, None, 1, True), (2, [1], None, True), (3, [1], 1, None)]) == []
    assert mined(spark, [(1, [1], 1, True)]) == [] and mined(spark, [(1, [1], 1, True), (2, [1], 1, False)]) == []
    from pyspark.sql import functions as F
    rows = vectors(5, 60)
    extra = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("row", "id", "leaf", "anchor", "score")])
    assert sorted(tuple(r) for r in M.mine(extra, "is_anchor").collect()) == brute(rows)


def test_ranges_hold_every_score():
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (500, 4)).astype(np.float64)
    tree = M.grow(x[:100], float((x ** 2).sum(axis=1).max()), 5, 3)
    ranges = M.Ranges.empty(tree)
    ranges.add(tree, x[:250])
    ranges.add(tree, x[250:])
    low, high = M.score_bounds(tree, ranges, x[:40])
    leaves, scores = tree.leaves_of(x), x[:40] @ x.T
    assert (low[:, leaves] <= scores).all() and (scores <= high[:, leaves]).all()
    # near rows let whole subtrees be passed over
    assert (high < np.sort(scores, axis=1)[:, -5:-4]).mean() > 0.2
