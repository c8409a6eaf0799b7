"""Session operators W1 (gap) and W2 (session number) against a brute-force model."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from clickcredit import operators as ops
from conftest import hits_df

T = 1_000_000


def _rows(seed: int, n: int, null_share: float = 0.05):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        visitor = rnd.choice([("1", "a"), ("1", "b"), ("2", "a"), (None, "a"), ("3", None)])
        ts = None if rnd.random() < null_share else T + rnd.choice([0, 1, 5, 900, 1800, 1801, 4000]) * rnd.randrange(4)
        out.append((ts, visitor[0], visitor[1], "", "", ""))
    return out


def _model(rows, timeout):
    """gap and session_id per event_id; NULL keys group together, like a window partition."""
    by_visitor = defaultdict(list)
    for i, r in enumerate(rows):
        by_visitor[(r[1], r[2])].append((i, r[0]))
    gap, sid = {}, {}
    for hits in by_visitor.values():
        prev, n = None, 0
        for i, ts in sorted((h for h in hits if h[1] is not None), key=lambda h: (h[1], h[0])):
            g = None if prev is None else ts - prev
            if g is None or g > timeout:
                n += 1
            gap[i], sid[i], prev = g, n, ts
        for i, ts in hits:
            if ts is None:
                gap[i], sid[i] = None, -1 - i  # a session of its own
    return gap, sid


@pytest.mark.parametrize("seed", [11, 12])
def test_inactivity_gap(spark, seed):
    rows = _rows(seed, 300)
    expected, _ = _model(rows, 1800)
    for width in (1800, 1, 37):
        got = ops.inactivity_gap(hits_df(spark, rows), tie="event_id", bucket_seconds=width)
        assert {r.event_id: r.gap for r in got.select("event_id", "gap").collect()} == expected


@pytest.mark.parametrize("seed,timeout", [(21, 1800), (22, 0), (23, 4000)])
def test_session_numbers(spark, seed, timeout):
    rows = _rows(seed, 300)
    _, expected = _model(rows, timeout)
    got = ops.session_numbers(hits_df(spark, rows), timeout, tie="event_id")
    assert {r.event_id: r.session_id for r in got.select("event_id", "session_id").collect()} == expected


def test_session_numbers_keep_all_columns_and_rows(spark):
    rows = _rows(31, 50)
    df = hits_df(spark, rows)
    got = ops.session_numbers(df, 1800)
    assert got.columns == df.columns + ["session_id"]
    assert got.count() == len(rows)


def test_first_touch_and_purchase_hits(spark):
    rows = [(T, "1", "a", "http://www.google.com/search?q=a", "", ""),
            (T + 10, "1", "a", "http://www.bing.com/search?q=b", "1", "E;X;1;5;"),
            (T + 5000, "1", "a", "", "1", "E;X;1;7;"),
            (T + 5001, "1", "a", "", "1", "E;X;1;0;")]
    enriched = ops.enrich(hits_df(spark, rows))
    ft = [tuple(r) for r in ops.first_touch(enriched, tie="event_id").collect()]
    assert ft == [("1", "a", 1, "google.com", "a")]
    ph = sorted((r.event_id, r.session_id, r.revenue) for r in ops.purchase_hits(enriched).collect())
    assert ph == [(1, 1, 5.0), (2, 2, 7.0)]
    ap = [(r.event_id, r.domain, r.keyword) for r in ops.attributed_purchases(enriched, tie="event_id").collect()]
    assert ap == [(1, "google.com", "a")]
