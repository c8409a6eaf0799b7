"""Attribution end to end on small tables, and against a brute-force model."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from clickcredit import operators as ops
from clickcredit.plans import search_revenue
from clickcredit.rules import DEFAULT_RULES
from conftest import hits_df

T = 1_000_000
G = "http://www.google.com/search?q={}"
B = "http://www.bing.com/search?q={}"
SHOP = "http://www.esshopzilla.com/cart/"


def _buy(amount):
    return f"Electronics;Item;1;{amount};"


def report(spark, rows, timeout=1800, with_id=True, **kw):
    rules = DEFAULT_RULES.with_timeout(timeout)
    df = search_revenue(hits_df(spark, rows, with_id), rules,
                        tie="event_id" if with_id else None, **kw)
    return [(r[0], r[1], round(r[2], 2)) for r in df.collect()]


CASES = {
    "no purchase": ([(T, "7.7.7.1", "Probe", G.format("lamp"), "2", "")], []),
    "no search referrer": ([(T, "7.7.7.1", "Probe", "", "1", _buy(41))], []),
    "timeout": ([(T, "7.7.7.2", "Probe", G.format("kettle"), "", ""),
                 (T + 2345, "7.7.7.2", "Probe", SHOP, "1", _buy(64))], []),
    "inside session": ([(T, "7.7.7.3", "Probe", B.format("easel"), "", ""),
                        (T + 777, "7.7.7.3", "Probe", SHOP, "1", _buy(88))],
                       [("bing.com", "easel", 88.0)]),
    "two sessions": ([(T, "7.7.7.4", "Reader", G.format("anvil"), "", ""),
                      (T + 250, "7.7.7.4", "Reader", SHOP, "", ""),
                      (T + 910, "7.7.7.4", "Reader", SHOP, "1", _buy(72)),
                      (T + 4321, "7.7.7.4", "Reader", B.format("tongs"), "", ""),
                      (T + 4400, "7.7.7.4", "Reader", SHOP, "1", _buy(13))],
                     [("google.com", "anvil", 72.0), ("bing.com", "tongs", 13.0)]),
    "exactly 1800": ([(T, "1.1.1.1", "X", G.format("a"), "", ""),
                      (T + 1800, "1.1.1.1", "X", SHOP, "1", _buy(10))],
                     [("google.com", "a", 10.0)]),
    "1801": ([(T, "1.1.1.1", "X", G.format("a"), "", ""),
              (T + 1801, "1.1.1.1", "X", SHOP, "1", _buy(10))], []),
    "purchase before touch": ([(T, "1.1.1.1", "X", SHOP, "1", _buy(10)),
                               (T + 60, "1.1.1.1", "X", G.format("a"), "", "")],
                              [("google.com", "a", 10.0)]),
    "two touches": ([(T, "1.1.1.1", "X", G.format("a"), "", ""),
                     (T + 60, "1.1.1.1", "X", B.format("b"), "", ""),
                     (T + 120, "1.1.1.1", "X", SHOP, "1", _buy(10))],
                    [("google.com", "a", 10.0)]),
    "touch without keyword": ([(T, "1.1.1.1", "X", "http://www.google.com/", "", ""),
                               (T + 60, "1.1.1.1", "X", B.format("b"), "", ""),
                               (T + 120, "1.1.1.1", "X", SHOP, "1", _buy(10))],
                              [("bing.com", "b", 10.0)]),
    "null agent": ([(T, "7.7.7.5", None, B.format("easel"), "", ""),
                    (T + 777, "7.7.7.5", None, SHOP, "1", _buy(88))], []),
    "same ip two agents": ([(T, "1.1.1.1", "X", G.format("a"), "", ""),
                            (T + 60, "1.1.1.1", "Y", SHOP, "1", _buy(10))], []),
    "revenue not positive": ([(T, "1.1.1.1", "X", G.format("a"), "", ""),
                              (T + 10, "1.1.1.1", "X", SHOP, "1", _buy(0)),
                              (T + 20, "1.1.1.1", "X", SHOP, "1", _buy(-5))], []),
    "untimed purchase with own touch": ([(None, "1.1.1.1", "X", G.format("a"), "1", _buy(7)),
                                         (None, "1.1.1.1", "X", G.format("a"), "1", _buy(3)),
                                         (None, "1.1.1.1", "X", SHOP, "1", _buy(9))],
                                        [("google.com", "a", 10.0)]),
    "untimed touch does not join timed session": (
        [(None, "1.1.1.1", "X", G.format("a"), "", ""),
         (T, "1.1.1.1", "X", SHOP, "1", _buy(5))], []),
    "chain of short gaps": ([(T + 1000 * i, "9.9.9.9", "Z", G.format("chain") if i == 0 else SHOP,
                              "1" if i == 9 else "", _buy(1) if i == 9 else "") for i in range(10)],
                            [("google.com", "chain", 1.0)]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_table_case(spark, name):
    rows, expected = CASES[name]
    assert sorted(report(spark, rows)) == sorted(expected)


def test_empty_input(spark):
    assert report(spark, []) == []


def test_six_hour_timeout_joins_sessions(spark):
    rows = CASES["timeout"][0]
    assert report(spark, rows, timeout=21600) == [("google.com", "kettle", 64.0)]


def test_without_tie_column(spark):
    rows, expected = CASES["two sessions"]
    assert sorted(report(spark, rows, with_id=False)) == sorted(expected)


def test_tie_on_equal_times_uses_tie_then_text(spark):
    rows = [(T, "1.1.1.1", "X", B.format("zz"), "", ""),
            (T, "1.1.1.1", "X", G.format("aa"), "", ""),
            (T + 5, "1.1.1.1", "X", SHOP, "1", _buy(4))]
    assert report(spark, rows) == [("bing.com", "zz", 4.0)]       # lower event_id first
    assert report(spark, rows, with_id=False) == [("bing.com", "zz", 4.0)]  # 'bing' < 'google'


def test_hits_without_a_time_mean_the_same_everywhere(spark):
    """Two untimed hits of one visitor are two sessions, in every operator."""
    rows = [(None, "1.1.1.1", "X", G.format("a"), "1", _buy(7)), (None, "1.1.1.1", "X", G.format("a"), "1", _buy(3)),
            (T, "1.1.1.1", "X", B.format("b"), "1", _buy(5)), (None, "1.1.1.1", "X", B.format("c"), "", "")]
    enriched = ops.enrich(hits_df(spark, rows))
    touches = {(r.session_id, r.keyword) for r in ops.first_touch(enriched, tie="event_id").collect()}
    assert touches == {(-1, "a"), (-2, "a"), (1, "b"), (-4, "c")}
    numbers = {r.event_id: r.session_id for r in ops.session_numbers(enriched, 1800, tie="event_id").collect()}
    assert numbers == {0: -1, 1: -2, 2: 1, 3: -4}
    bought = ops.purchase_hits(enriched, tie="event_id")
    assert {(r.event_id, r.session_id) for r in bought.collect()} == {(0, -1), (1, -2), (2, 1)}
    joined = ops.attribute(bought, ops.first_touch(enriched, tie="event_id"))
    assert sorted((r.keyword, r.revenue) for r in joined.collect()) == [("a", 3.0), ("a", 7.0), ("b", 5.0)]
    assert report(spark, rows) == report(spark, rows, with_id=False) == [("google.com", "a", 10.0), ("bing.com", "b", 5.0)]


def test_groups_rank_by_their_raw_revenue(spark):
    rows = [(T, "1.1.1.1", "X", G.format("less"), "1", _buy("0.0041")),
            (T, "1.1.1.2", "X", G.format("more"), "1", _buy("0.0042"))]
    found = search_revenue(hits_df(spark, rows), tie="event_id")
    assert [(r[1], r[2]) for r in found.collect()] == [("more", 0.0042), ("less", 0.0041)]
    assert [r[2] for r in ops.keyword_report(found).collect()] == ["0.00", "0.00"]


def test_bucket_width_does_not_change_sessions(spark):
    rows = [(T + s, "1.1.1.1", "X", G.format(f"k{s}") if s % 3 == 0 else SHOP,
             "1" if s % 5 == 0 else "", _buy(1)) for s in (0, 100, 1700, 1900, 3600, 5401, 7300, 7301)]
    base = sorted(report(spark, rows))
    for width in (1, 7, 900, 1801):
        assert sorted(report(spark, rows, bucket_seconds=width)) == base
    with pytest.raises(ValueError):
        report(spark, rows, bucket_seconds=1802)


# ---------------------------------------------------------------------------
# brute force: Python model of the session rules on random hits

ENGINE_URLS = [G, B, "http://search.yahoo.com/search?p={}", "http://www.basket.com/?query={}"]


def _random_hits(seed: int, n: int):
    rnd = random.Random(seed)
    visitors = [("10.0.0.1", "a"), ("10.0.0.1", "b"), ("10.0.0.2", "a"), ("10.0.0.3", "c")]
    rows = []
    for _ in range(n):
        ip, ua = visitors[min(rnd.randrange(6), 3)]  # visitor 3 is hot
        ts = None if rnd.random() < 0.03 else T + rnd.randrange(0, 20000)
        kind = rnd.random()
        if kind < 0.3:
            ref = rnd.choice(ENGINE_URLS).format(rnd.choice(["x", "y", "z"]))
        elif kind < 0.35:
            ref = "http://www.google.com/search?hl=en"
        else:
            ref = SHOP
        buy = rnd.random() < 0.3
        rows.append((ts, ip, ua, ref, "1" if buy else "2",
                     _buy(rnd.choice([0, 5, 12.5, 40])) if buy else ""))
    return rows


def _model(rows, timeout):
    """Sessions per visitor in (time, id) order; untimed hits alone; first touch by (time, id)."""
    import urllib.parse as up

    def touch(ref):
        host = (up.urlparse(ref).hostname or "")
        dom = next((e for e in DEFAULT_RULES.engines if e in host), None)
        if not dom:
            return None
        labels = host.split(".")
        dom = ".".join(labels[labels.index(dom):]) if dom in labels else host
        q = up.parse_qs(up.urlparse(ref).query)
        for p in DEFAULT_RULES.keyword_params:
            if q.get(p):
                kw = " ".join(q[p][0].split()).lower()
                return (dom, kw) if kw else None
        return None

    by_visitor = defaultdict(list)
    for i, r in enumerate(rows):
        by_visitor[(r[1], r[2])].append((i,) + tuple(r))
    out = defaultdict(float)
    for hits in by_visitor.values():
        timed = sorted((h for h in hits if h[1] is not None), key=lambda h: (h[1], h[0]))
        sessions, prev = [], None
        for h in timed:
            if prev is None or h[1] - prev > timeout:
                sessions.append([])
            sessions[-1].append(h)
            prev = h[1]
        sessions += [[h] for h in hits if h[1] is None]
        for s in sessions:
            first = next((touch(h[4]) for h in s if touch(h[4])), None)
            paid = sum(float(h[6].split(";")[3]) for h in s
                       if h[5] == "1" and h[6] and float(h[6].split(";")[3]) > 0)
            if first and paid > 0:
                out[first] += paid
    return sorted((d, k, round(v, 2)) for (d, k), v in out.items())


@pytest.mark.parametrize("seed,timeout", [(1, 1800), (2, 600), (3, 21600), (4, 0)])
def test_matches_brute_force(spark, seed, timeout):
    rows = _random_hits(seed, 400)
    assert sorted(report(spark, rows, timeout=timeout)) == _model(rows, timeout)


def test_operators_agree_with_each_other(spark):
    """J1 (literal join of purchase_hits and first_touch) equals the bucket-join path."""
    rows = _random_hits(7, 300)
    enriched = ops.enrich(hits_df(spark, rows))
    via_join = ops.attribute(ops.purchase_hits(enriched, tie="event_id"), ops.first_touch(enriched, tie="event_id"))
    via_buckets = ops.attributed_purchases(enriched, tie="event_id")
    cols = ["event_id", "domain", "keyword", "revenue"]
    joined = sorted(tuple(r) for r in via_join.select(cols).collect())
    bucketed = sorted(tuple(r) for r in via_buckets.select(cols).collect())
    assert joined == bucketed and joined
    total = sum(r[3] for r in via_buckets.select(cols).collect())
    report_total = sum(r[2] for r in ops.keyword_revenue(enriched, tie="event_id").collect())
    assert round(total, 2) == pytest.approx(report_total)


def test_group_count_and_report_format(spark):
    rows, _ = CASES["two sessions"]
    rep = search_revenue(hits_df(spark, rows), tie="event_id")
    assert ops.group_count(rep).first().groups == 2
    text = ops.keyword_report(rep).collect()
    assert [tuple(r) for r in text] == [("google.com", "anvil", "72.00"), ("bing.com", "tongs", "13.00")]
