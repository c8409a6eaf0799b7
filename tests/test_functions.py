"""Scalar column functions F1-F8, F11 on small literal inputs.

Each test builds one DataFrame of cases and checks all of them in one job.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickcredit.functions import (
    epoch_seconds,
    hit_revenue,
    hostname,
    is_external_search_referrer,
    is_purchase,
    money,
    search_domain,
    search_keyword,
    session_break,
)
from clickcredit.rules import DEFAULT_RULES

R = DEFAULT_RULES


def _apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


HOST_CASES = [
    ("http://www.google.com/search", "www.google.com"),
    ("", None),
    (None, None),
    ("http://U:p@WWW.Google.com:80/", "www.google.com"),
    ("www.google.com/search?q=x", None),
    ("//www.google.com/", "www.google.com"),
    ("HTTPS://Search.Yahoo.COM?p=x", "search.yahoo.com"),
    ("http://a@b@host.com/", "host.com"),
    ("http://:80/", None),
    ("http:///path", None),
    ("http://user@:80", None),
    ("1http://x.com/", None),
    ("http:www.google.com", None),
    ("  http://lead.space.com/", "lead.space.com"),
    ("http://tab\tbed.com/", "tabbed.com"),
    ("http://host.com#frag", "host.com"),
    ("http://host.com?x=1", "host.com"),
    ("http://[::1]:80/", "::1"),
    ("http://u:p@[2001:DB8::7%25eth0]/a?b", "2001:db8::7%25eth0"),
    ("//[1::2.3.4.5]#f", "1::2.3.4.5"),
    ("http://[::1]x/", None),
    ("http://[]/", None),
    ("http://host:[80/", None),
    ("http://www.host_name.com/", "www.host_name.com"),
    ("mailto:someone@example.com", None),
]


def test_hostname(spark):
    got = _apply(spark, [c for c, _ in HOST_CASES], hostname)
    assert got == [e for _, e in HOST_CASES]


FLAG_CASES = [
    ("http://search.yahoo.com/search?p=test", True),
    ("http://www.esshopzilla.com/checkout/", False),
    ("http://www.google.com/search?q=x", True),
    ("http://www.facebook.com/", False),
    ("", False),
    (None, False),
    ("not a url", False),
    ("http://google.esshopzilla.com/", False),
]


def test_external_search_referrer(spark):
    fn = lambda c: is_external_search_referrer(c, R.engines, R.site_domain)
    assert _apply(spark, [c for c, _ in FLAG_CASES], fn) == [e for _, e in FLAG_CASES]


def test_external_search_referrer_without_site(spark):
    fn = lambda c: is_external_search_referrer(c, R.engines, "")
    assert _apply(spark, ["http://google.esshopzilla.com/"], fn) == [True]


DOMAIN_CASES = [
    ("http://search.yahoo.com/search?p=cd+player", "yahoo.com"),
    ("http://www.facebook.com", None),
    ("http://www.google.com/search?q=ipod", "google.com"),
    ("http://www.bing.com/search?q=zune", "bing.com"),
    ("http://www.esshopzilla.com", None),
    ("https://www.google.co.uk/", "google.co.uk"),
    ("http://www.basket.com/", "www.basket.com"),
    ("http://googlebing.com/", "googlebing.com"),
    ("http://bing.google.com/", "google.com"),
    ("http://www.msn.ask.com/", "msn.ask.com"),
    ("http://www.google.google.com/", "google.google.com"),
    ("", None),
    (None, None),
    ("www.google.com/search?q=noscheme", None),
]


def test_search_domain(spark):
    fn = lambda c: search_domain(c, R.engines)
    assert _apply(spark, [c for c, _ in DOMAIN_CASES], fn) == [e for _, e in DOMAIN_CASES]


KEYWORD_CASES = [
    ("http://www.google.com/search?hl=en&q=Ipod&oq=", "ipod"),
    ("http://www.google.com/search?q=ipod++nano", "ipod nano"),
    ("http://www.google.com/search?q=", None),
    ("http://search.yahoo.com/search?p=cd+player", "cd player"),
    ("http://www.bing.com/search?q=Zune", "zune"),
    ("http://g.com/?q=&p=x", "x"),
    ("http://g.com/?q=+&p=x", None),
    ("http://g.com/?q=a&q=b", "a"),
    ("http://g.com/?q=&q=b", "b"),
    ("http://g.com/?q=100%", "100%"),
    ("http://g.com/?q=100%25", "100%"),
    ("http://g.com/#q=x", None),
    ("http://g.com/?x=1#q=x", None),
    ("http://g.com/?search=A%20B&p=z", "z"),
    ("http://g.com/?query=Hello%2BWorld", "hello+world"),
    ("http://g.com/?q=a=b", "a=b"),
    ("http://g.com/?Q=x", None),
    ("http://g.com/?qq=x", None),
    ("http://g.com/?q=%C3%89t%C3%A9", "été"),
    ("http://g.com/?q=%20%09x%0Ay%20", "x y"),
    ("www.google.com/search?q=noscheme", "noscheme"),
    ("", None),
    (None, None),
]


def test_search_keyword(spark):
    fn = lambda c: search_keyword(c, R.keyword_params)
    assert _apply(spark, [c for c, _ in KEYWORD_CASES], fn) == [e for _, e in KEYWORD_CASES]


PURCHASE_CASES = [
    ("1", True), ("2,1", True), ("2", False), ("", False), (None, False), ("11", False),
    ("12", False), ("11, 1 ", True), ("2, 1", True), (" 1", True), ("1,", True),
    (" 1\t", True), ("21", False), ("1 1", False),
]


def test_purchase_flag(spark):
    fn = lambda c: is_purchase(c, R.purchase_event)
    assert _apply(spark, [c for c, _ in PURCHASE_CASES], fn) == [e for _, e in PURCHASE_CASES]


REVENUE_CASES = [
    ("Electronics;Ipod;1;290;", 290.0),
    ("Electronics;A;1;100;,Electronics;B;1;50;", 150.0),
    ("A;B", 0.0),
    ("", 0.0),
    (None, 0.0),
    ("Electronics;Ipod;1;;", 0.0),
    ("E;A;1;100;, E;B;1;x;,E;C;1;;,A;B,E;D;1;50", 150.0),
    ("E;TV, 32in;1;100;", 0.0),
    ("E;A;1; 10.50 ;200=1", 10.5),
    ("E;A;1;1e2", 100.0),
    ("E;A;1;-5;", -5.0),
    ("E;A;1;.5;", 0.5),
    ("E;A;1;5.;", 5.0),
    ("E;A;1;nan;", 0.0),
    ("E;A;1;inf;", 0.0),
    ("E;A;1;1_000;", 0.0),
    ("E;A;1;12abc;", 0.0),
    (";;;7", 7.0),
]


def test_hit_revenue(spark):
    got = _apply(spark, [c for c, _ in REVENUE_CASES], hit_revenue)
    assert got == pytest.approx([e for _, e in REVENUE_CASES])


def test_epoch_seconds_from_strings_and_timestamps(spark):
    df = spark.createDataFrame([("1254033280",), (" 42 ",), (None,)], "s string")
    got = [r.t for r in df.select(epoch_seconds(F.col("s")).alias("t")).collect()]
    assert got == [1254033280, 42, None]
    ts = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.9' AS a, "
                   "TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS b")
    row = ts.select(epoch_seconds(F.col("a"), ts.schema["a"].dataType).alias("a"),
                    epoch_seconds(F.col("b"), ts.schema["b"].dataType).alias("b")).first()
    assert (row.a, row.b) == (1704067207, -1)


def test_session_break(spark):
    got = _apply(spark, [None, 0, 1800, 1801, -3], lambda c: session_break(c, 1800), "bigint")
    assert got == [1, 0, 0, 1, 0]


def test_money(spark):
    got = _apply(spark, [480.0, 0.125, 1.005, 249.999, 0.0], money, "double")
    assert got == ["480.00", "0.13", "1.01", "250.00", "0.00"]
