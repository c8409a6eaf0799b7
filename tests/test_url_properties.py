"""Random URLs: native URL columns agree with Python's own URL parsing.

The hit files come from tools that use ``urllib.parse``. Known and documented
differences are excluded from generation: bracketed IPv6 hosts, encoded
parameter names, and invalid UTF-8 escapes. Leading junk, tabs and line
breaks anywhere are included: the parser drops them.
"""

from __future__ import annotations

import urllib.parse as up

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickcredit.functions import hostname, search_domain, search_keyword
from clickcredit.rules import DEFAULT_RULES

R = DEFAULT_RULES

_scheme = st.sampled_from(["http://", "https://", "HTTP://", "//", "", "ftp:", "x1+.-:", "1a://"])
_user = st.sampled_from(["", "u@", "u:p@", "a@b@"])
_label = st.sampled_from(["www", "google", "bing", "search", "yahoo", "co", "uk", "com", "basket",
                          "ask", "msn", "WWW", "Google", "g-1", "a_b", ""])
_port = st.sampled_from(["", ":80", ":", ":x"])
_path = st.sampled_from(["", "/", "/search", "/a/b", "/x?y"])
_pname = st.sampled_from(["q", "p", "query", "search", "Q", "qq", "x", "", "q ", "q\t"])
_pval = st.lists(st.sampled_from(["a", "B", "+", "%20", "%41", "%", "%2", "%25", "%C3%A9", "=", " ",
                                  "%09", "%0A", "ipod", "Zune", "é", "x y", "\t"]), max_size=5).map("".join)
_param = st.tuples(_pname, st.sampled_from(["=", ""]), _pval).map(lambda t: "".join(t))
_query = st.lists(_param, max_size=4).map(lambda ps: "?" + "&".join(ps) if ps else "")
_frag = st.sampled_from(["", "#", "#q=frag", "#a?q=x"])
_lead = st.sampled_from(["", " ", "\t", " \x01"])
_break = st.sampled_from(["", "", "", "\t", "\n", "\r\n"])


@st.composite
def urls(draw):
    host = ".".join(draw(st.lists(_label, min_size=1, max_size=4)))
    cut = draw(st.integers(0, len(host)))
    host = host[:cut] + draw(_break) + host[cut:]
    return (draw(_lead) + draw(_scheme) + draw(_break) + draw(_user) + host + draw(_port)
            + draw(_path) + draw(_query) + draw(_break) + draw(_frag))


def py_host(url):
    try:
        return up.urlparse(url).hostname or None
    except ValueError:
        return None


def py_domain(url):
    host = py_host(url)
    if not host:
        return None
    engine = next((e for e in R.engines if e in host), None)
    if engine is None:
        return None
    labels = host.split(".")
    return ".".join(labels[labels.index(engine):]) if engine in labels else host


def py_keyword(url):
    try:
        query = up.parse_qs(up.urlparse(url).query)
    except ValueError:
        return None
    for p in R.keyword_params:
        if query.get(p):
            kw = " ".join(query[p][0].split()).lower()
            return kw or None
    return None


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(urls(), min_size=20, max_size=40))
def test_url_columns_match_python(spark, batch):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(batch)], "i int, u string")
    got = df.select(
        "i",
        hostname(F.col("u")).alias("h"),
        search_domain(F.col("u"), R.engines).alias("d"),
        search_keyword(F.col("u"), R.keyword_params).alias("k"),
    ).orderBy("i").collect()
    for row, url in zip(got, batch):
        assert row.h == py_host(url), url
        assert row.d == py_domain(url), url
        assert row.k == py_keyword(url), url


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(urls(), min_size=20, max_size=40))
def test_enrichment_matches_python(spark, batch):
    """``enrich`` parses the raw URL first and cleans only when needed; same answers."""
    from clickcredit import operators as ops
    rows = [(i, 1000 + i, "1.1.1.1", "a", u, "1", "E;A;1;5;") for i, u in enumerate(batch)]
    df = spark.createDataFrame(rows, "event_id long, hit_ts long, ip string, user_agent string, "
                                     "referrer string, event_list string, product_list string")
    full = {r.event_id: r for r in ops.enrich(df).collect()}
    hosts = {r.event_id: r.referrer_host for r in ops.with_referrer_host(df).collect()}
    for i, url in enumerate(batch):
        assert hosts[i] == py_host(url), url
        assert full[i].domain == py_domain(url), url
        assert full[i].keyword == py_keyword(url), url
