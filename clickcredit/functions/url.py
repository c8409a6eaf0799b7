"""Referrer URL columns: host name, search engine domain, search keyword.

All functions map ``Column -> Column`` and compile to JVM expressions, so
they stay inside whole-stage codegen and add no Python hop per row.

URL splitting follows the usual generic-URL rules: an optional scheme
(letter first, then letters, digits, ``+ - .``) and ``:``; an authority only
after ``//``; the host is the authority after the last ``@`` and before the
port; the query runs from the first ``?`` to the first ``#``. Leading control
characters and spaces, and any tab or line break, are dropped first.

A bracketed IPv6 host gives the address without its brackets. Known limit:
percent-encoded parameter names (``%71=x``) are not decoded, so they never
match a keyword parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_CLASS, collapse_ws, regex_literal

_CLEAN_RE = r"^[\x00-\x20]+|[\t\r\n]"
# (?i) scheme? // userinfo@? host, where the host is followed by a port, a
# path, a query, a fragment or the end, and no bracket is left in the
# authority. Only the extracted host is lower-cased.
_HOST = r"^(?i:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#@:\[\]]*)(?![^/?#]*[\[\]])"
# the same with an IPv6 address (and an optional zone) in brackets
_BRACKETED = r"^(?i:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#]*@)?\[([0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(?:%[^/?#\[\]]*)?)\](?::[^/?#\[\]]*)?(?=[/?#]|$)"
#: A length that no text reaches.
_WHOLE = (1 << 31) - 1
_STRAY_PERCENT = r"%(?![0-9A-Fa-f]{2})"


def clean_url(url: Column) -> Column:
    """Drop leading control characters / spaces and embedded tabs and breaks.

    The usual URL needs none of this; byte searches find that out, and the
    regex runs only on a URL that needs cleaning.
    """
    needs = ((F.ascii(url) <= 32) | (F.instr(url, "\t") > 0)
             | (F.instr(url, "\r") > 0) | (F.instr(url, "\n") > 0))
    return F.when(needs, F.regexp_replace(url, _CLEAN_RE, "")).otherwise(url)


def authority_of_clean(clean: Column) -> Column:
    """What stands between ``//`` and the path of a cleaned ``http(s)`` URL, by byte searches; else NULL."""
    rest = F.when(F.substring_index(clean, "//", 1).isin("http:", "https:"),
                  F.substring(clean, F.instr(clean, "//") + 2, F.lit(_WHOLE)))
    for mark in "/?#":
        rest = F.substring_index(rest, mark, 1)
    return rest


def host_of_clean(clean: Column, authority: Column | None = None) -> Column:
    """F1 on a URL that already went through ``clean_url``.

    Nearly every authority is a plain host. The patterns run only where it
    holds more, or the URL starts otherwise. ``authority`` is
    ``authority_of_clean``, if it is a column already.
    """
    authority = authority_of_clean(clean) if authority is None else authority
    simple = F.translate(authority, "@:[]", "") == authority
    plain = F.lower(F.regexp_extract(clean, _HOST, 1))
    # few URLs hold a bracket; the byte search spares the others the second pattern
    bracketed = F.lower(F.regexp_extract(clean, _BRACKETED, 1))
    return F.nullif(F.when(simple, F.lower(authority))
                    .when(F.instr(clean, "[") > 0, F.coalesce(F.nullif(plain, F.lit("")), bracketed))
                    .otherwise(plain), F.lit(""))


def query_of_clean(clean: Column) -> Column:
    """Raw query text of a cleaned URL (empty when there is none): from the first ``?`` to the first ``#``."""
    before = F.substring_index(clean, "#", 1)
    return F.substring(before, F.length(F.substring_index(before, "?", 1)) + 2, F.lit(_WHOLE))


def hostname(url: Column) -> Column:
    """F1. Lower-case host of a URL; NULL when there is no authority or host."""
    return host_of_clean(clean_url(url))


def query_string(url: Column) -> Column:
    """Raw query text of a URL (empty when there is none)."""
    return query_of_clean(clean_url(url))


def is_external_search_host(host: Column, engines: Sequence[str], site_domain: str = "") -> Column:
    """F2 on an already extracted host."""
    any_engine = None
    for name in engines:
        hit = host.contains(name)
        any_engine = hit if any_engine is None else (any_engine | hit)
    cond = host.isNotNull() & any_engine
    if site_domain:
        cond = cond & ~host.contains(site_domain)
    return F.coalesce(cond, F.lit(False))


def is_external_search_referrer(url: Column, engines: Sequence[str],
                                site_domain: str = "") -> Column:
    """F2. True when the host names a search engine and is not the own site.

    Spark does not share an expression that only later CASE / OR branches
    use, so on large inputs project ``hostname`` once and use
    ``is_external_search_host`` (as ``with_referrer_host`` does).
    """
    return is_external_search_host(hostname(url), engines, site_domain)


def engine_of_host(host: Column, engines: Sequence[str]) -> Column:
    """The first engine (list order) that is a substring of the host, else NULL."""
    out = None
    for name in engines:
        out = F.when(host.contains(name), name) if out is None else out.when(host.contains(name), name)
    return out


def domain_of_engine(host: Column, engine: Column) -> Column:
    """``host`` from its first label equal to ``engine`` on, else the whole host; NULL without an engine."""
    # position of ".name." in ".host." is where the label starts in host; a label never holds a dot
    pos = F.when(F.instr(engine, ".") == 0,
                 F.instr(F.concat(F.lit("."), host, F.lit(".")), F.concat(F.lit("."), engine, F.lit("."))))
    return F.when(engine.isNotNull(), F.substring(host, F.greatest(pos, F.lit(1)), F.length(host)))


def search_domain_of_host(host: Column, engines: Sequence[str]) -> Column:
    """F3 on an already extracted host."""
    return domain_of_engine(host, engine_of_host(host, engines))


def search_domain(url: Column, engines: Sequence[str]) -> Column:
    """F3. Search engine domain of a referrer.

    The first engine (list order) that is a substring of the host decides.
    When a host label equals it, the labels from there on are kept
    (``www.google.co.uk`` -> ``google.co.uk``); otherwise the whole host is
    returned (``www.basket.com`` for ``ask``). NULL when no engine matches.
    On large inputs project ``hostname`` once and use ``search_domain_of_host``.
    """
    return search_domain_of_host(hostname(url), engines)


def decode_query_value(raw: Column) -> Column:
    """Form-decode a raw query value: ``+`` is a space, ``%XX`` a byte, UTF-8.

    A ``%`` that does not start a two-digit hex escape is kept as it is.
    Without any ``%`` only the ``+`` have to be replaced.
    """
    return (F.when(F.instr(raw, "%") > 0, F.url_decode(F.regexp_replace(raw, _STRAY_PERCENT, "%25")))
            .otherwise(F.translate(raw, "+", " ")))


def raw_keyword(query: Column, keyword_params: Sequence[str]) -> Column:
    """The raw value of the first parameter (list order) that has a non-empty one, else NULL.

    A byte search finds out whether a parameter occurs, so its pattern runs only where it does.
    """
    pairs = F.concat(F.lit("&"), query)
    raws = [
        F.when(pairs.contains(f"&{p}="),
               F.get(F.regexp_extract_all(query, F.lit(rf"(?:^|&){regex_literal(p)}=([^&]+)"), 1), 0))
        for p in keyword_params
    ]
    return raws[0] if len(raws) == 1 else F.coalesce(*raws)


def keyword_of_raw(raw: Column) -> Column:
    """The keyword of a raw value: decoded, white space collapsed, lower case; NULL if blank."""
    return F.nullif(F.lower(collapse_ws(decode_query_value(raw))), F.lit(""))


def keyword_of_query(query: Column, keyword_params: Sequence[str]) -> Column:
    """F4 on raw query text (see ``search_keyword``)."""
    return keyword_of_raw(raw_keyword(query, keyword_params))


def search_keyword(url: Column, keyword_params: Sequence[str]) -> Column:
    """F4. Search keyword of a referrer.

    The first parameter (list order) that has a non-empty raw value decides;
    its first such value is decoded, whitespace-collapsed and lower-cased.
    NULL when no parameter has a value, or when the value is blank after
    decoding (``?q=+``); blank raw values are skipped (``?q=&p=x`` -> ``x``).
    """
    return keyword_of_query(query_string(url), keyword_params)


__all__ = [
    "WHITESPACE_CLASS",
    "authority_of_clean",
    "clean_url",
    "decode_query_value",
    "domain_of_engine",
    "engine_of_host",
    "host_of_clean",
    "hostname",
    "is_external_search_host",
    "is_external_search_referrer",
    "keyword_of_query",
    "keyword_of_raw",
    "query_of_clean",
    "query_string",
    "raw_keyword",
    "search_domain",
    "search_domain_of_host",
    "search_keyword",
]
