"""Scalar column functions (F1-F8, F11): native Spark expressions only."""

from .hits import epoch_seconds, hit_revenue, is_purchase, money, session_break
from .text import WHITESPACE_CLASS, collapse_ws
from .url import (
    authority_of_clean,
    clean_url,
    decode_query_value,
    domain_of_engine,
    engine_of_host,
    host_of_clean,
    hostname,
    is_external_search_host,
    is_external_search_referrer,
    keyword_of_query,
    keyword_of_raw,
    query_of_clean,
    query_string,
    raw_keyword,
    search_domain,
    search_domain_of_host,
    search_keyword,
)

__all__ = [
    "WHITESPACE_CLASS",
    "authority_of_clean",
    "clean_url",
    "collapse_ws",
    "decode_query_value",
    "domain_of_engine",
    "engine_of_host",
    "epoch_seconds",
    "hit_revenue",
    "host_of_clean",
    "hostname",
    "is_external_search_host",
    "is_external_search_referrer",
    "is_purchase",
    "keyword_of_query",
    "keyword_of_raw",
    "money",
    "query_of_clean",
    "query_string",
    "raw_keyword",
    "search_domain",
    "search_domain_of_host",
    "search_keyword",
    "session_break",
]
