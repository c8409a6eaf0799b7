"""enrich hits with epoch time, search domain, keyword, purchase flag, revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    authority_of_clean,
    clean_url,
    domain_of_engine,
    engine_of_host,
    epoch_seconds,
    hit_revenue,
    host_of_clean,
    hostname,
    is_purchase,
    keyword_of_raw,
    query_of_clean,
    raw_keyword,
)
from ..rules import DEFAULT_RULES, Rules
from .columns import (
    DOMAIN,
    EVENT_LIST,
    HIT_TIME,
    HIT_TS,
    IS_PURCHASE,
    KEYWORD,
    PRODUCT_LIST,
    REFERRER,
    REVENUE,
)

REFERRER_HOST = "referrer_host"
_CLEAN = "_clean_referrer"
_AUTHORITY = "_referrer_authority"
_QUERY = "_referrer_query"
_RAW = "_raw_keyword"
_ENGINE = "_engine"


def with_hit_ts(hits: DataFrame) -> DataFrame:
    """F7. Add ``hit_ts`` (BIGINT epoch seconds) from ``hit_time_gmt`` unless present."""
    if HIT_TS in hits.columns:
        return hits
    return hits.withColumn(HIT_TS, epoch_seconds(F.col(HIT_TIME), hits.schema[HIT_TIME].dataType))


def with_referrer_host(hits: DataFrame) -> DataFrame:
    """F1 as a column ``referrer_host``, computed once for the host-based functions."""
    return hits.withColumn(REFERRER_HOST, hostname(F.col(REFERRER)))


def enrich(hits: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """F9. Hits plus ``hit_ts``, ``domain``, ``keyword``, ``is_purchase``, ``revenue``.

    Absent domain or keyword stay NULL. Native expressions only. The
    cleaned referrer, its authority, host, query text and raw keyword are each computed once
    and shared (Spark does not share an expression that only later CASE or
    COALESCE branches use, so they are projected as columns first).
    """
    hits = with_hit_ts(hits)
    cleaned = hits.withColumn(_CLEAN, clean_url(F.col(REFERRER)))
    parts = cleaned.withColumns({_AUTHORITY: authority_of_clean(F.col(_CLEAN)),
                                 _QUERY: query_of_clean(F.col(_CLEAN))})
    hosted = parts.withColumns({REFERRER_HOST: host_of_clean(F.col(_CLEAN), F.col(_AUTHORITY)),
                                _RAW: raw_keyword(F.col(_QUERY), rules.keyword_params)})
    named = hosted.withColumn(_ENGINE, engine_of_host(F.col(REFERRER_HOST), rules.engines))
    return named.withColumns({
        DOMAIN: domain_of_engine(F.col(REFERRER_HOST), F.col(_ENGINE)),
        KEYWORD: keyword_of_raw(F.col(_RAW)),
        IS_PURCHASE: is_purchase(F.col(EVENT_LIST), rules.purchase_event),
        REVENUE: hit_revenue(F.col(PRODUCT_LIST)),
    }).drop(_CLEAN, _AUTHORITY, REFERRER_HOST, _QUERY, _RAW, _ENGINE)


def valid_touch() -> F.Column:
    """P1. A hit is a search touch when both domain and keyword are present."""
    return F.col(DOMAIN).isNotNull() & F.col(KEYWORD).isNotNull()


def paid_purchase() -> F.Column:
    """P2 + P3. A purchase hit with positive revenue."""
    return F.col(IS_PURCHASE) & (F.col(REVENUE) > 0)
