"""

``entry(spark)`` runs the flagship on sf0.001; ``queries()`` maps each
operator of the inventory to a ``(spark, sf_dir) -> DataFrame`` callable;
``oracle_sql()`` gives, for each, a DuckDB query over the same tables. The
oracle shares nothing with the library: it has its own constants and works by
splitting into lists where the library uses patterns, and by ASOF joins on the
visitors' own times where the library uses time buckets.

The session queries read the whole ``events`` table through the hit adapter of
``clickcredit.sources.events`` (the test tables hold no web hits). The URL
functions also run over the URLs of the whole ``pages`` table.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcredit import operators as ops
from clickcredit.functions import (
    hit_revenue,
    hostname,
    is_external_search_host,
    is_purchase,
    search_domain_of_host,
    search_keyword,
)
from clickcredit.operators.columns import REPORT_REVENUE
from clickcredit.rules import DEFAULT_RULES, Rules
from clickcredit.sources.events import read_event_hits

SMOKE_DIR = "/root/testdata/sf0.001"
TIE = "event_id"
RULES = DEFAULT_RULES
RULES_6H = DEFAULT_RULES.with_timeout(21600)
# page URLs name no search engine and carry other parameters
PAGE_RULES = Rules(engines=("example", "com", "th"), keyword_params=("ref", "page"), site_domain="example.net")


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_event_hits(spark, sf_dir)


def _enriched(spark: SparkSession, sf_dir: str, rules: Rules = RULES) -> DataFrame:
    return ops.enrich(_hits(spark, sf_dir), rules)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs as referrers."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.col("url").alias("referrer"))


def _cents(report: DataFrame) -> DataFrame:
    """The report with its revenue in whole cents, as it is shown."""
    return report.withColumn(REPORT_REVENUE, F.round(REPORT_REVENUE, 2))


# --------------------------------------------------------------------------
# queries


def q_referrer_hostname(spark, sf_dir):
    return _hits(spark, sf_dir).select(TIE, hostname(F.col("referrer")).alias("host"))


def q_search_referrer_flag(spark, sf_dir):
    flag = is_external_search_host(F.col("referrer_host"), RULES.engines, RULES.site_domain)
    return ops.with_referrer_host(_hits(spark, sf_dir)).select(TIE, flag.alias("is_search"))


def q_search_domain(spark, sf_dir):
    domain = search_domain_of_host(F.col("referrer_host"), RULES.engines)
    return ops.with_referrer_host(_hits(spark, sf_dir)).select(TIE, domain.alias("domain"))


def q_search_keyword(spark, sf_dir):
    kw = search_keyword(F.col("referrer"), RULES.keyword_params)
    return _hits(spark, sf_dir).select(TIE, kw.alias("keyword"))


def q_purchase_flag(spark, sf_dir):
    flag = is_purchase(F.col("event_list"), RULES.purchase_event)
    return _hits(spark, sf_dir).select(TIE, flag.alias("is_purchase"))


def q_hit_revenue(spark, sf_dir):
    return _hits(spark, sf_dir).select(TIE, hit_revenue(F.col("product_list")).alias("revenue"))


def q_enriched_hits(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        TIE, "hit_ts", "domain", "keyword", "is_purchase", "revenue")


def q_inactivity_gap(spark, sf_dir):
    return ops.inactivity_gap(_hits(spark, sf_dir), tie=TIE).select(TIE, "gap")


def q_session_numbers(spark, sf_dir):
    return ops.session_numbers(_hits(spark, sf_dir), RULES.timeout_seconds, tie=TIE).select(
        TIE, "session_id")


def q_first_touch(spark, sf_dir):
    return ops.first_touch(_enriched(spark, sf_dir), RULES, tie=TIE)


def q_purchase_hits(spark, sf_dir):
    return ops.purchase_hits(_enriched(spark, sf_dir), RULES, tie=TIE).select(
        TIE, "ip", "user_agent", "session_id", "revenue")


def q_attributed_purchases(spark, sf_dir):
    return ops.attributed_purchases(_enriched(spark, sf_dir), RULES, tie=TIE).select(
        TIE, "domain", "keyword", "revenue")


def _revenue(spark, sf_dir, rules=RULES):
    return ops.keyword_revenue(_enriched(spark, sf_dir, rules), rules, tie=TIE)


def q_keyword_revenue(spark, sf_dir):
    return _cents(_revenue(spark, sf_dir))


def q_keyword_revenue_6h(spark, sf_dir):
    return _cents(_revenue(spark, sf_dir, RULES_6H))


def q_keyword_report(spark, sf_dir):
    return ops.keyword_report(_revenue(spark, sf_dir))


def q_keyword_group_count(spark, sf_dir):
    return ops.group_count(_revenue(spark, sf_dir))


def q_page_search(spark, sf_dir):
    """F1 to F4 on page URLs."""
    host = F.col("referrer_host")
    return ops.with_referrer_host(_pages(spark, sf_dir)).select(
        "page_id", host.alias("host"),
        is_external_search_host(host, PAGE_RULES.engines, PAGE_RULES.site_domain).alias("is_search"),
        search_domain_of_host(host, PAGE_RULES.engines).alias("domain"),
        search_keyword(F.col("referrer"), PAGE_RULES.keyword_params).alias("keyword"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "referrer_hostname": q_referrer_hostname,
    "search_referrer_flag": q_search_referrer_flag,
    "search_domain": q_search_domain,
    "search_keyword": q_search_keyword,
    "purchase_flag": q_purchase_flag,
    "hit_revenue": q_hit_revenue,
    "enriched_hits": q_enriched_hits,
    "inactivity_gap": q_inactivity_gap,
    "session_numbers": q_session_numbers,
    "first_touch": q_first_touch,
    "purchase_hits": q_purchase_hits,
    "attributed_purchases": q_attributed_purchases,
    "keyword_revenue": q_keyword_revenue,
    "keyword_revenue_6h": q_keyword_revenue_6h,
    "keyword_report": q_keyword_report,
    "keyword_group_count": q_keyword_group_count,
    "page_search": q_page_search,
}


def entry(spark: SparkSession) -> DataFrame:
    return q_keyword_revenue(spark, SMOKE_DIR)


def _optional(name: str):
    """A module of the training-data operators, or None where that part isn't installed.

    Only its absence is forgiven; an import that fails inside it is an error.
    """
    try:
        return import_module(name)
    except ModuleNotFoundError as e:
        if e.name in (name, *_OPTIONAL):
            return None
        raise


_OPTIONAL = ("clickcredit.llm", "clickcredit.llm.queries", "corpus_pipeline")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(_QUERIES)
    if llm := _optional("clickcredit.llm.queries"):
        found |= llm.queries()
        if pipeline := _optional("corpus_pipeline"):
            found["pipeline"] = pipeline.run
    return found


# --------------------------------------------------------------------------
# DuckDB oracle: its own constants, lists instead of patterns, ASOF joins
# instead of time buckets

_ENGINES = ["google", "bing", "yahoo", "duckduckgo", "msn", "ask", "aol"]
_PARAMS = ["q", "p", "query", "search"]
_SITE = "esshopzilla.com"
# the code points of white space
_SPACES = [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
# the adapter's referrers, by event_id modulo 13 (12: none)
_REFERRERS = [
    "http://www.google.com/search?hl=en&q=Ipod&aq=f&oq=",
    "http://search.yahoo.com/search?p=cd+player&toggle=1",
    "http://www.bing.com/search?q=Zune%20HD&go=",
    "https://WWW.Google.co.uk:443/search?q=&p=Fall++Through",
    "http://www.google.com/search?hl=en",
    "http://www.basket.com/?query=cart",
    "http://www.facebook.com/page?q=ignored",
    "http://www.esshopzilla.com/cart/",
    "",
    "http://duckduckgo.com/?q=100%25+Wool#q=frag",
    "http://www.bing.com/search?q=+",
    "www.google.com/search?q=noscheme",
]


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_list(names: list[str]) -> str:
    return "[" + ", ".join(map(_sql_str, names)) + "]"


def _spaced(text: str) -> str:
    """The text with every white-space character as a plain space."""
    chars = " || ".join(f"chr({c})" for c in _SPACES)
    return f"translate({text}, {chars}, repeat(' ', {len(_SPACES)}))"


def _hits_sql() -> str:
    return f"""hits AS (
  SELECT event_id,
    CASE WHEN event_id % 101 <> 7 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS hit_ts,
    CASE WHEN event_id % 103 <> 5
         THEN '10.' || (user_id // 65536 % 256) || '.' || (user_id // 256 % 256) || '.' || (user_id % 256) END AS ip,
    CASE WHEN event_id % 107 <> 9 THEN 'ua-' || (user_id % 3) END AS user_agent,
    CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2, 1' END
         WHEN 'view' THEN '2' WHEN 'click' THEN '12' WHEN 'signup' THEN '11' ELSE '' END AS event_list,
    CASE WHEN event_type <> 'purchase' THEN CASE WHEN event_type = 'view' THEN 'Electronics;Viewed;1;;' ELSE '' END
         WHEN event_id % 7 = 0 THEN 'Electronics;NoRevenue'
         WHEN event_id % 7 = 1 THEN 'Electronics;Bad;1;n/a;'
         WHEN event_id % 7 = 2 THEN concat('Electronics;A;1;', CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), ';, Electronics;B;2; 10.50 ;200=1')
         ELSE concat('Electronics;A;1;', CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), ';') END AS product_list,
    {_sql_list(_REFERRERS)}[CAST(event_id % 13 AS INTEGER) + 1] AS referrer
  FROM events
)"""


def _parsed_sql(source: str) -> str:
    """Host and the list of ``name=value`` parts of each referrer of ``source``."""
    low = " || ".join(f"chr({c})" for c in range(1, 33))
    letters = "abcdefghijklmnopqrstuvwxyz"
    scheme_ok = (f"list_bool_and(list_transform(string_split(scheme, ''), lambda c: contains('{letters}0123456789+.-', c))) "
                 f"AND contains('{letters}', scheme[1])")
    return f"""parsed AS (
  SELECT *,
    CASE WHEN starts_with(place, '[') AND contains(place, ']:') THEN lower(place[2:instr(place, ']:') - 1])
         WHEN starts_with(place, '[') AND ends_with(place, ']') THEN lower(place[2:-2])
         WHEN contains(place, '[') OR contains(place, ']') THEN NULL
         ELSE nullif(lower(string_split(place, ':')[1]), '') END AS host
  FROM (
    SELECT *, string_split(string_split(string_split(string_split(rest, '/')[1], '?')[1], '#')[1], '@')[-1] AS place,
      string_split(CASE WHEN contains(string_split(url, '#')[1], '?')
        THEN substr(string_split(url, '#')[1], instr(url, '?') + 1) ELSE '' END, '&') AS parts
    FROM (
      SELECT *, CASE WHEN starts_with(url, '//') THEN substr(url, 3)
          WHEN scheme <> '' AND {scheme_ok} AND starts_with(substr(url, length(scheme) + 2), '//')
          THEN substr(url, length(scheme) + 4) ELSE '' END AS rest
      FROM (
        SELECT *, CASE WHEN contains(url, ':') THEN lower(string_split(url, ':')[1]) ELSE '' END AS scheme
        FROM (SELECT *, replace(replace(replace(ltrim(referrer, {low}), chr(9), ''), chr(10), ''), chr(13), '') AS url
              FROM {source}))))
)"""


def _enriched_sql(engines: list[str] = _ENGINES, params: list[str] = _PARAMS, site: str = _SITE,
                  hit_columns: bool = True) -> str:
    raw = ("list_extract(list_filter(list_transform({params}, lambda p: list_extract(list_filter(parts, "
           "lambda x: starts_with(x, p || '=') AND length(x) > length(p) + 1), 1)[length(p) + 2:]), "
           "lambda v: v IS NOT NULL AND v <> ''), 1)").format(params=_sql_list(params))
    words = f"list_filter(string_split({_spaced('decoded')}, ' '), lambda w: w <> '')"
    field = f"trim({_spaced('string_split(p, chr(59))[4]')})"
    number = (f"CASE WHEN list_bool_and(list_transform(string_split({field}, ''), "
              f"lambda c: contains('0123456789.+-eE', c))) THEN coalesce(TRY_CAST({field} AS DOUBLE), 0.0) ELSE 0.0 END")
    hits = f""",
    coalesce(list_contains(list_transform(string_split(event_list, ','), lambda e: trim({_spaced('e')})), '1'), false)
      AS is_purchase,
    coalesce(list_sum(list_transform(string_split(product_list, ','), lambda p: {number})), 0.0) AS revenue"""
    return f"""enriched AS (
  SELECT *,
    CASE WHEN engine IS NULL THEN NULL
         WHEN list_position(labels, engine) IS NOT NULL
           THEN array_to_string(labels[list_position(labels, engine):], '.')
         ELSE host END AS domain,
    coalesce(engine IS NOT NULL AND NOT contains(host, {_sql_str(site)}), false) AS is_search,
    nullif(lower(array_to_string({words}, ' ')), '') AS keyword{hits if hit_columns else ''}
  FROM (SELECT *, list_extract(list_filter({_sql_list(engines)}, lambda e: contains(host, e)), 1) AS engine,
          string_split(host, '.') AS labels, url_decode(replace({raw}, '+', ' ')) AS decoded
        FROM parsed)
)"""


def _sessions_sql(timeout: int) -> str:
    """A time starts a session if the visitor's latest time before it is too long ago; a hit is in
    the session of the latest start that is not after it. A hit without a time is alone."""
    return f"""visits AS (
  SELECT *, struct_pack(a := coalesce(ip, ''), b := ip IS NULL, c := coalesce(user_agent, ''), d := user_agent IS NULL)
    AS visitor
  FROM enriched
),
moments AS (SELECT DISTINCT visitor, hit_ts FROM visits WHERE hit_ts IS NOT NULL),
starts AS (
  SELECT m.visitor, m.hit_ts, row_number() OVER (PARTITION BY m.visitor ORDER BY m.hit_ts) AS session_id
  FROM moments m ASOF LEFT JOIN moments b ON m.visitor = b.visitor AND m.hit_ts > b.hit_ts
  WHERE b.hit_ts IS NULL OR m.hit_ts > b.hit_ts + {timeout}
),
numbered AS (
  SELECT v.*, s.session_id FROM (SELECT * FROM visits WHERE hit_ts IS NOT NULL) v
  ASOF JOIN starts s ON v.visitor = s.visitor AND v.hit_ts >= s.hit_ts
  UNION ALL SELECT *, -1 - event_id FROM visits WHERE hit_ts IS NULL
),
touches AS (
  SELECT visitor, session_id, any_value(ip) AS ip, any_value(user_agent) AS user_agent,
    arg_min(struct_pack(domain := domain, keyword := keyword), struct_pack(t := coalesce(hit_ts, 0), e := event_id)) AS touch
  FROM numbered WHERE domain IS NOT NULL AND keyword IS NOT NULL GROUP BY visitor, session_id
),
paid AS (SELECT * FROM numbered WHERE is_purchase AND revenue > 0),
credited AS (
  SELECT p.event_id, t.touch.domain AS domain, t.touch.keyword AS keyword, p.revenue
  FROM paid p JOIN touches t ON p.visitor = t.visitor AND p.session_id = t.session_id
  WHERE p.ip IS NOT NULL AND p.user_agent IS NOT NULL
),
report AS (
  SELECT domain AS "Search Engine Domain", keyword AS "Search Keyword", sum(revenue) AS total
  FROM credited GROUP BY domain, keyword
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def oracle_sql() -> dict[str, str]:
    base = _with(_hits_sql(), _parsed_sql("hits"), _enriched_sql())
    pages = _with("links AS (SELECT page_id, url AS referrer FROM (SELECT page_id, url FROM pages))",
                  _parsed_sql("links"), _enriched_sql(["example", "com", "th"], ["ref", "page"], "example.net", False))
    sess, sess6 = (_with(_hits_sql(), _parsed_sql("hits"), _enriched_sql(), _sessions_sql(t)) for t in (1800, 21600))
    llm = _optional("clickcredit.llm.queries")
    ordered = 'ORDER BY total DESC, "Search Engine Domain", "Search Keyword"'
    revenue = f'SELECT "Search Engine Domain", "Search Keyword", round(total, 2) AS "Revenue" FROM report {ordered}'
    return {
        "referrer_hostname": base + "SELECT event_id, host FROM parsed",
        "search_referrer_flag": base + "SELECT event_id, is_search FROM enriched",
        "search_domain": base + "SELECT event_id, domain FROM enriched",
        "search_keyword": base + "SELECT event_id, keyword FROM enriched",
        "purchase_flag": base + "SELECT event_id, is_purchase FROM enriched",
        "hit_revenue": base + "SELECT event_id, revenue FROM enriched",
        "enriched_hits": base + (
            "SELECT event_id, hit_ts, domain, keyword, is_purchase, revenue FROM enriched"),
        "inactivity_gap": _with(_hits_sql()) + (
            "SELECT event_id, hit_ts - lag(hit_ts) OVER (PARTITION BY ip, user_agent "
            "ORDER BY hit_ts NULLS LAST, event_id) AS gap FROM hits"),
        "session_numbers": sess + "SELECT event_id, session_id FROM numbered",
        "first_touch": sess + (
            "SELECT ip, user_agent, session_id, touch.domain AS domain, touch.keyword AS keyword FROM touches"),
        "purchase_hits": sess + "SELECT event_id, ip, user_agent, session_id, revenue FROM paid",
        "attributed_purchases": sess + "SELECT event_id, domain, keyword, revenue FROM credited",
        "keyword_revenue": sess + revenue,
        "keyword_revenue_6h": sess6 + revenue,
        "keyword_report": sess + (
            'SELECT "Search Engine Domain", "Search Keyword", printf(\'%.2f\', round(total, 2)) AS "Revenue" '
            f"FROM report {ordered}"),
        "keyword_group_count": sess + "SELECT count(*) AS groups FROM report",
        "page_search": pages + "SELECT page_id, host, is_search, domain, keyword FROM enriched",
    } | (llm.oracle_sql() if llm else {})
