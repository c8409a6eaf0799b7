"""First-touch attribution: touches (P1, A1), purchases (P2, P3), join (J1),
revenue per keyword (A2), display names (F10), money text (F11), group
count (A3) and ranking (O1).

The core is ``session_summaries``: one row per session with its first
search touch and its paid revenue. It is built on the bucket table of
``sessions.py``, so the flagship needs no join and never windows raw hits.

Which touch is first: the smallest ``(hit_ts, tie, domain, keyword)`` among
the session's valid touches, where ``tie`` is an optional unique number from
0 on (e.g. an event id). This makes "first" deterministic when times are equal.

Raw hits meet a hash aggregate: the touch's strings are grouping keys, and
everything aggregated is a number (times, revenue, and the first moment of
the touch as one number). A second aggregate, on those reduced rows, picks the
first touch of each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money
from ..rules import DEFAULT_RULES, Rules
from .columns import (
    DOMAIN,
    HIT_TS,
    IP,
    KEYWORD,
    REPORT_DOMAIN,
    REPORT_KEYWORD,
    REPORT_REVENUE,
    REVENUE,
    SESSION_ID,
    USER_AGENT,
)
from .enrich import paid_purchase, valid_touch
from .sessions import (
    BUCKET,
    FIRST_TS,
    LAST_TS,
    VISITOR_HASH,
    attach_session_ids,
    bucket_keys,
    bucket_width,
    number_buckets,
    same_bucket,
    time_bucket,
    untimed_session,
    visitor_hash,
)

TOUCH = "touch"
_SOLO = "_solo"
_SOLO_DOMAIN = "_solo_domain"
_SOLO_KEYWORD = "_solo_keyword"
_UNTIMED = "_untimed"
_T_DOMAIN = "_touch_domain"
_T_KEYWORD = "_touch_keyword"
_MOMENT = "_moment"
_PAID = "_paid"
_GROUPS = (VISITOR_HASH, IP, USER_AGENT, _UNTIMED, _SOLO, _SOLO_DOMAIN, _SOLO_KEYWORD)
# 10 ** 19 is above every bigint, so time * 10 ** 19 + tie orders as (time, tie) does
_TIE_RANGE = f"{10 ** 19}BD"


def touch_moment(tie: str | None = None) -> Column:
    """Order of the touches by ``(hit_ts, tie)`` as one fixed-width number."""
    if tie is None:
        return F.col(HIT_TS)
    return (F.col(HIT_TS).cast("decimal(18,0)") * F.expr(_TIE_RANGE) + F.col(tie)).cast("decimal(38,0)")


def _has_visitor(df: DataFrame) -> DataFrame:
    return df.where(F.col(IP).isNotNull() & F.col(USER_AGENT).isNotNull())


def _numbered_buckets(enriched: DataFrame, rules: Rules, tie: str | None,
                      bucket_seconds: int | None) -> DataFrame:
    """Numbered buckets with their first touch and paid revenue: ``*_GROUPS, _bucket, touch, revenue, session_id``.

    Untimed hits travel along in groups of their own, one per hit with a tie
    column and else one per visitor and touch, so the hits are read once.
    """
    width = bucket_width(rules.timeout_seconds, bucket_seconds)
    ts = F.col(HIT_TS)
    untimed = ts.isNull()
    touched = valid_touch()
    solo_touch = F.lit(tie is None) & untimed
    keyed = enriched.select(
        # A 64-bit hash of the visitor leads the keys: it adds no group (it is a function of
        # the visitor), but sorts then run on a nearly unique long instead of ip strings.
        visitor_hash().alias(VISITOR_HASH), IP, USER_AGENT, HIT_TS, untimed.alias(_UNTIMED),
        F.when(untimed, untimed_session(tie)).alias(_SOLO),
        F.when(solo_touch, F.col(DOMAIN)).alias(_SOLO_DOMAIN),
        F.when(solo_touch, F.col(KEYWORD)).alias(_SOLO_KEYWORD),
        time_bucket(ts, width).alias(BUCKET),
        F.when(touched, F.col(DOMAIN)).alias(_T_DOMAIN),
        F.when(touched, F.col(KEYWORD)).alias(_T_KEYWORD),
        F.when(touched, touch_moment(tie)).alias(_MOMENT),
        F.when(paid_purchase(), F.col(REVENUE)).alias(_PAID))
    per_touch = keyed.groupBy(*_GROUPS, BUCKET, _T_DOMAIN, _T_KEYWORD).agg(
        F.min(HIT_TS).alias(FIRST_TS), F.max(HIT_TS).alias(LAST_TS),
        F.min(_MOMENT).alias(_MOMENT), F.sum(_PAID).alias(REVENUE))
    # an untimed touch has no moment, but its group has just the one touch
    touch = F.when(F.col(_T_DOMAIN).isNotNull(), F.struct(
        _MOMENT, F.col(_T_DOMAIN).alias(DOMAIN), F.col(_T_KEYWORD).alias(KEYWORD)))
    per_bucket = per_touch.groupBy(*_GROUPS, BUCKET).agg(
        F.min(FIRST_TS).alias(FIRST_TS), F.max(LAST_TS).alias(LAST_TS),
        F.min(touch).alias(TOUCH), F.sum(REVENUE).alias(REVENUE))
    numbered = number_buckets(per_bucket, rules.timeout_seconds, partition_cols=_GROUPS)
    return numbered.withColumn(
        SESSION_ID, F.when(F.col(_UNTIMED), F.col(_SOLO)).otherwise(F.col(SESSION_ID)))


def session_summaries(enriched: DataFrame, rules: Rules = DEFAULT_RULES, tie: str | None = None,
                      bucket_seconds: int | None = None) -> DataFrame:
    """One row per session: ``ip, user_agent, session_id, touch, revenue``.

    ``touch`` is the first valid touch (struct with ``domain`` and ``keyword``)
    or NULL; ``revenue`` sums the session's purchases with positive revenue,
    or is NULL when there are none. Sessions with neither are left out.

    A hit without a time is a session of its own, numbered ``-1 - tie``. Without
    a tie column its number is NULL, and such hits of one visitor with the same
    touch (or with none) are combined; this leaves every credit unchanged,
    since each one credits its own revenue to its own touch.
    """
    numbered = _numbered_buckets(enriched, rules, tie, bucket_seconds)
    # Session numbers needed every bucket; the per-session step only needs
    # buckets that carry a touch or paid revenue (plain page views drop out
    # here, before the sort of the per-session aggregate).
    relevant = numbered.where(F.col(TOUCH).isNotNull() | F.col(REVENUE).isNotNull())
    sessions = relevant.groupBy(*_GROUPS, SESSION_ID).agg(
        F.min(TOUCH).alias(TOUCH), F.sum(REVENUE).alias(REVENUE))
    return sessions.select(IP, USER_AGENT, SESSION_ID, TOUCH, REVENUE)


def first_touch(enriched: DataFrame, rules: Rules = DEFAULT_RULES, tie: str | None = None,
                bucket_seconds: int | None = None) -> DataFrame:
    """P1 + A1. ``ip, user_agent, session_id, domain, keyword`` of every session with a touch."""
    s = session_summaries(enriched, rules, tie, bucket_seconds)
    return s.where(F.col(TOUCH).isNotNull()).select(
        IP, USER_AGENT, SESSION_ID,
        F.col(f"{TOUCH}.{DOMAIN}").alias(DOMAIN), F.col(f"{TOUCH}.{KEYWORD}").alias(KEYWORD))


def purchase_hits(enriched: DataFrame, rules: Rules = DEFAULT_RULES, tie: str | None = None,
                  bucket_seconds: int | None = None) -> DataFrame:
    """P2 + P3. Purchase hits with positive revenue, with their ``session_id``."""
    return attach_session_ids(enriched, rules.timeout_seconds, paid_purchase(), tie, bucket_seconds)


def attribute(purchases: DataFrame, touches: DataFrame) -> DataFrame:
    """J1. Inner equi-join of session-numbered purchases with first touches.

    ``purchases`` has ``ip, user_agent, session_id, revenue``; ``touches``
    has ``ip, user_agent, session_id, domain, keyword``. N:1; NULL keys never
    match. The purchases' own ``domain`` / ``keyword`` are replaced.
    """
    keys = [IP, USER_AGENT, SESSION_ID]
    left = purchases.drop(DOMAIN, KEYWORD)
    return left.join(touches.select(*keys, DOMAIN, KEYWORD), keys, "inner")


def attributed_purchases(enriched: DataFrame, rules: Rules = DEFAULT_RULES,
                         tie: str | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """J1 on hit level: each paid purchase with the first touch of its session.

    Output: the purchase hit's columns, with ``domain`` / ``keyword`` being
    the session's first touch. Purchases in sessions without a touch, and
    visitors with NULL ``ip`` or ``user_agent``, are dropped (inner join).

    The session touch is spread to every bucket of the session with a window
    over the bucket table. Only buckets that hold a paid purchase then join the
    purchases. A purchase without a time is its own session and keeps its
    own touch.
    """
    width = bucket_width(rules.timeout_seconds, bucket_seconds)
    visitors = _has_visitor(enriched)
    ts = F.col(HIT_TS)
    numbered = _numbered_buckets(visitors.where(ts.isNotNull()), rules, tie, bucket_seconds)
    per_session = Window.partitionBy(*_GROUPS, SESSION_ID)
    spread = (numbered.withColumn("_session_touch", F.min(TOUCH).over(per_session))
              .where(F.col("_session_touch").isNotNull() & F.col(REVENUE).isNotNull())
              .select(*bucket_keys(), F.col(f"_session_touch.{DOMAIN}").alias("_s_domain"),
                      F.col(f"_session_touch.{KEYWORD}").alias("_s_keyword")))
    paid = visitors.where(paid_purchase()).withColumns(
        {VISITOR_HASH: visitor_hash(), BUCKET: time_bucket(ts, width)})
    joined = paid.join(spread, same_bucket(paid, spread), "left")
    own = ts.isNull() & valid_touch()
    credit = {DOMAIN: F.coalesce(F.col("_s_domain"), F.when(own, F.col(DOMAIN))),
              KEYWORD: F.coalesce(F.col("_s_keyword"), F.when(own, F.col(KEYWORD)))}
    return (joined.select(*[c for c in enriched.columns if c not in credit],
                          *[c.alias(name) for name, c in credit.items()])
            .where(F.col(DOMAIN).isNotNull()))


def keyword_revenue(enriched: DataFrame, rules: Rules = DEFAULT_RULES, tie: str | None = None,
                    bucket_seconds: int | None = None) -> DataFrame:
    """A2 + F10 + O1. Revenue per first-touch (domain, keyword), highest first.

    Columns ``Search Engine Domain``, ``Search Keyword``, ``Revenue``. The
    revenue is the plain sum; it is rounded where it is shown (``keyword_report``,
    ``write_report``), and groups rank by what it is, not by what it shows.
    """
    s = session_summaries(_has_visitor(enriched), rules, tie, bucket_seconds)
    credited = s.where(F.col(TOUCH).isNotNull() & F.col(REVENUE).isNotNull())
    report = (credited.groupBy(F.col(f"{TOUCH}.{DOMAIN}").alias(REPORT_DOMAIN),
                               F.col(f"{TOUCH}.{KEYWORD}").alias(REPORT_KEYWORD))
              .agg(F.sum(REVENUE).alias(REPORT_REVENUE)))
    return rank_by_revenue(report)


def rank_by_revenue(report: DataFrame) -> DataFrame:
    """O1. Highest revenue first; domain and keyword make ties stable."""
    return report.orderBy(F.desc(REPORT_REVENUE), F.asc(REPORT_DOMAIN), F.asc(REPORT_KEYWORD))


def keyword_report(report: DataFrame) -> DataFrame:
    """F10 + F11. Display columns with revenue as two-decimal text."""
    return report.select(REPORT_DOMAIN, REPORT_KEYWORD,
                         money(F.col(REPORT_REVENUE)).alias(REPORT_REVENUE))


def group_count(report: DataFrame) -> DataFrame:
    """A3. Number of (domain, keyword) groups, as a one-row DataFrame ``groups``."""
    return report.agg(F.count(F.lit(1)).alias("groups"))
