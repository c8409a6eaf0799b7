"""DataFrame -> DataFrame operators: enrichment, sessions, attribution."""

from .attribution import (
    TOUCH,
    attribute,
    attributed_purchases,
    first_touch,
    group_count,
    keyword_report,
    keyword_revenue,
    purchase_hits,
    rank_by_revenue,
    session_summaries,
    touch_moment,
)
from .enrich import enrich, paid_purchase, valid_touch, with_hit_ts, with_referrer_host
from .sessions import (
    attach_session_ids,
    bucket_width,
    inactivity_gap,
    number_buckets,
    session_numbers,
    time_bucket,
    untimed_session,
    visitor_buckets,
)

__all__ = [
    "TOUCH",
    "attach_session_ids",
    "attribute",
    "attributed_purchases",
    "bucket_width",
    "enrich",
    "first_touch",
    "group_count",
    "inactivity_gap",
    "keyword_report",
    "keyword_revenue",
    "number_buckets",
    "paid_purchase",
    "purchase_hits",
    "rank_by_revenue",
    "session_numbers",
    "session_summaries",
    "time_bucket",
    "touch_moment",
    "untimed_session",
    "valid_touch",
    "visitor_buckets",
    "with_hit_ts",
    "with_referrer_host",
]
