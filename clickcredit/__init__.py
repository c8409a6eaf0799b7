"""clickcredit: session-aware first-touch revenue attribution on Spark.

Hits (one row per page request) in, revenue per first search referrer of
each session out. Every step is a lazy ``DataFrame -> DataFrame`` function
built from native Spark expressions.
"""

from .operators import (
    attribute,
    attributed_purchases,
    enrich,
    first_touch,
    group_count,
    inactivity_gap,
    keyword_report,
    keyword_revenue,
    purchase_hits,
    session_numbers,
    session_summaries,
)
from .plans import formatted_report, run_report, search_revenue
from .rules import DEFAULT_RULES, Rules
from .sources import hits_from_events, read_hits, report_name, write_report

__all__ = [
    "DEFAULT_RULES",
    "Rules",
    "attribute",
    "attributed_purchases",
    "enrich",
    "first_touch",
    "formatted_report",
    "group_count",
    "hits_from_events",
    "inactivity_gap",
    "keyword_report",
    "keyword_revenue",
    "purchase_hits",
    "read_hits",
    "report_name",
    "run_report",
    "search_revenue",
    "session_numbers",
    "session_summaries",
    "write_report",
]
