"""Q1, the flagship: revenue per first search touch of each session.

``search_revenue`` is lazy: hits in, report DataFrame out. ``run_report`` is
the batch job around it: read hit files, attribute, write one dated
tab-separated report.

Plan at scale (see ``operators/sessions.py``):

* scan: only ``hit_time_gmt, ip, user_agent, event_list, product_list,
  referrer`` are read; NULL visitor keys are filtered at the scan;
* one projection of native expressions (host, domain, keyword, purchase
  flag, revenue, bucket);
* aggregate per ``(ip, user_agent, bucket)`` with the partial step on the
  mappers: the first shuffle moves bucket summaries, not hits;
* a window per visitor over buckets, then a per-session aggregate that
  reuses the window's partitioning, so it needs no exchange;
* aggregate per ``(domain, keyword)`` with a partial step, and a sort of the
  small result.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators import enrich, keyword_report, keyword_revenue
from ..rules import DEFAULT_RULES, Rules
from ..sources import read_hits, read_hits_parquet, report_name, write_report


def search_revenue(hits: DataFrame, rules: Rules = DEFAULT_RULES, tie: str | None = None,
                   bucket_seconds: int | None = None) -> DataFrame:
    """Q1. ``Search Engine Domain, Search Keyword, Revenue`` for raw or timed hits."""
    enriched = enrich(hits, rules)
    return keyword_revenue(enriched, rules, tie=tie, bucket_seconds=bucket_seconds)


def run_report(spark: SparkSession, input_path: str, output_root: str,
               rules: Rules = DEFAULT_RULES, execution_date: datetime | None = None,
               multi_line: bool = False, parquet: bool = False, single_file: bool = False,
               repartition: int | None = None) -> str:
    """S1 -> Q1 -> S4/S5. Returns the report directory that was written.

    ``repartition`` deals the hits to that many tasks before they are parsed.
    It shuffles all of them, so it is only for input that can't be split, such
    as one large gzip file.
    """
    hits = read_hits_parquet(spark, input_path) if parquet else read_hits(spark, input_path, multi_line)
    if repartition:
        hits = hits.repartition(repartition)
    target = f"{output_root.rstrip('/')}/{report_name(execution_date)}"
    write_report(search_revenue(hits, rules), target, single_file=single_file)
    return target


def formatted_report(hits: DataFrame, rules: Rules = DEFAULT_RULES,
                     tie: str | None = None) -> DataFrame:
    """Q1 with display formatting (F10, F11)."""
    return keyword_report(search_revenue(hits, rules, tie=tie))
