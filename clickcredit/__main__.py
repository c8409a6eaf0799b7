"""Batch job: ``python -m clickcredit <input> <output_root> [options]``.

Under ``spark-submit`` the cluster's session is used as it is. The report is
written to ``<output_root>/YYYY-mm-dd_SearchKeywordPerformance.tab/``.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from .plans import run_report
from .rules import DEFAULT_RULES, Rules


def _names(text: str) -> tuple[str, ...]:
    return tuple(name for part in text.split(",") if (name := part.strip()))


def main(argv: list[str] | None = None) -> str:
    default = DEFAULT_RULES
    parser = argparse.ArgumentParser(prog="clickcredit", description=__doc__)
    parser.add_argument("input", help="hit files: a path, directory or glob")
    parser.add_argument("output_root", help="directory that receives the dated report")
    parser.add_argument("--timeout", type=int, default=default.timeout_seconds,
                        help="session inactivity timeout in seconds (default 1800)")
    parser.add_argument("--engines", type=_names, default=default.engines,
                        help="search engine names, separated by commas, in order")
    parser.add_argument("--keyword-params", type=_names, default=default.keyword_params,
                        help="query parameters that carry the keyword, separated by commas, in order")
    parser.add_argument("--site-domain", default=default.site_domain, help="the shop's own domain")
    parser.add_argument("--date", help="report date YYYY-mm-dd (default: today, UTC)")
    parser.add_argument("--parquet", action="store_true", help="input is Parquet, not TSV")
    parser.add_argument("--multi-line", action="store_true",
                        help="TSV fields may hold quoted line breaks (one task per file)")
    parser.add_argument("--single-file", action="store_true",
                        help="write the report as one file, by one task (small reports)")
    parser.add_argument("--repartition", type=int,
                        help="shuffle the hits to this many tasks first (input that can't be split)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("clickcredit").getOrCreate()
    rules = Rules(args.engines, args.keyword_params, args.site_domain, args.timeout, default.purchase_event)
    date = datetime.strptime(args.date, "%Y-%m-%d") if args.date else None
    target = run_report(spark, args.input, args.output_root, rules, date, args.multi_line,
                        args.parquet, args.single_file, args.repartition)
    print(f"report written to {target}")
    return target


if __name__ == "__main__":
    main()
