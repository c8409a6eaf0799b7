"""S1: hit-file scan. S4: report sink. S5: dated report name.

Paths are Hadoop paths, so local files, HDFS and object stores (``s3a://``)
all work the same way (S2).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money
from ..operators.columns import (
    HIT_INPUT_COLUMNS,
    REPORT_DOMAIN,
    REPORT_KEYWORD,
    REPORT_REVENUE,
)
from ..rules import REPORT_NAME_SUFFIX


def read_hits(spark: SparkSession, path: str | list[str], multi_line: bool = False,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """S1. Read tab-separated hit files with a header row, as strings.

    Fields may be quoted with ``"`` and quotes doubled inside them; CRLF and
    LF line ends both work. Columns are bound by header name. The six the
    attribution needs (plus ``keep``) are selected, so a missing one is an
    analysis error. All files of a call must have the same header: Spark binds
    columns by the first one, so a file whose header differs is an error when
    it is read, never columns that are silently swapped. Set ``multi_line``
    only when quoted fields hold line breaks: it makes each file a single task.
    """
    raw = (spark.read
           .option("sep", "\t")
           .option("header", True)
           .option("inferSchema", False)
           .option("quote", '"')
           .option("escape", '"')
           .option("multiLine", multi_line)
           .option("mode", "PERMISSIVE")
           .option("enforceSchema", False)
           .csv(path))
    return raw.select(*HIT_INPUT_COLUMNS, *keep)


def read_hits_parquet(spark: SparkSession, path: str | list[str],
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """S1 for Parquet hit tables with the same column names."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path)).select(
        *HIT_INPUT_COLUMNS, *keep)


def report_name(execution_date: datetime | None = None) -> str:
    """S5. ``YYYY-mm-dd_SearchKeywordPerformance.tab`` for the date (UTC today by default)."""
    date = execution_date or datetime.now(tz=timezone.utc)
    return f"{date.strftime('%Y-%m-%d')}_{REPORT_NAME_SUFFIX}"


def write_report(report: DataFrame, path: str, formatted: bool = True,
                 single_file: bool = False) -> None:
    """S4. Write the report as tab-separated text with a header.

    ``path`` is a directory. It gets a globally sorted, range-partitioned set
    of part files (in name order), each with its own header, written in
    parallel; keywords are free text, so the report may be large. With
    ``single_file`` (the original tool's output) one task writes one file:
    for reports that are known to be small. With ``formatted`` the revenue is
    written as two-decimal text, which is where it is rounded to cents.

    A field that holds a quote, a tab or a line break is written in quotes,
    with quotes doubled (``"ipod nano"`` becomes three quotes at each end), so
    that it reads back as it was with ``escape='"'``.
    """
    revenue_key = F.desc(REPORT_REVENUE)
    out = report
    if formatted:
        out = out.withColumn("_sort_revenue", F.col(REPORT_REVENUE)).withColumn(
            REPORT_REVENUE, money(F.col(REPORT_REVENUE)))
        revenue_key = F.desc("_sort_revenue")
    order = [revenue_key, F.asc(REPORT_DOMAIN), F.asc(REPORT_KEYWORD)]
    if single_file:
        out = out.repartition(1).sortWithinPartitions(*order)
    else:
        out = out.orderBy(*order)
    if formatted:
        out = out.drop("_sort_revenue")
    (out.write.option("sep", "\t").option("header", True)
        .option("quote", '"').option("escape", '"')
        .mode("overwrite").csv(path))
