"""Shared fixtures: one local Spark session, DuckDB over the test tables, hit builders."""

from __future__ import annotations

import csv
import io
import math
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path(os.environ.get("CLICKCREDIT_TESTDATA", "/root/testdata"))
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

HIT_COLUMNS = ["hit_time_gmt", "date_time", "user_agent", "ip", "event_list", "geo_city",
               "geo_region", "geo_country", "pagename", "page_url", "product_list", "referrer"]


@pytest.fixture(scope="session")
def spark():
    from clickcredit.session import get_session
    s = get_session(master="local[4]", app_name="clickcredit-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def duck_for(sf_dir: Path):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = sf_dir / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def normalize(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6)
    return value


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(normalize(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(normalize(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def tsv(rows: list[dict], columns=HIT_COLUMNS, line_end: str = "\n", quote_all: bool = False) -> str:
    """Tab-separated hits with a header, quoted where a field needs it (or everywhere)."""
    out = io.StringIO()
    writer = csv.DictWriter(out, columns, restval="", extrasaction="ignore", dialect="excel-tab",
                            lineterminator=line_end, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL)
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue()


def hits_df(spark, rows: list[tuple], with_id: bool = True):
    """Hit rows ``(time, ip, agent, referrer, events, products)`` as a DataFrame.

    ``time`` may be None; an ``event_id`` in row order is added with ``with_id``.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    fields = [StructField("hit_ts", LongType()), StructField("ip", StringType()),
              StructField("user_agent", StringType()), StructField("referrer", StringType()),
              StructField("event_list", StringType()), StructField("product_list", StringType())]
    data = [tuple(r) for r in rows]
    if with_id:
        fields = [StructField("event_id", LongType())] + fields
        data = [(i,) + r for i, r in enumerate(data)]
    return spark.createDataFrame(data, StructType(fields))
