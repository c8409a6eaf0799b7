"""Stand-in hits built from the driver's ``events`` table.

The test tables hold no web hits, so this adapter maps each event to one
hit, in the hit schema: a visitor from the whole ``user_id``, an event list and
product list from ``event_type`` and ``value``, and a referrer drawn from a
fixed mix. A few hits have no time, no ``ip`` or no ``user_agent``. The referrers cover plain, percent- and plus-coded keywords,
parameter fall-through, an upper-case host with a port, a substring engine,
a search without a keyword, non-search and own-site referrers, and empty,
NULL and scheme-less referrers.

It only shapes rows. All attribution work runs on them through the library,
and nothing in the library knows how they were made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_seconds

# The referrer mix, selected by event_id modulo 13 (index 12 is NULL).
REFERRERS = (
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
)


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _referrer_sql() -> str:
    slots = " ".join(f"WHEN {i} THEN {_sql_str(u)}" for i, u in enumerate(REFERRERS))
    return f"CASE event_id % 13 {slots} ELSE CAST(NULL AS STRING) END"


_IP = """CASE WHEN event_id % 103 <> 5 THEN concat_ws('.', '10',
    CAST(user_id DIV 65536 % 256 AS STRING), CAST(user_id DIV 256 % 256 AS STRING),
    CAST(user_id % 256 AS STRING)) END"""
_AGENT = "CASE WHEN event_id % 107 <> 9 THEN concat('ua-', CAST(user_id % 3 AS STRING)) END"
_PRICE = "CAST(CAST(value AS DECIMAL(12,2)) AS STRING)"
_EVENT_LIST = """CASE event_type
    WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '1' ELSE '2, 1' END
    WHEN 'view' THEN '2' WHEN 'click' THEN '12' WHEN 'signup' THEN '11' ELSE '' END"""
_PRODUCT_LIST = f"""CASE
    WHEN event_type <> 'purchase'
      THEN CASE WHEN event_type = 'view' THEN 'Electronics;Viewed;1;;' ELSE '' END
    WHEN event_id % 7 = 0 THEN 'Electronics;NoRevenue'
    WHEN event_id % 7 = 1 THEN 'Electronics;Bad;1;n/a;'
    WHEN event_id % 7 = 2
      THEN concat('Electronics;A;1;', {_PRICE}, ';, Electronics;B;2; 10.50 ;200=1')
    ELSE concat('Electronics;A;1;', {_PRICE}, ';') END"""


def hits_from_events(events: DataFrame) -> DataFrame:
    """``event_id, hit_ts, ip, user_agent, event_list, product_list, referrer``.

    Written as one SQL projection: it is a fixed row mapping, and one
    expression string is also far cheaper to build than many Column calls.
    """
    seconds = epoch_seconds(F.col("ts"), events.schema["ts"].dataType)
    return events.select(
        "event_id", F.when(F.expr("event_id % 101 <> 7"), seconds).alias("hit_ts"),
        F.expr(_IP).alias("ip"), F.expr(_AGENT).alias("user_agent"),
        F.expr(_EVENT_LIST).alias("event_list"),
        F.expr(_PRODUCT_LIST).alias("product_list"),
        F.expr(_referrer_sql()).alias("referrer"),
    )


def read_event_hits(spark, sf_dir: str) -> DataFrame:
    """Stand-in hits of ``{sf_dir}/events.parquet``."""
    return hits_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
