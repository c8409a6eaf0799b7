"""Sessionization: inactivity gap (W1), session break (F8), session number (W2).

A session of a visitor ``(ip, user_agent)`` ends when the next hit comes
more than ``timeout`` seconds after the previous one. The direct form is a
window ``PARTITION BY ip, user_agent ORDER BY hit_ts``. It puts every hit of a
visitor into one task, so one bot or NAT address that holds a third of the
data would become one task holding a third of the data.

Here the work is split by time instead. ``hit_ts`` is whole seconds, so in a
bucket ``[b, b + w)`` with ``w <= timeout + 1`` two consecutive hits are at
most ``timeout`` apart, and no session can end inside the bucket. Therefore:

1. Hits are pre-aggregated per ``(ip, user_agent, bucket)``: first and last
   time plus any decomposable aggregate the caller asks for. It is a
   partial + final hash/sort aggregate, so a hot visitor or a hot bucket is
   combined on every mapper before the shuffle.
2. Only this bucket table is windowed per visitor. A new session starts at a
   bucket whose first hit is more than ``timeout`` after the last hit of the
   visitor's previous bucket, and ``session_id`` is the running count of
   starts. A visitor's window holds at most ``span / w + 1`` rows, however
   many hits the visitor has.

Per-hit results (session number, gap) join back on the bucket key. There is
one row per key on the bucket side, and AQE's skew-join handling splits a hot
key on the hit side.

A hit with NULL ``hit_ts`` joins no session: it is a session of its own and has
no gap. Its number is ``-1 - tie``, with ``tie`` a unique number from 0 on such
as an event id; without a tie column it stays NULL. Visitors with NULL
``ip`` or ``user_agent`` are grouped like any other value here, as a window
partition would group them. Attribution drops them later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import session_break
from .columns import GAP, HIT_TS, IP, SESSION_ID, USER_AGENT
from .enrich import with_hit_ts

BUCKET = "_bucket"
FIRST_TS = "_first_ts"
LAST_TS = "_last_ts"
VISITOR_HASH = "_visitor_hash"

DEFAULT_GAP_BUCKET_SECONDS = 1800


def bucket_width(timeout_seconds: int, bucket_seconds: int | None = None) -> int:
    """Bucket width: ``timeout`` by default; must lie in ``[1, timeout + 1]``."""
    width = max(int(timeout_seconds), 1) if bucket_seconds is None else int(bucket_seconds)
    if width < 1 or width > int(timeout_seconds) + 1:
        raise ValueError(
            f"bucket width {width} s must be between 1 and timeout + 1 = {timeout_seconds + 1} s")
    return width


def visitor_hash() -> Column:
    """64-bit hash of ``(ip, user_agent)``, used to lead grouping and window keys.

    It is a function of the visitor, so it adds no group; but sorts on a key
    that starts with a nearly unique long avoid comparing ip strings.
    """
    return F.xxhash64(IP, USER_AGENT)


def untimed_session(tie: str | None) -> Column:
    """Session number of a hit without a time: its own, below 0, or NULL without a tie column."""
    return (F.lit(-1) - F.col(tie) if tie else F.lit(None)).cast("bigint")


def time_bucket(ts: Column, width: int) -> Column:
    """Start of the ``width``-second bucket holding ``ts`` (floor, also below 0)."""
    return ts - F.pmod(ts, F.lit(width).cast("bigint"))


def key_match(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]],
              strict: tuple[tuple[str, str], ...] = ()) -> Column:
    """Join condition: ``pairs`` compared null-safely (``<=>``), ``strict`` with ``=``."""
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    for lc, rc in strict:
        c = left[lc] == right[rc]
        cond = c if cond is None else cond & c
    return cond


def number_buckets(buckets: DataFrame, timeout_seconds: int,
                   partition_cols: tuple[str, ...] = (IP, USER_AGENT)) -> DataFrame:
    """W1 + F8 + W2 on the bucket table: add ``session_id`` per visitor bucket.

    ``buckets`` has one row per ``(ip, user_agent, _bucket)`` with the first
    and last hit time of the bucket (``_first_ts``, ``_last_ts``).
    ``partition_cols`` must hold the visitor key; extra columns split off
    groups that must not share sessions with the visitor's buckets, or are
    functions of the visitor (a hash that speeds up the sort).
    """
    w = Window.partitionBy(*partition_cols).orderBy(BUCKET)
    gap = F.col(FIRST_TS) - F.lag(LAST_TS).over(w)
    started = buckets.withColumn("_start", session_break(gap, timeout_seconds))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return started.withColumn(SESSION_ID, F.sum("_start").over(running)).drop("_start")


def visitor_buckets(hits: DataFrame, timeout_seconds: int, aggs: tuple[Column, ...] = (),
                    bucket_seconds: int | None = None) -> DataFrame:
    """Bucket table of all hits with a time, numbered into sessions.

    Columns: ``_visitor_hash, ip, user_agent, _bucket, _first_ts, _last_ts,
    *aggs, session_id``.
    """
    width = bucket_width(timeout_seconds, bucket_seconds)
    hits = with_hit_ts(hits)
    grouped = (hits.where(F.col(HIT_TS).isNotNull())
               .groupBy(visitor_hash().alias(VISITOR_HASH), IP, USER_AGENT,
                        time_bucket(F.col(HIT_TS), width).alias(BUCKET))
               .agg(F.min(HIT_TS).alias(FIRST_TS), F.max(HIT_TS).alias(LAST_TS), *aggs))
    return number_buckets(grouped, timeout_seconds, partition_cols=(VISITOR_HASH, IP, USER_AGENT))


def same_bucket(hits: DataFrame, buckets: DataFrame) -> Column:
    """Join condition of hits with ``_visitor_hash, _bucket`` and a table of ``_s_*`` bucket keys.

    The visitor hash and the bucket are the keys; visitor columns compare null-safely.
    """
    return key_match(hits, buckets, [(IP, "_s_ip"), (USER_AGENT, "_s_ua")],
                     strict=((VISITOR_HASH, "_s_hash"), (BUCKET, "_s_bucket")))


def bucket_keys() -> list[Column]:
    """The keys of a bucket table under the names that ``same_bucket`` joins on."""
    return [F.col(VISITOR_HASH).alias("_s_hash"), F.col(IP).alias("_s_ip"),
            F.col(USER_AGENT).alias("_s_ua"), F.col(BUCKET).alias("_s_bucket")]


def attach_session_ids(hits: DataFrame, timeout_seconds: int, only: Column | None = None,
                       tie: str | None = None, bucket_seconds: int | None = None) -> DataFrame:
    """Add ``session_id`` to the hits, or to those that ``only`` selects.

    Session boundaries always come from every hit of the visitor. With
    ``only``, buckets without a selected hit leave the plan before the join.
    """
    hits = with_hit_ts(hits)
    width = bucket_width(timeout_seconds, bucket_seconds)
    wanted = () if only is None else (F.max(F.coalesce(only, F.lit(False))).alias("_wanted"),)
    buckets = visitor_buckets(hits, timeout_seconds, wanted, width)
    if only is not None:
        buckets = buckets.where("_wanted")
        hits = hits.where(only)
    buckets = buckets.select(*bucket_keys(), F.col(SESSION_ID).alias("_s_session"))
    keyed = hits.withColumns({VISITOR_HASH: visitor_hash(), BUCKET: time_bucket(F.col(HIT_TS), width)})
    joined = keyed.join(buckets, same_bucket(keyed, buckets), "left")
    session = F.when(F.col(HIT_TS).isNull(), untimed_session(tie)).otherwise(F.col("_s_session"))
    return joined.select(*[c for c in hits.columns if c != SESSION_ID], session.alias(SESSION_ID))


def session_numbers(hits: DataFrame, timeout_seconds: int, tie: str | None = None,
                    bucket_seconds: int | None = None) -> DataFrame:
    """W2. Every hit plus its visitor's ``session_id`` (1, 2, ... in time order)."""
    return attach_session_ids(hits, timeout_seconds, tie=tie, bucket_seconds=bucket_seconds)


def inactivity_gap(hits: DataFrame, tie: str,
                   bucket_seconds: int = DEFAULT_GAP_BUCKET_SECONDS) -> DataFrame:
    """W1. Every hit plus ``gap``: seconds since the visitor's previous hit.

    Hits are ordered by ``(hit_ts, tie)``; ``tie`` must be a non-null,
    unique column such as an event id. The first hit of a visitor and hits
    without a time get NULL, and a hit at the same second as the one
    before it gets 0.

    Work is done on the distinct ``(visitor, second)`` times. Each bucket also
    gets the last time of the visitor's previous bucket, from a window over
    buckets, as a row of its own. Then one window over ``(visitor, bucket)``, of
    at most ``bucket_seconds + 1`` rows, gives each time its predecessor. The
    distinct times feed both windows through one exchange.
    """
    width = int(bucket_seconds)
    if width < 1:
        raise ValueError("bucket_seconds must be at least 1")
    hits = with_hit_ts(hits).withColumn(VISITOR_HASH, visitor_hash())
    visitor = (VISITOR_HASH, IP, USER_AGENT)
    times = (hits.where(F.col(HIT_TS).isNotNull())
             .groupBy(*visitor, HIT_TS).agg(F.min(tie).alias("_first_tie"))
             .withColumn(BUCKET, time_bucket(F.col(HIT_TS), width)))

    across = Window.partitionBy(*visitor).orderBy(BUCKET)
    # the tie is carried, though not used, so that both branches read the same exchange
    before = (times.groupBy(*visitor, BUCKET)
              .agg(F.max(HIT_TS).alias(LAST_TS), F.min("_first_tie").alias("_first_tie"))
              .withColumn(HIT_TS, F.lag(LAST_TS).over(across))
              .where(F.col(HIT_TS).isNotNull()))
    columns = (*visitor, BUCKET, HIT_TS, "_first_tie")
    both = times.select(*columns, F.lit(True).alias("_own")).unionByName(
        before.select(*columns, F.lit(False).alias("_own")))
    within = Window.partitionBy(*visitor, BUCKET).orderBy(HIT_TS)
    prev = (both.withColumn("_prev", F.lag(HIT_TS).over(within)).where("_own")
            .select(F.col(VISITOR_HASH).alias("_s_hash"), F.col(IP).alias("_s_ip"),
                    F.col(USER_AGENT).alias("_s_ua"), F.col(HIT_TS).alias("_s_ts"), "_first_tie", "_prev"))
    on = key_match(hits, prev, [(IP, "_s_ip"), (USER_AGENT, "_s_ua")],
                   strict=((VISITOR_HASH, "_s_hash"), (HIT_TS, "_s_ts")))
    joined = hits.join(prev, on, "left")
    gap = (F.when(F.col(tie) == F.col("_first_tie"), F.col(HIT_TS) - F.col("_prev"))
           .when(F.col("_first_tie").isNotNull(), F.lit(0).cast("bigint")))
    return joined.withColumn(GAP, gap).drop("_s_hash", "_s_ip", "_s_ua", "_s_ts", "_first_tie", "_prev",
                                            VISITOR_HASH)
