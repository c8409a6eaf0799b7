"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import contextlib
import io
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from clickcredit import operators as ops
from clickcredit.plans import search_revenue
from clickcredit.sources import read_hits_parquet

T = 1_000_000


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def parquet_hits(spark):
    """A hit table with all twelve columns, one hot visitor holding a third of the rows."""
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        ip, ua = ("9.9.9.9", "bot") if hot else (f"10.0.{i % 17}.1", f"ua{i % 5}")
        ref = "http://www.google.com/search?q=k%d" % (i % 4) if i % 7 == 0 else "http://shop/"
        rows.append((str(T + i * 37), "2009-09-27", ua, ip, "1" if i % 5 == 0 else "2",
                     "Salem", "OR", "US", "Home", "http://shop/", f"E;A;1;{i % 11};", ref))
    cols = ["hit_time_gmt", "date_time", "user_agent", "ip", "event_list", "geo_city",
            "geo_region", "geo_country", "pagename", "page_url", "product_list", "referrer"]
    path = tempfile.mkdtemp(prefix="clickcredit-plan-") + "/hits"
    spark.createDataFrame(rows, cols).repartition(4).write.parquet(path)
    return path


def test_scan_is_pruned_and_filtered(spark, parquet_hits):
    plan = _plan(search_revenue(read_hits_parquet(spark, parquet_hits)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    names = {f.split(":")[0] for f in schema.split(",")}
    assert names == {"hit_time_gmt", "user_agent", "ip", "event_list", "product_list", "referrer"}
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "IsNotNull(ip)" in pushed and "IsNotNull(user_agent)" in pushed


def test_flagship_has_no_join_and_windows_only_buckets(spark, parquet_hits):
    plan = _plan(search_revenue(read_hits_parquet(spark, parquet_hits)))
    tree = plan.split("\n\n")[0]
    assert "Join" not in tree
    # the first exchange carries partial aggregates keyed by the time bucket,
    # so the per-visitor window reads bucket summaries, never raw hits
    exchanges = re.findall(r"Exchange \((\d+)\)", tree)
    assert len(exchanges) == 5  # touches per bucket, buckets, window, keywords, final sort
    assert tree.count("Scan parquet") == 1
    # raw hits meet a hash aggregate: the aggregate nearest to the scan
    aggregates = re.findall(r"(\w+)Aggregate", tree)
    assert aggregates[-2:] == ["Hash", "Hash"]
    details = plan.split("\n\n")
    first_exchange = [d for d in details if d.startswith(f"({min(map(int, exchanges))}) Exchange")][0]
    assert "_bucket" in first_exchange
    assert tree.index("Window") < tree.index("SortAggregate", tree.index("Window"))


def test_hot_visitor_window_input_is_bounded(spark, parquet_hits):
    """A third of the hits belong to one visitor; its window sees one row per bucket."""
    hits = read_hits_parquet(spark, parquet_hits)
    hot_hits = hits.where(F.col("ip") == "9.9.9.9").count()
    buckets = ops.visitor_buckets(hits, 1800).where(F.col("ip") == "9.9.9.9")
    n_buckets = buckets.count()
    span = 3000 * 37
    assert hot_hits == 1000
    assert n_buckets <= span // 1800 + 2
    assert buckets.agg(F.max("session_id")).first()[0] == 1  # 111 s steps: one long session


def test_window_of_a_bot_with_many_keywords_sees_buckets(spark):
    """4,000 hits of one visitor in two hours, each with a keyword of its own."""
    from clickcredit.operators import attribution
    from conftest import hits_df
    rows = [(T + i * 7200 // 4000, "9.9.9.9", "bot", f"http://www.google.com/search?q=k{i}", "", "") for i in range(4000)]
    enriched = ops.enrich(hits_df(spark, rows))
    for tie in ("event_id", None):
        buckets = attribution._numbered_buckets(enriched, attribution.DEFAULT_RULES, tie, None).collect()
        assert len(buckets) <= 7200 // 1800 + 2
        assert min(r.touch for r in buckets).keyword == "k0"


@pytest.fixture(scope="module")
def session_queries():
    import __spark_entry__ as entry_mod
    from conftest import TESTDATA
    sf = TESTDATA / "sf0.001"
    if not sf.exists():
        pytest.skip("test tables not present")
    return entry_mod._QUERIES, str(sf)


def test_no_query_deals_rows_round_robin(spark, session_queries):
    queries, sf = session_queries
    assert len(queries) >= 16
    for name, query in queries.items():
        assert "RoundRobin" not in _plan(query(spark, sf)), name


def test_gap_reads_the_distinct_times_once(spark, session_queries):
    queries, sf = session_queries
    df = queries["inactivity_gap"](spark, sf)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    exchanges = len(re.findall(r"(?<!Reused)Exchange (?:hash|range|single)", final)) - final.count("ReusedExchange")
    assert final.count("ReusedExchange") == 1 and exchanges <= 6
    assert final.count("FileScan") == 2


@pytest.mark.parametrize("name", ["purchase_hits", "attributed_purchases"])
def test_only_buckets_with_a_purchase_meet_the_purchases(spark, session_queries, name):
    queries, sf = session_queries
    plan = _plan(queries[name](spark, sf))
    tree = plan.split("\n\n")[0]
    join = tree.index("Join")
    window = tree.index("Window")
    assert join < tree.index("Filter", join) < window  # the filter lies between the window and the join
    assert tree.count("Scan parquet") == 2


_PASS_THROUGH = ("Window", "Sort", "Project", "Exchange", "Filter", "AQEShuffleRead",
                 "WindowGroupLimit")


def _window_inputs(plan: str) -> list[str]:
    """For each Window node, the first node below it that is not a pass-through node."""
    tree = [line for line in plan.split("\n\n")[0].splitlines() if "(" in line]
    names = [re.sub(r"^[\s:+\-|]*", "", line).split(" (")[0].strip() for line in tree]
    found = []
    for i, name in enumerate(names):
        if name == "Window":
            below = next((n for n in names[i + 1:] if n not in _PASS_THROUGH), "")
            found.append(below)
    return found


@pytest.mark.parametrize("name", ["inactivity_gap", "session_numbers", "first_touch",
                                  "purchase_hits", "attributed_purchases", "keyword_revenue"])
def test_no_window_over_raw_hits(spark, name):
    """Every window in every registered session query reads aggregated rows."""
    import __spark_entry__ as entry_mod
    from conftest import TESTDATA
    sf = TESTDATA / "sf0.001"
    if not sf.exists():
        pytest.skip("test tables not present")
    inputs = _window_inputs(_plan(entry_mod.queries()[name](spark, str(sf))))
    assert inputs, "expected a window in the plan"
    # a union here is that of the distinct times with one row per bucket
    assert all(i.endswith("Aggregate") or i == "Union" for i in inputs), inputs
