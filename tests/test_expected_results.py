"""Published expected results of the events adapter (FIXTURES.md §4)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from clickcredit import operators as ops
from clickcredit.sources.events import read_event_hits
from conftest import TESTDATA

SF01 = TESTDATA / "sf0.01"

pytestmark = pytest.mark.skipif(not SF01.exists(), reason="test tables not present")


@pytest.mark.parametrize("sf,timeout,sessions", [
    ("0.001", 1800, 947), ("0.001", 21600, 606),
    ("0.01", 1800, 9579), ("0.01", 21600, 5946),
])
def test_session_counts(spark, sf, timeout, sessions):
    hits = read_event_hits(spark, str(TESTDATA / f"sf{sf}"))
    numbered = ops.session_numbers(hits, timeout, tie="event_id")
    assert numbered.select("ip", "user_agent", "session_id").distinct().count() == sessions


REPORT_1800 = [
    ("google.co.uk", "fall through", 6818.14), ("bing.com", "zune hd", 6669.42),
    ("duckduckgo.com", "100% wool", 6132.82), ("www.basket.com", "cart", 5920.63),
    ("google.com", "ipod", 5381.51), ("yahoo.com", "cd player", 4689.14),
]
REPORT_21600 = [
    ("google.co.uk", "fall through", 9472.90), ("google.com", "ipod", 8691.42),
    ("duckduckgo.com", "100% wool", 8226.90), ("www.basket.com", "cart", 8050.75),
    ("yahoo.com", "cd player", 7261.96), ("bing.com", "zune hd", 7018.64),
]


@pytest.mark.parametrize("name,expected", [("keyword_revenue", REPORT_1800),
                                           ("keyword_revenue_6h", REPORT_21600)])
def test_reports(spark, name, expected):
    got = [tuple(r) for r in entry_mod.queries()[name](spark, str(SF01)).collect()]
    assert got == expected
