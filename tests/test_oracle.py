"""Every registered query against its DuckDB oracle on the driver's tables.

The oracle computes sessions from the visitors' own times, so this also checks
the bucketed session plan end to end.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod
from conftest import TESTDATA, duck_for, rows_of_duck, rows_of_spark

SF = os.environ.get("CLICKCREDIT_ORACLE_SF", "0.001")
SF_DIR = TESTDATA / f"sf{SF}"

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duck_for(SF_DIR)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(entry_mod._QUERIES) <= set(entry_mod.oracle_sql())
    assert set(entry_mod._QUERIES) <= set(entry_mod.queries())


def test_oracle_shares_no_constant_with_the_library():
    import clickcredit
    from clickcredit import rules
    from clickcredit.functions import hits, text
    assert clickcredit and entry_mod._SPACES
    library = {text.WHITESPACE_CLASS, hits.NUMBER, rules.DEFAULT_ENGINES, rules.DEFAULT_KEYWORD_PARAMS}
    own = {v for k, v in vars(entry_mod).items() if isinstance(v, (str, tuple)) and not k.startswith("__")}
    assert not library & own
    assert not any("regexp" in entry_mod.oracle_sql()[name] for name in entry_mod._QUERIES)


@pytest.mark.parametrize("name", sorted(entry_mod._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, str(SF_DIR))
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(duck, entry_mod.oracle_sql()[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["Search Engine Domain", "Search Keyword", "Revenue"]
    assert df.count() > 0
