"""Hit-file scan (S1), report sink (S4), report name (S5), and the whole job."""

from __future__ import annotations

import glob
import tempfile
from datetime import datetime
from pathlib import Path

import pytest

from clickcredit.plans import run_report, search_revenue
from clickcredit.sources import read_hits, report_name, write_report
from conftest import tsv

T = 1_000_000


def _scratch() -> Path:
    return Path(tempfile.mkdtemp(prefix="clickcredit-test-"))


def _write(text: str, name: str = "hits.tsv", newline: str = "") -> str:
    path = _scratch() / name
    with open(path, "w", encoding="utf-8", newline=newline) as f:
        f.write(text)
    return str(path)


def _two_session_rows():
    """One visitor, two sessions 90 minutes apart, each with its own search."""
    who = {"ip": "198.51.100.9", "user_agent": 'Walker/2.1 (a, "b"; c)'}
    shop = "http://www.esshopzilla.com/"
    return [
        who | {"hit_time_gmt": T + 11, "referrer": "http://www.google.com/search?q=anvil"},
        who | {"hit_time_gmt": T + 741, "event_list": "1", "product_list": "Tools;Anvil;1;72.5;", "referrer": shop},
        who | {"hit_time_gmt": T + 6141, "referrer": "http://www.bing.com/search?q=tongs"},
        who | {"hit_time_gmt": T + 6200, "event_list": "2,1", "product_list": "Tools;Tongs;2;13;", "referrer": shop},
    ]


def test_read_hits_binds_by_name_and_keeps_strings(spark):
    path = _write(tsv(_two_session_rows()))
    df = read_hits(spark, path)
    assert df.columns == ["hit_time_gmt", "user_agent", "ip", "event_list", "product_list", "referrer"]
    assert all(t == "string" for _, t in df.dtypes)
    assert df.count() == 4


def test_read_hits_reordered_columns(spark):
    cols = ["referrer", "ip", "hit_time_gmt", "product_list", "user_agent", "event_list", "pagename"]
    path = _write(tsv(_two_session_rows(), columns=cols))
    rows = [tuple(r) for r in search_revenue(read_hits(spark, path)).collect()]
    assert rows == [("google.com", "anvil", 72.5), ("bing.com", "tongs", 13.0)]


def test_read_hits_missing_column_is_an_error(spark):
    path = _write("hit_time_gmt\tip\n1\t2\n")
    with pytest.raises(Exception):
        read_hits(spark, path).columns  # noqa: B018


def test_quoted_agent_with_doubled_quotes_and_crlf(spark):
    text = ("hit_time_gmt\tuser_agent\tip\tevent_list\tproduct_list\treferrer\r\n"
            f'{T}\t"Mozilla (X, ""Y"" Z)"\t1.1.1.1\t\t\thttp://www.google.com/search?q=a\r\n'
            f'{T + 5}\t"Mozilla (X, ""Y"" Z)"\t1.1.1.1\t1\tE;A;1;10;\thttp://www.esshopzilla.com/\r\n')
    path = _write(text)
    agents = {r.user_agent for r in read_hits(spark, path).collect()}
    assert agents == {'Mozilla (X, "Y" Z)'}
    assert [tuple(r) for r in search_revenue(read_hits(spark, path)).collect()] == [
        ("google.com", "a", 10.0)]


def test_short_and_long_rows(spark):
    text = ("hit_time_gmt\tuser_agent\tip\tevent_list\tproduct_list\treferrer\n"
            f"{T}\tA\t1.1.1.1\t\t\thttp://www.google.com/search?q=a\textra\n"
            f"{T + 5}\tA\t1.1.1.1\t1\tE;A;1;10;\n")
    rows = read_hits(spark, _write(text)).orderBy("hit_time_gmt").collect()
    assert rows[0].referrer == "http://www.google.com/search?q=a"
    assert rows[1].referrer is None
    assert [tuple(r) for r in search_revenue(read_hits(spark, _write(text))).collect()] == [
        ("google.com", "a", 10.0)]


def test_header_only_gives_empty_report(spark):
    path = _write(tsv([]))
    rep = search_revenue(read_hits(spark, path))
    assert rep.columns == ["Search Engine Domain", "Search Keyword", "Revenue"]
    assert rep.count() == 0


def test_bad_time_is_an_error(spark):
    path = _write(tsv([{"hit_time_gmt": "yesterday", "ip": "1", "user_agent": "a"}]))
    with pytest.raises(Exception):
        search_revenue(read_hits(spark, path)).collect()


def test_report_name():
    assert report_name(datetime(2024, 3, 15)) == "2024-03-15_SearchKeywordPerformance.tab"
    assert report_name().endswith("_SearchKeywordPerformance.tab")


def _single_part(directory: str) -> str:
    parts = glob.glob(f"{directory}/part-*")
    assert len(parts) == 1
    return Path(parts[0]).read_text()


def test_write_report_round_trip(spark):
    rep = search_revenue(read_hits(spark, _write(tsv(_two_session_rows()))))
    out = str(_scratch() / "report")
    write_report(rep, out, single_file=True)
    text = _single_part(out)
    assert text.splitlines() == ["Search Engine Domain\tSearch Keyword\tRevenue",
                                 "google.com\tanvil\t72.50", "bing.com\ttongs\t13.00"]
    back = spark.read.option("sep", "\t").option("header", True).csv(out)
    assert [tuple(r) for r in back.collect()] == [("google.com", "anvil", "72.50"),
                                                  ("bing.com", "tongs", "13.00")]


def test_write_report_multi_part_keeps_global_order(spark):
    rows = [(f"d{i % 7}.com", f"k{i}", float(i % 13) + i / 1000) for i in range(300)]
    rep = spark.createDataFrame(rows, "`Search Engine Domain` string, `Search Keyword` string, "
                                      "Revenue double").repartition(5)
    out = str(_scratch() / "multi")
    write_report(rep, out)
    lines = []
    for part in sorted(glob.glob(f"{out}/part-*")):
        lines += Path(part).read_text().splitlines()[1:]
    revenues = [float(line.split("\t")[2]) for line in lines]
    assert len(lines) == 300
    assert revenues == sorted(revenues, reverse=True)


def test_write_empty_report_has_header(spark):
    rep = search_revenue(read_hits(spark, _write(tsv([]))))
    out = str(_scratch() / "empty")
    write_report(rep, out, single_file=True)
    assert _single_part(out).splitlines() == ["Search Engine Domain\tSearch Keyword\tRevenue"]


def test_run_report_writes_dated_directory(spark):
    src = _write(tsv(_two_session_rows()))
    target = run_report(spark, src, str(_scratch()), execution_date=datetime(2026, 3, 5), single_file=True)
    assert target.endswith("/2026-03-05_SearchKeywordPerformance.tab")
    assert _single_part(target).splitlines()[1] == "google.com\tanvil\t72.50"


def test_command_line_job(spark):
    from clickcredit.__main__ import main
    src = _write(tsv(_two_session_rows()))
    out = str(_scratch())
    target = main([src, out, "--date", "2026-03-05", "--timeout", "1800", "--single-file"])
    assert target == f"{out}/2026-03-05_SearchKeywordPerformance.tab"
    assert _single_part(target).splitlines()[1:] == ["google.com\tanvil\t72.50",
                                                     "bing.com\ttongs\t13.00"]
    # with a 6-hour timeout the two searches fall into one session
    target = main([src, out, "--date", "2026-03-06", "--timeout", "21600", "--single-file", "--repartition", "3"])
    assert _single_part(target).splitlines()[1:] == ["google.com\tanvil\t85.50"]


def test_command_line_rules(spark):
    from clickcredit.__main__ import main
    rows = [dict(r, referrer=r["referrer"].replace("google.com/search?q", "seekwell.org/find?term")) for r in _two_session_rows()]
    src, out = _write(tsv(rows)), str(_scratch())
    target = main([src, out, "--engines", "seekwell, bing", "--keyword-params", "term,q", "--site-domain", "shop.test",
                   "--date", "2026-03-05", "--single-file"])
    assert _single_part(target).splitlines()[1:] == ["seekwell.org\tanvil\t72.50", "bing.com\ttongs\t13.00"]


def _folder(*texts: str) -> str:
    folder = _scratch() / "hits"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"part{i}.tsv").write_text(text, encoding="utf-8", newline="")
    return str(folder)


def test_files_of_one_header_are_read_together(spark):
    rows = _two_session_rows()
    path = _folder(tsv(rows[:1]), tsv(rows[1:3]), tsv(rows[3:]))
    assert [tuple(r) for r in search_revenue(read_hits(spark, path)).collect()] == [
        ("google.com", "anvil", 72.5), ("bing.com", "tongs", 13.0)]


def test_files_of_different_headers_are_an_error(spark):
    rows = _two_session_rows()
    six = ["hit_time_gmt", "user_agent", "ip", "event_list", "product_list", "referrer"]
    path = _folder(tsv(rows[:2], six), tsv(rows[2:], [*six[3:], *six[:3]]))
    with pytest.raises(Exception, match="header"):
        read_hits(spark, path).collect()


def test_four_visitors_from_file_to_report(spark):
    """CRLF lines, quoted agents with tabs and quotes, searches with and without a purchase, in two files."""
    def hit(second, who, referrer, events="", products=""):
        agent = {"a": "Plain/1", "b": 'Says "hi"', "c": "Has\ttab", "d": "Comma, (x; y)"}[who]
        return {"hit_time_gmt": T + second, "ip": f"203.0.113.{ord(who)}", "user_agent": agent, "referrer": referrer,
                "event_list": events, "product_list": products}
    shop = "https://www.esshopzilla.com/checkout/"
    rows = [
        hit(5, "a", "http://www.google.com/search?q=Brass++Bell&hl=en"), hit(8, "b", "http://search.yahoo.com/search?p=oak+chair"),
        hit(9, "c", "https://duckduckgo.com/?q=%22brass+bell%22"), hit(40, "d", "http://www.google.com/search?q=brass%20bell"),
        hit(300, "b", shop, "2"), hit(900, "a", shop, "1,2", "Home;Bell;1;30.25;,Home;Cord;2;4.5;"),
        hit(901, "d", shop, "1", "Home;Bell;1;31;"), hit(1300, "c", shop, "1", "Home;Bell;1;29.99;"),
    ]
    path = _folder(tsv(rows[:5], line_end="\r\n", quote_all=True), tsv(rows[5:], line_end="\r\n", quote_all=True))
    out = str(_scratch())
    target = run_report(spark, path, out, execution_date=datetime(2026, 1, 2))
    assert target == f"{out}/2026-01-02_SearchKeywordPerformance.tab"
    back = spark.read.option("sep", "\t").option("header", True).option("escape", '"').csv(target)
    assert [tuple(r) for r in back.collect()] == [
        ("google.com", "brass bell", "65.75"), ("duckduckgo.com", '"brass bell"', "29.99")]
    lines = [x for p in sorted(glob.glob(f"{target}/part-*")) for x in Path(p).read_text().splitlines()]
    assert 'duckduckgo.com\t"""brass bell"""\t29.99' in lines
