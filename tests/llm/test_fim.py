from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from clickcredit.llm import fim as M

from .conftest import documents, prose

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rate=50, spm_rate=80):
    """The definition, unit by unit: ``n, form, prefix, middle, output``."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def found(df, **kw):
    rows = M.transform(df, **kw)
    return rows.withColumn("back", M.restored(rows["output"], rows["form"])).collect()


TEXTS = ["", " ", "\n\t", "one", " one", "one ", "a b c", "  a b \x1cc\n\n", "x\x00y z\x85 w", "é è 😀 漢字 ünï",
         "<", "a <P b", "ends in <", "<P>", "has <M> inside", "<S", "P> <S", "tail \x0b\x0c\r"]


@pytest.mark.parametrize("rate,spm_rate", [(50, 80), (100, 50), (100, 0), (0, 100)])
def test_as_by_the_definition(spark, rate, spm_rate):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(1000 + i, prose(i, i)) for i in range(60)]
    rows += [(2000, None), (2001, "word\t" * 200_000), (2002, "x" * 1_000_000)]
    got = {r.id: r for r in found(documents(spark, rows), rate=rate, spm_rate=spm_rate)}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(i, t, rate, spm_rate)
        assert r.back == (t or "")
    if rate == 50:
        assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é<>PSM \t\n\x0b\x1c\x85　😀")), min_size=1, max_size=5),
       st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_units_cover_the_text(texts, draws):
    array = pa.array([t.encode() for t in texts], pa.large_binary())
    units, parents = M.units_of(array)
    for i, t in enumerate(texts):
        assert [u.decode() for u, p in zip(units.to_pylist(), parents, strict=True) if p == i] == UNIT.findall(t)
    made = M.examples(array, [np.full(len(texts), d) for d in draws], 100, 50, M.Sentinels())
    for t, out, form in zip(texts, made["output"].to_pylist(), made["form"].to_pylist(), strict=True):
        cut = len(UNIT.findall(t)) > 0 and not any(x in t for x in M.Sentinels())
        assert (form != "plain") == cut and (cut or out.decode() == t)


def test_other_sentinels(spark):
    marks = M.Sentinels("[pre]", "[suf]", "[mid]")
    rows = [(i, prose(i, 20)) for i in range(40)] + [(50, "holds [mid] it"), (51, "holds <P> and <S>")]
    made = M.transform(documents(spark, rows), rate=100, sentinels=marks)
    out = made.withColumn("back", M.restored(made["output"], made["form"], marks)).collect()
    assert {r.id: r.back for r in out} == dict(rows)
    assert {r.id for r in out if r.form == "plain"} == {50}
    assert all(m in r.output for r in out if r.id != 50 for m in marks)


def test_odd_rows(odd, nothing):
    got = sorted(((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found(odd, rate=100)), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.doc_id, r.text, 100)) for r in odd.collect()), key=repr)
    assert found(nothing) == []
