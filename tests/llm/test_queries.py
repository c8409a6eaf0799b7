"""The registered queries and the pipeline on the smallest tables, against SQL or brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict

import pytest
from conftest import TESTDATA, duck_for, rows_of_duck, rows_of_spark

import corpus_pipeline
from clickcredit.llm import queries as Q
from clickcredit.llm import secret_scan
from clickcredit.llm.shared import materialize

from . import test_decontaminate, test_exact_dedup, test_line_dedup, test_ngram_lm, test_simhash, test_token_store

SF_DIR = TESTDATA / "sf0.001"
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]


def run(spark, name):
    return Q.queries()[name](spark, str(SF_DIR))


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    con = duck_for(SF_DIR)
    assert rows_of_spark(run(spark, name)) == rows_of_duck(con, Q.oracle_sql()[name])


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_query_language_id(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = run(spark, "op1_language_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_fill_in_middle"])
def test_sql_on_the_next_larger_tables(spark, name):
    sf_dir = TESTDATA / "sf0.01"
    found = rows_of_spark(Q.queries()[name](spark, str(sf_dir)))
    assert len(found[1]) > 100 and found == rows_of_duck(duck_for(sf_dir), Q.oracle_sql()[name])


def test_query_toxicity(spark):
    """On the next larger tables: the smallest hold too few labels to learn from."""
    sf_dir = str(TESTDATA / "sf0.01")
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = Q.queries()["op13_toxicity"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == ids
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) >= 0.9 * len(held)


def test_query_packing(spark, rows):
    got = run(spark, "op3_best_fit_packing").collect()
    sizes, bins = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.doc_id] += r.n_words
        bins[r.bin_id] += r.n_words
    assert sizes == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in rows}
    assert max(bins.values()) <= 2048


def test_query_secret_scan(spark):
    """On the next larger tables: the smallest hold too few secrets to learn from."""
    sf_dir = str(TESTDATA / "sf0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    text = dict(rows)
    got = Q.queries()["op4_secret_scan"](spark, sf_dir).collect()
    spans = {(i, m.start(), len(m.group())) for i, t in rows for m in re.finditer(r"[A-Za-z0-9_+/-]{16,}", t)}
    assert {(r.doc_id, r.start, r.n_chars) for r in got} == spans

    def confirmed(r):
        before, value = text[r.doc_id][:r.start], text[r.doc_id][r.start:r.start + r.n_chars]
        return bool(re.search(Q.CONFIRMED, value) or re.search(Q.CONFIRMED_VALUE, value)
                    and re.search(Q.CONFIRMED_BEFORE, before[-secret_scan._NEAR:]))
    held = [r for r in got if r.held_out]
    assert sum(r.is_secret == confirmed(r) for r in held) >= 0.95 * len(held)


def test_query_lm_score(spark, rows):
    brute = test_ngram_lm.Brute([t for i, t in rows if fold(i, 10) != 0], 0.0)
    got = {r.doc_id: r for r in run(spark, "op5_lm_score").collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        d, r = test_ngram_lm.tokens_of(t), got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            fold(i, 10) == 0, len(d), sum(brute.c[w] > 0 for w in d), brute.n)
        assert r.base_score == pytest.approx(sum(math.log10(brute.p1(w)) for w in d), rel=1e-9)
        assert r.score == pytest.approx(brute.score(t), abs=0.002 * len(d))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_query_token_store(spark, rows):
    got = run(spark, "op6_token_store").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == test_token_store.brute(rows)


def near_copies(rows):
    fps = {i: test_simhash.brute_fingerprint(t) for i, t in rows}
    root = test_simhash.brute_components(list(fps.values()))
    least = {}
    for i in sorted(fps):
        least.setdefault(root[fps[i]], i)
    return {i: (f"{f:016x}", least[root[f]]) for i, f in fps.items()}


def test_query_simhash(spark, rows):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op7_simhash_dedup").collect()}
    assert got == near_copies(rows)


def test_query_line_dedup(spark, rows):
    text = dict(rows)
    got = {}
    for r in run(spark, "op8_line_dedup").where("size(removed) > 0").collect():
        gone = {n for x in r.removed for n in range(x.first_line, x.last_line + 1)}
        got[r.doc_id] = {n for n, _ in test_line_dedup.lines_of(text[r.doc_id]) if n in gone}
    expected = test_line_dedup.brute(rows, 50)
    assert expected and got == expected


def test_query_decontaminate(spark, rows, items):
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in run(spark, "op9_decontaminate").collect()}
    assert got == test_decontaminate.brute(rows, items)


def test_pipeline_stage_by_stage(spark, docs, items):
    stages = dict(corpus_pipeline.STAGES)
    assert 4 <= len(stages) <= 5 and corpus_pipeline.ORACLE_SQL is None
    now = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r.doc_id, r.text) for r in now.collect())
        after = materialize(stage(spark, now, str(SF_DIR)), f"test-{name}")
        if name != "best_fit_packing":
            assert after.columns == docs.columns
            seen[name] = before, sorted((r.doc_id, r.text) for r in after.collect())
        now = after
    before, after = seen["language_id"]
    assert len(after) >= 0.99 * len(before)
    before, after = seen["exact_dedup"]
    assert [i for i, _ in after] == sorted(x[0] for x in test_exact_dedup.brute(before) if x[3])
    before, after = seen["simhash_near_dedup"]
    assert [i for i, _ in after] == sorted(i for i, (_, c) in near_copies(before).items() if i == c)
    before, after = seen["benchmark_decontamination"]
    copies = {i for i, _ in test_decontaminate.brute(before, items)}
    assert copies and [i for i, _ in after] == [i for i, _ in before if i not in copies]
    packed = now.collect()
    assert {r.doc_id for r in packed} == {i for i, _ in after}
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(SF_DIR)).collect())) == sorted(map(tuple, packed))
