from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickcredit.llm import exact_dedup as D

from .conftest import documents


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def marked(df, **kw):
    return sorted((tuple(r) for r in D.mark(df, **kw).select(
        "id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_odd_rows(odd):
    assert marked(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    rows = [(i, t) for i, t in enumerate(["ab", "cd", "ab", "ef", "", None, "xyz", "uvw", "xyz"])]
    df = documents(spark, rows)
    # every text of one length shares a hash, so chains have several entries
    assert marked(df, key=lambda c: F.xxhash64(F.length(c))) == brute(rows)


def test_rows_are_found_through_the_directory(spark, monkeypatch):
    rows = [(i, f"text {i % 300}") for i in range(600)] + [(1000 + i, f"once {i}") for i in range(50)]
    df = documents(spark, rows)
    assert marked(df, bucket_entries=8) == brute(rows)
    sound = D.directory

    def broken(*args):
        slots, depth = sound(*args)
        first = slots.agg(F.min("bucket")).first()[0]
        return slots.where(F.col("bucket") != first), depth
    monkeypatch.setattr(D, "directory", broken)
    lost = marked(df, bucket_entries=8)
    assert 0 < len(lost) < len(rows) and set(lost) < set(brute(rows))


def test_no_text_moves_but_repeated_ones(spark):
    df = documents(spark, [(i, f"{i}" * 50) for i in range(100)] + [(200 + i, "again") for i in range(5)])
    index = D.build_index(df)
    assert {(r.group_size, r.digest is None) for r in index.table.collect()} == {(1, True), (5, False)}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["", "a", "b ", "b", "A", "\n", "é", "é", "long " * 50]), max_size=30))
def test_any_groups(spark, texts):
    rows = list(enumerate(texts))
    assert marked(documents(spark, rows)) == brute(rows)


def test_directory_splits_until_no_bucket_is_overfull(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h"))
    # a third of all entries share their leading six bits
    skewed = spark.range(1000).select(F.shiftrightunsigned(F.xxhash64("id"), 6).alias("h"))
    both = hashes.unionByName(skewed)
    slots, depth = D.directory(both, bucket_entries=100)
    table = {r.slot: (r.bucket, r.depth) for r in slots.collect()}
    sizes = {}
    for r in both.collect():
        slot = (r.h & (1 << 64) - 1) >> 64 - depth
        bucket, local = table[slot]
        assert bucket == slot >> depth - local << depth - local
        sizes[bucket] = sizes.get(bucket, 0) + 1
    assert max(sizes.values()) <= 100
    assert len({d for _, d in table.values()}) > 1  # skewed hashes need deeper buckets


def test_deduplicate_keeps_one_row_of_each_text_and_all_columns(odd, nothing):
    kept = D.deduplicate(odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    rows = kept.collect()
    texts = [r.text or "" for r in rows]
    assert len(texts) == len(set(texts)) == len({r.text or "" for r in odd.collect()})
    assert {(r.doc_id, r.text) for r in rows} <= {(r.doc_id, r.text) for r in odd.collect()}
    assert 6 in [r.doc_id for r in rows] and 5 not in [r.doc_id for r in rows]
    assert all(r["ROOT"].startswith("ROOT-") and r["row_key"].startswith("row_key-") for r in rows)
    assert D.deduplicate(nothing).collect() == [] and D.mark(nothing).collect() == []
