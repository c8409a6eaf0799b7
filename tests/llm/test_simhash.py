from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from clickcredit.llm import simhash as S
from clickcredit.llm.components import connected_components

from .conftest import documents, prose


def brute_fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def brute_components(fps, bits=3):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprints():
    for t in ["", " \x0b", "One", "one two", "A b C d e f", "Éa éb c d\x1ce\x85f", "x y z " * 400, prose(3, 500)]:
        assert S.fingerprint(t) == brute_fingerprint(t)
        assert S.fingerprint(t, 1) == brute_fingerprint(t, 1)


def flips(rng, f, most):
    return f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most)))


def crafted(seed, centres, around, chains):
    """Balls, chains of steps of three bits, and the neighbours at four bits that must stay apart."""
    rng = random.Random(seed)
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        out += [flips(rng, c, 3) for _ in range(around)] + [c ^ 0b1111]
    for _ in range(chains):
        c = rng.getrandbits(64)
        for _ in range(12):
            c = flips(rng, c, 3)
            out.append(c)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def linked(spark, fps, **kw):
    rows = spark.createDataFrame([(i, 0, signed(f)) for i, f in enumerate(fps)], "id bigint, row_key bigint, fp bigint")
    return {r.fp & (1 << 64) - 1: r.id for r in S.components(rows, **kw).collect()}


def test_all_links_are_found_whatever_the_bucket_size(spark):
    fps = crafted(1, 20, 15, 15) + [0, 1, 3, 7, 15, (1 << 64) - 1]
    root = brute_components(fps)
    least = {}
    for i, f in enumerate(fps):
        least.setdefault(root[f], i)
    expected = {f: least[root[f]] for f in fps}
    assert linked(spark, fps) == expected
    # buckets that overflow are dealt again and again
    assert linked(spark, fps, bucket_rows=8) == expected


def test_a_dense_group_makes_few_links(spark):
    rng = random.Random(5)
    fps = list({flips(rng, 1 << 40, 3) for _ in range(1500)})
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    found = S.links(df, bucket_rows=256).collect()
    assert len(found) < 60 * len(fps)
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 9 for r in found)
    assert set(linked(spark, fps, bucket_rows=256).values()) == {0}


def test_pivot_discard_never_loses_a_pair():
    rng = np.random.default_rng(2)
    fp = np.array(crafted(9, 10, 20, 5), np.uint64)
    fp = np.unique(np.concatenate((fp, rng.integers(0, 1 << 63, 200, dtype=np.uint64))))
    a, b = S.linked(np.zeros(len(fp), np.int64), fp, 3, S.pivots())
    root = brute_components(fp.tolist())
    got = brute_components([])
    got = {f: f for f in fp.tolist()}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        got[x] = y
    assert {frozenset(f for f in root if root[f] == r) for r in root.values()} == {
        frozenset(f for f in got if got[f] == r) for r in got.values()}


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 400)]
    cycle = [(500, 501), (501, 502), (502, 500), (600, 600)]
    links = spark.createDataFrame(chain + star + cycle, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 400)}, 500: 500, 501: 500, 502: 500}


def test_odd_rows(odd, nothing):
    rows = odd.collect()
    fps = [brute_fingerprint(r.text or "") for r in rows]
    root = brute_components(fps)
    expected = []
    for r, f in zip(rows, fps, strict=True):
        ids = [x.doc_id for x, g in zip(rows, fps, strict=True) if root[g] == root[f] and x.doc_id is not None]
        expected.append((r.doc_id, signed(f), min(ids, default=None)))
    got = [(r.id, r.fp, r.component_id) for r in S.mark(odd).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    kept = S.deduplicate(odd)
    assert kept.schema == odd.schema
    stays = kept.collect()
    assert len(stays) == len(set(root.values()))
    assert {root[brute_fingerprint(r.text or "")] for r in stays} == set(root.values())
    assert S.mark(nothing).collect() == [] and S.deduplicate(nothing).collect() == []


def test_near_copies_leave_one_document(spark):
    base = prose(11, 3000)
    near = base.replace("alpha1 ", "alpha2 ", 1) if "alpha1 " in base else base + " tail"
    docs = documents(spark, [(10, prose(12, 300)), (3, near), (7, base), (5, base)])
    assert (S.fingerprint(base) ^ S.fingerprint(near)).bit_count() <= 3
    assert sorted(r.doc_id for r in S.deduplicate(docs).collect()) == [3, 10]
