from __future__ import annotations

import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickcredit.llm import token_store as S
from clickcredit.llm.shared import scratch_path

from .conftest import documents, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1), st.sampled_from([255, 256, 65535, 65536, 2**24])),
                max_size=300))
def test_codes_round_trip_and_random_access(ids):
    codes = S.Codes(S.encode(np.array(ids, np.uint32)))
    assert len(codes) == len(ids)
    assert codes.take(np.arange(len(ids))).tolist() == ids
    for i in range(0, len(ids), 7):
        assert codes[i] == ids[i]
    for lo, hi in ((0, len(ids)), (0, 0), (len(ids) // 3, len(ids)), (len(ids) // 2, len(ids) // 2 + min(1, len(ids) // 2))):
        assert codes.range(lo, hi).tolist() == ids[lo:hi]
    back = np.arange(len(ids))[::-1]
    assert codes.take(back).tolist() == ids[::-1]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text(
    st.sampled_from("aAzZéÉßÿŸİıŒſΣς'.,!?;:%&*#$)\"<|>-_0129²¼ªº \n\t\x0b\u0301\u00a0"), max_size=30) | st.lists(
    st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "It's", "'s.", "don't!", "(a)", "x.y.", "A²)", "IJ\u0130", " "]), max_size=6).map("".join))
def test_words_give_the_tokens_of_the_text(text):
    definition = open(PATH, encoding="utf-8").read()
    whole = np.array(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, "<u4")
    assert S.token_bytes([text], definition) == [whole.tobytes()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=0x41, max_codepoint=0x250, categories=["L"]), min_size=1, max_size=14), max_size=8))
def test_letters_go_straight_to_the_merges(words):
    definition = open(PATH, encoding="utf-8").read()
    assert S._merges_letters(definition)
    whole = np.array(Tokenizer.from_file(PATH).encode(" ".join(words), add_special_tokens=False).ids, "<u4")
    assert S.token_bytes([" ".join(words)], definition) == [whole.tobytes()]


def test_a_tokenizer_of_another_kind_is_asked_word_by_word():
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert S._parts_letters(open(PATH, encoding="utf-8").read())
    assert not S._parts_letters(open(other, encoding="utf-8").read())
    assert not S._merges_letters(open(other, encoding="utf-8").read())


def test_access_beyond_the_end_fails():
    codes = S.Codes(S.encode(np.array([1, 500], np.uint32)))
    for i in (-1, 2):
        with pytest.raises(IndexError):
            codes[i]
    with pytest.raises(ValueError):
        S.Codes(b"nonsense........")


def brute(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, t in sorted(rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


NASTY = ["", None, "a b c d\x0be\x0cf\x1cg\x85h", "<|endoftext|> x<|startoftext|>y", "é ́ e", "It's I'LL they've 's",
         "漢字かな交じり文 ＡＢＣ ﬁ İ ẞ", "0123 4.5e-6 \U0001f600‍\U0001f525", " \n\t ", "x" * 50_000, prose(1, 3000), "\r\n a \r b"]


def test_documents_come_back_as_the_tokenizer_encodes_them(spark):
    rows = [(i * 7 % 100, t) for i, t in enumerate(NASTY)] + [(1000 + i, prose(i, i)) for i in range(50)]
    path = scratch_path(spark, "test-tokens")
    S.write_tokens(documents(spark, rows).repartition(5), path, PATH, 1, block_tokens=400)
    store = spark.read.parquet(path)
    assert store.count() > 5
    got = sorted(tuple(r) for r in S.read_tokens(store).select("id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute(rows)


def test_any_token_of_any_document(spark):
    rows = [(i, prose(i, 30 + i)) for i in range(20)]
    path = scratch_path(spark, "test-tokens")
    S.write_tokens(documents(spark, rows), path, PATH, 1, block_tokens=300)
    tokenizer = Tokenizer.from_file(PATH)
    for r in spark.read.parquet(path).collect():
        codes = S.Codes(bytes(r.codes))
        for k, i in enumerate(r.ids):
            ids = tokenizer.encode(rows[i][1], add_special_tokens=False).ids + [1]
            assert [codes[r.bounds[k] + j] for j in (0, len(ids) // 2, len(ids) - 1)] == [ids[0], ids[len(ids) // 2], 1]


def test_odd_rows(spark, odd, nothing):
    path = scratch_path(spark, "test-tokens")
    S.write_tokens(odd, path, PATH, 1)
    got = S.read_tokens(spark.read.parquet(path)).orderBy("start").collect()
    assert len(got) == odd.count() and got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    ids = [r.id for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    empty = scratch_path(spark, "test-tokens")
    S.write_tokens(nothing, empty, PATH, 1)
    assert S.read_tokens(spark.read.parquet(empty)).collect() == []
