"""Token ids on disk as directly addressable codes.

An id is cut into chunks of 8 bits. Level 0 holds the lowest chunk of every id
and, as a bitmap, whether the id goes on; level 1 holds the next chunk of
those that do, and so on. A rank directory counts the set bits before each
64-bit word of a bitmap. So token ``i`` is found with one look at each of its
levels: the rank of its continuation bit is its place on the next level.
Nothing has to be decoded before it.

A block of codes is a string of bytes, little-endian::

    'DAC1', levels u32, ids u64,
    then for each level: its ids u64, bitmap words u64 each,
    directory u32 for each word, chunks u8 each, zeros to a multiple of 8

``write_tokens`` encodes documents in ascending id order into such blocks, each
of whole documents. A block is one row of a Parquet table, so tasks commit as
Spark's writers do, on any file system: a lost executor leaves nothing half
written. ``read_tokens`` reads the documents back.

Defined cases: a null text counts as empty, and an empty one has the end id
alone; null ids come first; rows that share an id follow in the order of
their text's hash; an empty table gives an empty store; a very long text is a
block of its own; other columns are never read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import prepare_workers, text_of
from .words import SPACE, parts_of, word_hashes

MAGIC = b"DAC1"
CHUNK = 8
BLOCK_TOKENS = 1 << 20
#: Words and parts of words that a worker remembers.
_CACHED_WORDS, _CACHED_PARTS = 2_000_000, 200_000
_BATCH_CHARS = 1 << 22


def encode(ids: np.ndarray) -> bytes:
    """The codes of an array of ids below 2 ** 32."""
    rest = np.ascontiguousarray(ids, np.uint32)
    levels = []
    while len(rest) or not levels:
        more = rest >= 1 << CHUNK
        bits = np.packbits(np.append(more, np.zeros(-len(rest) % 64, bool)), bitorder="little")
        words = bits.view("<u8")
        ones = np.bitwise_count(words).astype(np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        body = b"".join((struct.pack("<Q", len(rest)), words.tobytes(), ranks.astype("<u4").tobytes(),
                         (rest & ((1 << CHUNK) - 1)).astype(np.uint8).tobytes()))
        levels.append(body + bytes(-len(body) % 8))
        rest = rest[more] >> CHUNK
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class Codes:
    """Random access to the ids of a block."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of codes")
        count, self.length = struct.unpack_from("<IQ", data, 4)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = 16
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", data, at)
            words = -(-n // 64)
            bitmap = np.frombuffer(data, "<u8", words, at + 8)
            ranks = np.frombuffer(data, "<u4", words, at + 8 + 8 * words)
            chunks = np.frombuffer(data, np.uint8, n, at + 8 + 12 * words)
            size = 8 + 12 * words + n
            at += size + -size % 8
            self.levels.append((bitmap, ranks, chunks))

    def __len__(self) -> int:
        return self.length

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.length:
            raise IndexError(i)
        return int(self.take(np.array([i]))[0])

    def range(self, lo: int, hi: int) -> np.ndarray:
        """The ids from place ``lo`` to ``hi``; on every level they lie next to each other."""
        out, owner = np.zeros(hi - lo, np.uint32), np.arange(hi - lo)
        for k, (bitmap, ranks, chunks) in enumerate(self.levels):
            if lo == hi:
                break
            out[owner] |= chunks[lo:hi].astype(np.uint32) << np.uint32(CHUNK * k)
            bits = np.unpackbits(bitmap[lo >> 6:(hi + 63) >> 6].view(np.uint8), bitorder="little")
            more = np.flatnonzero(bits[lo & 63:(lo & 63) + hi - lo])
            # the ids before ``lo`` that go on come first on the next level
            below = bitmap[lo >> 6] & ((np.uint64(1) << np.uint64(lo & 63)) - np.uint64(1))
            lo = int(ranks[lo >> 6]) + int(np.bitwise_count(below))
            hi, owner = lo + len(more), owner[more]
        return out

    def take(self, at: np.ndarray) -> np.ndarray:
        """The ids at these places, in their order."""
        out = np.zeros(len(at), np.uint32)
        owner, at = np.arange(len(at)), np.asarray(at, np.int64)
        for k, (bitmap, ranks, chunks) in enumerate(self.levels):
            out[owner] |= chunks[at].astype(np.uint32) << np.uint32(CHUNK * k)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            more = (bitmap[word] >> bit & np.uint64(1)).astype(bool)
            word, bit, owner = word[more], bit[more], owner[more]
            if not len(owner):
                break
            below = bitmap[word] & ((np.uint64(1) << bit) - np.uint64(1))
            at = ranks[word].astype(np.int64) + np.bitwise_count(below)
        return out


#: Closing marks that no added token holds, so that a word may be cut before them.
_TAIL = ".,!?;:%&*#$)\""
_LETTER_RUNS = "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _parts_letters(definition: str) -> bool:
    """Whether the tokenizer lower-cases, and parts letters and digits from anything else by pattern."""
    parsed = json.loads(definition)

    def steps(key: str, inner: str) -> list[dict]:
        top = parsed.get(key) or {}
        return top.get(inner, [top])

    lowers = any(s.get("type") == "Lowercase" for s in steps("normalizer", "normalizers"))
    splits = any(s.get("type") == "Split" and s["pattern"].get("Regex", "").endswith(_LETTER_RUNS)
                 for s in steps("pre_tokenizer", "pretokenizers"))
    added = "".join(t["content"] for t in parsed.get("added_tokens", []))
    return lowers and splits and not set(_TAIL) & set(added)


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes before merging: visible Latin-1 ones for themselves, the rest from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def _merges_letters(definition: str) -> bool:
    """Whether a run of plain lower-case letters goes to the merges as it is, byte by byte."""
    parsed = json.loads(definition)
    normalizer, splitter = parsed.get("normalizer") or {}, parsed.get("pre_tokenizer") or {}
    steps = [x["type"] for x in splitter.get("pretokenizers", [])]
    return (_parts_letters(definition) and parsed["model"]["type"] == "BPE" and steps == ["Split", "ByteLevel"]
            and not splitter["pretokenizers"][1]["add_prefix_space"] and not splitter["pretokenizers"][1]["use_regex"]
            and {x["type"] for x in normalizer.get("normalizers", [normalizer])} <= {"NFC", "Lowercase", "Replace"}
            and all(x["pattern"] == {"Regex": "\\s+"} for x in normalizer.get("normalizers", []) if x["type"] == "Replace")
            and not any(t["content"].isalpha() for t in parsed.get("added_tokens", [])))


def _cut(word: str) -> tuple[str, str]:
    """A word as lower-case letters and closing marks, which such a tokenizer encodes apart.

    A word that may hold an added token, or letters whose lower case or
    composition is not plain (from U+0130 on), stays whole.
    """
    if "<" in word or not (word.isascii() or max(word) < "\u0130"):
        return word, ""
    core = word.rstrip(_TAIL)
    if core and core[-1].isalnum():
        return core.lower(), word[len(core):]
    return word.lower(), ""


class _Words:
    """Encoded words of a worker: their sorted 64-bit hashes, and where the ids of each lie."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.parts = _parts_letters(definition)
        self.merge = self.tokenizer.model.tokenize if _merges_letters(definition) else None
        #: Parts of words, those of the current generation and of the one before.
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.first, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the bounds of each text's."""
        data = "\n".join(texts).encode()
        offsets = np.cumsum([0, *(len(t) if t.isascii() else len(t.encode()) for t in texts)]) + np.arange(len(texts) + 1)
        starts, hashes = word_hashes(data)
        distinct, at, word = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > _CACHED_WORDS:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        known = np.append(self.keys, np.uint64(0))[place] == distinct
        known &= place < len(self.keys)
        if not known.all():
            self._learn(distinct[~known], data, starts[at[~known]])
            place = np.searchsorted(self.keys, distinct)
        first, sizes = self.first[place][word], self.sizes[place][word]
        ends = np.cumsum(sizes)
        out = self.ids[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return out, np.append(0, ends)[np.searchsorted(starts, offsets)]

    def _learn(self, keys: np.ndarray, data: bytes, starts: np.ndarray) -> None:
        """Add words that start at these places of ``data``."""
        breaks = np.append(np.flatnonzero(SPACE[np.frombuffer(data, np.uint8)]), len(data))
        ends = breaks[np.searchsorted(breaks, starts)]
        found = self._encoded([data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        sizes = np.array([len(x) // 4 for x in found], np.int64)
        first = len(self.ids) + np.cumsum(sizes) - sizes
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.first = np.concatenate((self.first, first))[order]
        self.sizes = np.concatenate((self.sizes, sizes))[order]
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(found), "<u4")))

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit numbers."""
        if len(self.now) > _CACHED_PARTS:
            self.now, self.before = {}, self.now
        cut = [_cut(w) if self.parts else (w, "") for w in words]
        wanted = {p for c in cut for p in c}
        lost = wanted.difference(self.now)
        self.now.update((p, self.before[p]) for p in lost.intersection(self.before))
        new = lost.difference(self.before)
        if self.merge:
            # most parts: no normalising or splitting is left to do
            plain = [p for p in new if p.isascii() and p.isalpha() and p.islower()]
            plain += [p for p in new if not p.isascii() and p.isalpha() and p == p.lower() and max(p) < "\u0130"]
            for part in plain:
                letters = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LETTERS)
                self.now[part] = array("I", [t.id for t in self.merge(letters)]).tobytes()
            new = new.difference(plain)
        new = list(new)
        for part, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.now[part] = array("I", found.ids).tobytes()
        return [self.now[a] + self.now[b] if b else self.now[a] for a, b in cut]


@cache
def _words(definition: str) -> _Words:
    return _Words(definition)


def token_bytes(texts: list[str], definition: str) -> list[bytes]:
    """The ids of each text as little-endian 32-bit numbers.

    The tokenizer must drop white space and never join across it, so a text is
    encoded word by word. Words are told apart by 64-bit hashes: each distinct
    one is encoded once, and the texts' ids are gathered by arrays.
    """
    ids, bounds = _words(definition).encode(texts)
    return [ids[lo:hi].tobytes() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _encode_blocks(definition: str, end_id: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, block = TaskContext.get().partitionId(), 0
        end = array("I", [end_id]).tobytes()
        ids: list[pa.Array] = []
        tokens: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, size
            bounds = np.cumsum([0, *(len(t) // 4 for t in tokens)])
            one = pa.concat_arrays(ids)
            row = pa.record_batch({
                "shard": pa.array([partition], pa.int32()), "block": pa.array([block], pa.int32()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(one)], pa.int32()), one),
                "bounds": pa.array([bounds], pa.list_(pa.int64())),
                "n_tokens": pa.array([bounds[-1]], pa.int64()),
                "codes": pa.array([encode(np.frombuffer(b"".join(tokens), "<u4"))], pa.binary())})
            block, size = block + 1, 0
            ids.clear()
            tokens.clear()
            return row

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in parts_of([len(t) for t in texts], _BATCH_CHARS):
                for i, found in zip(range(part.start, part.stop), token_bytes(texts[part], definition),
                                    strict=True):
                    ids.append(batch.column("id").slice(i, 1))
                    tokens.append(found + end)
                    size += len(found) // 4 + 1
                    if size >= block_tokens:
                        yield flush()
        if tokens:
            yield flush()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``docs`` with the ``tokenizers`` file ``tokenizer`` into blocks below ``path``.

    The table has ``shard, block, ids, bounds, n_tokens, codes``: blocks in
    ascending ``(shard, block)`` hold the documents in ascending id order;
    document ``k`` of a block has its tokens ``bounds[k]`` to ``bounds[k + 1]``.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    # the hash parts the rows of an id that a third of the table may share
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        T.StructField("bounds", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("codes", T.BinaryType())])
    (placed.mapInArrow(_encode_blocks(definition, end_id, block_tokens), schema)
     .write.option("compression", "zstd").parquet(path))


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            codes = Codes(batch.column("codes")[i].as_py())
            bounds = batch.column("bounds")[i].values.to_numpy()
            digest = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                crc = 0
                for at in range(lo, hi, 1 << 20):
                    found = codes.range(at, min(at + (1 << 20), hi))
                    crc = zlib.crc32(found.astype("<u4").tobytes(), crc)
                digest.append(crc)
            n = len(digest)
            yield pa.record_batch({
                "id": batch.column("ids")[i].values,
                "shard": pa.array(np.full(n, batch.column("shard")[i].as_py(), np.int32)),
                "block": pa.array(np.full(n, batch.column("block")[i].as_py(), np.int32)),
                "block_start": pa.array(bounds[:-1]), "n_tokens": pa.array(np.diff(bounds)),
                "ids_crc32": pa.array(digest, pa.int64())})


def block_starts(store: DataFrame) -> DataFrame:
    """``shard, block, first``: the tokens of all blocks before each block.

    The running sum within a shard, and over the sums of the shards (one row per task that wrote).
    """
    blocks = store.select("shard", "block", "n_tokens")
    within = F.expr("sum(n_tokens) OVER (PARTITION BY shard ORDER BY block) - n_tokens")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.expr("sum(n) OVER (ORDER BY shard) - n").alias("shard_first"))
    return blocks.withColumn("within", within).join(shards, "shard").select(
        "shard", "block", (F.col("shard_first") + F.col("within")).alias("first"))


def read_tokens(store: DataFrame) -> DataFrame:
    """Read every document back: ``id, start, n_tokens, ids_crc32, shard, block, block_start``.

    ``store`` is the table that ``write_tokens`` wrote. ``start`` counts the
    tokens of all documents before it.
    """
    schema = T.StructType([
        T.StructField("id", store.schema["ids"].dataType.elementType),
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("block_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])
    prepare_workers(store.sparkSession)
    found = store.select("shard", "block", "ids", "bounds", "codes").mapInArrow(_read_blocks, schema)
    return found.join(block_starts(store), ["shard", "block"]).select(
        "id", (F.col("first") + F.col("block_start")).alias("start"), "n_tokens", "ids_crc32",
        "shard", "block", "block_start")
