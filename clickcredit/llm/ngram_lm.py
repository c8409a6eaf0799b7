"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are words (A-Z in lower case) and an end after each text. Training
counts all texts given, in three passes: words, pairs, triples. The model keeps
every pair and triple with ``MIN_COUNT`` occurrences, however large the corpus
(``share`` of ``train`` asks for more). The counts are Spark groupings over
everything and stay tables, which grow with the input.

The model is interpolated absolute discounting down to the additive word
model ``p1(w) = (c + 0.1) / (N + 0.1 (V + 1))``:

    p(w | h) = max(c(h w) - D, 0) / c(h) + back(h) p(w | shorter h)

with ``back(h)`` the mass that the kept n-grams leave, so probabilities sum to
one. So a kept n-gram adds a ``gain`` to the log probability that its shorter one
gives, and each context adds what it leaves (``left``) to the token behind it. Both are quantised to 16 bits on
one grid (``STEPS`` of ``elias_fano``), and a text's score is a sum of them over its words and n-grams.

All words and n-grams of the model are in Elias-Fano tries. The *head*, those that have a
share of ``HEAD_SHARE`` of all training tokens, is ``1 / HEAD_SHARE`` entries a
level at most. Its trie is one memory-mapped file, which Spark ships to each executor, so that
texts meet their most frequent n-grams where they are read. All others are in *shards*: tries
of about ``SHARD_NGRAMS`` entries, built by tasks, one for each range of context hashes, so that the
model grows with the corpus and no task or machine needs to hold it. A context of the head,
whose children can be many, has them in the shards of their own hashes instead. Where an
n-gram is kept doesn't change the score: its codes are the same.

The head's levels are words by their 64-bit hashes, then per level the pointers and the ids
relative to their context. A shard's are the same with contexts and children
by ``64 - CHILD_CUT`` bits of their hashes: a context's last, as the shard stands for its first ones. Texts are scored in batches where they are read.
What the head doesn't have goes to its shard as packed blocks, one for each batch and shard; the shard
sends back what each text of the block gains, and the batch sums that up. No key is hot: what is frequent is in the head.
Bitmaps of ``FILTER_BITS`` bits of the kept n-grams' hashes spare the shuffle most
of the n-grams that no shard has; where they are full they spare nothing and the results are the same.

Words and n-grams count as equal if their 64-bit hashes are (n-grams in a shard: if those bits of context and child are).

``docs`` of ``score`` should be a table: if an executor is lost, batches are cut again from the
rows in their order. If that order changed, ``score`` ends with an error instead of a mixed result.

Defined cases: a null text counts as empty and is one end; without training
texts N and V are 0 and every token has probability one; repeated rows are
scored each; null ids are carried; a very long text is scored in one piece
per row, its words as arrays; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .elias_fano import STEPS, EliasFano, Level, map_arrays, pack_arrays, view_arrays
from .shared import discard, materialize, prepare_workers, releasing, text_of, write_shared_file
from .words import parts_of, text_words

#: Least occurrences of a kept n-gram, and least share of the training tokens: none.
MIN_COUNT = 2
SHARE = 0.0
HEAD_SHARE = 2.5e-7
SHARD_NGRAMS = 1 << 20
CHILD_CUT = 24
FILTER_BITS = 27
ADD = 0.1
DISCOUNT = 0.75
END = np.uint64(0x9B97A6E2D5F41C03)
#: Characters whose n-grams are asked for together, and of them those that are hashed and looked up at a time.
_BATCH_CHARS = 1 << 21
_PART_CHARS = 1 << 19
_TALLY = 1 << 19
#: Training tokens, and so n-grams at most, of a range of keys that one group counts.
RANGE_TOKENS = 1 << 19
#: Characters that a text counts for besides its own, so that a batch has no more than 65,536 texts.
_TEXT_CHARS = 32


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, an end behind each, and their bounds."""
    hashes, bounds = text_words([t.encode().lower() for t in texts])
    return np.insert(hashes, bounds[1:], END), bounds + np.arange(len(bounds))


class _Tally:
    """Counts of keys with their first parts, given back whenever they are too many to keep."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, firsts, counts))
        self.size += len(keys)

    def full(self) -> bool:
        """Whether more keys than ``_TALLY`` are left after equal ones are put together."""
        if self.size > 2 * _TALLY:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
        return self.size > _TALLY

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each key once, in order; the parts are gone."""
        columns = [list(x) for x in zip(*self.parts, strict=True)]
        self.parts = []
        # a column's parts go as soon as they are put together
        keys, firsts, counts = (np.concatenate(columns.pop(0)) for _ in range(3))
        order = np.argsort(keys)
        keys = keys[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        return keys[heads], firsts[order[heads]], np.add.reduceat(counts[order], heads) if len(heads) else counts

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``merged``; the tally is empty afterwards."""
        found = self.merged()
        self.parts, self.size = [], 0
        return found


def _count(keys_of, give):
    """Arrow function: counts of the keys, with their first parts, that ``keys_of(tokens, bounds)`` gives, as batches by ``give``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in parts_of([len(t) for t in texts], _PART_CHARS):
                keys, firsts = keys_of(*_tokens(texts[part]))
                tally.add(keys, firsts, np.ones(len(keys), np.int64))
                if tally.full():
                    yield give(*tally.taken())
        if tally.size:
            yield give(*tally.taken())
    return run


def _word_rows(keys: np.ndarray, _: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"key": pa.array(keys.view(np.int64)), "n": pa.array(counts)})


def _key_range(keys: np.ndarray, parts: int) -> np.ndarray:
    """Of ``parts`` equal ranges of hashes the one that each is in."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _edges(places: np.ndarray) -> list[int]:
    """Where each run of equal places begins, and the end."""
    return np.append(np.flatnonzero(np.diff(places, prepend=-1)), len(places)).tolist()


def _by_place(name: str, places: np.ndarray, columns: Iterable[np.ndarray]) -> pa.RecordBatch:
    """The columns of rows in the order of ``places``, as one packed block for each place."""
    edges = _edges(places)
    blocks = [b"".join(x[lo:hi].tobytes() for x in columns) for lo, hi in zip(edges, edges[1:], strict=False)]
    return pa.record_batch({name: pa.array(places[edges[:-1]], pa.int32()), "block": pa.array(blocks, pa.binary())})


def _place_order(places: np.ndarray) -> np.ndarray:
    """Their stable order; numbers of 16 bits are sorted by radix."""
    return np.argsort(places.astype(np.uint16) if places.max(initial=0) < 1 << 16 else places, kind="stable")


def _ngram_blocks(parts: int):
    """Counts of sorted keys as one packed block for each range of keys."""
    def give(keys: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return _by_place("range", _key_range(keys, parts), (keys, firsts, counts.astype(np.uint64)))
    return give


def _kept(first: str, least: int):
    """Arrow function: of the blocks of one range the n-grams with ``least`` occurrences. The key and the first part give the second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            for block in batch.column("block").to_pylist():
                keys, firsts, counts = np.frombuffer(block, np.uint64).reshape(3, -1)
                tally.add(keys, firsts, counts.astype(np.int64))
            tally.full()
        keys, firsts, counts = tally.taken()
        at = np.flatnonzero(counts >= least)
        yield pa.record_batch({"key": pa.array(keys[at].view(np.int64)), first: pa.array(firsts[at].view(np.int64)),
                               "n": pa.array(counts[at])})
    return run


def _within(bounds: np.ndarray, count: int) -> np.ndarray:
    """Whether each token follows another one of its text."""
    out = np.ones(count, bool)
    out[bounds[:-1]] = False
    return out


#: Bits that the first part of a pair's and of a triple's key is turned by; they differ, so that "a b c" isn't "c b a".
_TURN2, _TURN3 = 21, 31


def _turned(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys << np.uint64(bits) | keys >> np.uint64(64 - bits)


def _turned_column(key: Column, bits: int) -> Column:
    return F.shiftleft(key, bits).bitwiseOR(F.shiftrightunsigned(key, 64 - bits))


def _pair_keys(tokens: np.ndarray) -> np.ndarray:
    """Of the pair that ends at each token; of the first one a stray value."""
    return _turned(np.roll(tokens, 1), _TURN2) ^ tokens


def _triple_keys(pair_keys: np.ndarray) -> np.ndarray:
    """Of the triple that ends at each token, from the pairs; of the first two stray values."""
    return _turned(np.roll(pair_keys, 1), _TURN3) ^ pair_keys


def _third(follows: np.ndarray) -> np.ndarray:
    """Whether each token follows two others of its text."""
    out = follows.copy()
    out[1:] &= follows[:-1]
    return out


def _all_pairs(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    at = np.flatnonzero(_within(bounds, len(tokens)))
    return _pair_keys(tokens)[at], tokens[at - 1]


def _triples_of(pair_filter: str):
    """Triples whose pairs may be kept: those of no others can be."""
    def run(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        pairs = _pair_keys(tokens)
        may = _within(bounds, len(tokens)) & _passes(_open_filter(pair_filter), pairs)
        at = np.flatnonzero(_third(may))
        return _triple_keys(pairs)[at], pairs[at - 1]
    return run


def _filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of the leading ``FILTER_BITS`` bits of ``key``."""
    place = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    rows = keys.groupBy(F.shiftright(place, 15).cast("int").alias("page")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for page in rows.toLocalIterator():
        out[page["page"] << 12:(page["page"] + 1) << 12] = np.frombuffer(page["bits"], np.uint8)
    return out


def _share(spark: SparkSession, name: str, data: bytes) -> str:
    """Ship a file to each executor; its name there."""
    path = write_shared_file(spark, name, data)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


@lru_cache(maxsize=2)
def _open_filter(file: str) -> np.ndarray:
    """The bitmap of a file, memory-mapped, so that the workers of a machine share its pages."""
    return np.memmap(SparkFiles.get(file), np.uint8, "r").view(np.ndarray)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - FILTER_BITS)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


@dataclass
class NgramModel:
    """A trained model: the head's file, the totals, the shards (a written table), the files of the filters of pairs and triples.

    ``shards`` has ``shard, trie``, of ``parts`` shards those that aren't empty.
    """

    file: str
    total: int
    distinct: int
    shards: DataFrame
    parts: int
    filters: tuple[str, str]


def _log_word(counts: np.ndarray, total: int, distinct: int) -> np.ndarray:
    return np.log10((counts + ADD) / (total + ADD * (distinct + 1)))


def build_trie(words: np.ndarray, word_counts: np.ndarray, pairs: np.ndarray, triples: np.ndarray,
               codes: dict[str, np.ndarray], total: int, distinct: int) -> bytes:
    """The file of a trie from sorted keys: word hashes, ``word << 32 | word`` and ``pair << 32 | word``.

    ``codes`` are the quantised ``left1`` of words, ``gain2`` and ``left2`` of pairs, and ``gain3`` of triples.
    """
    low = (1 << 32) - 1
    meta = {"total": total, "distinct": distinct}
    arrays: dict[str, np.ndarray] = {"counts": word_counts.astype(np.int64), **codes}
    parts = {"words": EliasFano.build(words)}
    for k, (keys, count) in enumerate(((pairs, len(words)), (triples, len(pairs))), 2):
        parts |= {f"{name}{k}": x for name, x in Level.build(keys >> 32, keys & low, count).items()}
    for name, (numbers, own) in parts.items():
        meta[name] = numbers
        arrays |= {f"{name}_{x}": a for x, a in own.items()}
    return pack_arrays(meta, arrays)


class Trie:
    """A trie in a memory-mapped file."""

    def __init__(self, path: str):
        meta, arrays = map_arrays(path)
        self.total, self.distinct, self.counts = meta["total"], meta["distinct"], arrays["counts"]

        def sequence(name: str) -> EliasFano:
            return EliasFano(meta[name]["low_bits"], meta[name]["length"],
                             *(arrays[f"{name}_{x}"] for x in ("low", "high", "ranks")))

        self.words = sequence("words")
        self.pairs = Level(sequence("pointers2"), sequence("ids2"))
        self.triples = Level(sequence("pointers3"), sequence("ids3"))
        self.codes = {x: arrays[x] for x in ("left1", "gain2", "left2", "gain3")}

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.codes[name][at] / STEPS

    def score(self, tokens: np.ndarray, bounds: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> tuple[np.ndarray, ...]:
        """``ids, pair, triple, word, whole`` per token: the nodes that end at it (-1: none), its log ``p1`` and its score.

        ``pairs`` and ``triples`` tell where the one that ends there may be kept.
        For a token of the tail ``word`` is 0, and ``whole`` has what the trie's n-grams give.
        """
        ids = self.words.find(tokens)
        known = np.flatnonzero(ids >= 0)
        word = np.zeros(len(tokens))
        word[known] = _log_word(self.counts[ids[known]], self.total, self.distinct)
        whole = word.copy()
        follows = _within(bounds, len(tokens))
        at = np.flatnonzero(follows)
        at = at[ids[at - 1] >= 0]
        whole[at] += self.value("left1", ids[at - 1])
        at = at[(ids[at] >= 0) & pairs[at]]
        pair = np.full(len(tokens), -1, np.int64)
        pair[at] = self.pairs.find(ids[at - 1], ids[at])
        at = at[pair[at] >= 0]
        whole[at] += self.value("gain2", pair[at])
        at = np.flatnonzero(follows)
        at = at[pair[at - 1] >= 0]
        whole[at] += self.value("left2", pair[at - 1])
        at = at[(ids[at] >= 0) & triples[at]]
        node = self.triples.find(pair[at - 1], ids[at])
        whole[at[node >= 0]] += self.value("gain3", node[node >= 0])
        triple = np.full(len(tokens), -1, np.int64)
        triple[at] = node
        return ids, pair, triple, word, whole


#: Kinds of a shard's entries.
WORD, PAIR, TRIPLE = 0, 1, 2


def _children(hashes: np.ndarray) -> np.ndarray:
    """A child's bits in a shard."""
    return (hashes >> np.uint64(CHILD_CUT)).astype(np.int64)


#: A context's bits in a shard: the last ones, as the shard itself, a range of hashes, stands for the first.
CONTEXT_BITS = 64 - CHILD_CUT
_CONTEXT = (1 << CONTEXT_BITS) - 1


def _build_shard(table: pa.Table) -> pa.Table:
    """The trie of one shard's entries."""
    kind, context, child, n, value, left = (table.column(x).to_numpy() for x in ("kind", "context", "child", "n", "value", "left"))
    context, child = context.view(np.uint64), _children(child.view(np.uint64))
    at = np.flatnonzero(kind == WORD)
    at = at[np.argsort(context[at])]
    arrays, parts = {"counts": n[at], f"left{WORD}": left[at]}, {"words": EliasFano.build(context[at])}
    for k in (PAIR, TRIPLE):
        at = np.flatnonzero(kind == k)
        contexts, parents = np.unique(context[at], return_inverse=True)
        order = np.lexsort((child[at], parents))
        at, parents = at[order], parents[order]
        arrays |= {f"value{k}": value[at], f"left{k}": left[at]}
        parts[f"contexts{k}"] = EliasFano.build(contexts)
        parts |= {f"{name}{k}": x for name, x in Level.build(parents, child[at], len(contexts)).items()}
    meta = {name: numbers for name, (numbers, _) in parts.items()}
    arrays |= {f"{name}_{x}": a for name, (_, own) in parts.items() for x, a in own.items()}
    return pa.table({"shard": table.column("shard").slice(0, 1).cast(pa.int32()),
                     "trie": pa.array([pack_arrays(meta, arrays)], pa.binary())})


#: Columns of a shard's entries in their packed blocks.
_ENTRY = {"context": np.dtype(np.int64), "child": np.dtype(np.int64), "n": np.dtype(np.int64),
          "value": np.dtype(np.int16), "left": np.dtype(np.int16), "kind": np.dtype(np.int8)}


def _entry_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: entries as packed blocks, one for each shard, of all that come together."""
    def give(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        rows.clear()
        shard = table.column("shard").to_numpy()
        order = _place_order(shard)
        return _by_place("shard", shard[order], [table.column(x).to_numpy()[order] for x in _ENTRY])

    rows: list[pa.RecordBatch] = []
    for batch in batches:
        rows.append(batch)
        if sum(len(x) for x in rows) >= _TALLY:
            yield give(rows)
    if rows:
        yield give(rows)


def _entries_of(blocks: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of packed blocks."""
    width = sum(kind.itemsize for kind in _ENTRY.values())
    out, before = {}, 0
    for name, kind in _ENTRY.items():
        counts = [len(x) // width for x in blocks]
        out[name] = np.concatenate([np.frombuffer(x, kind, n, n * before) for x, n in zip(blocks, counts, strict=True)])
        before += kind.itemsize
    return out


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: the trie of one shard from its blocks."""
    blocks, shard = [], None
    for batch in batches:
        if len(batch):
            shard = batch.column("shard")[0].as_py()
            blocks += batch.column("block").to_pylist()
    columns = _entries_of(blocks)
    blocks.clear()
    yield from _build_shard(pa.table({"shard": pa.array(np.full(len(columns["n"]), shard, np.int32)), **columns})).to_batches()


class Shard:
    """The trie of one shard."""

    def __init__(self, data: bytes):
        meta, self.arrays = view_arrays(np.frombuffer(data, np.uint8))

        def sequence(name: str) -> EliasFano:
            return EliasFano(meta[name]["low_bits"], meta[name]["length"],
                             *(self.arrays[f"{name}_{x}"] for x in ("low", "high", "ranks")))

        self.words = sequence("words")
        self.contexts = {k: sequence(f"contexts{k}") for k in (PAIR, TRIPLE)}
        self.levels = {k: Level(sequence(f"pointers{k}"), sequence(f"ids{k}")) for k in (PAIR, TRIPLE)}

    def count(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and ``left`` code of each word; 0 for unknown ones."""
        node = self.words.find(words)
        return self._codes("counts", node), self._codes(f"left{WORD}", node)

    def gains(self, kind: int, contexts: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``value`` and ``left`` codes of the n-grams; 0 for unknown ones."""
        parent = self.contexts[kind].find(contexts)
        at = np.flatnonzero(parent >= 0)
        node = np.full(len(contexts), -1, np.int64)
        node[at] = self.levels[kind].find_wide(parent[at], children[at])
        return self._codes(f"value{kind}", node), self._codes(f"left{kind}", node)

    def _codes(self, name: str, node: np.ndarray) -> np.ndarray:
        out = np.zeros(len(node), np.int64)
        found = np.flatnonzero(node >= 0)
        out[found] = self.arrays[name][node[found]]
        return out


@lru_cache(maxsize=1)
def _open_trie(path: str) -> Trie:
    """The trie of a file, opened once per worker, which keeps the last one."""
    return Trie(path)


def train(docs: DataFrame, text_col: str = "text", share: float = SHARE,
          head_share: float = HEAD_SHARE, shard_ngrams: int = SHARD_NGRAMS) -> NgramModel:
    """Count all texts of ``docs``, build the head's trie and the shards."""
    spark = docs.sparkSession
    prepare_workers(spark)
    texts = docs.select(text_of(docs, text_col).alias("text"))

    counts = materialize(texts.mapInArrow(releasing(_count(lambda tokens, bounds: (tokens, tokens), _word_rows)), "key bigint, n bigint")
                         .groupBy("key").agg(F.sum("n").alias("n")), "lm-words")
    totals = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct")).first()
    total, distinct = totals["total"] or 0, totals["distinct"]
    least = max(MIN_COUNT, int(np.ceil(share * total)))
    head = max(least, int(np.ceil(head_share * total)))
    floor = F.lit(total + ADD * (distinct + 1))
    kept = F.col("n") >= least

    ranges = max(1, total // RANGE_TOKENS)

    def counted(keys_of, first: str) -> DataFrame:
        blocks = texts.mapInArrow(releasing(_count(keys_of, _ngram_blocks(ranges))), "range int, block binary")
        return blocks.groupBy("range").applyInArrow(
            releasing(_kept(first, least)), f"key bigint, {first} bigint, n bigint")

    pairs = materialize(counted(_all_pairs, "a"), "lm-pairs")
    pair_filter = _share(spark, "lm-pair-filter", _filter(pairs).tobytes())
    triples = materialize(counted(_triples_of(pair_filter), "ab"), "lm-triples")
    triple_filter = _share(spark, "lm-triple-filter", _filter(triples).tobytes())

    # the second part of a pair and of a triple, from its key and its first part
    b_of = F.col("key").bitwiseXOR(_turned_column(F.col("a"), _TURN2))
    bc_of = F.col("key").bitwiseXOR(_turned_column(F.col("ab"), _TURN3))

    def taken(ngrams: DataFrame, by: str) -> DataFrame:
        return ngrams.groupBy(F.col(by).alias("key")).agg(F.sum(F.col("n") - DISCOUNT).alias("taken"))

    def code(value: Column) -> Column:
        return F.rint(F.log10(value) * STEPS).cast("smallint")

    left = 1 - F.coalesce("taken", F.lit(0.0)) / F.col("n")
    words = materialize(counts.join(taken(pairs, "a"), "key", "left").select(
        "key", "n", left.alias("left")), "lm-word-model")
    first = words.where(kept).select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"))
    second = words.where(kept).select(F.col("key").alias("b"), ((F.col("n") + ADD) / floor).alias("p1"))
    own, lower = (F.col("n") - DISCOUNT) / F.col("n_a"), F.col("left_a") * F.col("p1")
    two = materialize(pairs.join(first, "a").withColumn("b", b_of).join(second, "b").join(taken(triples, "ab"), "key", "left").select(
        "key", "a", "n", (F.col("n_a") >= head).alias("split"), left.alias("left"), (own + lower).alias("p"),
        code(1 + own / lower).alias("value")), "lm-pair-model")
    discard(pairs)
    ab = two.select(F.col("key").alias("ab"), (F.col("n") * F.col("left")).alias("scale"), (F.col("n") >= head).alias("split"))
    bc = two.select(F.col("key").alias("bc"), "p")
    gain = code(1 + (F.col("n") - DISCOUNT) / (F.col("scale") * F.col("p")))
    three = materialize(triples.join(ab, "ab").withColumn("bc", bc_of).join(bc, "bc").select("key", "ab", "n", "split", gain.alias("value")),
                        "lm-triple-model")
    discard(counts, triples)

    parts = max(1, sum(x.count() for x in (words, two, three)) // shard_ngrams)

    def entries(table: DataFrame, kind: int, context: str, child: Column, home: Column, value: Column, left: Column) -> DataFrame:
        shard = F.shiftright(F.shiftrightunsigned(home, 32) * F.lit(parts).cast("bigint"), 32)
        return table.where(F.col("n") < head).select(
            shard.cast("int").alias("shard"), F.lit(kind).cast("tinyint").alias("kind"),
            (F.col(context) if kind == WORD else F.col(context).bitwiseAND(F.lit(_CONTEXT))).alias("context"),
            child.alias("child"), "n", value.alias("value"), left.alias("left"))

    none, left_code = F.lit(0).cast("smallint"), code(F.col("left"))
    rows = (
        entries(words, WORD, "key", F.lit(0).cast("bigint"), F.col("key"), none, left_code)
        .unionByName(entries(two, PAIR, "a", b_of, F.when(F.col("split"), F.col("key")).otherwise(F.col("a")),
                             F.col("value"), left_code))
        .unionByName(entries(three, TRIPLE, "ab", bc_of, F.when(F.col("split"), F.col("key")).otherwise(F.col("ab")),
                             F.col("value"), none)))
    # packed first, so that the shuffle sorts blocks and not rows
    shards = materialize(rows.mapInArrow(releasing(_entry_blocks), "shard int, block binary")
                         .groupBy("shard").applyInArrow(releasing(_build_shards), "shard int, trie binary"), "lm-shards")

    def columns(table: DataFrame, *names: str | Column) -> list[np.ndarray]:
        found = table.where(F.col("n") >= head).select(*names).toArrow()
        return [c.to_numpy() for c in found.columns]

    keys, word_counts, left1 = columns(words, "key", "n", left_code)
    order = np.argsort(keys.view(np.uint64))
    keys, word_counts, left1 = keys.view(np.uint64)[order], word_counts[order], left1[order]
    pair_keys, a, b, gain2, left2 = columns(two, "key", "a", b_of, "value", left_code)
    ids = np.searchsorted(keys, a.view(np.uint64)) << 32 | np.searchsorted(keys, b.view(np.uint64))
    order = np.argsort(ids)
    pair_keys, ids, gain2, left2 = (x[order] for x in (pair_keys, ids, gain2, left2))
    by_key = np.argsort(pair_keys)
    ab_keys, bc_keys, gain3 = columns(three, "ab", bc_of, "value")
    ab_at, bc_at = (by_key[np.searchsorted(pair_keys, x, sorter=by_key)] for x in (ab_keys, bc_keys))
    nodes = ab_at << 32 | ids[bc_at] & ((1 << 32) - 1)
    order = np.argsort(nodes)
    codes = {"left1": left1, "gain2": gain2, "left2": left2, "gain3": gain3[order]}
    data = build_trie(keys, word_counts, ids, nodes[order], codes, total, distinct)
    discard(words, two, three)
    return NgramModel(_share(spark, "lm-trie", data), total, distinct, shards, parts, (pair_filter, triple_filter))


#: A block of n-grams that a batch of texts asks a shard for, its answer, or (with shard -1) the batch itself, with its ``ids``.
_ASKED = ("kinds", "contexts", "children")
_ANSWERED = ("texts", "known", "words", "gains", "n_tokens")


def _block_type(id_type: T.DataType, asked: bool) -> T.StructType:
    fields = {"shard": T.IntegerType(), "batch": T.StringType(), "blocks": T.IntegerType(), "ids": T.ArrayType(id_type)}
    fields |= dict.fromkeys((*(_ASKED if asked else ()), *_ANSWERED), T.BinaryType())
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _blocks(rows: list[dict], ids: pa.DataType, asked: bool) -> pa.RecordBatch:
    fields = {"shard": pa.int32(), "batch": pa.string(), "blocks": pa.int32(), "ids": ids}
    fields |= dict.fromkeys((*(_ASKED if asked else ()), *_ANSWERED), pa.binary())
    return pa.record_batch({name: pa.array([r.get(name) for r in rows], kind) for name, kind in fields.items()})


def _ask(file: str, parts: int, filter_files: tuple[str, str]):
    """Arrow function: of each batch of texts what the head gives, and a block for each shard that may have more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, filters = _open_trie(SparkFiles.get(file)), tuple(_open_filter(x) for x in filter_files)
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in parts_of([len(t) + _TEXT_CHARS for t in texts], _BATCH_CHARS):
                ids = batch.column("id").slice(part.start, part.stop - part.start)
                content = hashlib.blake2b(repr(ids).encode(), digest_size=12)
                asked, own = [], []
                for piece in parts_of([len(t) for t in texts[part]], _PART_CHARS):
                    tokens, bounds = _tokens(texts[part][piece])
                    content.update(tokens)
                    content.update(bounds)
                    wanted, sums = _ask_head(trie, parts, filters, tokens, bounds)
                    wanted["texts"] += np.uint32(piece.start)
                    asked.append(wanted)
                    own.append(sums)
                yield from _ask_shards(f"{task}.{made}.{content.hexdigest()}", ids, _joined(asked), _joined(own))
                made += 1
    return run


def _packed(numbers: np.ndarray) -> np.ndarray:
    """The lower bytes of numbers that have ``64 - CHILD_CUT`` bits, a row each."""
    return numbers.view(np.uint8).reshape(-1, 8)[:, :8 - CHILD_CUT // 8]


def _unpacked(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :8 - CHILD_CUT // 8] = np.frombuffer(data, np.uint8).reshape(n, -1)
    return out.view(np.int64)[:, 0]


def _ask_head(trie: Trie, parts: int, filters: tuple[np.ndarray, ...], tokens: np.ndarray,
              bounds: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """What shards may have more of, and per text its numbers from the head. A word's first bits are where others have a child."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n, dtype=np.uint32), np.diff(bounds))
    follows = _within(bounds, len(tokens))
    followed = np.append(follows[1:], False)
    pairs = _pair_keys(tokens)
    triples = _triple_keys(pairs)
    may_two = follows & _passes(filters[0], pairs)
    may_three = _third(may_two) & _passes(filters[1], triples)
    node, pair, triple, word, whole = trie.score(tokens, bounds, may_two, may_three)
    one = np.flatnonzero(node < 0)
    two = np.flatnonzero(may_two & (pair < 0))
    three = np.flatnonzero(may_three & (triple < 0))
    at = np.concatenate((one, two, three))
    home = np.concatenate((tokens[one], np.where(node[two - 1] >= 0, pairs[two], tokens[two - 1]),
                           np.where(pair[three - 1] >= 0, triples[three], pairs[three - 1])))
    contexts = np.concatenate((tokens[one], tokens[two - 1], pairs[three - 1])) & np.uint64(_CONTEXT)
    children = np.concatenate(((tokens[one] >> np.uint64(CONTEXT_BITS)).astype(np.int64), _children(tokens[two]),
                               _children(pairs[three])))
    kinds = np.repeat([WORD, PAIR, TRIPLE], (len(one), len(two), len(three))) << 1 | followed[at]
    return ({"shard": _key_range(home, parts).astype(np.int32), "kinds": kinds.astype(np.uint8), "contexts": _packed(contexts),
             "children": _packed(children), "texts": doc[at]},
            {"n_tokens": np.diff(bounds).astype(np.int64), "known": np.bincount(doc, node >= 0, n).astype(np.int64),
             "words": np.bincount(doc, word, n), "gains": np.bincount(doc, whole, n)})


def _joined(found: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Each column in one piece; its pieces leave ``found``."""
    return {x: np.concatenate([y.pop(x) for y in found]) for x in list(found[0])}


def _ask_shards(name: str, ids: pa.Array, asked: dict[str, np.ndarray], own: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(ids)
    shard = asked.pop("shard")
    order = _place_order(shard)
    edges = _edges(shard[order])
    asked = {x: y[order] for x, y in asked.items()}
    asked["texts"] = asked["texts"].astype(np.uint16 if n <= 1 << 16 else np.uint32)
    rows = [{"shard": int(shard[order[lo]]), "batch": name, **{x: y[lo:hi].tobytes() for x, y in asked.items()}}
            for lo, hi in zip(edges, edges[1:], strict=False)]
    listed = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids)
    yield _blocks(rows, listed.type, True)
    whole = _blocks([{"shard": -1, "batch": name, "blocks": len(rows), **{x: y.tobytes() for x, y in own.items()}}], listed.type, True)
    yield whole.set_column(whole.schema.get_field_index("ids"), "ids", listed)


def _answer(total: int, distinct: int):
    """Arrow function: blocks answered by their shard's trie, which comes before them; batches pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, of = None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            whole = batch.filter(pa.array(shards < 0))
            yield whole.select(["shard", "batch", "blocks", "ids", *_ANSWERED])
            rows = []
            for i in np.flatnonzero(shards >= 0):
                if batch.column("trie")[i].is_valid:
                    trie, of = Shard(batch.column("trie")[i].as_py()), shards[i]
                    continue
                block = {x: batch.column(x)[i].as_py() for x in ("batch", "kinds", "contexts", "children", "texts")}
                rows.append({"shard": int(shards[i]), "batch": block["batch"],
                             **_gains(trie if of == shards[i] else None, total, distinct, block)})
            yield _blocks(rows, batch.schema.field("ids").type, False)
    return run


def _gains(trie: Shard | None, total: int, distinct: int, block: dict[str, bytes]) -> dict[str, bytes]:
    """Per text of a block: its number, known words, their log ``p1`` and the codes' sum."""
    kinds = np.frombuffer(block["kinds"], np.uint8)
    n = len(kinds)
    contexts, children = _unpacked(block["contexts"], n), _unpacked(block["children"], n)
    texts = np.frombuffer(block["texts"], f"u{len(block['texts']) // n}")
    counts, codes = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for kind in (WORD, PAIR, TRIPLE) if trie else ():
        at = np.flatnonzero(kinds >> 1 == kind)
        if kind == WORD:
            words = (children[at] << CONTEXT_BITS | contexts[at]).view(np.uint64)
            counts[at], left = trie.count(words)
        else:
            codes[at], left = trie.gains(kind, contexts[at].view(np.uint64), children[at])
        codes[at] += left * (kinds[at] & 1)
    is_word = kinds >> 1 == WORD
    word = np.where(is_word, _log_word(counts, total, distinct) if total else 0.0, 0.0)
    own, place = np.unique(texts, return_inverse=True)
    return {"texts": own.tobytes(), "known": np.bincount(place, counts > 0).astype(np.uint32).tobytes(),
            "words": np.bincount(place, word).tobytes(), "gains": np.bincount(place, codes).astype(np.int64).tobytes()}


def _sum_up(total: int):
    """Arrow function: the texts of one batch with what its blocks brought."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words = gains = batch = None
        came, waiting = 0, []
        more: dict[str, np.ndarray] = {}

        def add(row: dict) -> None:
            at = np.frombuffer(row["texts"], f"u{len(row['texts']) * 4 // len(row['known'])}")
            more["known"][at] += np.frombuffer(row["known"], np.uint32)
            more["words"][at] += np.frombuffer(row["words"], np.float64)
            more["codes"][at] += np.frombuffer(row["gains"], np.int64)

        for rows in batches:
            for row in rows.drop_columns(["ids"]).to_pylist():
                if row["shard"] < 0:
                    known, words, gains, n_tokens = (np.frombuffer(row[x], kind) for x, kind in (
                        ("known", np.int64), ("words", np.float64), ("gains", np.float64), ("n_tokens", np.int64)))
                    at = rows.column("shard").to_pylist().index(-1)
                    ids, batch = rows.column("ids")[at].values, row
                    more = {"known": np.zeros(len(known), np.int64), "words": np.zeros(len(known)),
                            "codes": np.zeros(len(known), np.int64)}
                    for other in waiting:
                        add(other)
                    waiting = []
                else:
                    came += 1
                    add(row) if more else waiting.append(row)
        if batch is None or came != batch["blocks"]:
            raise RuntimeError("a lost task read its rows in another order: score a written table")
        yield pa.record_batch({
            "id": ids, "n_tokens": pa.array(n_tokens), "n_known": pa.array(known + more["known"]),
            "train_tokens": pa.array(np.full(len(known), total, np.int64)), "base_score": pa.array(words + more["words"]),
            "score": pa.array(gains + more["words"] + more["codes"] / STEPS)})
    return run


def score(docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` per row, in log10."""
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    scored = T.StructType([T.StructField("id", id_type), *(T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")),
                           *(T.StructField(x, T.DoubleType()) for x in ("base_score", "score"))])
    blocks = rows.mapInArrow(releasing(_ask(model.file, model.parts, model.filters)), _block_type(id_type, True))
    # a batch's name is not empty, so a shard's trie comes before its blocks
    routed = (blocks.withColumn("trie", F.lit(None).cast("binary"))
              .unionByName(model.shards.withColumn("batch", F.lit("")), allowMissingColumns=True)
              .repartition("shard", F.when(F.col("shard") < 0, F.col("batch"))).sortWithinPartitions("shard", "batch"))
    return (routed.mapInArrow(releasing(_answer(model.total, model.distinct)), _block_type(id_type, False))
            .groupBy("batch").applyInArrow(_sum_up(model.total), scored))
