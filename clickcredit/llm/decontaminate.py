"""Benchmark decontamination: rare word and pair seeds, then Smith-Waterman alignment.

Texts are compared as lower-case words of letters and digits. The steps:

1. **Statistics.** One pass counts, over all documents, every word and pair of
   words that occurs in a benchmark item (map-side sums, then a grouping).
2. **Seeds.** A copy that reaches the similarity keeps so many of the item's
   words, and so many of its pairs, at least (``_kept``). With one fewer of the most
   frequent left out, each of the others is a seed, so every such copy holds
   one, wherever it was edited. An item takes its words or its pairs, whichever
   occur less. There is no cap on a seed's count.
3. **Join and align.** A second pass joins the documents' n-grams with the
   seeds. Seeds of one item on near diagonals give one window of the
   document, which is aligned with the whole item (match 2, mismatch and
   gap -1). An alignment of n words that reaches the similarity s has at most
   2 (1 - s) n gaps, and a window reaches that far to both sides of its seeds, so
   it holds the whole of any such alignment through them. ``similarity`` is
   the score over that of a perfect copy.

Documents aren't shuffled: the benchmark comes to them, in blocks of at most
``BLOCK_WORDS`` words, one pass for each block.

Defined cases: a null text or item counts as empty; an item of fewer than
``MIN_ITEM_WORDS`` words is no evidence and matches nothing; repeated items and
rows each give their own result; empty tables give empty results; null ids are
carried like any others; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import keep_marked, materialize, prepare_workers, row_key, text_of
from .words import NOT_ALNUM, grams, parts_of, text_words

SEED_SIZES = (1, 2)
MIN_ITEM_WORDS = 5
MIN_SIMILARITY = 0.6
BLOCK_WORDS = 2_000_000
_BATCH_BYTES = 1 << 22
_MATCH, _MISS, _GAP = 2, -1, 1


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_words([t.lower().encode() for t in texts], NOT_ALNUM)


def _kept(size: int, length: int, min_similarity: float) -> int:
    """How many of an item's words (size 1) or pairs (2) any copy of ``min_similarity`` keeps, at least.

    With m matches and e edits, 2 m - e reaches 2 s n. So m is s n or more; and as the matches are
    e + 1 runs at most, m - e - 1 pairs or more stay, which is least for m = n.
    """
    least = min_similarity * length if size == 1 else (2 * min_similarity - 1) * length - 1
    return max(ceil(least - 1e-9), 2 - size)


class Items:
    """Benchmark items as one word array, with their words and pairs."""

    def __init__(self, texts: list[str]):
        self.words, self.bounds = _words(texts)
        lengths = np.diff(self.bounds)
        at, keys, sizes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for size in SEED_SIZES:
            found = grams(self.words, size)
            for lo, n in zip(self.bounds[:-1], lengths, strict=True):
                if n >= MIN_ITEM_WORDS:
                    at.append(np.arange(lo, lo + n - size + 1))
                    keys.append(found[at[-1]])
                    sizes.append(np.full(len(at[-1]), size))
        self.at, self.grams, self.size = (np.concatenate(x) for x in (at, keys, sizes))
        self.item = np.searchsorted(self.bounds, self.at, side="right") - 1

    def seeds(self, counts: dict[int, int], min_similarity: float) -> np.ndarray:
        """Indices of each item's words or pairs without its most frequent ones, as many as a copy may do without."""
        freq = np.array([counts.get(g, 0) for g in self.grams.view(np.int64).tolist()], np.int64)
        best: dict[int, tuple[int, np.ndarray]] = {}
        for lo, hi in _runs(self.item * len(SEED_SIZES) + self.size - 1):
            item, size = int(self.item[lo]), int(self.size[lo])
            length = int(self.bounds[item + 1] - self.bounds[item])
            kept = _kept(size, length, min_similarity)
            if kept < 1:
                continue
            rarest = lo + np.argsort(freq[lo:hi], kind="stable")[:max(hi - lo - kept + 1, 0)]
            total = int(freq[rarest].sum())
            if item not in best or total < best[item][0]:
                best[item] = total, rarest
        return np.sort(np.concatenate([np.empty(0, np.int64), *(x for _, x in best.values())]))


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return ((a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a)


def _found(sorted_keys: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which queries are among the keys: their indices, and the first key's index of each."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(sorted_keys, queries), len(sorted_keys) - 1)
    hit = np.flatnonzero(sorted_keys[place] == queries)
    return hit, place[hit]


def _inside(bounds: np.ndarray, count: int, n: int) -> np.ndarray:
    """Whether the n-gram that starts at each word ends in the same text."""
    good = np.ones(count, bool)
    for k in range(1, n):
        at = bounds[1:-1] - k
        good[at[(at >= 0) & (at < count)]] = False
    return good


def _count_in(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in parts_of([len(t) for t in texts], _BATCH_BYTES):
                words, bounds = _words(texts[part])
                for size in SEED_SIZES:
                    found = grams(words, size)
                    found = found[_inside(bounds, len(found), size)]
                    total += np.bincount(_found(known, found)[1], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(known[seen].view(np.int64)), "n": pa.array(total[seen])})
    return run


def smith_waterman(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each row of ``items`` in the same row of ``windows``, and where it ends.

    Both are word arrays, padded with values that match nothing.
    """
    n, width = windows.shape
    ramp = np.arange(1, width + 1, dtype=np.int32) * _GAP
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for k in range(items.shape[1]):
        step = np.where(windows == items[:, k:k + 1], _MATCH, _MISS)
        row = np.maximum(above[:, :-1] + step, above[:, 1:] - _GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        above[:, 1:] = row
        at = row.argmax(axis=1)
        top = row[np.arange(n), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


def _padded(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, pad: int) -> np.ndarray:
    width = int((hi - lo).max()) if len(lo) else 0
    at = lo[:, None] + np.arange(width)
    out = words[np.minimum(at, len(words) - 1)]
    out[at >= hi[:, None]] = np.uint64(pad)
    return out


def align(items: Items, words: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray,
          min_similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``candidate, score, start, end`` of the candidates that reach ``min_similarity``.

    Candidate ``i`` is the range ``lo[i]:hi[i]`` of ``words`` against item ``item[i]``.
    """
    length = np.diff(items.bounds)[item]
    order = np.argsort(length, kind="stable")
    out: list[tuple[np.ndarray, ...]] = []
    cells = (length[order] * (hi - lo)[order]).tolist()
    for part in parts_of(cells, 1 << 21):
        c = order[part]
        first = items.bounds[item[c]]
        a = _padded(items.words, first, first + length[c], 1)
        b = _padded(words, lo[c], hi[c], 2)
        # an upper bound of the score: each word of the item that occurs in the window matches
        common = np.zeros(len(c), np.int64)
        for k in range(a.shape[1]):
            common += (b == a[:, k:k + 1]).any(axis=1)
        able = common >= min_similarity * length[c]
        if not able.any():
            continue
        c, a, b = c[able], a[able], b[able]
        score, end = smith_waterman(a, b)
        good = score >= min_similarity * _MATCH * length[c]
        c, a, b, score, end = c[good], a[good], b[good], score[good], end[good]
        if not len(c):
            continue
        # the start: the same alignment read backwards from its end
        cut = np.where(np.arange(b.shape[1]) < end[:, None], b, np.uint64(2))
        back = smith_waterman(a[:, ::-1], cut[:, ::-1])[1]
        out.append((c, score, lo[c] + b.shape[1] - back, lo[c] + end))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))  # type: ignore[return-value]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _candidates(items: Items, seeds: np.ndarray, order: np.ndarray, keys: np.ndarray,
                words: np.ndarray, bounds: np.ndarray, min_similarity: float) -> tuple[np.ndarray, ...]:
    """``doc, item, lo, hi``: windows of the documents around seeds on near diagonals."""
    hits = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for size in np.unique(items.size[seeds]).tolist():
        found = grams(words, size)
        hit, place = _found(keys, found)
        inside = _inside(bounds, len(found), size)[hit]
        hits.append((hit[inside], place[inside]))
    hit, place = (np.concatenate(x) for x in zip(*hits, strict=True))
    upto = np.searchsorted(keys, keys[place], side="right")
    many = upto - place
    at = np.repeat(hit, many)
    skip = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    gram = seeds[order[np.repeat(place, many) + skip]]
    item = items.item[gram]
    doc = np.searchsorted(bounds, at, side="right") - 1
    diagonal = at - (items.at[gram] - items.bounds[item])
    length = np.diff(items.bounds)[item]
    slack = np.ceil(2 * (1 - min_similarity) * length).astype(np.int64)
    # seeds of one document and item in one cell of diagonals share a window
    cell = (diagonal + (1 << 40)) // (slack + 1)
    by = np.lexsort((diagonal, cell, item, doc))
    doc, item, cell, diagonal, length, slack = (x[by] for x in (doc, item, cell, diagonal, length, slack))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(doc)])) - 1 if len(head) else head
    doc, item = doc[head], item[head]
    lo = np.maximum(diagonal[head] - slack[head], bounds[doc])
    hi = np.minimum(diagonal[tail] + length[head] + slack[head], bounds[doc + 1])
    return doc, item, lo, hi


def _match_in(texts_of_items: list[str], chosen: np.ndarray, item_ids: pa.Array, min_similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(texts_of_items)
        seeds = chosen
        order = np.argsort(items.grams[seeds], kind="stable")
        keys = items.grams[seeds][order]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in parts_of([len(t) for t in texts], _BATCH_BYTES):
                words, bounds = _words(texts[part])
                doc, item, lo, hi = _candidates(items, seeds, order, keys, words, bounds, min_similarity)
                c, score, start, end = align(items, words, item, lo, hi, min_similarity)
                if not len(c):
                    continue
                doc, item = doc[c], item[c]
                by = np.lexsort((start, -score, item, doc))
                doc, item, score, start, end = (x[by] for x in (doc, item, score, start, end))
                first = np.ones(len(doc), bool)
                first[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
                doc, item, score, start, end = (x[first] for x in (doc, item, score, start, end))
                rows = pa.array(doc + part.start)
                length = np.diff(items.bounds)[item]
                yield pa.record_batch({
                    "id": batch.column("id").take(rows), "row_key": batch.column("row_key").take(rows),
                    "item_id": item_ids.take(pa.array(item)),
                    "similarity": pa.array(score / (_MATCH * length)),
                    "score": pa.array(score.astype(np.int64)), "item_words": pa.array(length),
                    "word_start": pa.array(start - bounds[doc]), "word_end": pa.array(end - bounds[doc])})
    return run


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text",
            min_similarity: float = MIN_SIMILARITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row and item that it copies (written).

    ``id, row_key, item_id, similarity, score, item_words, word_start,
    word_end``: the best alignment, with its range of the document's words.
    """
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), row_key(docs, text_col).alias("row_key"),
                       text_of(docs, text_col).alias("text"))
    items = benchmark.select(benchmark[item_col].alias("item_id"),
                             text_of(benchmark, item_text_col).alias("text"))
    # a word and its separator take two bytes at least
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-size // (2 * block_words)) or 1
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("row_key", T.LongType()),
        T.StructField("item_id", items.schema["item_id"].dataType),
        T.StructField("similarity", T.DoubleType()), T.StructField("score", T.LongType()),
        T.StructField("item_words", T.LongType()), T.StructField("word_start", T.LongType()),
        T.StructField("word_end", T.LongType())])
    found = None
    for block in range(blocks):
        table = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        texts = table["text"].to_pylist()
        known = Items(texts)
        counted = (rows.select("text").mapInArrow(_count_in(np.unique(known.grams)), "gram bigint, n bigint")
                   .groupBy("gram").agg(F.sum("n").alias("n")))
        chosen = known.seeds({r["gram"]: r["n"] for r in counted.collect()}, min_similarity)
        ids = table["item_id"].combine_chunks()
        part = materialize(rows.mapInArrow(_match_in(texts, chosen, ids, min_similarity), schema),
                           "decontaminate-matches")
        found = part if found is None else found.unionByName(part)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``docs`` without the documents that hold a copy of a benchmark item, all columns as they were."""
    found = matches(docs, benchmark, id_col, text_col, item_col, item_text_col, min_similarity)
    actions = found.select("id", "row_key").distinct().select("*", F.lit(True).alias("drop"))
    return keep_marked(docs, materialize(actions, "decontaminate-actions"), id_col, text_col)
