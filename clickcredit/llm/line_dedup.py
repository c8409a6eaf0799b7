"""Line deduplication by winnowing over line hashes.

A document is the sequence of its non-empty lines, trimmed, each with a
64-bit hash. The steps:

1. **Winnow.** A window is the shortest run of lines with ``min_words`` words from a
   line on, or up to a line. The line of the least hash (the first of equals) is
   the window's fingerprint. Equal windows have the same fingerprint at the same line, wherever
   they stand, so any run of ``min_words`` words or more that occurs twice
   shares the fingerprints of all windows inside it.
2. **Join positions.** A fingerprint is joined together with the hash of the lines of
   its window, 128 bits in all: its line alone may be a frequent one, whose first place says
   nothing about the others. The first position of each in the corpus, in order
   of ``(id, text hash, line)``, is found by a grouping with a map-side step. Every
   later position is joined with that one, never with each other.
3. **Extend.** Windows stand at every line, to both sides of a fingerprint. So a match goes
   on both ways, window by window, as far as lines agree, and no further: each matched window has
   ``min_words`` words, so no line goes that is in no repeated run of so many.
4. **Delete.** Matched windows that touch are one run. Runs are deleted, with the
   empty lines inside. Each deleted line has an equal one at an earlier place, so the first copy stays.

Defined cases: null and empty texts have no lines and stay as they are; null
ids come first in the order; rows that repeat both id and text are one
document and don't repeat each other; lines that are equal but for white
space at their ends are equal; a line may be arbitrarily long; an empty table
gives an empty result; other columns pass through ``deduplicate``.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import docs_col, free_name, materialize, prepare_workers, row_key, text_of

MIN_WORDS = 50


def lines_of(text: str) -> tuple[list[int], list[str]]:
    """The non-empty lines of a text, trimmed, with their numbers."""
    found = [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip())]
    return [i for i, _ in found], [s for _, s in found]


def windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """The shortest runs ``(first, last)`` of ``min_words`` words from each line on, and up to each line."""
    found, lo, total = set(), 0, 0
    for hi, n in enumerate(words):
        total += n
        while total >= min_words and lo <= hi:
            found.add((lo, hi))
            total -= words[lo]
            lo += 1
        # one line more reaches the words again
        if lo and total + words[lo - 1] >= min_words:
            found.add((lo - 1, hi))
    return sorted(found)


def fingerprints(hashes: list[int], runs: list[tuple[int, int]]) -> list[int]:
    """The fingerprint of each window: the place of its least hash, the first of equals.

    Windows in order begin and end no earlier than the one before, so the candidates are kept in a queue.
    """
    chosen, queue, seen = [], deque(), 0
    for lo, hi in runs:
        for at in range(max(seen, lo), hi + 1):
            while queue and hashes[queue[-1]] > hashes[at]:
                queue.pop()
            queue.append(at)
        seen = max(seen, hi + 1)
        while queue[0] < lo:
            queue.popleft()
        chosen.append(queue[0])
    return chosen


def _positions(min_words: int):
    """Arrow function: the windows of every text, with their fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, lo, hi, fp, around = [], [], [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                _, lines = lines_of(text)
                hashes = [xxhash.xxh64_intdigest(s) - (1 << 63) for s in lines]
                runs = windows([len(s.split()) for s in lines], min_words)
                every = np.array(hashes, np.int64)
                for (a, b), p in zip(runs, fingerprints(hashes, runs), strict=True):
                    row.append(r)
                    lo.append(a)
                    hi.append(b)
                    fp.append(hashes[p])
                    around.append(xxhash.xxh64_intdigest(every[a:b + 1].tobytes()) - (1 << 63))
            rows = pa.array(row, pa.int64())
            yield pa.record_batch({
                "id": batch.column("id").take(rows), "row_key": batch.column("row_key").take(rows),
                "lo": pa.array(lo, pa.int32()), "hi": pa.array(hi, pa.int32()),
                "fp": pa.array(fp, pa.int64()), "around": pa.array(around, pa.int64())})
    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            min_words: int = MIN_WORDS) -> DataFrame:
    """``id, row_key, ranges`` of the rows with matches: ranges ``(lo, hi)`` of non-empty lines."""
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), row_key(docs, text_col).alias("row_key"),
                       text_of(docs, text_col).alias("text"))
    placed = materialize(rows.mapInArrow(_positions(min_words), T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("row_key", T.LongType()),
        T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()),
        T.StructField("fp", T.LongType()), T.StructField("around", T.LongType())])), "lines-fingerprints")
    first = materialize(placed.groupBy("fp", "around").agg(
        F.min(F.struct("id", "row_key", "lo")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("fp", "around", "first"), "lines-first")
    later = placed.join(first, ["fp", "around"]).where(~F.struct("id", "row_key", "lo").eqNullSafe(F.col("first")))
    return materialize(later.groupBy("id", "row_key").agg(
        F.collect_set(F.struct("lo", "hi")).alias("ranges")), "lines-ranges")


def without_repeats(text: str, ranges: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without its repeated runs, and the line numbers ``(from, to)`` of each run."""
    numbers, _ = lines_of(text)
    runs: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if runs and lo <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    gone = [(numbers[lo], numbers[hi]) for lo, hi in runs]
    kept, at = [], 0
    whole = text.split("\n")
    for lo, hi in gone:
        kept += whole[at:lo]
        at = hi + 1
    return "\n".join(kept + whole[at:]), gone


_CLEANED = "text string, removed array<struct<first_line:int,last_line:int>>"


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with one more column, a struct ``text, removed``: null where nothing is repeated.

    The column's name is ``cleaned``, with underscores in front if ``docs`` has one.
    """
    @F.pandas_udf(_CLEANED)
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        found = [(None, None) if t is None else
                 without_repeats(t, [(x["lo"], x["hi"]) for x in r])
                 for t, r in zip(texts, ranges, strict=True)]
        return pd.DataFrame({
            "text": [t for t, _ in found],
            "removed": [None if g is None else [{"first_line": a, "last_line": b} for a, b in g]
                        for _, g in found]}, dtype=object)

    key, name, ranges = (free_name(docs, x) for x in ("row_key", "cleaned", "ranges"))
    marks = repeats(docs, id_col, text_col, min_words).select(
        F.col("id").alias("mark_id"), F.col("row_key").alias("mark_key"), F.col("ranges").alias(ranges))
    # a table of ranges that grows with the texts: merged at every size, so that the plan doesn't turn with it
    marks = marks.hint("merge")
    keyed = docs.withColumn(key, row_key(docs, text_col))
    joined = keyed.join(marks, keyed[id_col].eqNullSafe(marks["mark_id"])
                        & (keyed[key] == marks["mark_key"]), "left")
    # only rows with matches go to Python with their text
    some = F.when(joined[ranges].isNotNull(), text_of(joined, text_col))
    return (joined.withColumn(name, cut(some, joined[ranges]))
            .select(*[docs_col(c) for c in docs.columns],
                    F.when(joined[ranges].isNotNull(), docs_col(name)).alias(name)))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated runs cut out of the texts, all other columns as they were."""
    name = free_name(docs, "cleaned")
    cleaned = clean(docs, id_col, text_col, min_words)
    return cleaned.select(*[
        F.coalesce(docs_col(name)["text"], docs_col(c)).alias(c) if c == text_col else docs_col(c)
        for c in docs.columns])
