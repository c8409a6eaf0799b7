"""SimHash near-deduplication with pivot distance tables.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes
(seed 42) of its shingles. Fingerprints that differ in at most ``max_bits``
bits are linked; linked documents form components. No link is missed:

1. **Deal.** The bits are cut into ``max_bits + 1`` blocks. Two fingerprints
   within ``max_bits`` agree on all bits of some block, so each fingerprint
   goes to one bucket per block. A bucket of more than ``bucket_rows``
   distinct fingerprints is dealt again by the same argument on its free
   bits, until no bucket is larger. Fingerprints of a bucket are distinct, so
   a bucket with ``f`` free bits has at most ``2 ** f`` rows and this ends.
2. **Pivot tables.** For each bucket's rows the Hamming distances to
   ``PIVOTS`` reference fingerprints are computed. By the triangle
   inequality a pair within ``max_bits`` differs by no more than that in every
   coordinate. Rows are ordered by the first coordinate, pairs beyond the
   allowed difference in any coordinate are discarded, and the survivors
   are verified by their exact distance.
3. **Components.** A bucket emits for each linked row the smallest row of its
   bucket component: at most one link per row and bucket, never all pairs.

Pivot distances alone can't deal rows to tasks: distances of unrelated
fingerprints to a pivot all lie near 32, so each coordinate parts them only
in two. That is why step 1 deals by blocks and step 2 discards by pivots.

Defined cases: a null text counts as empty; a text without words has
fingerprint zero, linked like any other; equal fingerprints are one node, so a
group of copies of any size costs one row; null ids take part, and a
component's id is its smallest non-null id; an empty table gives an empty
result; other columns are never read and pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import keep_marked, materialize, prepare_workers, row_key, text_of

SEED = 42
PIVOTS = 32
BUCKET_ROWS = 1024
_MASK64 = (1 << 64) - 1


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """The 64-bit SimHash of a text; see the module's text for its definition."""
    words = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64,
                         len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3) -> DataFrame:
    """``id, row_key, fp`` of every row (``fp`` as a signed 64-bit number)."""
    prepare_workers(docs.sparkSession)

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return docs.select(docs[id_col].alias("id"), row_key(docs, text_col).alias("row_key"),
                       of(text_of(docs, text_col)).alias("fp"))


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: the XXH64 hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(count)], np.uint64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(mask: int, parts: int) -> list[int]:
    """Masks that fix one more block of the bits that ``mask`` leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cut, cut[1:], strict=False)]


def _deal(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """``mask, key, fp`` for each of the masks that follow the row's own."""
    if list(masks) == [0]:
        following = F.array(*[F.lit(_signed(m)) for m in masks[0]])
    else:
        pairs = [x for m, to in masks.items() for x in
                 (F.lit(_signed(m)), F.array(*[F.lit(_signed(t)) for t in to]))]
        following = F.element_at(F.create_map(*pairs), F.col("mask"))
    return (rows.select(F.explode(following).alias("mask"), "fp")
            .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))


def buckets(fps: DataFrame, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Distinct fingerprints dealt to buckets ``mask, key, fp`` of at most ``bucket_rows`` rows."""
    parts = max_bits + 1
    open_rows = _deal(fps.select("fp"), {0: _blocks(0, parts)})
    leaves = None
    while True:
        sizes = open_rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
        over = materialize(sizes.where(F.col("n") > bucket_rows), "simhash-overfull")
        small = open_rows.join(over, ["mask", "key"], "left_anti")
        leaves = small if leaves is None else leaves.unionByName(small)
        masks = [r["mask"] & _MASK64 for r in over.select("mask").distinct().collect()]
        if not masks:
            return leaves
        full = open_rows.join(over, ["mask", "key"], "left_semi").select("mask", "fp")
        open_rows = materialize(_deal(full, {m: _blocks(m, parts) for m in masks}).distinct(),
                                "simhash-dealt")


def linked(group: np.ndarray, fp: np.ndarray, max_bits: int,
           refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside buckets: for each linked row, the row and the first row of its component.

    ``group`` numbers the bucket of each row. Rows of a bucket are adjacent.
    """
    n = len(fp)
    first = np.bitwise_count(fp ^ refs[0]).astype(np.int16)
    order = np.lexsort((first, group))
    group, fp, first = group[order], fp[order], first[order]
    label = np.arange(n)
    at, step = np.arange(n), 0
    links: list[tuple[np.ndarray, np.ndarray]] = []
    table = None
    while True:
        step += 1
        at = at[at + step < n]
        at = at[(group[at + step] == group[at]) & (first[at + step] - first[at] <= max_bits)]
        if not len(at):
            break
        if table is None:
            table = np.bitwise_count(fp[:, None] ^ refs[None, 1:]).astype(np.int16)
        i, j = at, at + step
        for p in range(table.shape[1]):
            near = np.abs(table[i, p] - table[j, p]) <= max_bits
            i, j = i[near], j[near]
            if len(i) < 64:
                break
        near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        if near.any():
            links.append((i[near], j[near]))
    if links:
        a, b = (np.concatenate(x) for x in zip(*links, strict=True))
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    moved = np.flatnonzero(label != np.arange(n))
    return fp[moved], fp[label[moved]]


def _links_of(max_bits: int):
    """Arrow function over partitions sorted by bucket; a bucket may span batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        rest: tuple[np.ndarray, ...] = tuple(np.empty(0, np.int64) for _ in range(3))

        def solve(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            change = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])
            group = np.concatenate(([0], np.cumsum(change)))
            a, b = linked(group, fp.view(np.uint64), max_bits, refs)
            return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            now = tuple(np.concatenate((r, batch.column(c).to_numpy(zero_copy_only=False)))
                        for r, c in zip(rest, ("mask", "key", "fp"), strict=True))
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield solve(*(x[:cut] for x in now))
            rest = tuple(x[cut:] for x in now)
        if len(rest[0]):
            yield solve(*rest)
    return run


def links(fps: DataFrame, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that together connect all within ``max_bits``."""
    dealt = buckets(fps, max_bits, bucket_rows)
    placed = dealt.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return placed.mapInArrow(_links_of(max_bits), "a bigint, b bigint")


def components(rows: DataFrame, max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``fp, root, id`` per distinct fingerprint of the written table ``rows(id, row_key, fp)``.

    ``root`` names the component, ``id`` is its smallest id.
    """
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-fps")
    roots = materialize(connected_components(links(fps, max_bits, bucket_rows)), "simhash-roots")
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-rooted")
    least = materialize(rooted.groupBy("root").agg(F.min("least_id").alias("id")), "simhash-least")
    return rooted.join(least, "root").select("fp", "root", "id")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
         max_bits: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``id, row_key, fp, root, component_id`` per row of ``docs``."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle_words), "simhash-rows")
    found = materialize(components(rows, max_bits, bucket_rows), "simhash-components")
    return rows.join(found.withColumnRenamed("id", "component_id"), "fp").select(
        "id", "row_key", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = 3, max_bits: int = 3,
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were.

    The row with the component's smallest id stays; among rows that share
    that id, the one with the smallest ``row_key``, and one of its repeats.
    """
    marks = materialize(mark(docs, id_col, text_col, shingle_words, max_bits, bucket_rows)
                        .select("root", "id", "row_key"), "simhash-marks")
    order = F.struct(F.col("id").isNull(), "id", "row_key")
    stays = materialize(marks.groupBy("root").agg(F.min(order).alias("stays")), "simhash-stays")
    judged = marks.join(stays, "root").select(
        "id", "row_key", (order != F.col("stays")).alias("drop"))
    judged = judged.groupBy("id", "row_key", "drop").agg(F.count(F.lit(1)).alias("n"))
    actions = materialize(judged.where("drop OR n > 1").select("id", "row_key", "drop"),
                          "simhash-actions")
    return keep_marked(docs, actions, id_col, text_col)
