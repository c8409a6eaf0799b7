"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

A document longer than a bin is cut into pieces of bin size and a rest. Bins
are open in order of their residual capacity. A piece goes into the tightest bin
that holds it and has no conflict: the search starts at the bin of the least
sufficient residual and steps to the next larger one until a bin is compatible;
without one, a new bin opens. Each bin carries two bitmaps, of the sources
and of the duplicate clusters it holds, so a conflict is one AND. A bin never
holds two pieces of one cluster (a document's own pieces included) and, with
``source_conflict``, never two of one source.

Bins are packed in shards: the pieces are dealt by a hash of the row, longest
first within a shard, and each shard of at most ``SHARD_PIECES`` pieces is packed on
its own. No shard depends on another, so the number of tasks grows with the
data, a hot source or cluster is spread over all shards, and a lost task is
simply run again with the same result.

Defined cases: a document without words takes no room: it gets one row
without a bin; a null source conflicts with nothing; a null cluster is a
cluster of one; repeated rows are rows of their own (their equal cluster keeps
them apart); an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import materialize, prepare_workers, text_of

CAPACITY = 2048
SHARD_PIECES = 4096


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def normalised_key(text: Column) -> Column:
    """A duplicate cluster: texts that are equal up to case and white space."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))))


class Shard:
    """Open bins in order of residual, then of number."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece with these one-bit bitmaps (0: none) into a bin: its number and offset."""
        bins, k = self.open, bisect_left(self.open, (length, -1))
        while k < len(bins):
            residual, b = bins[k]
            if not self.sources[b] & source and not self.clusters[b] & cluster:
                del bins[k]
                break
            k += 1
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if residual > length:
            insort(bins, (residual - length, b))
        return b, self.capacity - residual


def pack_shard(lengths: list[int], sources: list[object], clusters: list[object],
               capacity: int) -> tuple[list[int], list[int], int]:
    """Bin number and offset of each piece, in the order given, and the number of bins.

    A bit stands for each source, and for each cluster that occurs twice.
    """
    source_bits: dict[object, int] = {}
    count: dict[object, int] = {}
    for c in clusters:
        if c is not None:
            count[c] = count.get(c, 0) + 1
    cluster_bits = {c: 1 << i for i, c in enumerate(c for c, n in count.items() if n > 1)}
    shard, bins, offsets = Shard(capacity), [], []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        bit = 0 if source is None else source_bits.setdefault(source, 1 << len(source_bits))
        b, offset = shard.place(length, bit, cluster_bits.get(cluster, 0))
        bins.append(b)
        offsets.append(offset)
    return bins, offsets, len(shard.sources)


def _pack(capacity: int, shard_pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, first_bin = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            nonlocal first_bin
            table = table.sort_by([("n_words", "descending"), ("order", "ascending"), ("piece", "ascending")])
            bins, offsets, used = pack_shard(*(table[c].to_pylist() for c in ("n_words", "source", "cluster")),
                                             capacity)
            ids = (np.int64(partition) << 32) + first_bin + np.array(bins, np.int64)
            first_bin += used
            columns = {c: table[c].combine_chunks() for c in ("id", "piece", "word_start", "n_words")}
            return pa.record_batch(columns | {
                "bin_id": pa.array(ids), "bin_offset": pa.array(np.array(offsets, np.int64))})

        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, shard_pieces - rows)
                batch = batch.slice(part.num_rows)
                waiting.append(part)
                rows += part.num_rows
                if rows == shard_pieces:
                    yield solve(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
        if rows:
            yield solve(pa.Table.from_batches(waiting))
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster_col: str | None = None, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES,
         source_conflict: bool = True) -> DataFrame:
    """One row per piece: ``id, piece, word_start, n_words, bin_id, bin_offset``.

    ``piece`` counts from 0; the piece is the words ``word_start`` to
    ``word_start + n_words`` of the document and lies at ``bin_offset`` in its
    bin. Without ``cluster_col`` texts that are equal up to case and white
    space form a cluster.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    prepare_workers(docs.sparkSession)
    text = text_of(docs, text_col)
    cluster = docs[cluster_col] if cluster_col else normalised_key(text)
    source = docs[source_col].cast("string") if source_conflict else F.lit(None).cast("string")
    sized = docs.select(
        docs[id_col].alias("id"), source.alias("source"), cluster.cast("string").alias("cluster"),
        F.xxhash64(docs[id_col], text).alias("order"), word_count(text).cast("bigint").alias("total"))
    pieces = sized.select(
        "id", "source", "order",
        # a row without a cluster gets one of its own, which keeps its pieces apart
        F.coalesce("cluster", F.concat(F.lit("row "), F.col("order").cast("string"))).alias("cluster"),
        "total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(
            F.lit(0), F.floor((F.col("total") - 1) / capacity)).cast("bigint"))).alias("piece"))
    pieces = pieces.select(
        "id", "source", "cluster", "order", "piece", (F.col("piece") * capacity).alias("word_start"),
        F.least(F.col("total") - F.col("piece") * capacity, F.lit(capacity)).cast("bigint").alias("n_words"))
    pieces = materialize(pieces, "packing-pieces")
    some = pieces.where("n_words > 0")
    shards = -(-some.count() // shard_pieces) or 1
    # the pieces of a row are spread too, so that one endless text is no hot key
    dealt = some.repartition(shards, "order", "piece").sortWithinPartitions("order", "piece")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(
        T.StructField(c, T.LongType()) for c in ("piece", "word_start", "n_words", "bin_id", "bin_offset"))])
    packed = dealt.mapInArrow(_pack(capacity, shard_pieces), schema)
    nothing = F.lit(None).cast("bigint")
    return packed.unionByName(pieces.where("n_words = 0").select(
        "id", "piece", "word_start", "n_words", nothing.alias("bin_id"), nothing.alias("bin_offset")))
