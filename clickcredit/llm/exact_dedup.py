"""Exact deduplication over an extendible-hash index on shared files.

Only DataFrame functions run here. The steps:

1. **Hashes.** Rows are counted by ``h``, the 64-bit XXH64 of the text, with a map-side step: a
   text that a third of all rows share leaves each mapper as one row of three numbers. No text moves.
2. **Directory.** It starts at one bucket per ``bucket_entries`` hashes. An
   overfull bucket of local depth ``d`` is split on the next bit of the hash
   into two of depth ``d + 1``, which doubles the directory where needed, until
   none is overfull. The directory is a table: slot to bucket.
3. **Index.** The directory routes each hash to its bucket. Each owner task takes a range of buckets and
   writes them to the shared folder. A hash of one row is an entry as it is. Of
   hashes of several rows, and only of those, the texts are fetched and compared byte by byte,
   again with a map-side step: those that differ form a chain of entries.
4. **Probe.** A row goes through the directory to its bucket and looks its hash up there. A chain of one entry
   is the answer. In longer chains the row's text is compared with the texts of the
   chain, by a join on hash and text over the rows of such hashes only.

Defined cases: a null text counts as empty; among equal texts the row with
the largest id stays and null ids come last (a group without any id keeps a
null); rows that repeat both id and text are all marked kept by ``mark``, and
``deduplicate`` returns one of them; an empty table gives an empty result;
a text may be arbitrarily long, and is moved only if its hash occurs again;
other columns are never read by the index and pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep_marked, materialize, row_key, text_of

BUCKET_ENTRIES = 4096
HASH_BITS = 64


def _prefix(depth: int) -> Column:
    """The leading ``depth`` bits of ``h`` as a non-negative number."""
    if depth == 0:
        return F.lit(0).cast("bigint")
    return F.shiftrightunsigned("h", HASH_BITS - depth)


def hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per hash of a text: ``h, keep_id, group_size`` (written)."""
    rows = docs.select(docs[id_col].alias("id"), key(text_of(docs, text_col)).cast("bigint").alias("h"))
    return materialize(rows.groupBy("h").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
                       "dedup-hashes")


def directory(seen: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """Slots of the directory ``(slot, bucket, depth)`` and its global depth.

    ``seen`` is a written table with the column ``h``. A slot is a prefix of
    global depth; ``bucket`` is the first slot of its bucket. All slots of a
    bucket share its ``depth`` leading bits.
    """
    depth = ((max(seen.count(), 1) - 1) // bucket_entries).bit_length()
    leaves: list[tuple[int, DataFrame]] = []
    todo = seen.select("h")
    while True:
        sizes = materialize(todo.groupBy(_prefix(depth).alias("prefix"))
                            .agg(F.count(F.lit(1)).alias("n")), "dedup-buckets")
        over = F.col("n") > bucket_entries
        if depth == HASH_BITS or sizes.where(over).isEmpty():
            leaves.append((depth, sizes))
            break
        leaves.append((depth, sizes.where(~over)))
        full = sizes.where(over).select("prefix")
        todo = (todo.withColumn("prefix", _prefix(depth))
                .join(full, "prefix", "left_semi").select("h"))
        depth += 1
    slots = None
    for local, table in leaves:
        width = depth - local
        part = table.select(
            F.explode(F.sequence(F.lit(0), F.lit((1 << width) - 1))).alias("i"),
            F.shiftleft("prefix", width).alias("bucket"), F.lit(local).alias("depth"),
        ).select((F.col("bucket") + F.col("i")).alias("slot"), "bucket", "depth")
        slots = part if slots is None else slots.unionByName(part)
    return materialize(slots, "dedup-directory"), depth


@dataclass
class Index:
    """The written index ``bucket, depth, h, keep_id, group_size, digest, chain_no, chain_len``, and its directory.

    ``digest`` is the text's SHA-256 where the chain's texts were compared.
    """

    table: DataFrame
    slots: DataFrame
    depth: int

    def route(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a hash ``h``, each with the ``bucket`` that the directory names, and its ``depth``."""
        return rows.withColumn("slot", _prefix(self.depth)).join(self.slots, "slot").drop("slot")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_entries: int = BUCKET_ENTRIES,
                key: Callable[[Column], Column] = F.xxhash64) -> Index:
    """The index of ``docs``."""
    seen = hashes(docs, id_col, text_col, key)
    index = Index(seen, *directory(seen, bucket_entries))
    routed = index.route(seen)
    alone = routed.where("group_size = 1").withColumn("digest", F.lit(None).cast("binary"))
    # written, so that the planner knows how few they are before it moves any text to them
    several = materialize(routed.where("group_size > 1").select("h", "bucket", "depth"), "dedup-repeated")
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    equal = (rows.withColumn("h", key(F.col("text")).cast("bigint")).join(several, "h")
             .groupBy("bucket", "depth", "h", "text")
             .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .withColumn("digest", _digest(F.col("text"))).drop("text"))
    chain = F.expr("row_number() OVER (PARTITION BY bucket, h ORDER BY digest)")
    length = F.expr("count(1) OVER (PARTITION BY bucket, h)")
    owned = (alone.unionByName(equal).repartitionByRange("bucket")
             .select("*", chain.alias("chain_no"), length.alias("chain_len")))
    index.table = materialize(owned, "dedup-index")
    return index


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         bucket_entries: int = BUCKET_ENTRIES,
         key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: ``id, row_key, keep_id, group_size, kept, text_sha256``.

    ``id`` is the row's own id, ``row_key`` the 64-bit hash that names it with
    the id; ``kept`` says that the row holds the largest id of its text.
    """
    index = build_index(docs, id_col, text_col, bucket_entries, key)
    answer = ["id", "row_key", "digest", "keep_id", "group_size"]
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("id"), row_key(docs, text_col).alias("row_key"),
                       key(text).cast("bigint").alias("h"), _digest(text).alias("digest"))
    place = ["bucket", "h"]
    found = index.route(rows).join(
        index.table.where("chain_len = 1").select(*place, "keep_id", "group_size"), place).select(answer)
    collided = index.table.where("chain_len > 1").select(*place, "digest", "keep_id", "group_size")
    if not collided.isEmpty():
        texts = docs.select(docs[id_col].alias("id"), row_key(docs, text_col).alias("row_key"), text.alias("text"))
        probes = index.route(texts.withColumn("h", key(F.col("text")).cast("bigint"))
                             .join(collided.select("h").distinct(), "h", "left_semi"))
        # the chain's texts, fetched by digest; the row is then compared with them byte by byte
        chains = (probes.select(*place, "text", _digest(F.col("text")).alias("digest")).distinct()
                  .join(collided, [*place, "digest"]))
        found = found.unionByName(probes.join(chains, [*place, "text"]).select(answer))
    return found.select("id", "row_key", "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    marks = materialize(mark(docs, id_col, text_col, bucket_entries).select("id", "row_key", "kept"),
                        "dedup-marks")
    repeats = (marks.where("kept").groupBy("id", "row_key").agg(F.count(F.lit(1)).alias("n"))
               .where("n > 1"))
    actions = marks.where("NOT kept").select("id", "row_key").distinct().select(
        "*", F.lit(True).alias("drop")).unionByName(
        repeats.select("id", "row_key", F.lit(False).alias("drop")))
    return keep_marked(docs, materialize(actions, "dedup-actions"), id_col, text_col)
