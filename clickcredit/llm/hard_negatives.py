"""Hard negatives by a multiway hyperplane tree.

For each anchor its positives are the rows of its label with the largest
inner products. For each positive, the hard negatives are the rows of other
labels whose inner product lies in a window just below the positive's.
Vectors are integers, so scores are exact.

**Geometry.** A row ``x`` gets one more coordinate, ``sqrt(M - |x|^2)`` with ``M`` the
largest squared length, and an anchor ``q`` gets a zero. Then the distance of ``q``
and ``x`` is ``sqrt(|q|^2 + M - 2 score)``: a window of scores is an annulus around
the anchor, and the triangle inequality holds.

**Tree.** A node has up to ``FANOUT`` split points, chosen far apart from a bounded
sample (``SAMPLE_ROWS``). A row belongs to the nearest one, so subtrees are parted
by hyperplanes between split points. Every row is indexed: it is routed to a leaf in Arrow
batches, and the table is written in order of leaves; a leaf of any size spans as
many tasks as it needs. Each split point stores the range of its distances to the
rows of every sibling subtree, taken over all rows.

**Search.** Anchors go in blocks of at most about ``ANCHOR_BLOCK`` against all rows. With
the anchor's distances to the split points, each range bounds the distances,
hence the scores, of a subtree. A subtree whose bounds miss the annulus of the
anchor's window is eliminated; the rows of the other leaves are scored exactly.
Each task keeps the few best of each anchor, so what is shuffled is anchors
times tasks, whatever the size of a leaf or a label. Positives come first, with a lower bound on the last
one's score from the sample; their scores are the windows of the second search.

Defined cases: rows with a null id or label, a null vector, or a null or
non-finite component take no part; vectors are as long as the longest one, with
zeros behind; equal scores go by the smaller id; rows that share an id are rows of their own,
and a repeated anchor has results of its own; an anchor without
positives, and a positive without negatives, give no row; an empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, prepare_workers

FANOUT = 16
DEPTH = 2
SAMPLE_ROWS = 4096
ANCHOR_BLOCK = 8192
#: Rows of an index task where there are many, and the least where there are few.
TASK_ROWS, LEAST_ROWS = 1 << 18, 1 << 12
_ANCHORS_AT_ONCE = 256
_ROWS_AT_ONCE = 1 << 13
_NONE = np.iinfo(np.int64).min
#: Float64 holds every integer below this.
_EXACT = 1 << 53


@dataclass
class Node:
    """Split points (their integer coordinates and the added one), and what each one's subtree is.

    ``below[j]`` is the number of a node, or ``-1 - leaf``.
    """

    points: np.ndarray
    added: np.ndarray
    below: np.ndarray


@dataclass
class Tree:
    """Nodes (the first is the root), leaves, and the largest squared length ``most`` of all rows."""

    nodes: list[Node]
    leaves: int
    most: float

    def added(self, x: np.ndarray) -> np.ndarray:
        """The added coordinate of each row."""
        return np.sqrt(np.maximum(self.most - np.einsum("ij,ij->i", x, x), 0.0))

    def distances(self, node: Node, x: np.ndarray, added: np.ndarray) -> np.ndarray:
        """From each row to each split point."""
        own = np.einsum("ij,ij->i", x, x) + added ** 2
        points = np.einsum("ij,ij->i", node.points, node.points) + node.added ** 2
        squared = own[:, None] + points - 2 * (x @ node.points.T + np.outer(added, node.added))
        return np.sqrt(np.maximum(squared, 0.0))

    def route(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``node, rows, nearest, distances`` of every node that rows come to."""
        added = self.added(x)
        todo = [(0, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            node = self.nodes[number]
            far = self.distances(node, x[rows], added[rows])
            nearest = far.argmin(axis=1)
            yield number, rows, nearest, far
            todo += [(int(child), rows[nearest == j]) for j, child in enumerate(node.below)
                     if child >= 0 and (nearest == j).any()]

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for number, rows, nearest, _ in self.route(x):
            below = self.nodes[number].below[nearest]
            out[rows[below < 0]] = -1 - below[below < 0]
        return out


def _split_points(x: np.ndarray, added: np.ndarray, count: int) -> np.ndarray:
    """Places of up to ``count`` rows far from each other, each the farthest from those before it."""
    whole = np.column_stack((x, added))
    chosen, far = [0], np.full(len(x), np.inf)
    while len(chosen) < count:
        far = np.minimum(far, ((whole - whole[chosen[-1]]) ** 2).sum(axis=1))
        best = int(far.argmax())
        if far[best] <= 0:
            break
        chosen.append(best)
    return np.array(chosen)


def grow(sample: np.ndarray, most: float, fanout: int = FANOUT, depth: int = DEPTH) -> Tree:
    """A tree from sampled rows; a node of too few of them is a leaf."""
    tree = Tree([], 0, most)

    def node_of(rows: np.ndarray, levels: int) -> int:
        x = sample[rows]
        added = tree.added(x)
        at = _split_points(x, added, fanout)
        node = Node(x[at], added[at], np.zeros(len(at), np.int64))
        number = len(tree.nodes)
        tree.nodes.append(node)
        nearest = tree.distances(node, x, added).argmin(axis=1)
        for j in range(len(at)):
            inside = rows[nearest == j]
            if levels > 1 and len(inside) >= 2 * fanout:
                node.below[j] = node_of(inside, levels - 1)
            else:
                node.below[j] = -1 - tree.leaves
                tree.leaves += 1
        return number

    node_of(np.arange(len(sample)), depth)
    return tree


@dataclass
class Ranges:
    """``low[node][i, j]`` and ``high``: distances of split point ``i`` to the rows of the subtree of ``j``."""

    low: list[np.ndarray]
    high: list[np.ndarray]

    @staticmethod
    def empty(tree: Tree) -> Ranges:
        shapes = [(len(n.below), len(n.below)) for n in tree.nodes]
        return Ranges([np.full(s, np.inf) for s in shapes], [np.full(s, -np.inf) for s in shapes])

    def add(self, tree: Tree, x: np.ndarray) -> None:
        for number, _, nearest, far in tree.route(x):
            for j in np.unique(nearest):
                own = far[nearest == j]
                self.low[number][:, j] = np.minimum(self.low[number][:, j], own.min(axis=0))
                self.high[number][:, j] = np.maximum(self.high[number][:, j], own.max(axis=0))


def score_bounds(tree: Tree, ranges: Ranges, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that a row of each leaf can have with each anchor: ``(anchors, leaves)``."""
    low, high = (np.zeros((len(anchors), tree.leaves)) for _ in range(2))
    length = np.einsum("ij,ij->i", anchors, anchors)
    # far above the rounding of the distances, far below a score's unit of 1
    slack = 1e-9 * (length + tree.most)[:, None] + 1e-6
    todo = [(0, np.zeros((len(anchors), 1)), np.full((len(anchors), 1), np.inf))]
    while todo:
        number, nearest, farthest = todo.pop()
        node = tree.nodes[number]
        far = tree.distances(node, anchors, np.zeros(len(anchors)))
        least = np.repeat(nearest, len(node.below), axis=1)
        most = np.repeat(farthest, len(node.below), axis=1)
        for i in range(len(node.below)):
            to_i = far[:, i:i + 1]
            np.maximum(least, ranges.low[number][i] - to_i, out=least)
            np.maximum(least, to_i - ranges.high[number][i], out=least)
            np.minimum(most, to_i + ranges.high[number][i], out=most)
        for j, child in enumerate(node.below):
            if child >= 0:
                todo.append((int(child), least[:, j:j + 1], most[:, j:j + 1]))
            else:
                base = length + tree.most
                with np.errstate(invalid="ignore"):
                    high[:, -1 - child] = (base - least[:, j] ** 2) / 2
                    low[:, -1 - child] = (base - np.minimum(most[:, j], 1e150) ** 2) / 2
    return low - slack, high + slack


@dataclass
class Block:
    """Anchors that are searched for together, with the tree and its ranges."""

    tree: Tree
    ranges: Ranges
    dims: int
    exact: bool
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def scores(self, some: np.ndarray, x: np.ndarray) -> np.ndarray:
        if self.exact:
            return np.rint(self.vectors[some].astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
        return self.vectors[some] @ x.T


class Best:
    """The best ``k`` of each query, by score and then by id and row."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), _NONE)
        self.ids = np.zeros((queries, k), np.int64)
        self.rows = np.zeros((queries, k), np.int64)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Offer rows in order of ``(id, row)`` to queries; ``_NONE`` as a score is no offer."""
        largest = scores.max(axis=1)
        live = (largest > _NONE) & (largest >= self.scores[queries, -1])
        queries, scores = queries[live], scores[live]
        if not len(queries):
            return
        if scores.shape[1] > self.k:
            least = np.partition(scores, -self.k, axis=1)[:, -self.k:].min(axis=1)[:, None]
            above, equal = scores > least, scores == least
            taken = above | (equal & (np.cumsum(equal, axis=1) <= self.k - above.sum(axis=1)[:, None]))
        else:
            taken = np.ones(scores.shape, bool)
        q, at = np.nonzero(taken & (scores > _NONE))
        slot = np.arange(len(queries))
        query = np.concatenate((q, np.repeat(slot, self.k)))
        columns = [np.concatenate((new, old[queries].ravel())) for new, old in (
            (scores[q, at], self.scores), (ids[at], self.ids), (rows[at], self.rows))]
        order = np.lexsort((columns[2], columns[1], ~columns[0], query))
        query = query[order]
        first = np.searchsorted(query, slot)
        keep = order[(first[:, None] + np.arange(self.k)).ravel()]
        for table, column in zip((self.scores, self.ids, self.rows), columns, strict=True):
            table[queries] = column[keep].reshape(-1, self.k)


def matrix_of(vectors: pa.Array, dims: int) -> np.ndarray:
    """Integer vectors as rows of ``dims`` numbers, with zeros behind shorter ones."""
    sizes = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _segments(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``leaf, ids, rows, labels, vectors`` of runs of one leaf, in order of id and row."""
    leaf, ids, rows, labels = (batch.column(c).to_numpy() for c in ("leaf", "id", "row", "label"))
    order = np.lexsort((rows, ids, leaf))
    edges = np.flatnonzero(np.diff(leaf[order])) + 1
    vectors = matrix_of(batch.column("vec"), dims)
    for run in np.split(order, edges):
        for lo in range(0, len(run), _ROWS_AT_ONCE):
            at = run[lo:lo + _ROWS_AT_ONCE]
            yield leaf[at[0]], ids[at], rows[at], labels[at], vectors[at]


def _chunks(places: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(places), _ANCHORS_AT_ONCE):
        yield places[lo:lo + _ANCHORS_AT_ONCE]


def _positives(shared, bound: np.ndarray, k: int):
    """Arrow function: a task's best rows of the anchors' labels, where their last score may reach ``bound``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        best, most = Best(len(block.rows), k), None
        for batch in batches:
            if most is None:
                most = score_bounds(block.tree, block.ranges, block.vectors.astype(np.float64))[1]
            for leaf, ids, rows, labels, x in _segments(batch, block.dims):
                wanted = np.isin(block.labels, np.unique(labels))
                reach = np.maximum(bound, best.scores[:, -1])
                for some in _chunks(np.flatnonzero(wanted & (most[:, leaf] >= reach))):
                    scores = block.scores(some, x)
                    scores[(block.labels[some][:, None] != labels) | (block.rows[some][:, None] == rows)] = _NONE
                    best.add(some, scores, ids, rows)
        q, at = np.nonzero(best.scores > _NONE)
        yield pa.record_batch({"anchor": pa.array(q), "score": pa.array(best.scores[q, at]),
                               "id": pa.array(best.ids[q, at]), "row": pa.array(best.rows[q, at])})
    return run


def _negatives(shared, windows, low: int, high: int, scale: int, k: int):
    """Arrow function: a task's best rows of other labels in the window of each positive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        anchor, positive = windows.value
        best, bounds = Best(len(anchor), k), None
        for batch in batches:
            if bounds is None:
                least, most = score_bounds(block.tree, block.ranges, block.vectors.astype(np.float64))
                bounds = least[anchor], most[anchor]
            for leaf, ids, rows, labels, x in _segments(batch, block.dims):
                inside = ((bounds[0][:, leaf] * scale <= positive * high)
                          & (bounds[1][:, leaf] * scale >= np.maximum(positive * low, best.scores[:, -1] * 1.0 * scale)))
                for some in _chunks(np.flatnonzero(inside)):
                    asked, back = np.unique(anchor[some], return_inverse=True)
                    scores = block.scores(asked, x)
                    scores[block.labels[asked][:, None] == labels] = _NONE
                    scores, top = scores[back], positive[some][:, None]
                    out = (scores == _NONE) | (scores * scale > top * high)
                    out |= np.where(out, 0, scores) * scale < top * low
                    scores[out] = _NONE
                    best.add(some, scores, ids, rows)
        q, at = np.nonzero(best.scores > _NONE)
        yield pa.record_batch({"window": pa.array(q), "score": pa.array(best.scores[q, at]),
                               "id": pa.array(best.ids[q, at]), "row": pa.array(best.rows[q, at])})
    return run


def _routed(tree: Tree, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves_of(matrix_of(batch.column("vec"), dims).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])
    return run


def _range_rows(tree: Tree, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Ranges.empty(tree)
        for batch in batches:
            found.add(tree, matrix_of(batch.column("vec"), dims).astype(np.float64))
        for number, (low, high) in enumerate(zip(found.low, found.high, strict=True)):
            i, j = np.nonzero(np.isfinite(low))
            yield pa.record_batch({"node": pa.array(np.full(len(i), number)), "i": pa.array(i), "j": pa.array(j),
                                   "low": pa.array(low[i, j]), "high": pa.array(high[i, j])})
    return run


def usable(vectors: DataFrame, vec_col: str, *others: str) -> DataFrame:
    """The rows that take part: no null in the named columns or the vector, no non-finite component."""
    finite = F.forall(vectors[vec_col], lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    keep = vectors[vec_col].isNotNull() & finite
    for name in others:
        keep = keep & vectors[name].isNotNull()
    return vectors.where(keep)


def quantised(vec: Column, unit: int = 256) -> Column:
    """``floor(unit * x)`` of each component, with ``x`` as a double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * unit))


@dataclass
class Index:
    """Every row with its leaf (a written table), the tree, its ranges, and the sampled rows."""

    table: DataFrame
    tree: Tree
    ranges: Ranges
    dims: int
    exact: bool
    sample: pa.Table


def build_index(rows: DataFrame, fanout: int = FANOUT, depth: int = DEPTH, sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """The index of a written table ``row, id, label, vec, anchor``; none if it is empty."""
    spark = rows.sparkSession
    squares = F.aggregate("vec", F.lit(0).cast("bigint"), lambda total, x: total + x * x)
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims"), F.max(squares).alias("most")).first()
    if not seen["n"]:
        return None
    dims, most = seen["dims"], seen["most"]
    draw = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw <= sample_rows / seen["n"]).toArrow()
    if not sample.num_rows:
        sample = rows.limit(1).toArrow()
    tree = grow(matrix_of(sample["vec"].combine_chunks(), dims).astype(np.float64), float(most), fanout, depth)
    routed = rows.mapInArrow(_routed(tree, dims), "row bigint, id bigint, label bigint, vec array<bigint>, anchor boolean, leaf bigint")
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen["n"] // LEAST_ROWS))
    tasks = max(few, -(-seen["n"] // TASK_ROWS))
    # the row's hash spreads a leaf that holds a third of all rows
    table = materialize(routed.repartitionByRange(tasks, "leaf", F.xxhash64("row")).sortWithinPartitions("leaf", "id"),
                        "negatives-index")
    found = table.mapInArrow(_range_rows(tree, dims), "node bigint, i bigint, j bigint, low double, high double")
    ranges = Ranges.empty(tree)
    # one row for each pair of siblings: bounded by the tree
    for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        ranges.low[r["node"]][r["i"], r["j"]], ranges.high[r["node"]][r["i"], r["j"]] = r["low"], r["high"]
    return Index(table, tree, ranges, dims, most < _EXACT, sample)


def _first(found: DataFrame, by: str, k: int) -> DataFrame:
    """The best ``k`` of what the tasks found for each anchor or window: a few rows of each task."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(index: Index, anchors: pa.Table, positives: int, negatives: int, low: int, high: int,
            scale: int) -> DataFrame | None:
    """The results of a block of anchors."""
    spark = index.table.sparkSession
    columns = [anchors[c].to_numpy() for c in ("row", "id", "label")]
    block = Block(index.tree, index.ranges, index.dims, index.exact, *columns,
                  matrix_of(anchors["vec"].combine_chunks(), index.dims))
    shared = spark.sparkContext.broadcast(block)
    # what the sample has is a lower bound of what all rows have
    seeds = Best(len(block.rows), positives)
    sample = [index.sample[c].to_numpy() for c in ("id", "row", "label")]
    order = np.lexsort((sample[1], sample[0]))
    ids, rows, labels = (x[order] for x in sample)
    x = matrix_of(index.sample["vec"].combine_chunks(), index.dims)[order]
    for some in _chunks(np.arange(len(block.rows))):
        scores = block.scores(some, x)
        scores[(block.labels[some][:, None] != labels) | (block.rows[some][:, None] == rows)] = _NONE
        seeds.add(some, scores, ids, rows)
    found = index.table.mapInArrow(_positives(shared, seeds.scores[:, -1], positives),
                                   "anchor bigint, score bigint, id bigint, row bigint")
    # as many rows as the block has anchors, times the positives of one
    best = _first(found, "anchor", positives).select("anchor", "score", "id", "rank").orderBy("anchor", "rank").toArrow()
    if not best.num_rows:
        return None
    anchor, positive, positive_id = (best[c].to_numpy() for c in ("anchor", "score", "id"))
    windows = spark.sparkContext.broadcast((anchor, positive))
    hits = index.table.mapInArrow(_negatives(shared, windows, low, high, scale, negatives),
                                  "window bigint, score bigint, id bigint, row bigint")
    known = spark.createDataFrame(pa.table({
        "window": pa.array(np.arange(len(anchor))), "anchor_id": pa.array(block.ids[anchor]),
        "positive_id": pa.array(positive_id), "positive_score": pa.array(positive)}))
    return materialize(
        _first(hits, "window", negatives).join(F.broadcast(known), "window").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")), "negatives-found")


SCHEMA = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(vectors: DataFrame, anchor_col: str, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "vec",
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 100,
         fanout: int = FANOUT, depth: int = DEPTH, sample_rows: int = SAMPLE_ROWS,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has integer vectors; ``anchor_col`` marks the anchors. A negative's score is
    from ``low / scale`` to ``high / scale`` of its positive's.
    """
    spark = vectors.sparkSession
    prepare_workers(spark)
    rows = materialize(usable(vectors, vec_col, id_col, label_col).select(
        F.monotonically_increasing_id().alias("row"), vectors[id_col].cast("bigint").alias("id"),
        vectors[label_col].cast("bigint").alias("label"), vectors[vec_col].cast("array<bigint>").alias("vec"),
        F.coalesce(vectors[anchor_col], F.lit(False)).alias("anchor")), "negatives-rows")
    index = build_index(rows, fanout, depth, sample_rows)
    if index is None:
        return spark.createDataFrame([], SCHEMA)
    anchors = index.table.where("anchor").select("row", "id", "label", "vec")
    blocks = max(1, -(-anchors.count() // anchor_block))
    number = F.pmod(F.xxhash64("row"), F.lit(blocks))
    out = spark.createDataFrame([], SCHEMA)
    for k in range(blocks):
        block = anchors.where(number == k).toArrow()
        found = _search(index, block, positives, negatives, low, high, scale) if block.num_rows else None
        out = out if found is None else out.unionByName(found)
    return out
