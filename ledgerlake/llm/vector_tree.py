"""A multiway hyperplane tree over integer vectors, in the manner of GNAT, and exact windowed searches in it.

Each inner node has up to ``DEGREE`` split points; a vector belongs to the nearest one, and so on down to a
leaf.  For each pair of siblings the node stores the range of distances from the one's split point to the
vectors below the other, and for each subtree the range of lengths.  A search asks for vectors whose inner
product with a query lies in a window.  With a subtree's lengths a window becomes an annulus of distances
around the query; by the triangle inequality, a sibling falls out if the distances from some split point
that the annulus admits do not meet the stored range.  What is left is compared one by one in the leaves.

Split points come from a sample of at most ``SAMPLE`` rows by hash, so the tree has at most
``MOST_LEAVES`` leaves; that only shapes the tree.  Every row is assigned, and ranges cover every row, so
results are exact.  Leaves are stored as packed pieces of about ``PIECE`` rows by hash, however many rows
(copies of one vector, say) a leaf holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .packed import freeze, thaw
from .storage import bucket_count, written

DEGREE, SAMPLE, LEAF_ROWS, MOST_LEAVES, PIECE, ASKS = 8, 8192, 4000, 4096, 8192, 2048
NO_LOW, NO_HIGH = -(1 << 62), 1 << 62
_EXACT = float(1 << 53)


def as_matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows of a float matrix; shorter ones get zeros."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), int(sizes.max(initial=0))))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy()
    return out


def padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, max(0, width - a.shape[1]))))[:, :max(width, a.shape[1])]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: in floats where these hold them, else by Python's integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = padded(a, width), padded(b, width)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * width < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, NO_LOW, NO_HIGH).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    a, b = padded(a, width), padded(b, width)
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Node:
    """``splits`` of an inner node and its children; a leaf has a number.  Ranges are filled from all rows."""

    splits: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1
    name: int = -1
    near: np.ndarray | None = None  # least distance from split point i to a vector below sibling j
    far: np.ndarray | None = None
    least_length: np.ndarray | None = None  # of the vectors below child j
    most_length: np.ndarray | None = None


def _spread(sample: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` different rows, each the farthest from those before."""
    chosen = [0]
    gap = distances(sample, sample[:1])[:, 0]
    while len(chosen) < k and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(sample, sample[chosen[-1:]])[:, 0])
        gap[chosen] = 0
    return np.array(chosen)


class Tree:
    """The shape of the tree: small enough to go to every task."""

    def __init__(self, sample: np.ndarray, rows: int) -> None:
        levels = max(1, round(np.log(max(rows, 1) / LEAF_ROWS) / np.log(DEGREE))) if rows > LEAF_ROWS else 0
        self.n_leaves, self.inner = 0, []
        self.root = self._node(sample, min(levels, round(np.log(MOST_LEAVES) / np.log(DEGREE))))

    def _node(self, sample: np.ndarray, levels: int) -> Node:
        splits = _spread(sample, DEGREE) if levels and len(sample) else []
        if len(splits) < 2:
            self.n_leaves += 1
            return Node(leaf=self.n_leaves - 1)
        node = Node(splits=sample[splits], name=len(self.inner))
        self.inner.append(node)
        owner = distances(sample, node.splits).argmin(axis=1)
        node.children = [self._node(sample[owner == j], levels - 1) for j in range(len(splits))]
        size = (len(splits), len(splits))
        node.near, node.far = np.full(size, np.inf), np.full(size, -np.inf)
        node.least_length, node.most_length = np.full(len(splits), np.inf), np.full(len(splits), -np.inf)
        return node

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Each vector's leaf, and what ranges it takes: (node, i, j, near, far); i = -1 stands for the origin."""
        leaf, ranges, lengths = np.zeros(len(vectors), np.int64), [], np.sqrt((vectors**2).sum(axis=1))

        def down(node: Node, rows: np.ndarray) -> None:
            if node.splits is None:
                leaf[rows] = node.leaf
                return
            gaps = distances(vectors[rows], node.splits)
            owner = gaps.argmin(axis=1)
            for j in np.unique(owner):
                own = owner == j
                below = gaps[own]
                ranges.extend((node.name, i, int(j), float(below[:, i].min()), float(below[:, i].max())) for i in range(below.shape[1]))
                size = lengths[rows[own]]
                ranges.append((node.name, -1, int(j), float(size.min()), float(size.max())))
                down(node.children[j], rows[own])

        if len(vectors):
            down(self.root, np.arange(len(vectors)))
        return leaf, ranges

    def set_ranges(self, ranges: list[tuple]) -> None:
        for name, i, j, near, far in ranges:
            node = self.inner[name]
            if i < 0:
                node.least_length[j], node.most_length[j] = near, far
            else:
                node.near[i, j], node.far[i, j] = near, far

    def visits(self, queries: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, windows) that may meet: window k asks for products with query ``owner[k]`` from ``low[k]`` to ``high[k]``."""
        square, out = (queries**2).sum(axis=1), []

        def down(node: Node, windows: np.ndarray) -> None:
            if not len(windows):
                return
            if node.splits is None:
                out.append((node.leaf, windows))
                return
            gaps, q2 = distances(queries, node.splits)[owner[windows]], square[owner[windows]]
            for j, child in enumerate(node.children):
                if node.least_length[j] > node.most_length[j]:
                    continue  # nothing below
                # the annulus around the query that holds every vector of this subtree in the window
                inner = np.sqrt(np.maximum(q2 + node.least_length[j] ** 2 - 2 * high[windows], 0))
                outer = np.sqrt(np.maximum(q2 + node.most_length[j] ** 2 - 2 * low[windows], 0))
                slack = 1e-6 * (1 + gaps + outer[:, None] + np.sqrt(q2)[:, None])  # of rounding
                reach = gaps + outer[:, None]  # farthest from a split point that the annulus admits
                miss = np.maximum(gaps - outer[:, None], inner[:, None] - gaps)  # nearest
                alive = ((reach + slack >= node.near[:, j]) & (miss - slack <= node.far[:, j])).all(axis=1)
                alive &= (low[windows] <= np.sqrt(q2) * node.most_length[j] * (1 + 1e-9) + 1)
                down(child, windows[alive])

        down(self.root, np.arange(len(owner)))
        return out


class VectorTree:
    """The rows (vec_id, label, vector) in leaves on the shared folder, with the tree that finds them."""

    def __init__(self, rows: DataFrame) -> None:
        self.spark = rows.sparkSession
        number = rows.count()
        share = F.pmod(F.xxhash64("vec_id"), F.lit(number // (SAMPLE // 2) + 1)) == 0  # about so many rows, half of SAMPLE at least
        few = rows if number <= SAMPLE else rows.where(share)
        sample = few.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow().column(0).combine_chunks()
        self.tree = tree = Tree(as_matrix(sample), number)

        def assign(batches):
            for batch in batches:
                vectors = as_matrix(batch.column(2))
                leaf, _ = tree.assign(vectors)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec_id", "label", "vector"])

        placed = written(rows.mapInArrow(assign, "leaf long, vec_id long, label long, vector array<double>"), "leaf-rows")
        sizes = placed.groupBy("leaf").agg(F.count("*").alias("size"))  # at most MOST_LEAVES rows
        piece = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("size") / PIECE))
        pieces = placed.join(F.broadcast(sizes), "leaf").withColumn("piece", piece)

        def pack(key, table):
            vectors = as_matrix(table["vector"].combine_chunks())
            order = np.argsort(table["vec_id"].to_numpy(), kind="stable")
            _, ranges = tree.assign(vectors)
            names, i, j, near, far = zip(*ranges, strict=True) if ranges else [()] * 5
            held = freeze(table["vec_id"].to_numpy()[order], table["label"].to_numpy()[order], small(vectors[order]))
            bounds = freeze(*(np.array(x, t) for x, t in ((names, np.int32), (i, np.int32), (j, np.int32), (near, float), (far, float))))
            return pa.table({"leaf": pa.array([key[0].as_py()]), "rows": pa.array([table.num_rows]), "held": pa.array([held], pa.binary()),
                             "bounds": pa.array([bounds], pa.binary())})

        self.pieces = written(
            pieces.select("leaf", "piece", "vec_id", "label", "vector").groupBy("leaf", "piece")
            .applyInArrow(pack, "leaf long, rows long, held binary, bounds binary"),
            "leaves",
        )

        def bounds(batches):
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    arrays = thaw(raw, 5)
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["node", "i", "j", "near", "far"])

        ranges = self.pieces.select("bounds").mapInArrow(bounds, "node int, i int, j int, near double, far double")
        tree.set_ranges([tuple(r) for r in ranges.groupBy("node", "i", "j").agg(F.min("near"), F.max("far")).collect()])  # of the tree's size

    def search(self, asks: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The first ``k`` rows of each window of ``asks`` by product, then least id: anchor_id, slot, vec_id, score.

        Asks: anchor_id, label, vector, windows (slot, low, high).  Rows of the anchor's label are sought
        or, else, left out; the anchor itself is never found.  First the leaf in which the anchor would lie
        is searched; where that gave ``k`` rows, the last one's product is the window's new low end, so that the
        annuli narrow before the tree is searched.
        """
        asks = written(asks, "asks")
        home = self._compare(self._home(asks), k, same_label)
        best = written(first_of(home, k), "home-hits")
        last = best.groupBy("anchor_id", "slot").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
        told = last.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "least"))).alias("least"))
        narrowed = asks.join(told, "anchor_id", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
            w["slot"].alias("slot"), F.greatest(w["low"], F.element_at("least", w["slot"])).alias("low"), w["high"].alias("high"),
        ))).drop("least")
        rest = self._compare(self._left(narrowed), k, same_label)
        return first_of(best.union(rest), k)

    def _home(self, asks: DataFrame) -> DataFrame:
        tree = self.tree

        def visit(batches):
            for batch in batches:
                leaf, _ = tree.assign(as_matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", *batch.schema.names])

        return asks.select("anchor_id", "label", "vector", "windows").mapInArrow(visit, _VISIT)

    def _left(self, asks: DataFrame) -> DataFrame:
        """Asks at every leaf that the annuli of their windows do not rule out, but for the leaf searched first."""
        tree = self.tree

        def visit(batches):
            for batch in batches:
                queries, windows = as_matrix(batch.column(2)), batch.column(3)
                home, _ = tree.assign(queries)
                owner = np.repeat(np.arange(len(batch)), windows.value_lengths().to_numpy(zero_copy_only=False))
                low, high = (windows.flatten().field(f).to_numpy().astype(float) for f in ("low", "high"))
                for leaf, alive in tree.visits(queries, owner, low, high):
                    go = np.setdiff1d(owner[alive], np.flatnonzero(home == leaf))
                    if len(go):
                        part = batch.take(pa.array(go))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(go), leaf)), *part.columns], ["leaf", *part.schema.names])

        return asks.select("anchor_id", "label", "vector", "windows").mapInArrow(visit, _VISIT)

    def _compare(self, visits: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The first ``k`` hits of each window in each piece of the visited leaves."""
        visits = written(visits, "visits")
        sizes = visits.groupBy("leaf").agg(F.count("*").alias("asks"))
        bundle = F.pmod(F.xxhash64("anchor_id"), F.ceil(F.col("asks") / ASKS))
        tied = (
            visits.join(F.broadcast(sizes), "leaf").withColumn("bundle", bundle)
            .groupBy("leaf", "bundle").applyInArrow(_tie, "leaf long, asked binary")
        )

        def compare(batches):
            for batch in batches:
                for held, asked in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids, labels, vectors = thaw(held, 3)
                    yield hits(ids, labels, vectors.astype(float), *thaw(asked, 5), k, same_label)

        met = self.pieces.select("leaf", "held").join(tied, "leaf").select("held", "asked")
        # a pair is some megabytes: few to a batch, dealt to all tasks
        return written(met.repartition(bucket_count(0)).mapInArrow(compare, _HIT), "hits")


_VISIT = "leaf long, anchor_id long, label long, vector array<double>, windows array<struct<slot:int,low:long,high:long>>"
_HIT = "anchor_id long, slot int, vec_id long, score long"


def small(vectors: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest kind that holds them."""
    top = np.abs(vectors).max(initial=0)
    return vectors.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else float)


def _tie(key, table):
    windows = table["windows"].combine_chunks()
    flat = windows.flatten()
    asked = freeze(
        table["anchor_id"].to_numpy(), table["label"].to_numpy(), small(as_matrix(table["vector"].combine_chunks())),
        windows.value_lengths().to_numpy(zero_copy_only=False), np.column_stack([flat.field(f).to_numpy().astype(np.int64) for f in ("slot", "low", "high")]),
    )
    return pa.table({"leaf": pa.array([key[0].as_py()]), "asked": pa.array([asked], pa.binary())})


def hits(ids, labels, vectors, anchors, of_anchor, queries, n_windows, windows, k: int, same_label: bool) -> pa.RecordBatch:
    """The first ``k`` of the rows (ordered by id) in each window of each anchor, by product and then id."""
    out = [np.empty((0, 4), np.int64)]
    at = np.concatenate([[0], np.cumsum(n_windows)])
    for first in range(0, len(anchors), 256):
        scores = products(queries[first : first + 256].astype(float), vectors)
        for a in range(first, min(first + 256, len(anchors))):
            mine, score = windows[at[a] : at[a + 1]], scores[a - first]
            if not len(mine):
                continue
            fit = (labels == of_anchor[a]) if same_label else (labels != of_anchor[a])
            rows = np.flatnonzero(fit & (score >= mine[:, 1].min()) & (score <= mine[:, 2].max()) & (ids != anchors[a]))
            for slot, low, high in mine:
                value = score[rows]
                inside = rows[(value >= low) & (value <= high)]
                if len(inside) > 4 * k:  # all that can be among the first k, ties included
                    value = score[inside]
                    inside = inside[value >= np.partition(value, len(value) - k)[len(value) - k]]
                best = inside[np.argsort(-score[inside], kind="stable")[:k]]
                out.append(np.column_stack([np.full(len(best), anchors[a]), np.full(len(best), slot), ids[best], score[best]]))
    table = np.concatenate(out)
    return pa.RecordBatch.from_arrays(
        [pa.array(table[:, 0]), pa.array(table[:, 1].astype(np.int32)), pa.array(table[:, 2]), pa.array(table[:, 3])],
        ["anchor_id", "slot", "vec_id", "score"],
    )


def first_of(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k).drop("_rank")
