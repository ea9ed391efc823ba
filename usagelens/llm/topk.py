"""Exact top-k search by inner product with two trees.

Queries and data each form a tree whose nodes have a centre and a covering radius; a node's
children are centres picked farthest first until half its radius covers its points or the
fan-out is reached. Two nodes with centres c, d and radii r, s hold no larger inner product than

    c . d  +  |c| s  +  |d| r  +  r s,

so a pair of nodes is dropped when that is below the worst k-th score among the query
node's points. Data and queries are dealt into blocks around sampled pivots; pairs of blocks that the
same bound excludes are never sent, each other pair is searched by a task of its own, and the
best k of all blocks are kept. Where the leaves' bounds show that the trees exclude little, the
scores of two blocks come from matrix products.
"""

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import ship
from usagelens.llm.vectors import as_long, by_length, scaled, usable
from usagelens.storage import materialize

FANOUT, LEAF = 16, 64
SAMPLE, MOST_CELLS = 256, 128
# Trees are descended where their leaves exclude at least this share of the pairs; a product
# computes a score several times faster than the descent does.
WORTH, CHUNK = 0.7, 512
# Squares of larger components would leave the range of doubles.
LARGEST = 1e150


class Node:
    """Points ``first`` to ``last`` of the tree's order, around ``centre``."""

    __slots__ = ("first", "last", "centre", "norm", "radius", "children")

    def __init__(self, first, last, centre, radius, children):
        self.first, self.last, self.centre, self.radius = first, last, centre, radius
        self.norm = float(np.sqrt(centre @ centre))
        self.children = children


class CoverTree:
    """A tree over the rows of ``points``; ``order`` says which row is where in it."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.leaf = leaf
        order = []
        self.root = self._grow(points, np.arange(len(points)), 0, order)
        self.order = np.concatenate(order)
        self.points = points[self.order]

    def _grow(self, points, rows, first, order):
        own = points[rows]
        far = np.sqrt(((own - own[0]) ** 2).sum(1))
        radius = float(far.max())
        if len(rows) <= self.leaf or radius == 0:
            order.append(rows)
            return Node(first, first + len(rows), own[0], radius, [])
        nearest, centre = far, np.zeros(len(rows), np.int64)
        for child in range(1, FANOUT):
            at = int(nearest.argmax())
            if nearest[at] <= radius / 2:
                break
            distance = np.sqrt(((own - own[at]) ** 2).sum(1))
            closer = distance < nearest
            nearest = np.where(closer, distance, nearest)
            centre[closer] = child
        children, begin = [], first
        for child in np.unique(centre):
            part = rows[centre == child]
            part = part[np.argsort(nearest[centre == child], kind="stable")]  # the centre first
            children.append(self._grow(points, part, begin, order))
            begin += len(part)
        return Node(first, first + len(rows), own[0], radius, children)


class Search:
    """The ``k`` best data rows of each query, found by descending both trees together."""

    def __init__(self, queries: np.ndarray, query_ids, floors, data: np.ndarray, ids, k: int):
        self.k, self.data, self.queries = k, CoverTree(data), CoverTree(queries, 32)
        self.ids = ids[self.data.order]
        self.query_ids = query_ids[self.queries.order]
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        # A score that at least k rows of all data are known to reach.
        self.floors = floors[self.queries.order]
        self.kth = self.floors.copy()
        self.compared = 0

    def run(self) -> Iterator[tuple[int, int, int]]:
        if self._excluded() >= WORTH:
            self._descend(self.queries.root, [self.data.root])
        else:
            for first in range(0, len(self.ids), CHUNK):
                self._compare(slice(0, len(self.query_ids)), slice(first, first + CHUNK))
        for q, i in zip(*np.nonzero(self.scores > -np.inf)):
            yield int(self.query_ids[q]), int(self.found[q, i]), as_long(self.scores[q, i])

    def _excluded(self) -> float:
        """The share of pairs that the bounds of leaves exclude before any score is known."""
        nodes = leaves(self.data.root)
        sizes = np.array([n.last - n.first for n in nodes])
        out = 0
        for query in leaves(self.queries.root):
            misses = self._bounds(query, nodes) < self.kth[query.first : query.last].min()
            out += (query.last - query.first) * int(sizes[misses].sum())
        return out / (len(self.query_ids) * len(self.ids))

    def _bounds(self, query: Node, nodes: list[Node]) -> np.ndarray:
        centres = np.stack([n.centre for n in nodes]) @ query.centre
        radii = np.array([n.radius for n in nodes])
        norms = np.array([n.norm for n in nodes])
        bounds = centres + query.norm * radii + norms * query.radius + query.radius * radii
        # For rounding, of terms that can cancel each other; scores are whole numbers.
        return bounds + 1e-9 * (query.norm + query.radius) * (norms + radii) + 0.5

    def _descend(self, query: Node, nodes: list[Node]) -> None:
        bounds = self._bounds(query, nodes)
        order = np.argsort(-bounds)
        if query.children:
            worst = self.kth[query.first : query.last].min()
            kept = [nodes[i] for i in order if bounds[i] >= worst]
            further = [c for n in kept for c in (n.children or [n])]
            if further:
                for child in query.children:
                    self._descend(child, further)
            return
        for i in order:
            if bounds[i] < self.kth[query.first : query.last].min():
                return
            if nodes[i].children:
                self._descend(query, nodes[i].children)
            else:
                self._compare(slice(query.first, query.last), slice(nodes[i].first, nodes[i].last))

    def _compare(self, rows: slice, own: slice) -> None:
        scores = self.queries.points[rows] @ self.data.points[own].T
        self.compared += scores.size
        ids = self.ids[own]
        scores[self.query_ids[rows, None] == ids[None, :]] = -np.inf
        better = np.flatnonzero((scores >= self.kth[rows, None]).any(axis=1))
        if not len(better):
            return
        at = better + rows.start
        scores = np.concatenate([self.scores[at], scores[better]], axis=1)
        ids = np.concatenate([self.found[at], np.broadcast_to(ids, (len(at), len(ids)))], axis=1)
        order = np.argsort(ids, axis=1, kind="stable")
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        order = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        self.found[at] = np.take_along_axis(ids, order, 1)
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.kth[at] = np.maximum(self.floors[at], self.scores[at, -1])


def leaves(node: Node) -> list[Node]:
    found, waiting = [], [node]
    while waiting:
        node = waiting.pop()
        waiting += node.children
        if not node.children:
            found.append(node)
    return found


def pivots(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` of the points, picked farthest first."""
    picked = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(picked) < min(count, len(points)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[picked[-1]]) ** 2).sum(1))
    return points[picked]


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors of doubles; rows that take no part are left out."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))


def whole(vectors: list, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, cut to ``LARGEST``, as doubles."""
    return np.clip(scaled(np.array(vectors, np.float64), scale), -LARGEST, LARGEST)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    data_rows: int = 20_000,
    query_rows: int = 4_000,
    parallel: int = 12,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each query row, ties to smaller ids.

    Scores are inner products of the vectors' components as floor(scale * x); they are exact
    while they stay below 2^53, and beyond as near as doubles are. Components beyond 1e150 count as
    1e150, and a score that a long cannot hold is cut to the nearest one after ranking within a
    task, so between tasks such scores tie. Candidates are all rows but those with the query's id; fewer
    than ``k`` candidates are all returned. Vectors that are NULL, or hold NULL or
    non-finite components, and rows without id take no part, and only vectors of the
    same length are compared. Candidates repeated with one id count as often as they
    occur; repeated query rows count once. An empty table gives no rows, and other columns are not read.

    Data lie in blocks of at most about ``data_rows`` rows around at least ``parallel`` pivots, and
    queries in blocks of about ``query_rows``; a task holds one block of each. ``SAMPLE`` rows, fixed
    in number, give the pivots, and every query a score that its k-th best will reach. Runs at once.
    """
    spark = ship(vectors.sparkSession)
    rows = usable_vectors(vectors, id_col, vector_col).withColumn("size", F.size("v"))
    queries = usable_vectors(vectors.where(is_query), id_col, vector_col).distinct()
    queries = queries.withColumn("size", F.size("v"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(row["size"], []).append(row)
    sampled = {
        size: (np.array([r["vec_id"] for r in own]), whole([r["v"] for r in own], scale))
        for size, own in by_size.items()
    }

    def dealt(own: DataFrame, block_rows: int, least: int, name: str) -> tuple[DataFrame, dict]:
        total = own.count()
        cells = min(MOST_CELLS, max(least, ceil(total / block_rows)))
        centres = {size: pivots(points, cells) for size, (_, points) in sampled.items()}
        made = materialize(placed(own, centres, sampled, scale, k), name)
        most = made.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
        chunks = max(1, ceil(most / block_rows))
        chunk = F.pmod(F.monotonically_increasing_id(), F.lit(chunks))
        made = made.withColumn("block", F.col("cell") * chunks + chunk)
        return materialize(made, name), centres

    data, data_centres = dealt(rows, data_rows, parallel, "top-k-data")
    asked, query_centres = dealt(queries, query_rows, 1, "top-k-queries")
    centres = spark.sparkContext.broadcast((query_centres, data_centres))
    around = data.groupBy("size", "block").agg(F.first("cell").alias("cell"), F.max("far").alias("radius"))
    asking = asked.groupBy("size", "block").agg(
        F.first("cell").alias("query_cell"), F.max("far").alias("query_radius"), F.min("floor").alias("floor")
    )
    met = around.join(asking.withColumnRenamed("block", "query_block"), "size")

    def near(batches):
        queries, points = centres.value
        for batch in batches:
            keep = []
            for r in batch.to_pylist():
                if r["size"] not in points:
                    keep.append(True)
                    continue
                c, d = queries[r["size"]][r["query_cell"]], points[r["size"]][r["cell"]]
                c_norm, d_norm = np.sqrt(c @ c), np.sqrt(d @ d)
                reach = (c_norm + r["query_radius"]) * (d_norm + r["radius"])
                bound = c @ d + c_norm * r["radius"] + d_norm * r["query_radius"] + r["radius"] * r["query_radius"]
                keep.append(not bound + 1e-9 * reach + 0.5 < r["floor"])
            yield batch.select(["size", "block", "query_block"]).filter(pa.array(keep, pa.bool_()))

    schema = "size int, block long, query_block long"
    pairs = materialize(met.mapInArrow(near, schema), "top-k-pairs")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        query_ids, ids = left["vec_id"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        points, floors = whole(left["v"].to_list(), scale), left["floor"].to_numpy(np.float64)
        found = Search(points, query_ids, floors, whole(right["v"].to_list(), scale), ids, k).run()
        return pd.DataFrame(list(found), columns=["query_id", "vec_id", "score"])

    keys = ["size", "block", "query_block"]
    asked = asked.withColumnRenamed("block", "query_block").join(pairs, ["size", "query_block"])
    best = (
        asked.select(*keys, "vec_id", "v", "floor")
        .groupBy(*keys)
        .cogroup(data.select("size", "block", "vec_id", "v").join(pairs, ["size", "block"]).groupBy(*keys))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(
        F.col("rank") <= k
    )


def placed(rows: DataFrame, centres: dict, sampled: dict, scale: int, k: int) -> DataFrame:
    """(vec_id, v, size, cell, far, floor): the nearest centre, the distance to it, and a score that the
    k-th best of all rows will reach."""

    def place(batches):
        for batch in batches:
            for at, matrix in by_length(batch.column(1)):
                size, own = matrix.shape[1], batch.take(pa.array(at))
                ids, points = own.column(0).to_numpy(), whole(matrix, scale)
                cell, far, floor = np.zeros(len(at), np.int32), np.zeros(len(at)), np.full(len(at), -np.inf)
                if size in centres:
                    # By differences, as products would lose the digits that far vectors have in common.
                    gaps = np.stack([np.sqrt(((points - c) ** 2).sum(1)) for c in centres[size]], axis=1)
                    cell, far = gaps.argmin(axis=1).astype(np.int32), gaps.min(axis=1)
                    known_ids, known = sampled[size]
                    if len(known_ids) > k:
                        scores = points @ known.T
                        scores[ids[:, None] == known_ids[None, :]] = -np.inf
                        # Sums of large numbers in another order can come out a little less.
                        most = np.sqrt((points**2).sum(1)) * np.sqrt((known**2).sum(1)).max()
                        floor = np.partition(scores, -k, axis=1)[:, -k] - 1e-12 * most
                columns = [own.column(0), own.column(1), own.column(2), pa.array(cell), pa.array(far), pa.array(floor)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "size", "cell", "far", "floor"])

    return rows.mapInArrow(place, "vec_id long, v array<double>, size int, cell int, far double, floor double")
