"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by a hash of their id (about ``shard_rows`` each, so one shard
fits a task whatever the data); a task builds the ball tree of a shard and streams the
queries through it. Nodes are visited in the order of their upper bound for the inner
product, q.c + |q| r; the search of a shard ends when the best open node cannot reach the
query's k-th score. That score is shared: a first round searches each query in one shard
only, its k-th score then travels with the query to all other shards as the floor.

Components must be whole numbers. Scores are exact: float64 products while every sum stays
below 2**53, whole-number arithmetic beyond (clipped to the range of a long).

Defined cases: vectors that are null or hold null or non-finite components take no part, as
query or candidate; only vectors of equal length are compared (those of length 0 score 0);
rows with the query's own id are not its candidates; of repeated rows of a
query's id the smallest vector of each length asks; fewer than k candidates give fewer
rows; ties go to the smaller id; repeated rows of an id are candidates each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymend.llm.common import staged

SAFE = float(1 << 53)
RESULT = "query_id long, vec_id long, score long"


class BallTree:
    """Balls around halves of the points, down to leaves of ``leaf`` points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = 128):
        order = np.arange(len(points))
        self.centres, self.radii, self.children, self.spans = [], [], [], []
        stack = [(0, len(points), -1)]
        while stack:
            low, high, parent = stack.pop()
            own = points[order[low:high]]
            centre = own.mean(0)
            off = np.sqrt(((own - centre) ** 2).sum(1))
            node = len(self.centres)
            self.centres.append(centre)
            self.radii.append(off.max())
            self.children.append([])
            self.spans.append((low, high))
            if parent >= 0:
                self.children[parent].append(node)
            if high - low > leaf and off.max() > 0:
                # Along the line between two far points.
                a = own[off.argmax()]
                b = own[((own - a) ** 2).sum(1).argmax()]
                half = (high - low) // 2
                order[low:high] = order[low:high][np.argpartition(own @ (b - a), half)]
                stack += [(low, low + half, node), (low + half, high, node)]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self.ids, self.points = ids[order], points[order]

    def search(self, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, candidate ids, scores) with every candidate that can be among the k best."""
        norms = np.sqrt((queries**2).sum(1))
        bounds = queries @ self.centres.T + norms[:, None] * self.radii[None]
        # Rounding must never hide a candidate.
        bounds += 1e-9 * (np.abs(bounds) + norms[:, None] * (np.abs(self.radii) + np.sqrt((self.centres**2).sum(1)))[None]) + 1e-6
        for own, query, floor, bound in zip(ids, queries, floors, bounds, strict=True):
            found_ids, found = np.empty(0, np.int64), np.empty(0)
            heap = [(-bound[0], 0)]
            while heap and -heap[0][0] >= floor:
                node = heapq.heappop(heap)[1]
                if self.children[node]:
                    for child in self.children[node]:
                        if bound[child] >= floor:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                low, high = self.spans[node]
                scores = self.points[low:high] @ query
                use = (scores >= floor) & (self.ids[low:high] != own)
                if use.any():
                    found_ids, found = np.append(found_ids, self.ids[low:high][use]), np.append(found, scores[use])
                    if len(found) > k:
                        best = np.lexsort((found_ids, -found))[:k]
                        found_ids, found = found_ids[best], found[best]
                    if len(found) == k:
                        floor = max(floor, found.min())
            yield own, found_ids, found


def exact_scores(ids, points, own, query, floor, k):
    """The same by whole-number arithmetic, for components that are too large for float64."""
    whole = [int(x) for x in query]
    scores = [(-sum(a * int(b) for a, b in zip(whole, p, strict=True)), int(i)) for i, p in zip(ids, points, strict=True) if i != own]
    best = heapq.nsmallest(k, (s for s in scores if -s[0] >= floor))
    return np.array([i for _, i in best], np.int64), [max(-(1 << 63), min((1 << 63) - 1, -s)) for s, _ in best]


def _searched(rows: DataFrame, k: int, batch: int = 1024) -> DataFrame:
    """``rows``: cell, kind (0 candidate, 1 query), id, floor, vector; sorted by (cell, kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, tree, parts, large = None, None, [], 0.0
        for b in batches:
            cells, kinds = b.column(0).to_pylist(), b.column(1).to_numpy()
            ids, floors = b.column(2).to_numpy(), b.column(3).to_pylist()
            flat, offsets = b.column(4).flatten().to_numpy(zero_copy_only=False), b.column(4).offsets.to_numpy()
            offsets = offsets - offsets[0]
            at = 0
            while at < len(cells):
                end = at
                while end < len(cells) and cells[end] == cells[at] and kinds[end] == kinds[at]:
                    end += 1
                if cells[at] != cell:
                    cell, tree, parts = cells[at], None, []
                width = int(offsets[at + 1] - offsets[at])
                block = flat[offsets[at] : offsets[end]].astype(np.float64).reshape(end - at, width)
                if kinds[at] == 0:
                    parts.append((ids[at:end], block))
                elif parts or tree is not None:
                    if tree is None:
                        points = np.concatenate([p for _, p in parts])
                        owners = np.concatenate([i for i, _ in parts])
                        tree, large = BallTree(owners, points), float(np.abs(points).max(initial=0))
                        parts = []
                    low = np.array([-np.inf if f is None else f for f in floors[at:end]])
                    if width * large * float(np.abs(block).max(initial=0)) < SAFE:
                        hits = tree.search(ids[at:end], block, low, k)
                    else:
                        hits = ((i, *exact_scores(tree.ids, tree.points, i, q, f, k)) for i, q, f in zip(ids[at:end], block, low, strict=True))
                    for query, found_ids, found in hits:
                        if len(found_ids):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(found_ids), query)), pa.array(found_ids), pa.array([int(s) for s in found], pa.int64())],
                                names=["query_id", "vec_id", "score"],
                            )
                at = end

    return rows.select("cell", "kind", "id", "floor", "vector").mapInArrow(run, RESULT)


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col="vec_id", vector_col="vector", shard_rows: int = 50_000) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``queries`` selects, the k best others."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.col(vector_col).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = vectors.where(good & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"),
        F.size(vector).alias("width"),
    )
    usable = staged(usable)
    shards = [(r["width"], max(1, -(-r["n"] // shard_rows))) for r in usable.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()]
    spark = vectors.sparkSession
    if not shards:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # One row for each length of vectors.
    plan = F.broadcast(spark.createDataFrame(shards, "width int, shards long"))
    placed = usable.join(plan, "width").withColumn("shard", F.pmod(F.xxhash64("id", F.lit(1)), F.col("shards")))
    none = F.lit(None).cast("long")

    def search(asking: DataFrame) -> DataFrame:
        stored = placed.select("width", "shard", F.lit(0).alias("kind"), "id", none.alias("floor"), "vector")
        both = stored.unionByName(asking.select("width", "shard", F.lit(1).alias("kind"), "id", "floor", "vector"))
        both = both.withColumn("cell", F.concat_ws("/", "width", "shard"))
        return _searched(both.repartition("cell").sortWithinPartitions("cell", "kind"), k)

    # One query for each id, also when its rows repeat.
    asks = placed.where("asks").groupBy("id", "width", "shard", "shards").agg(F.min("vector").alias("vector"))
    first = staged(search(asks.withColumn("floor", none)))
    floors = first.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor")
    )
    others = asks.join(floors, "id", "left").withColumn("home", F.col("shard")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    ).where("shard <> home")
    found = first.unionByName(search(others))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
