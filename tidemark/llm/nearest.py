"""Exact top-k by inner product with two cover trees.

Queries and candidates are dealt into blocks, and every block of queries meets every block of candidates in
one task, which indexes both: a cover tree keeps, at each node, a centre and the radius that covers all vectors below it.
A pair of nodes can hold no inner product above <a, b> + |a|s + |b|r + rs for centres a, b and radii r, s. A pair whose bound
is below the worst k-th score found so far in its group of queries is cut off; the rest are split, the most
promising first, down to leaves, whose scores are counted out. The best k of each block are merged for each query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import partitions, reach

TOP = 5
SCALE = 256
#: Queries and candidates of a block, about.
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
#: Vectors of a leaf, and children of a node, at most.
LEAF, CHILDREN = 64, 16


class CoverTree:
    """Nodes over some vectors: centre, covering radius, range in `order`, children. Radii shrink from level to level."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.order = vectors, np.arange(len(vectors))
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        waiting = [(0, len(vectors), -1)] if len(vectors) else []
        while waiting:
            lo, hi, parent = waiting.pop()
            own = self.vectors[self.order[lo:hi]]
            centre = own.mean(axis=0)
            centre = own[int(np.argmin(((own - centre) ** 2).sum(axis=1)))]
            far = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.centre)
            self.centre.append(centre)
            self.radius.append(float(far.max()) * (1 + 1e-12))
            self.range.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo > LEAF and self.radius[node] > 0:
                groups = self._cover(own, self.radius[node] / 2)
                self.order[lo:hi] = self.order[lo:hi][np.concatenate(groups)]
                for g in groups:
                    waiting.append((lo, lo + len(g), node))
                    lo += len(g)

    def _cover(self, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """Groups of the vectors nearest to centres of their own, each centre the vector farthest from those before.

        There are as many as it takes to cover all within `radius`, at most `CHILDREN`: vectors that lie far apart in many
        directions shrink less from level to level, but every node is split down to leaves.
        """
        away, nearest = np.full(len(own), np.inf), np.zeros(len(own), np.int64)
        centre = 0
        for k in range(CHILDREN):
            now = ((own - own[centre]) ** 2).sum(axis=1)
            closer = now < away
            away[closer], nearest[closer] = now[closer], k
            centre = int(away.argmax())
            if away[centre] <= radius**2 and k:
                break
        return [g for g in (np.flatnonzero(nearest == i) for i in range(k + 1)) if len(g)]


def top_k(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `k` highest scores with their ids (ties to smaller ids), by a dual-tree search.

    Rows of whole numbers in; a query's own id is no candidate. Missing places have id -1 and score -2**62.
    """
    low = -(1 << 62)
    best, named = np.full((len(queries), k), low, np.int64), np.full((len(queries), k), -1, np.int64)
    if not len(queries) or not len(vectors):
        return best, named
    exact = max(np.abs(queries).max(), 1) * max(np.abs(vectors).max(), 1) * queries.shape[1] < 2**52
    left, right = (x.astype(float) if exact else x for x in (queries, vectors))
    a, b = CoverTree(queries.astype(float)), CoverTree(vectors.astype(float))
    size_a, size_b = ([float(np.linalg.norm(c)) for c in t.centre] for t in (a, b))

    def bound(i: int, j: int) -> float:
        r, s = a.radius[i], b.radius[j]
        top = float(a.centre[i] @ b.centre[j]) + size_a[i] * s + size_b[j] * r + r * s
        return top + 1e-9 * abs(top) + 1e-6

    def worst(i: int) -> int:
        lo, hi = a.range[i]
        return int(best[a.order[lo:hi], -1].min())

    heap = [(-bound(0, 0), 0, 0)]
    while heap:
        top, i, j = heapq.heappop(heap)
        if -top < worst(i):
            continue
        if a.children[i] or b.children[j]:
            split = bool(a.children[i]) and (not b.children[j] or a.radius[i] >= b.radius[j])
            pairs = [(c, j) for c in a.children[i]] if split else [(i, c) for c in b.children[j]]
            for pair in pairs:
                if (limit := bound(*pair)) >= worst(pair[0]):
                    heapq.heappush(heap, (-limit, *pair))
            continue
        mine, theirs = a.order[slice(*a.range[i])], b.order[slice(*b.range[j])]
        for at in range(0, len(theirs), 4096):
            some = theirs[at : at + 4096]
            scores = (left[mine] @ right[some].T).astype(np.int64)
            scores[query_ids[mine][:, None] == ids[some][None, :]] = low
            _merge(best, named, mine, scores, ids[some], k)
    return best, named


def _merge(best: np.ndarray, named: np.ndarray, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Put new scores among the best of some queries."""
    low = -(1 << 62)
    open_ = np.flatnonzero(scores.max(axis=1) >= best[rows, -1])
    for q in open_:
        row = rows[q]
        new = np.flatnonzero((scores[q] >= best[row, -1]) & (scores[q] > low))
        s, n = np.append(best[row], scores[q, new]), np.append(named[row], ids[new])
        order = np.lexsort((n, -s))[:k]
        best[row], named[row] = s[order], n[order]


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers; a shorter vector ends in zeros."""
    lists = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    place = np.arange(len(lists)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = lists
    return out


def _searcher(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        column = lambda t: t.column("_x").combine_chunks()
        names = lambda t: t.column("vec_id").to_numpy()
        found = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            x, y = _matrix(column(queries)), _matrix(column(candidates))
            width = max(x.shape[1], y.shape[1])
            x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
            best, named = top_k(x, names(queries), y, names(candidates), k)
            row, place = np.nonzero(named >= 0) if (names(candidates) >= 0).all() else np.nonzero(best > -(1 << 62))
            found = {"query_id": names(queries)[row], "vec_id": named[row, place], "score": best[row, place]}
        return pa.table({c: pa.array(v, pa.int64()) for c, v in found.items()})

    return run


def scaled(embeddings: DataFrame) -> DataFrame:
    """(vec_id, _x): vectors as floor(256 x); those missing, without an id, or with a missing or non-finite part are left out."""
    whole = "embedding is not null and vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding").where(whole)
    return rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("_x"))


def nearest(embeddings: DataFrame, is_query: str, k: int = TOP) -> DataFrame:
    """The `k` highest inner products of each query row with all other rows: query_id, rank (from 1), vec_id, score.

    `is_query` is a condition on vec_id. Ties go to the smaller vec_id; with fewer candidates there are fewer rows. Equal rows count
    once; different vectors with one id count as one candidate or query of several places, never as its own candidate.
    Vectors of unequal length end in zeros. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    reach(spark)
    vectors = scaled(embeddings).distinct()
    asked = vectors.where(is_query)
    many, total = asked.count(), vectors.count()
    q_blocks = max(1, math.ceil(many / QUERY_BLOCK))
    c_blocks = max(1, math.ceil(total / CANDIDATE_BLOCK), min(partitions(spark) // q_blocks, math.ceil(total / 2048)))
    # each block meets every other: a query block is sent to every candidate block and the other way round
    q = asked.withColumn("_q", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_blocks)))
    c = vectors.withColumn("_c", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(c_blocks)))
    q = q.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
    c = c.withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    met = q.groupBy("_q", "_c").cogroup(c.groupBy("_q", "_c")).applyInArrow(_searcher(k), "query_id long, vec_id long, score long")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
