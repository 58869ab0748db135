"""Nearest neighbours by inner product: a vantage-point tree per shard.

Inner products become distances by one more coordinate: with M the largest norm,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = M^2 + |q|^2 - 2 q.x, so the
nearest by distance is the largest by product. Vectors are dealt to shards by a hash of
their id; each shard builds a tree: a vantage point, the others split at the median
distance from it, and each half knows its smallest and largest distance. By the triangle
inequality a half is at least as far from a query as its range is from the query's own
distance to the vantage point; the largest such bound on the way down counts. A node is left
out if its bound times ``factor`` exceeds the distance of the query's k-th best so far: factor 1
is exact search, more leaves out more. Every query first goes straight down to one small
subtree, so that its k-th best is near before anything else is looked at. Vantage points
are scored as they are met.

All queries meet every shard, in blocks: a task holds one shard and one block of queries,
whose sizes are parameters, and walks the tree with all of the block's queries at once.
Equal vectors of a shard are one point with their smallest ids. Scores are summed in
double precision over the original components in order; ties go to the smaller id.

Vectors that are null, empty, zero or hold null or non-finite components take no part;
vectors of different length are never compared. A repeated id counts once, with its
smallest vector; null ids take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch

LEAF = 16
FIRST = 64  # points, at least, that a query looks at before it leaves anything out
SHARD = 8192
BLOCK = 4096
UNITS = 1 << 16  # tasks, at most
SPARE = 8  # points kept beyond k, so that rounding in the search can't push one out
SLACK = 1e-7
ROW = "query_id bigint, vec_id bigint, score double"


class Tree:
    """Points in tree order. A node is (first, last, vantage, halves); a half is (node, least, most distance).

    Node ``first`` to ``last`` covers its halves and, in front of them, its vantage point.
    ``scored`` counts the products that searches have computed.
    """

    def __init__(self, points: np.ndarray, norm2: float):
        self.x = points
        rest = np.sqrt(np.maximum(norm2 - (points * points).sum(axis=1), 0))
        self.lifted = np.hstack([points, rest[:, None]])
        self.norm2 = norm2
        self.order = np.arange(len(points))
        self.root = self._build(0, len(points))
        self.scored = 0

    def _build(self, first: int, last: int):
        if last - first <= LEAF:
            return (first, last, None, ())
        own = self.order[first:last]
        # the point farthest from the first one: an edge point separates best
        from_first = ((self.lifted[own] - self.lifted[own[0]]) ** 2).sum(axis=1)
        vantage = own[int(from_first.argmax())]
        d = np.sqrt(((self.lifted[own] - self.lifted[vantage]) ** 2).sum(axis=1))
        d[own == vantage] = -1  # sorts to the front
        rank = np.argsort(d, kind="stable")
        self.order[first:last], d = own[rank], d[rank]
        mid = (1 + last - first) // 2
        halves = tuple((self._build(first + a, first + b), d[a], d[b - 1]) for a, b in ((1, mid), (mid, last - first)))
        return (first, last, vantage, halves)

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best points of each query by product: (points, products), unordered; point -1 where there are fewer."""
        n = len(queries)
        best = np.full((n, k), -np.inf)
        point = np.full((n, k), -1, dtype=np.int64)
        base = self.norm2 + (queries * queries).sum(axis=1)
        seen = np.full((n, 2), -1)  # the part of the order that a query has looked at first

        def score(q: np.ndarray, own: np.ndarray) -> np.ndarray:
            new = queries[q] @ self.x[own].T
            self.scored += new.size
            product = np.hstack([best[q], new])
            which = np.hstack([point[q], np.broadcast_to(own, (len(q), len(own)))])
            top = np.argpartition(-product, k - 1, axis=1)[:, :k]
            best[q] = np.take_along_axis(product, top, axis=1)
            point[q] = np.take_along_axis(which, top, axis=1)
            return new

        def bounds(q: np.ndarray, new: np.ndarray, halves) -> list[np.ndarray]:
            d = np.sqrt(np.maximum(base[q] - 2 * new, 0))
            return [np.maximum(np.maximum(least - d, d - most), 0) for _, least, most in halves]

        down = [(self.root, np.arange(n))]
        while down:
            (first, last, vantage, halves), q = down.pop()
            if vantage is None or last - first <= 2 * FIRST:
                score(q, self.order[first:last])
                seen[q] = first, last
                continue
            new = queries[q] @ self.x[vantage]
            self.scored += len(q)
            near, far = bounds(q, new, halves)
            for half, mine in zip(halves, (near <= far, near > far), strict=True):
                if mine.any():
                    down.append((half[0], q[mine]))
        stack = [(self.root, np.arange(n), np.zeros(n))]
        while stack:
            (first, last, vantage, halves), q, bound = stack.pop()
            # the bound was set when the node was put off; better points may have come since
            on = (bound * factor <= self._reach(best[q], base[q])) & ((seen[q, 0] > first) | (seen[q, 1] < last))
            q, bound = q[on], bound[on]
            if not len(q):
                continue
            if vantage is None:
                score(q, self.order[first:last])
                continue
            new = score(q, self.order[first : first + 1])[:, 0]
            near, far = bounds(q, new, halves)
            later = [(half[0], q, np.maximum(bound, own)) for half, own in zip(halves, (near, far), strict=True)]
            stack += later[::-1] if (near <= far).mean() >= 0.5 else later
        return point, best

    @staticmethod
    def _reach(best: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Distance of the worst point kept."""
        worst = best.min(axis=1)
        return np.where(np.isneginf(worst), np.inf, np.sqrt(np.maximum(base - 2 * np.where(np.isneginf(worst), 0, worst), 0))) + SLACK


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out = out + a[:, d] * b[:, d]
    return out


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(k: int, factor: float):
    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy().astype(bool)
        ids = table.column("vec_id").to_numpy()
        dim = table.column("dim")[0].as_py()
        all_rows = _matrix(table.column("v"), dim)
        norm2 = table.column("norm2")[0].as_py()
        queries, asked = all_rows[is_query], ids[is_query]
        points, owner = all_rows[~is_query], ids[~is_query]
        if not len(queries) or not len(points):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        by_id = np.argsort(owner, kind="stable")
        points, owner = points[by_id], owner[by_id]
        distinct, member = np.unique(points, axis=0, return_inverse=True)
        member = member.ravel()
        # a point's k + 1 smallest ids: no more can be among k results that leave out one's own
        grouped = np.argsort(member, kind="stable")
        nth = np.arange(len(member)) - np.searchsorted(member[grouped], member[grouped])
        grouped = grouped[nth <= k]
        start = np.searchsorted(member[grouped], np.arange(len(distinct) + 1))
        point, _ = Tree(distinct, norm2).search(queries, k + 1 + SPARE, factor)
        q, slot = np.nonzero(point >= 0)
        p = point[q, slot]
        score = products(queries[q], distinct[p])
        size = start[p + 1] - start[p]
        row = np.repeat(np.arange(len(p)), size)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        found = owner[grouped[start[p[row]] + inner]]
        q, score = q[row], score[row]
        other = found != asked[q]
        q, score, found = q[other], score[other], found[other]
        order = np.lexsort((found, -score, q))
        q, score, found = q[order], score[order], found[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        on = nth < k
        return pa.table({"query_id": pa.array(asked[q[on]], pa.int64()), "vec_id": pa.array(found[on], pa.int64()), "score": pa.array(score[on], pa.float64())})

    return run


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim): one vector per id, without those that take no part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.filter("vec_id is not null and v is not null").filter(fine).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    factor: float = 1.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_size: int = SHARD,
    block_size: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which ``is_query`` (a Column over vec_id) holds."""
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.save(usable(vectors, vec_id, vector).withColumn("asks", is_query), "vectors")
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    by_dim = rows.groupBy("dim").agg(
        F.max(norm2).alias("norm2"),
        F.ceil(F.count("*") / shard_size).cast("int").alias("shards"),
        F.greatest(F.ceil(F.count_if("asks") / block_size), F.lit(1)).cast("int").alias("blocks"),
    )
    sized = rows.join(by_dim, "dim")
    shard = F.pmod(F.xxhash64("vec_id"), "shards").cast("int")
    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    points = sized.select("dim", "norm2", "vec_id", "v", F.lit(False).alias("is_query"), shard.alias("shard"), every("blocks").alias("block"))
    queries = sized.filter("asks").select("dim", "norm2", "vec_id", "v", F.lit(True).alias("is_query"), every("shards").alias("shard"), block.alias("block"))
    units = by_dim.agg(F.sum(F.col("shards") * F.col("blocks"))).first()[0] or 1
    # a task for each unit: units are small in bytes but not in work, so they are not put together by size
    dealt = points.union(queries.select(points.columns)).repartition(min(units, UNITS), "dim", "shard", "block")
    found = dealt.groupBy("dim", "shard", "block").applyInArrow(_unit(k, factor), ROW)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
