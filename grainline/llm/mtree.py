"""Exact top-k by inner product: best-first search in M-trees.

Inner products become a metric by one more coordinate: with M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and
q' = (q, 0) have |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so nearest is largest. A tree's nodes are pages: routing objects with
covering radius and the distance to their parent's routing object; leaf pages keep each member's distance to the page's
object. A search expands the page with the least possible distance first. The triangle inequality over stored distances
rules out pages and members before any distance to them is computed: |d(q, parent) - d(parent, x)| <= d(q, x).
Bounds are floating point with some slack; scores are integer products, so results and ties are exact.

On Spark: vectors are dealt by hash into shards of about SHARD_ROWS, each shard's tree is built once and written to the
shared folder, and every block of queries meets every tree; a query's best of all trees are its result. The number of
trees grows with the table, each task's memory does not. Equal vectors, however many, spread over all shards.

Defined results. Vectors that are null or empty, or hold null or non-finite components, and rows without an id take no part.
Scaled components are
limited to +-LIMIT, so that inner products of up to 512 components fit in 64 bits. Vectors of different lengths are not compared. A repeated id: one query (its least vector); as candidates, rows with the
query's id are its own, other repeated rows count each. Fewer than k candidates: all. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

SHARD_ROWS = 8192
LIMIT = 1 << 27
QUERY_ROWS = 4096
PAGE_ROWS, FANOUT = 256, 16


class MTree:
    """Nodes in flat arrays. A node's children (or a leaf's members) are a range; routing objects are rows of ``points``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, page_rows: int = PAGE_ROWS, fanout: int = FANOUT, seed: int = 0):
        norms = (vectors.astype(float) ** 2).sum(1)
        points = np.column_stack([vectors, np.sqrt(np.maximum(largest - norms, 0))]).astype(float)
        rng = np.random.default_rng(seed)
        order, centre, radius, to_parent, first, last, leaf = [], [], [], [], [], [], []
        member_distance = np.zeros(len(ids))

        def new(rows: np.ndarray, parent: np.ndarray | None) -> int:
            c = points[rows].mean(0)
            c = points[rows[int(np.argmin(((points[rows] - c) ** 2).sum(1)))]]      # the routing object is a member
            centre.append(c)
            radius.append(0.0)
            to_parent.append(0.0 if parent is None else float(np.sqrt(((c - parent) ** 2).sum())))
            for column in (first, last, leaf):
                column.append(0)
            return len(centre) - 1

        root = new(np.arange(len(ids)), None)
        todo = [(root, np.arange(len(ids)))]
        while todo:
            node, rows = todo.pop(0)
            d = np.sqrt(((points[rows] - centre[node]) ** 2).sum(1))
            radius[node] = float(d.max())
            if len(rows) <= page_rows:
                first[node], last[node], leaf[node] = len(order), len(order) + len(rows), 1
                member_distance[len(order):len(order) + len(rows)] = d
                order += rows.tolist()
                continue
            ways = min(fanout, -(-len(rows) // page_rows) + 1)
            pick = points[rng.choice(rows, ways, replace=False)]
            near = ((points[rows] ** 2).sum(1)[:, None] + (pick ** 2).sum(1) - 2 * points[rows] @ pick.T).argmin(1)
            parts = [rows[near == k] for k in range(ways) if (near == k).any()]
            if len(parts) == 1:                                                     # equal points: by position
                parts = np.array_split(rows, ways)
            first[node] = len(centre)
            for part in parts:
                todo.append((new(part, centre[node]), part))
            last[node] = len(centre)
        order = np.array(order, np.int64)
        self.ids, self.vectors, self.member_distance = ids[order], vectors[order], member_distance
        self.centre, self.radius, self.to_parent = np.array(centre), np.array(radius), np.array(to_parent)
        self.first, self.last, self.leaf = np.array(first), np.array(last), np.array(leaf, bool)
        self.largest = largest

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[list[tuple[int, int]], int]:
        """(score, id) of the k best by score, then smaller id; and how many members were compared."""
        q = np.append(query.astype(float), 0.0)
        norm = float((q ** 2).sum())
        slack = 1e-7 * (1 + norm + self.largest) ** 0.5
        best: list[tuple[int, int]] = []                                            # a heap of (score, -id)
        reach, compared = np.inf, 0
        d_root = float(np.sqrt(((self.centre[0] - q) ** 2).sum()))
        pages = [(max(d_root - self.radius[0], 0.0), 0, d_root)]
        while pages:
            low, node, d = heapq.heappop(pages)
            if low > reach:
                break
            i, j = self.first[node], self.last[node]
            if self.leaf[node]:
                near = i + np.flatnonzero(np.abs(d - self.member_distance[i:j]) <= reach)
                compared += len(near)
                score, ids = self.vectors[near] @ query, self.ids[near]
                if len(best) == k:
                    may = score >= best[0][0]
                    score, ids = score[may], ids[may]
                if len(score) > k:
                    may = score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    score, ids = score[may], ids[may]
                for s, x in sorted(zip(score.tolist(), ids.tolist(), strict=True), key=lambda e: (-e[0], e[1])):
                    if x == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -x))
                    elif (s, -x) > best[0]:
                        heapq.heapreplace(best, (s, -x))
                    else:
                        break
                if len(best) == k:
                    reach = max(norm + self.largest - 2.0 * best[0][0], 0.0) ** 0.5 + slack
                continue
            may = i + np.flatnonzero(np.abs(d - self.to_parent[i:j]) - self.radius[i:j] <= reach)
            there = np.sqrt(((self.centre[may] - q) ** 2).sum(1))
            for n, x in zip(may.tolist(), there.tolist(), strict=True):
                if x - self.radius[n] <= reach:
                    heapq.heappush(pages, (max(x - self.radius[n], 0.0), n, x))
        return sorted(((s, -x) for s, x in best), key=lambda e: (-e[0], e[1])), compared


def usable(table: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (array of long: floor(scale * component)), n (length), of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    t = table.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(whole)
    return t.select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale).cast("long")))).alias("v"),
                    F.size("embedding").alias("n"))


def _rows(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)


def search(table: DataFrame, is_query, k: int = 5, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``table``: vec_id, embedding. Best k of all other rows for the rows where ``is_query`` (a column of vec_id) holds:
    query_id, rank, vec_id, score."""
    t = usable(table)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = t.agg(F.count("*").alias("n"), F.max(norm).alias("largest"), F.sum(is_query.cast("int")).alias("q")).first()
    largest = float(size.largest or 0.0)
    shards, blocks = max(1, -(-size.n // shard_rows)), max(1, -(-(size.q or 0) // query_rows))

    def build(part: pa.Table) -> pa.Table:
        n = part.column("n")[0].as_py()
        tree = MTree(part.column("vec_id").to_numpy(), _rows(part.column("v"), n), largest)
        return pa.table({"shard": [part.column("shard")[0].as_py()], "n": pa.array([n], pa.int32()), "tree": [pickle.dumps(tree)]},
                        schema=pa.schema([("shard", pa.int64()), ("n", pa.int32()), ("tree", pa.binary())]))

    dealt = t.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.col("v")), F.lit(shards)))
    trees = written(dealt.groupBy("shard", "n").applyInArrow(build, "shard long, n int, tree binary"), "mtrees")
    queries = t.where(is_query).groupBy("vec_id", "n").agg(F.min("v").alias("v")).groupBy("vec_id").agg(F.min(F.struct("n", "v")).alias("x"))
    queries = queries.select("vec_id", "x.n", "x.v", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    # each block of queries meets each tree
    left = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def answer(tree: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if tree.num_rows and asked.num_rows:
            index = pickle.loads(tree.column("tree")[0].as_py())
            for own, v in zip(asked.column("vec_id").to_pylist(), _rows(asked.column("v"), asked.column("n")[0].as_py()), strict=True):
                out += [(own, x, s) for s, x in index.search(v, own, k)[0]]
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    found = left.groupBy("shard", "block", "n").cogroup(right.groupBy("shard", "block", "n")).applyInArrow(
        answer, "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same rows by brute force in DuckDB SQL.
TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
