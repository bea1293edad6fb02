import numpy as np
import pytest
from pyspark.sql import functions as F

from grainline.llm import mtree


def brute(rows, k=5, every=50):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ok.setdefault(i, []).append([int(np.floor(256 * float(x))) for x in v])
    out = []
    for q in sorted(ok):
        if q % every == 0:
            qv = min(ok[q])
            found = sorted((-int(np.dot(qv, c)), i) for i, vs in ok.items() if i != q for c in vs if len(c) == len(qv))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


@pytest.mark.parametrize("kind", ["clusters", "random", "equal", "ties"])
def test_tree_equals_brute_force(kind):
    rng = np.random.default_rng(3)
    n = 3000
    v = {"clusters": (rng.integers(0, 12, n)[:, None] * 97 % 211 * np.ones(8) + rng.normal(0, 4, (n, 8))), "random": rng.normal(0, 90, (n, 8)),
         "equal": np.ones((n, 8)) * 7, "ties": rng.integers(-2, 3, (n, 8))}[kind].astype(np.int64)
    ids = rng.permutation(n)
    tree = mtree.MTree(ids, v, float((v.astype(float) ** 2).sum(1).max()), page_rows=32, fanout=8)
    seen = 0
    for q in range(0, n, 150):
        got, compared = tree.search(v[q], int(ids[q]), 5)
        seen += compared
        want = sorted((-int(s), int(i)) for s, i in zip(v @ v[q], ids, strict=True) if i != ids[q])[:5]
        assert got == [(-s, i) for s, i in want]
    if kind == "clusters":
        assert seen < 0.7 * n * 20          # whole pages are ruled out


def test_search_on_given_vectors(spark, sf_small):
    from grainline.llm import queries
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = queries.op6_mtree_top5(spark, sf_small)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_shards_blocks_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 4).round(1).tolist()) for i in range(400)]
    rows += [(None, [1.0] * 4), (500, None), (501, []), (502, [1.0, None, 2.0, 3.0]), (503, [float("nan")] * 4), (504, [float("inf")] * 4),
             (550, [1.0, 2.0]), (551, [1.0, 2.0]), (50, [9.0, 9.0, 9.0, 9.0]), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = mtree.search(df, F.col("vec_id") % 50 == 0, shard_rows=60, query_rows=4)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert mtree.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = mtree.search(df.where("vec_id IN (0, 1, 2)"), F.col("vec_id") % 50 == 0)
    assert [r.rank for r in few.orderBy("rank").collect()] == [1, 2]


def test_very_large_components_are_limited(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [600_000.0, 3.0]), (50, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in mtree.search(df, F.col("vec_id") % 50 == 0, 5).collect()}
    most = mtree.LIMIT
    assert got[0, 2] == most * most + 256 * 768 and got[0, 1] == -most * most + 256 * 512 and got[50, 0] == 512 * most + 512 * 256
