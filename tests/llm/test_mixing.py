import random
import re

import pytest
from pyspark.sql import functions as F

from grainline.llm import mixing, queries


def water_fill(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """Targets by sharing what full sources leave, again and again."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + ([None] if None in sizes else [])
    w = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    target, left, open_ = {k: 0.0 for k in names}, share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(w[k] for k in open_)
        shares = {k: left * w[k] / total for k in open_}
        left = 0.0
        for k, s in shares.items():
            target[k] += s
            if target[k] > epochs * sizes[k]:
                left += target[k] - epochs * sizes[k]
                target[k] = float(epochs * sizes[k])
                open_.discard(k)
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    sources = ["hot"] * 60 + ["b"] * 3 + ["Z", "é", None, "empty"]
    rows = [(i, None if rng.random() < 0.02 else " ".join("w" * rng.randint(0, 4) for _ in range(rng.randint(0, 90))), rng.choice(sources), 1, "x")
            for i in range(1500)]
    rows = [(i, "" if s == "empty" else t, s, a, b) for i, t, s, a, b in rows]
    rows += [rows[3], rows[3], (None, "a b c", "hot", 1, "x"), (None, "a b c", "hot", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int, target string")
    return rows, df, mixing.mix(df).collect()


def test_targets_and_budgets(mixed):
    rows, _, got = mixed
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    want = water_fill(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r["size"] == count(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in want)


def test_reruns_and_other_partitions_agree(mixed, monkeypatch):
    _, df, got = mixed
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.taken)
    again = mixing.mix(df.repartition(7, "text")).collect()
    assert sorted(((key(r), r.taken) for r in again)) == sorted(((key(r), r.taken) for r in got))
    monkeypatch.setattr(mixing, "KEY_RANGES", 4)
    assert sorted(((key(r), r.taken) for r in mixing.mix(df).collect())) == sorted(((key(r), r.taken) for r in got))


def test_materialised_mix(mixed):
    _, df, got = mixed
    out = mixing.materialise(mixing.mix(df), ["doc_id", "text", "source"]).collect()
    words = {}
    for r in out:
        words[r.source] = words.get(r.source, 0) + len((r.text or "").split())
    target = {r.source: r.target for r in got}
    for s, t in target.items():
        assert abs(words.get(s, 0) - t) <= 90


def test_empty_table_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(df).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.materialise(mixing.mix(df), df.columns).count() == 0


def test_only_dataframe_operations(spark, sf_small):
    plan = queries.op5_mixing(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_query_equals_sql(spark, duck_small):
    import os
    from grainline import testing
    sf = "/root/testdata/sf0.01"
    con = testing.duck(sf)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    ok, msg = testing.compare(queries.op5_mixing(spark, sf), con, mixing.MIX_SQL)
    assert ok and os.path.isdir(sf), msg
    assert queries.op5_mixing(spark, sf).select(F.sum("taken")).first()[0] > 0
