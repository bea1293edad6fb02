"""Key discovery, distinct counts, frequent groups and join-size sketches against plain counting."""
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainline import catalog
from grainline.operators import joins, keys, profile


def brute_keys(rows, cols, most):
    unique = [c for n in range(1, most + 1) for c in combinations(range(len(cols)), n) if len({tuple(r[i] for i in c) for r in rows}) == len(rows)]
    return sorted(tuple(cols[i] for i in c) for c in unique if not any(set(d) < set(c) for d in unique))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("sample", [3, 1000])
def test_minimal_keys_equal_brute_force(spark, seed, sample):
    rng = np.random.default_rng(seed)
    cols = ["a", "b", "c", "d", "e"]
    wide = rng.integers(2, 9, len(cols))
    rows = sorted({tuple(None if v == 0 else int(v) for v in rng.integers(0, wide)) for _ in range(40)}, key=str)
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in cols))
    found, checked = keys.minimal_keys(df, cols, 4, sample)
    assert sorted(found) == brute_keys(rows, cols, 4)
    if sample == 1000:
        assert checked == len(found)                    # the sample is the whole table: only keys are left to prove


def test_keys_of_odd_tables(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", None)], "a int, b string, c int")
    assert keys.minimal_keys(df)[0] == []                               # a repeated row: no key
    assert keys.minimal_keys(df.limit(1))[0] == [("a",), ("b",), ("c",)]
    assert keys.minimal_keys(df.limit(0))[0] == [("a",), ("b",), ("c",)]
    two = spark.createDataFrame([(None, 1), (None, 2)], "a int, b int")
    assert keys.minimal_keys(two)[0] == [("b",)]                        # nulls agree


def test_sample_settles_most_sets(spark, sf_small):
    t0a = catalog.Src(spark, sf_small).t0a
    found, checked = keys.minimal_keys(t0a, catalog.T0A_KEY_COLUMNS, 4, 2000)
    assert found == [("row_key",)] and checked < 12                     # of 162 sets


def test_distinct_counts_do_not_multiply_rows(spark, sf_small):
    s = catalog.Src(spark, sf_small)
    for df in (catalog.q_distinct_counts_wide(spark, sf_small), catalog.q_grain_report(spark, sf_small), profile.value_inventory(s.t0a, ["age", "tobacco"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "Generate explode(array" not in plan
    rows = [(None, -40_000, 1 << 40, "x"), (5, 40_000, 3, None), (5, -40_000, 3, "x"), (70_000, None, -(1 << 50), "y")]
    df = spark.createDataFrame(rows, "a int, b bigint, c bigint, d string")
    assert tuple(profile.distinct_counts(df, ["a", "b", "c", "d"]).first()) == (2, 2, 3, 2)
    assert tuple(profile.distinct_counts(df.limit(0), ["a", "d"]).first()) == (0, 0)
    assert profile._narrow(df, ["a", "b", "c", "d"]) == {"a": (5, 3), "b": (-40_000, 3)}


def test_frequent_groups_are_proved_or_counted_in_full(spark):
    hot = spark.range(60_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 6).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    top, proved = profile.frequent_groups(hot, ["k", "v"], 3, tracked=1024)
    assert proved and top.collect() == profile.grain_top(hot, ["k", "v"], 3).collect()
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert " IN (" in plan or "INSET" in plan.upper()                   # only the proposals are grouped
    for frame, n in ((hot, 4), (spark.range(500).select((F.col("id") % 100).alias("k"), F.lit("x").alias("v")), 7), (hot.limit(0), 2)):
        top, proved = profile.frequent_groups(frame, ["k", "v"], n, tracked=1024)
        assert not proved and top.collect() == profile.grain_top(frame, ["k", "v"], n).collect()


@pytest.mark.parametrize("kind", ["uniform", "hot", "disjoint"])
def test_join_size_estimates_keep_their_bound(spark, kind):
    rng = np.random.default_rng(3)
    n = 40_000
    a, b = rng.integers(0, 20_000, n), rng.integers(0, 20_000, n)
    if kind == "hot":
        a[: n // 3], b[: n // 5] = 7, 7
    if kind == "disjoint":
        b += 1 << 32
    left = spark.createDataFrame([(int(x),) for x in a] + [(None,)], "k bigint")
    right = spark.createDataFrame([(str(x),) for x in b] + [(None,)], "q string")       # another type: compared as text
    exact = sum(int((a == k).sum()) * int((b == k).sum()) for k in np.intersect1d(a, b)) if kind != "uniform" else int((np.bincount(a, minlength=20_000) * np.bincount(b, minlength=20_000)).sum())
    got = joins.estimate_size(left, right, [("k", "q")]).first()
    assert abs(got.estimated_rows - exact) <= got.error_bound
    assert got.error_bound < max(0.1 * exact, 4_000)
    assert tuple(joins.estimate_size(left.limit(0), right, [("k", "q")]).first()) == (0, 0)


@pytest.mark.parametrize("few", [1, 1000])
def test_repeats_are_found_in_a_slice_or_by_hash(spark, monkeypatch, few):
    """Few repeated keys, in whatever slice; nulls agree; different keys are no repeat."""
    monkeypatch.setattr(keys, "FEW", few)
    rows = [(i, f"p{i % 50}", None if i % 7 == 0 else i // 2) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b string, c long")
    assert keys._twice(df, ["a", "b"]) == []
    for i in (1, 7, 200):
        again = df.union(spark.createDataFrame([rows[i]], df.schema))
        found = keys._twice(again, ["a", "b", "c"])
        assert [(r.a, r.b, r.c) for r in found] == [rows[i]]
        one, other = keys._pair(again, again.columns, ["a", "b", "c"])
        assert tuple(one) == tuple(other) == rows[i]
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert len(keys._twice(zeros, ["x"])) == 1
