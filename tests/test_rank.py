from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from grainline.operators import rank

DDL = "g string, metal string, rate decimal(12,2), id int"


def _frame(spark, rows):
    return spark.createDataFrame([(g, m, None if r is None else Decimal(r), i)
                                  for i, (g, m, r) in enumerate(rows)], DDL)


def _window_flags(df):
    w = Window.partitionBy("g").orderBy(F.col("rate").asc_nulls_last())
    return (df.withColumn("w_min", F.min("rate").over(Window.partitionBy("g")))
            .withColumn("w_is_min", F.when(F.rank().over(w) == 1, 1).otherwise(0))
            .withColumn("w_slcsp", F.when((F.rank().over(w) == 2) & (F.col("metal") == "Silver"), 1)
                        .otherwise(0))
            .withColumn("w_dense", F.when((F.dense_rank().over(w) == 2)
                                          & (F.col("metal") == "Silver"), 1).otherwise(0)))


def _agg_flags(df):
    t = rank.with_group_min(df, ["g"], "rate", "a_min")
    t = rank.flag_rank(t, ["g"], "rate", 1, "a_is_min")
    silver = F.col("metal") == "Silver"
    t = rank.flag_rank(t, ["g"], "rate", 2, "a_slcsp", method="rank", where=silver)
    return rank.flag_rank(t, ["g"], "rate", 2, "a_dense", method="dense_rank", where=silver)


def _compare(spark, rows):
    df = _frame(spark, rows)
    a = {r.id: r for r in _agg_flags(df).collect()}
    w = {r.id: r for r in _window_flags(df).collect()}
    assert a.keys() == w.keys()
    for i in a:
        assert a[i].a_min == w[i].w_min, (i, rows)
        assert a[i].a_is_min == w[i].w_is_min, (i, rows)
        assert a[i].a_slcsp == w[i].w_slcsp, (i, rows)
        assert a[i].a_dense == w[i].w_dense, (i, rows)


def test_tie_at_minimum_has_no_rank_two(spark):
    rows = [("a", "Silver", "100"), ("a", "Silver", "100"), ("a", "Silver", "200")]
    out = {r.id: r for r in _agg_flags(_frame(spark, rows)).collect()}
    assert [out[i].a_is_min for i in range(3)] == [1, 1, 0]
    assert [out[i].a_slcsp for i in range(3)] == [0, 0, 0]      # rank jumps 1, 1, 3
    assert [out[i].a_dense for i in range(3)] == [0, 0, 1]


def test_null_rate_never_wins_and_single_value_group(spark):
    rows = [("a", "Silver", None), ("a", "Silver", "50"),     # NULL ranks after 50: rank 2
            ("b", "Silver", None), ("b", "Silver", None),     # all NULL: all rank 1
            ("c", None, "10")]                                 # NULL group key is a group
    _compare(spark, rows)
    out = {r.id: r for r in _agg_flags(_frame(spark, rows)).collect()}
    assert out[0].a_is_min == 0 and out[1].a_is_min == 1 and out[0].a_slcsp == 1
    assert out[2].a_is_min == 1 and out[3].a_is_min == 1


rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["Silver", "Gold"]),
              st.one_of(st.none(), st.sampled_from(["100", "150", "200", "250"]))),
    min_size=1, max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st)
def test_aggregate_strategy_equals_window(spark, rows):
    _compare(spark, rows)


def test_nth_row_matches_row_number(spark):
    rows = [("a", "Silver", "100"), ("a", "Silver", "100"), ("a", "Gold", "90"),
            ("a", "Gold", None), ("b", "Gold", None), ("b", "Gold", "5")]
    df = _frame(spark, rows)
    w = Window.partitionBy("g").orderBy(F.col("rate").asc_nulls_last(), F.col("id").asc())
    for n in (1, 2, 3):
        want = {(r.g, r.id) for r in df.withColumn("rn", F.row_number().over(w))
                .where(F.col("rn") == n).collect()}
        got = {(r.g, r.id) for r in rank.nth_row(df, ["g"], ["rate", "id"], n, ["id"]).collect()}
        assert got == want, n


def test_window_group_limit_planned_for_nth_row(spark):
    df = _frame(spark, [("a", "Silver", "1")])
    for n in (2, 3):
        plan = rank.nth_row(df, ["g"], ["rate", "id"], n, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Join" not in plan


def _rn_frame(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        g = "hot" if i % 3 else rnd.choice(["a", "b", None])
        r = None if i % 17 == 0 else Decimal(rnd.choice([100, 150, 150, 200, 250]))
        rows.append((g, "Silver", r, i))
    return spark.createDataFrame(rows, DDL)


def _plain_numbers(df, keys):
    w = Window.partitionBy(*keys).orderBy(F.col("rate").asc_nulls_last(), F.col("id").asc_nulls_last())
    return {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}


def test_split_row_numbers_equal_windows(spark):
    df = _rn_frame(spark)
    # no cut, a few cells, a cell a row; from the whole table and from a sample
    for cell_rows, sample in ((10_000, 10_000), (60, 10_000), (7, 10_000), (1, 10_000), (40, 200)):
        out = rank.split_row_numbers(df, {"rn": ["g"], "fine": ["g", "metal"], "by_rate": ["g", "rate"]}, ["rate", "id"], cell_rows, sample).collect()
        assert len(out) == 400
        assert {r.id: r.rn for r in out} == _plain_numbers(df, ["g"])
        assert {r.id: r.fine for r in out} == _plain_numbers(df, ["g", "metal"])
        assert {r.id: r.by_rate for r in out} == _plain_numbers(df, ["g", "rate"])
    empty = rank.split_row_numbers(df.limit(0), {"rn": ["g"]}, ["rate", "id"], 1)
    assert empty.count() == 0 and "rn" in empty.columns
    with pytest.raises(ValueError):
        rank.split_row_numbers(df, {"rn": ["g", "metal"], "coarse": ["g"]}, ["rate", "id"])


@pytest.mark.parametrize("most_sample", [100_000, 4_000])
def test_a_hot_group_at_one_rate_spreads_over_many_cells(spark, most_sample):
    n = 30_000                                                  # a third of the rows in one group, all at one rate
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 100)).alias("g"),
                               F.lit("Silver").alias("metal"), F.lit(Decimal(5)).cast("decimal(12,2)").alias("rate"), F.col("id"))
    cuts = {r.g: len(r["__cuts"]) for r in rank.learn_splitters(df, ["g"], ["rate", "id"], 500, most_sample).collect()}
    assert set(cuts) == {"hot"} and cuts["hot"] >= 8
    out = rank.split_row_numbers(df, {"rn": ["g"]}, ["rate", "id"], 500, most_sample)
    assert out.where(F.col("rn") != F.when(F.col("g") == "hot", F.floor(F.col("id") / 3) + 1).otherwise(F.col("rn"))).count() == 0
    assert out.groupBy("g").agg((F.max("rn") - F.count("*")).alias("d"), F.count_distinct("rn").alias("k"), F.count("*").alias("n")).where("d <> 0 OR k <> n").count() == 0
    # every window over rows is inside a cell, and the largest cell holds a small part of the group
    windows = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in line]
    assert windows and all("__cell" in line for line in windows)
    cut = rank.learn_splitters(df, ["g"], ["rate", "id"], 500, most_sample)
    cells = df.join(cut, "g").withColumn("c", rank._cell(F.col("__cuts"), rank.order_struct(["rate", "id"], ()), cuts["hot"]))
    assert cells.groupBy("c").count().agg(F.max("count")).first()[0] < n / 3 / 4


def test_rank_by_counts_equals_windows(spark):
    df = _rn_frame(spark)
    w = Window.partitionBy("g").orderBy(F.col("rate").asc_nulls_last())
    want = {r.id: (r.a, r.b) for r in df.withColumn("a", F.rank().over(w)).withColumn("b", F.dense_rank().over(w)).collect()}
    got = {r.id: (r.a, r.b) for r in rank.rank_by_counts(df, ["g"], "rate", "a", "b").collect()}
    assert got == want


def test_rank_flags_equal_separate_flags(spark):
    df = _rn_frame(spark)
    silver = F.col("metal") == "Silver"
    one = {r.id: (r.m, r.f1, r.f2) for r in rank.rank_flags(
        df, ["g"], "rate", "m", [("f1", 1, "rank", None), ("f2", 2, "dense_rank", silver)]).collect()}
    t = rank.with_group_min(df, ["g"], "rate", "m")
    t = rank.flag_rank(t, ["g"], "rate", 1, "f1")
    t = rank.flag_rank(t, ["g"], "rate", 2, "f2", method="dense_rank", where=silver)
    sep = {r.id: (r.m, r.f1, r.f2) for r in t.collect()}
    assert one == sep


def test_bounded_groups_broadcast_the_statistics(spark):
    df = _rn_frame(spark)
    t = rank.rank_flags(df, ["g"], "rate", "m", [("f", 1, "rank", None)], groups_bounded=True)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan
    # only the two statistics aggregations shuffle; the rows join back by broadcast
    assert plan.count("Exchange hashpartitioning") == 2
    u = rank.rank_flags(df, ["g"], "rate", "m", [("f", 1, "rank", None)])
    assert {r.id: r.f for r in t.collect()} == {r.id: r.f for r in u.collect()}


def _splits(spark, df, cell_rows):
    """The plan of split row numbers, when no side may be broadcast for its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = rank.split_row_numbers(df, {"rn": ["g"], "fine": ["g", "metal"]}, ["rate", "id"], cell_rows)
        return out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_split_rows_are_not_joined_after_their_windows(spark):
    plan = _splits(spark, _rn_frame(spark), 7)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == plan.count("BroadcastExchange")


def test_no_rows_are_sampled_if_no_group_is_large(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") % 50).alias("g"), F.lit("Silver").alias("metal"), F.lit(1).alias("rate"), F.col("id"))
    monkeypatch.setattr(rank, "order_struct", None)             # the sample's
    assert rank.learn_splitters(df, ["g"], ["rate", "id"], 8) is None


@pytest.mark.parametrize("n", [0, 5, 16, 17, 300])
def test_cells_count_the_cuts_at_or_below(spark, n):
    cuts = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.struct((i * 10).cast("bigint").alias("x")))
    df = spark.range(-15, n * 10 + 25, 5).withColumn("c", rank._cell(cuts, F.struct(F.col("id").alias("x")), n + 1))
    for r in df.collect():
        assert r.c == sum(i * 10 <= r.id for i in range(n + 1))
    assert spark.range(1).select(rank._cell(F.lit(None).cast("array<struct<x:bigint>>"), F.struct(F.col("id").alias("x")), n + 1)).first()[0] == 0
