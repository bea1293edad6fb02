import pytest
from pyspark.sql import functions as F

from grainline.operators import joins


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, lv string")
    right = spark.createDataFrame(
        [(1, "x"), (1, "y"), (1, "z"), (2, None), (4, "w"), (None, "n")], "k int, rv string")
    return left, right


def test_empty_on_is_refused(sides):
    left, right = sides
    with pytest.raises(ValueError):
        joins.join(left, right, [])


def test_audit_matches_real_join(sides):
    left, right = sides
    a = joins.audit(left, right, ["k"]).collect()[0]
    real = left.join(right, "k").count()
    assert a.joined_rows == real == 7
    assert a.left_rows == 5 and a.right_rows == 6
    assert a.left_unmatched == 2          # k=3 and the NULL key
    assert a.right_unmatched == 2         # k=4 and the NULL key
    assert a.max_right_dups == 3
    assert a.fanout == pytest.approx(7 / 5)


def test_audit_steps_equal_filtered_counts(sides):
    left, right = sides
    steps = [("all", None, None),
             ("lv_not_a", F.col("lv") != "a", None),
             ("rv_present", None, F.col("rv").isNotNull())]
    got = {r.step: r.joined_rows for r in
           joins.audit_steps(left, right, ["k"], steps).collect()}
    j = left.join(right, "k")
    assert got["all"] == j.count()
    assert got["lv_not_a"] == j.where(F.col("lv") != "a").count()
    assert got["rv_present"] == j.where((F.col("lv") != "a") & F.col("rv").isNotNull()).count()
    assert got["all"] >= got["lv_not_a"] >= got["rv_present"]


def test_key_overlap(spark):
    a = spark.createDataFrame([("001",), ("002",), ("3",)], "k string")
    b = spark.createDataFrame([("001",), ("004",)], "k string")
    r = joins.key_overlap(a, "k", b, "k").collect()[0]
    assert (r.a_keys, r.b_keys, r.a_only, r.b_only, r.both) == (3, 2, 2, 1, 1)
    assert (r.a_min_len, r.a_max_len) == (1, 3)


def test_unmatched_keeps_matched_nulls(sides):
    left, right = sides
    un = joins.unmatched(left, right, ["k"], "rv")
    # k=2 matched a NULL value, k=3 and NULL key matched nothing
    assert sorted(r.lv for r in un.collect()) == ["c", "d", "e"]
    anti = joins.anti(left, right, ["k"])
    assert sorted(r.lv for r in anti.collect()) == ["d", "e"]


def test_lookup_broadcast_only_when_bounded(sides):
    left, right = sides
    plan = joins.left_lookup(left, right, ["k"], bounded=True)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Broadcast" in plan


def test_skew_join_equals_plain_join(spark):
    big = spark.range(3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50))
                                   .alias("k"), F.col("id").alias("v"))
    big = big.union(spark.range(40).select(F.lit(None).cast("long"), F.col("id")))      # NULL keys are spread too
    small = spark.createDataFrame([(7, "hot"), (7, "hot2"), (1, "one"), (99, "none"), (None, "null")],
                                  "k bigint, name string")
    for how in ("inner", "left"):
        want = joins.join(big, small, ["k"], how)
        got = joins.skew_join(big, small, ["k"], how, buckets=8)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert got.count() == want.count()


def test_only_hot_keys_are_salted(spark):
    n = 20_000
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") + 100).alias("k"),
                                (F.col("id") % 5).alias("v"))
    small = spark.range(6_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = joins.heavy_hitters(big, ["k"])
    assert len(hot) == 2                                        # key 7 and NULL, a third of the rows each
    for how in ("inner", "left"):
        want, got = joins.join(big, small, ["k"], how), joins.skew_join(big, small, ["k"], how, buckets=16)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and got.count() == want.count()
    # the small side grows by its rows with a hot key only, not by the number of salts
    got = joins.skew_join(big, small, ["k"], buckets=16, hot=hot)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        loads = {r.p: r.n for r in joins.skew_join(big, small, ["k"], buckets=16, hot=hot).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
        plain = {r.p: r.n for r in joins.join(big, small, ["k"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "__salt" in plan
    # one task held all joined rows of the hot key; now no task holds half of them
    assert max(plain.values()) >= n // 3 and max(loads.values()) < n // 6
    none = spark.range(1000).select(F.col("id").alias("k"))
    assert joins.heavy_hitters(none, ["k"]) == [] and "__salt" not in joins.skew_join(none, small, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert joins.heavy_hitters(none.limit(0), ["k"]) == []
    with pytest.raises(ValueError):
        joins.skew_join(none, small.withColumn("k", F.col("k").cast("string")), ["k"])


def test_hot_plan_in_the_rate_join(spark, sf_small):
    """X2 with one plan on a third of the rate rows: the same rows with its key salted."""
    from grainline import catalog
    from grainline.plans import landscape as ls
    inp = catalog.Src(spark, sf_small).inputs()
    plan = inp.rate.where((F.col("business_year") == catalog.YEAR) & (F.col("age") == "21")).orderBy("row_key").first().plan_id
    n = inp.rate.count()
    more = inp.rate.where((F.col("plan_id") == plan) & (F.col("age") == "21")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(400))))
    more = more.withColumn("row_key", F.concat("row_key", F.lit("/"), "copy")).drop("copy")
    inp.rate = inp.rate.unionByName(more)
    assert inp.rate.count() > 1.2 * n
    salted = ls.summary(inp, catalog.Params(catalog.YEAR), ls.Options(salt_buckets=8))
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    want = ls.summary(inp, catalog.Params(catalog.YEAR))
    assert salted.count() == want.count() and salted.exceptAll(want).count() == 0
