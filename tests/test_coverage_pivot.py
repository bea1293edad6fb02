from pyspark.sql import functions as F

from grainline.operators import coverage, pivot, profile


def _sa(spark):
    return spark.createDataFrame([
        (2024, "AA", 1, "S1", "Yes", None, "No"),
        (2024, "AA", 2, "S2", "No", "X - 01001", "No\r"),
        (2024, "AA", 2, "S2", "No", "X - 01001", "No"),        # duplicate after expansion
        (2024, "AA", 3, "S3", "true", None, "No"),             # neither spelling: dropped
        (2024, "BB", 4, "S4", "false", "Y - 02003", "Yes"),    # dental only: dropped
    ], "business_year int, state_code string, issuer_id int, service_area_id string, "
       "cover_entire_state string, county string, dental_only_plan string")


def _counties(spark):
    return spark.createDataFrame([("AA", "01001"), ("AA", "01003"), ("AA", "01005"),
                                  ("BB", "02001")], "usps string, geoid string")


def test_expand_statewide_gets_every_county(spark):
    out = coverage.expand(_sa(spark), _counties(spark)).collect()
    by_issuer = {}
    for r in out:
        by_issuer.setdefault(r.issuer_id, set()).add(r.county)
    assert by_issuer[1] == {"01001", "01003", "01005"}     # the state's county count
    assert by_issuer[2] == {"01001"}                        # deduplicated
    assert 3 not in by_issuer and 4 not in by_issuer


def test_expand_broadcasts_the_lookup_only_when_told_that_it_is_bounded(spark):
    plan = lambda **k: coverage.expand(_sa(spark), _counties(spark), **k)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan() and "ResolvedHint (strategy=broadcast)" in plan(counties_bounded=True)


def test_coverage_audit_reports_unknown_spelling(spark):
    rows = {r.cover_entire_state: r.treatment for r in coverage.coverage_audit(_sa(spark)).collect()}
    assert rows["true"] == "dropped" and rows["Yes"] == "whole" and rows["false"] == "part"


def test_expansion_report(spark):
    sa, c = _sa(spark), _counties(spark)
    rep = {r.state_code: r for r in
           coverage.expansion_report(sa, c, coverage.expand(sa, c)).collect()}
    assert rep["AA"].county_count == 3 and rep["AA"].expanded_rows == 4
    assert rep["AA"].raw_sa_rows == 3       # exact 'No' misses the '\r' row
    assert rep["BB"].expanded_rows == 0


def test_pivot_count_zero_cells_and_total(spark):
    df = spark.createDataFrame([(1, "Bronze"), (1, "Gold"), (1, "High"), (2, "Gold"),
                                (None, "Gold")], "issuer_id int, metal_level string")
    p = {r.issuer_id: r for r in pivot.pivot_count(
        df, ["issuer_id"], "metal_level", "issuer_id", ["Bronze", "Gold"], total="grand_total")
        .collect()}
    assert p[2].bronze == 0                                  # empty cell is 0, not NULL
    assert p[1].grand_total == 3 > p[1].bronze + p[1].gold   # total counts unlisted levels
    assert p[None].gold == 0 and p[None].grand_total == 0   # COUNT(issuer_id) skips NULL


def test_pivot_min(spark):
    df = spark.createDataFrame([("R1", "Gold", 5.0), ("R1", "Gold", 3.0), ("R1", "Silver", 4.0)],
                               "ra string, metal_level string, rate double")
    r = pivot.pivot_min(df, ["ra"], "metal_level", "rate", ["Gold", "Silver", "Bronze"]).collect()[0]
    assert (r.gold, r.silver, r.bronze) == (3.0, 4.0, None)


def test_grain_report(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3), (2, "a", 4)],
                               "x int, y string, z int")
    rep = {r.candidate: r for r in
           profile.grain_report(df, {"x": ["x"], "xy": ["x", "y"], "z": ["z"]}).collect()}
    assert rep["z"].is_unique == 1 and rep["z"].distinct_keys == 4
    assert rep["x"].is_unique == 0 and rep["x"].max_rows == 2 and rep["x"].dup_keys == 2
    assert rep["xy"].dup_keys == 1 and rep["xy"].rows == 4


def test_grain_top_orders_biggest_first(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    top = profile.grain_top(df, ["x"], 1).collect()
    assert top[0].x == 1 and top[0].row_count == 2


def test_distinct_counts_tall_and_approx(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    tall = {r.metric: r.value for r in profile.distinct_counts_tall(df, ["a", "b"]).collect()}
    assert tall == {"distinct_a": 7, "distinct_b": 1000}
    approx = profile.distinct_counts(df, ["b"], approx=True).collect()[0][0]
    assert abs(approx - 1000) <= 30
