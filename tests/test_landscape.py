import contextlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from grainline import catalog
from grainline.plans import landscape as ls
from grainline.plans.params import Params
from grainline.sources.steps import LIVE, Steps, file_system, release_all

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tiny(spark):
    D = Decimal
    rate = spark.createDataFrame([
        # year, state, issuer, plan, area, age, rate, row_key
        (2024, "AA", 1, "1-0", "Rating Area 1", "21", D("300.00"), "r1"),
        (2024, "AA", 1, "1-1", "Rating Area 1", "21", D("250.00"), "r2"),
        (2024, "AA", 2, "2-0", "Rating Area 1", "21", D("250.00"), "r3"),   # tie with r2
        (2024, "AA", 2, "2-1", "Rating Area 1", "21", None, "r4"),          # NULL rate
        (2024, "AA", 2, "2-2", "Rating Area 1", "21", D("400.00"), "r5"),
        (2024, "AA", 2, "2-0", "Rating Area 1", "22", D("1.00"), "r6"),     # wrong age
    ], "business_year int, state_code string, issuer_id bigint, plan_id string, "
       "rating_area_id string, age string, individual_rate decimal(12,2), row_key string")
    plan = spark.createDataFrame([
        (2024, "AA", 1, "Iss One", "1-0", "1-0-01", "SA0", "Silver", "Individual"),
        (2024, "AA", 1, "Iss One", "1-1", "1-1-01", "SA0", "Silver", "Individual"),
        (2024, "AA", 2, "Iss Two", "2-0", "2-0-01", "SA1", "Silver", "Individual"),
        (2024, "AA", 2, "Iss Two", "2-1", "2-1-01", "SA1", "Silver", "Individual"),
        (2024, "AA", 2, "Iss Two", "2-2", "2-2-01", "SA1", "Expanded Bronze", "Individual"),
        (2024, "AA", 2, "Iss Two", "2-2", "2-2-02", "SA1", "Expanded Bronze", "Individual"),
    ], "business_year int, state_code string, issuer_id bigint, "
       "issuer_market_place_marketing_name string, standard_component_id string, plan_id string, "
       "service_area_id string, metal_level string, market_coverage string")
    for c in ["plan_marketing_name", "plan_type", "tehb_ded_inn_tier1_individual",
              "mehb_ded_inn_tier1_individual", "tehb_ded_inn_tier1_family_per_person",
              "tehb_inn_tier1_individual_moop", "tehb_inn_tier1_family_per_person_moop"]:
        plan = plan.withColumn(c, F.lit("$1,000 per person"))
    sa = spark.createDataFrame([
        (2024, "AA", 1, "SA0", "Yes", None, "No"),
        (2024, "AA", 2, "SA1", "No", "AA - 01001", "No\r"),
    ], "business_year int, state_code string, issuer_id bigint, service_area_id string, "
       "cover_entire_state string, county string, dental_only_plan string")
    counties = spark.createDataFrame([("AA", "01001"), ("AA", "01003")], "usps string, geoid string")
    cmap = spark.createDataFrame([("01001", "Adams", "Rating Area 1"),
                                  ("01003", "Baker", "Rating Area 1")],
                                 "fips string, county string, rating_area string")
    zra = spark.createDataFrame([("01001", "AA", "Rating Area 1"), ("01001", "AA", "Rating Area 1"),
                                 ("01003", "AA", "Rating Area 1")],
                                "fips string, state string, rate_area string")
    enr = spark.createDataFrame([(1, 2024, "01001", "9"), (1, 2024, "01001", "10"), (1, 2024, "01003", "7"),
                                 (1, 2024, "01003", "NULL"), (2, 2024, "01001", "NULL")],
                                "issuer_hios_id bigint, year int, county_fips string, avg_enrollment string")
    parent = spark.createDataFrame([(1, "One Co", "P1")],
                                   "hios_issuer_id bigint, company_name string, parent_name string")
    return ls.Inputs(rate, plan, sa, counties, cmap, zra, enr, parent)


def test_tiny_landscape(tiny):
    run = ls.Landscape(tiny, Params(2024, "All"))
    rk = {(r.row_key, r.fips): r for r in run.ranking().collect()}
    out = run.final().collect()
    diffs = {(r.row_key, r.fips): r for r in run.diffs().collect()}
    # issuer 1 statewide -> both counties; issuer 2 -> Adams only; age 22 row dropped
    assert len(rk) == 2 * 2 + 3
    adams = sorted((r.metal_rank, r.row_key) for k, r in rk.items()
                   if k[1] == "01001" and r.metal_level == "Silver")
    # tie at 250 broken by plan_id: 1-1 before 2-0; NULL rate last
    assert adams == [(1, "r2"), (2, "r3"), (3, "r1"), (4, "r4")]
    assert rk[("r5", "01001")].metal_level == "Bronze"
    # benchmark exists in Adams (r3 at 250) but Baker has only issuer 1's two plans
    assert diffs[("r1", "01001")].diff_from_slcsp == Decimal("50.00")
    assert diffs[("r1", "01003")].diff_from_slcsp == Decimal("0.00")    # Baker: r1 is rank 2
    assert diffs[("r2", "01003")].diff_from_slcsp == Decimal("-50.00")
    assert diffs[("r4", "01001")].diff_from_min is None
    assert len(out) == len(rk)
    assert {r.parent_name for r in out if r.issuer_id == 2} == {None}   # left join kept
    assert all(len(r) == 21 for r in out)


def test_duplicate_enrollment_takes_the_largest_number(tiny):
    rk = ls.ranking(ls.summary(tiny, Params(2024)))
    o = [r for r in ls.overall_rank(ls.entrants(rk, tiny)).collect() if r.metal_level == "Silver"]
    assert sorted(r.issuer_overall_rank for r in o if r.fips == "01001") == [1, 2]
    best = ls.overall_rank(ls.entrants(ls.winners(ls.summary(tiny, Params(2024))), tiny))
    assert sorted(best.collect(), key=str) == sorted(ls.overall_rank(ls.entrants(rk, tiny)).collect(), key=str)
    # '9' and '10' as numbers; a number beats the sentinel; only a sentinel is NULL
    assert {(r.issuer_id, r.fips): r.issuer_avg_monthly_enrollment for r in o} == {
        (1, "01001"): 10.0, (1, "01003"): 7.0, (2, "01001"): None}
    written = [r for r in ls.overall_rank(ls.entrants(rk, tiny, ls.Options(enrollment="as_written"))).collect() if r.metal_level == "Silver"]
    # the raw rows repeat issuer 1's winner and push issuer 2 down
    assert sorted((r.issuer_overall_rank, r.issuer_avg_monthly_enrollment) for r in written if r.fips == "01001") == [
        (1, "10"), (2, "9"), (3, "NULL")]


@pytest.fixture(scope="module")
def small_rank(spark, sf_small):
    src = catalog.Src(spark, sf_small)
    run = ls.Landscape(src.inputs(), Params(catalog.YEAR, "All"))
    return run, run.ranking()


def test_properties(small_rank):
    run, rk = small_rank
    g = ["business_year", "state_code", "county", "metal_level"]
    stats = rk.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.max("metal_rank").alias("mx"),
                               F.count_distinct("metal_rank").alias("d"),
                               F.min("metal_rank").alias("mn"))
    assert stats.where((F.col("n") != F.col("mx")) | (F.col("d") != F.col("n"))
                       | (F.col("mn") != 1)).count() == 0
    one = rk.where(F.col("issuer_rank") == 1).groupBy(*g, ls.ISSUER_NAME).count()
    assert one.where(F.col("count") != 1).count() == 0
    d = run.diffs()
    assert d.where(F.col("diff_from_min") < 0).count() == 0
    assert d.count() == rk.count()


def test_rerun_is_identical(spark, sf_small):
    a = catalog.q_landscape_current_year(spark, sf_small)
    b = catalog.q_landscape_current_year(spark, sf_small)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_cartesian_or_python_in_pipeline(spark, sf_small):
    for key in ["landscape_current_year", "landscape_all_years", "sa_expanded", "is_slcsp_flag",
                "join_fanout_audit", "pivot_grand_total", "grain_report"]:
        plan = _plan(catalog.REGISTRY[key][0](spark, sf_small))
        for bad in FORBIDDEN:
            assert bad not in plan, (key, bad)


def test_ranking_windows_share_one_exchange(spark, sf_small):
    lines = _plan(catalog._run(spark, sf_small).ranking()).splitlines()
    idx = [i for i, line in enumerate(lines) if "Window [row_number()" in line][:2]
    assert len(idx) == 2
    assert not any("Exchange" in line for line in lines[idx[0]:idx[1]])


@contextlib.contextmanager
def _largest_input(spark):
    """Plans as they are when no side may be broadcast for its size, and nothing is planned anew at run time."""
    for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false"),
                 ("spark.sql.maxMetadataStringLength", "2000")):        # whole paths
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rates_are_scanned_once_and_later_steps_read_stored_rows(spark, sf_small):
    run = catalog._run(spark, sf_small)
    with _largest_input(spark):
        x2 = _plan(ls.summary(run.inp, run.params, run.opts))
        plans = {"ranking": _plan(run.ranking()), "overall_rank": _plan(run.overall_rank()), "final": _plan(run.final())}
    scans = lambda plan, table: sum(table in line for line in plan.splitlines() if "FileScan" in line)
    assert scans(x2, "st_rate/") + scans(x2, "st_rate]") == 1
    for name, plan in plans.items():
        assert "st_rate" not in plan.replace("st_rating", ""), name
        assert "grainline-steps" in plan, name
    exchanges = {name: plan.count("Exchange hashpartitioning") for name, plan in plans.items()}
    # one for X3's windows; X7 reads its stored entrants; the final join's four sides, and the distinct of X0
    assert exchanges["ranking"] == 1 and exchanges["overall_rank"] == 1 and exchanges["final"] <= 7
    assert plans["final"].count("SortMergeJoin") == 2


def test_a_failed_run_goes_on_from_its_stored_steps(spark, tiny, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    want = sorted(ls.Landscape(tiny, Params(2024)).final().collect(), key=str)
    built, plain = [], ls.summary
    monkeypatch.setattr(ls, "summary", lambda *a: built.append(1) or plain(*a))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ls, "final", broken)
    run = Steps(spark, "recovery-test")
    with pytest.raises(RuntimeError):
        ls.Landscape(tiny, Params(2024), steps=run).write(path)
    folder, fs = file_system(spark, run.root)
    assert built == [1] and fs.exists(folder) and "recovery-test" in LIVE
    # an unfinished table is not taken over
    unfinished, _ = file_system(spark, f"{run.root}/{[k for k in run._tables if k.startswith('entrants')][0]}/_SUCCESS")
    fs.delete(unfinished, False)
    monkeypatch.undo()
    monkeypatch.setattr(ls, "summary", lambda *a: built.append(2) or plain(*a))
    again = Steps(spark, "recovery-test")                       # as a new process would name it
    ls.Landscape(tiny, Params(2024), steps=again).write(path)
    assert built == [1]                                         # X2 was not computed a second time
    back = spark.read.parquet(path).select(*ls.FINAL_COLUMNS).collect()
    assert sorted(back, key=str) == want
    assert not fs.exists(folder) and "recovery-test" not in LIVE


def test_views_end_with_their_run(spark):
    with Steps(spark) as run:
        run.view("grainline_step_view", lambda: spark.range(3).toDF("x"))
        assert spark.sql("SELECT sum(x) FROM grainline_step_view").first()[0] == 3
        calls = []
        assert run.table("grainline_step_view", lambda: calls.append(1)).count() == 3 and not calls
    assert not spark.catalog.tableExists("grainline_step_view")
    Steps(spark).table("x", lambda: spark.range(1))
    release_all()
    assert not LIVE


def test_x7_cuts_a_hot_group(spark, tiny):
    rows = spark.range(3000).select(
        F.lit(2024).alias("business_year"), F.lit("AA").alias("state_code"), F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("C"), F.col("id") % 50)).alias("county"),
        F.lit("Silver").alias("metal_level"), F.col("id").alias("issuer_id"), F.col("id").cast("string").alias("fips"), F.lit(7).alias(ls.RATE),
        F.lit("p").alias("plan_id"), F.col("id").cast("string").alias("row_key"), F.lit(1.0).alias("avg_enrollment"))
    cut = ls.overall_rank(rows, ls.Options(cell_rows=100))
    whole = ls.overall_rank(rows)
    assert sorted(cut.collect(), key=str) == sorted(whole.collect(), key=str)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number()" in line]
    assert windows and all("__cell" in line for line in windows)


def test_small_lookups_are_broadcast_and_rows_are_not_shuffled_for_them(spark, sf_small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = catalog._run(spark, sf_small)
        ranking, diffs = _plan(run.ranking()), _plan(run.diffs())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the ranked rows and the two small sides each hold the ranking's joins; joining them adds none
    assert diffs.count("SortMergeJoin") == 3 * ranking.count("SortMergeJoin")


def test_filters_reach_the_scan(spark, sf_small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(catalog.q_filter_equality(spark, sf_small))
    assert "EqualTo(metal_level,Gold)" in plan and "EqualTo(state_code,NATION_3)" in plan
    plan = _plan(catalog.q_curated_columns(spark, sf_small))
    assert "business_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<>" in _plan(catalog.q_row_count(spark, sf_small))


def test_stored_tables_are_sorted_by_state_inside_each_file(spark, sf_small):
    import glob

    import pyarrow.parquet as pq
    for table in (catalog.Src(spark, sf_small).rate, catalog.Src(spark, sf_small).plan):
        files = table.inputFiles()
        assert files
        for f in files:
            for path in glob.glob(f.removeprefix("file://").removeprefix("file:")):
                states = pq.read_table(path, columns=["state_code"]).column(0).to_pylist()
                assert states == sorted(states)
                stats = pq.ParquetFile(path).metadata.row_group(0)
                col = next(i for i in range(stats.num_columns) if stats.column(i).path_in_schema == "state_code")
                assert stats.column(col).statistics.min == states[0]


def test_fingerprint_follows_the_input_files(spark, tmp_path):
    from grainline.sources import standins
    spark.range(3).write.parquet(str(tmp_path / "nation.parquet"))
    first = standins._fingerprint(spark, str(tmp_path))
    assert first == standins._fingerprint(spark, f"{tmp_path}/")
    spark.range(5).write.mode("overwrite").parquet(str(tmp_path / "nation.parquet"))
    assert standins._fingerprint(spark, str(tmp_path)) != first


def test_ordered_outputs(spark, sf_small):
    none_last = lambda x: (x is None, x)
    for key, columns in (("sort_rating_area", ["rating_area_number", "rating_area_id"]),
                         ("distinct_values", ["rate_effective_date", "version_number"]),
                         ("pivot_min_rate_as_written", ["rating_area_number"]),
                         ("sa_expanded_state", ["business_year", "issuer_id", "service_area_id", "county"]),
                         ("state_rows_ordered", ["service_area_id", "cover_entire_state", "county_name"])):
        rows = catalog.REGISTRY[key][0](spark, sf_small).collect()
        got = [tuple(none_last(r[c]) for c in columns) for r in rows]
        assert got and got == sorted(got), key
    top = [r.row_count for r in catalog.q_t0a_grain_top20(spark, sf_small).collect()]
    assert top == sorted(top, reverse=True)


def test_no_vacuous_rows(spark, sf_small):
    """The stand-ins hold every case that the checks are about."""
    s = catalog.Src(spark, sf_small)
    count = lambda key: catalog.REGISTRY[key][0](spark, sf_small).count()
    assert count("filter_equality") > 0
    assert count("unmatched_enrollment") > count("anti_enrollment") > 0
    assert {r.treatment for r in catalog.q_coverage_audit(spark, sf_small).collect()} == {"whole", "part", "dropped"}
    audit = catalog.q_join_fanout_audit(spark, sf_small).first()
    assert audit.left_unmatched > 0 and audit.right_unmatched > 0
    assert s.cmap.groupBy("fips").count().where("count > 1").count() > 0
    assert ls.fips_ra(s.inputs()).groupBy("fips", "state").count().where("count > 1").count() > 0
    a, b = catalog.q_landscape_overall_rank(spark, sf_small), catalog.q_landscape_overall_rank_as_written(spark, sf_small)
    assert a.count() != b.count()
    assert catalog.q_is_slcsp_as_written_slice(spark, sf_small).where("is_slcsp = 1").count() > 0


def test_sink_modes(spark, sf_small, tmp_path):
    from grainline.sources import sink
    rows = spark.createDataFrame([(2023, "AA", 1), (2024, "AA", 2), (2024, "BB", 3)], "business_year int, state_code string, v int")
    path = str(tmp_path / "out")
    read = lambda: sorted(r.v for r in sink.read_partitioned(spark, path).collect())
    sink.write_partitioned(rows, path)
    one = rows.where("state_code = 'BB'").withColumn("v", F.lit(9))
    sink.write_partitioned(one, path, mode="partitions")
    assert read() == [1, 2, 9]
    sink.write_partitioned(one, path)
    assert read() == [9]                    # fewer years leave none behind
    with pytest.raises(ValueError):
        sink.write_partitioned(one, path, mode="append")
    assert sink.shared_path(spark, "x", "/a") == sink.shared_path(spark, "x", "/a") != sink.shared_path(spark, "x", "/b")


def _variant(tiny, spark, **repl):
    d = dict(tiny.__dict__)
    d.update(repl)
    return ls.Inputs(**d)


def test_split_county_fans_out_and_audit_sees_it(spark, tiny):
    # one county in two rating areas: X0 has two rows for it, so X8 repeats its plans
    zra = spark.createDataFrame([("01001", "AA", "Rating Area 1"), ("01001", "AA", "Rating Area 2"),
                                 ("01003", "AA", "Rating Area 1")],
                                "fips string, state string, rate_area string")
    inp = _variant(tiny, spark, zip_rating_area=zra)
    run = ls.Landscape(inp, Params(2024))
    rk, out = run.ranking(), run.final()
    n_rank, n_out = rk.count(), out.count()
    adams = rk.where(F.col("fips") == "01001").count()
    assert n_out == n_rank + adams
    from grainline.operators import joins
    a = joins.audit(rk, ls.fips_ra(inp).withColumnRenamed("fips", "k"), [("fips", "k")]).collect()[0]
    assert a.max_right_dups == 2 and a.joined_rows == n_out


def test_issuer_ids_sharing_a_name_lose_rows_in_the_final_join(spark, tiny):
    # issuer 2 renamed to issuer 1's marketing name: X3 ranks them as one issuer, so only
    # one of the two ids has an X7 winner per county and metal and the other id's rows drop
    plan = tiny.plan.withColumn(ls.ISSUER_NAME, F.lit("Same Name"))
    inp = _variant(tiny, spark, plan=plan)
    run = ls.Landscape(inp, Params(2024))
    n_rank = run.ranking().count()
    n_out = run.final().count()
    assert n_out < n_rank


def test_fips_sharing_a_county_name_compete_in_one_group(spark, tiny):
    cmap = spark.createDataFrame([("01001", "Adams", "Rating Area 1"),
                                  ("01003", "Adams", "Rating Area 1")],
                                 "fips string, county string, rating_area string")
    inp = _variant(tiny, spark, county_map=cmap)
    run = ls.Landscape(inp, Params(2024))
    rk = run.ranking().where(F.col("metal_level") == "Silver")
    ranks = sorted(r.metal_rank for r in rk.collect())
    # both FIPS now sit in one (county name, metal) group: ranks run 1..n over both
    assert ranks == list(range(1, len(ranks) + 1))


def test_pivot_columns_sum_to_at_most_grand_total(spark, sf_small):
    p = catalog.q_pivot_grand_total(spark, sf_small)
    listed = sum(F.col(c) for c in ["bronze", "silver", "gold", "platinum", "catastrophic"])
    assert p.where(listed > F.col("grand_total")).count() == 0
    assert p.agg(F.sum("grand_total")).collect()[0][0] == 193     # FIXTURES.md §D, sf0.001


def test_sink_read_prunes_partitions(spark, sf_small):
    from grainline.sources import sink
    df = catalog.q_landscape_current_year(spark, sf_small)
    path = sink.shared_path(spark, "test_sink_prune")
    sink.write_partitioned(df, path)
    back = sink.read_partitioned(spark, path, catalog.YEAR, catalog.STATE)
    plan = _plan(back)
    assert "PartitionFilters: [isnotnull(business_year" in plan and "= 1997" in plan
    want = df.where(F.col("state_code") == catalog.STATE)
    assert back.select(*df.columns).exceptAll(want).count() == 0
    assert want.exceptAll(back.select(*df.columns)).count() == 0


def test_rates_are_laid_out_before_their_texts_are_made(spark, sf_small):
    """The exchange and the sort of the stored rates hold the source's numbers only; the stored rows are the derived ones."""
    from grainline.sources import standins
    plan = standins._laid_out(spark, sf_small, "st_rate")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    place = {what: next(i for i, line in enumerate(plan) if what in line) for what in ("AS row_key", "AS plan_id", "Sort [", "RebalancePartitions")}
    assert max(place["AS row_key"], place["AS plan_id"]) < place["Sort ["] < place["RebalancePartitions"]
    stored, derived = standins.materialized(spark, sf_small, "st_rate"), standins.build(spark, sf_small, "st_rate")
    assert stored.columns == derived.columns and stored.count() == derived.count()
    assert stored.exceptAll(derived).count() == 0


def test_plans_meet_rates_as_one_row_and_x7_reads_stored_standings(spark, sf_small):
    run = catalog._run(spark, sf_small)
    x2 = ls.summary(run.inp, run.params, run.opts)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    rates = next(i for i, line in enumerate(x2) if "row_key" in line and "Relation" in line)
    spread = next(i for i, line in enumerate(x2) if "Generate explode(s_counties" in line)
    # the counties are spread above (after) the join with the rates
    assert spread < rates and any("Join Inner" in line for line in x2[spread:rates])
    run.final()
    names = sorted(k.split("-")[0] for k in run.steps._tables)
    assert names == ["entrants", "standings", "summary"]
    kept = next(df for k, df in run.steps._tables.items() if k.startswith("standings"))
    assert kept.where("issuer_rank = 1 AND row_key IS NULL OR issuer_rank > 1 AND row_key IS NOT NULL").count() == 0
    assert kept.count() == run.summary().count() > 0
    best = {tuple(r) for r in ls.entrants(kept, run.inp, run.opts).collect()}
    assert best == {tuple(r) for r in ls.entrants(ls.winners(run.summary(), run.opts), run.inp, run.opts).collect()}
