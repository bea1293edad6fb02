"""Regression numbers of FIXTURES.md §D (sf0.001 column), measured with the stand-ins as SQL; they pin the stand-ins and the pipeline without going through the oracle."""
from pyspark.sql import functions as F

from grainline import catalog
from grainline.operators import joins


def _n(df):
    return df.count()


def test_standin_row_counts(spark, sf_small):
    s = catalog.Src(spark, sf_small)
    assert (_n(s.rate), _n(s.plan), _n(s.sa)) == (6000, 1890, 280)
    assert (_n(s.county), _n(catalog.q_distinct_lookup(spark, sf_small)), _n(s.enrollment),
            _n(s.parent), _n(s.t0a)) == (125, 92, 369, 9, 1874)


def test_join_fanout_numbers(spark, sf_small):
    s = catalog.Src(spark, sf_small)
    a = joins.audit(s.rate, s.plan, [("plan_id", "standard_component_id")]).collect()[0]
    assert (a.joined_rows, a.max_right_dups) == (122913, 21)


def test_pipeline_numbers(spark, sf_small):
    exp = catalog.q_sa_expanded(spark, sf_small)
    assert (_n(exp), exp.select("county").distinct().count()) == (469, 43)
    summ = catalog.q_landscape_summary(spark, sf_small)
    assert _n(summ) == 308
    assert summ.where(F.col("individual_rate").isNotNull()).count() == 294
    assert summ.select("fips").distinct().count() == 38
    assert round(summ.agg(F.sum("individual_rate")).collect()[0][0], 2) == 14603598.63
    rk = catalog.q_landscape_ranking(spark, sf_small)
    assert rk.agg(F.sum("metal_rank"), F.sum("issuer_rank")).collect()[0][:] == (579, 579)
    assert _n(catalog.q_landscape_slcsp(spark, sf_small)) == 20
    assert _n(catalog.q_landscape_current_year(spark, sf_small)) == 250
    assert _n(catalog.q_landscape_all_years(spark, sf_small)) == 1694
    written = catalog.q_landscape_current_year(spark, sf_small)
    by_state = catalog.q_landscape_by_state(spark, sf_small)
    assert written.agg(F.sum("issuer_overall_rank")).collect()[0][0] == 889
    assert by_state.agg(F.sum("issuer_overall_rank")).collect()[0][0] == 250


def test_written_grouping_numbers(spark, sf_small):
    t, piece = catalog.q_is_slcsp_as_written(spark, sf_small), catalog.q_is_slcsp_as_written_slice(spark, sf_small)
    assert t.agg(F.sum("is_min"), F.sum("is_slcsp")).first()[:] == (23, 4)
    assert piece.agg(F.sum("is_min"), F.sum("is_slcsp"), F.count("*")).first()[:] == (16, 2, 29)


def test_benchmark_flag_numbers(spark, sf_small):
    t = catalog.q_is_slcsp_flag(spark, sf_small)
    dense = catalog.q_is_slcsp_dense(spark, sf_small)
    assert t.agg(F.sum("is_min")).collect()[0][0] == 193
    assert t.agg(F.sum("is_slcsp")).collect()[0][0] == 26
    assert dense.agg(F.sum("is_slcsp")).collect()[0][0] == 27
    counts = catalog.q_metal_counts_as_written(spark, sf_small)
    assert _n(counts) == 80 and counts.select("state_code", "metal_level").distinct().count() == 70
