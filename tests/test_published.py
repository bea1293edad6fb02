import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from grainline import catalog
from grainline.plans import landscape as ls
from grainline.plans import refresh
from grainline.plans.params import Params
from grainline.sources.published import Published, PublishConflict

DDL = "business_year int, state_code string, v int"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return Published(spark, str(tmp_path / "data" / "t"))          # a folder named like the table's own


FIRST = [(2023, "AA", 1), (2024, "AA", 2), (2024, "B/B=x", 3), (2024, None, 4)]


def test_whole_and_partial_replacement(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(spark.createDataFrame(FIRST, DDL))
    assert rows(table.read()) == sorted(FIRST, key=str)
    kept = [f for f in table.current().folders if "2023" in f]
    second = table.publish(spark.createDataFrame([(2024, "AA", 9)], DDL), [{"business_year": 2024}], {"why": "test"})
    assert second.version == 2 and table.current().notes == {"why": "test"}
    assert rows(table.read()) == [(2023, "AA", 1), (2024, "AA", 9)]
    assert [f for f in second.folders if "2023" in f] == kept      # the other year's files were not touched
    assert rows(table.read(business_year=2023)) == [(2023, "AA", 1)] and table.read(state_code="ZZ").count() == 0
    # nothing instead of a partition; a state with odd characters, and a null one
    table.publish(spark.createDataFrame(FIRST, DDL))
    table.publish(spark.createDataFrame([], DDL), [{"state_code": "B/B=x"}, {"state_code": None}])
    assert rows(table.read()) == sorted(FIRST[:2], key=str)
    table.publish(spark.createDataFrame([], DDL))
    assert table.read().count() == 0 and table.read().columns == ["business_year", "state_code", "v"]
    assert table.vacuum() > 0 and table.vacuum() == 0 and table.read().count() == 0


def test_a_failing_write_leaves_the_old_table(spark, table):
    table.publish(spark.createDataFrame(FIRST, DDL))
    bad = spark.range(100, numPartitions=20).select(F.lit(2023).alias("business_year"), F.lit("AA").alias("state_code"),
                                                    F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit(5)).cast("int").alias("v"))
    for replacing in (None, [{"business_year": 2023}]):
        with pytest.raises(Exception, match="lost"):
            table.publish(bad, replacing)
        assert rows(table.read()) == sorted(FIRST, key=str) and table.current().version == 1
    with pytest.raises(ValueError):
        table.publish(spark.createDataFrame(FIRST, DDL), [{"business_year": 2023}])
    with pytest.raises(ValueError):
        table.publish(spark.createDataFrame([(2023, "AA", "x")], "business_year int, state_code string, v string"), [{"business_year": 2023}])
    assert rows(table.read()) == sorted(FIRST, key=str)
    assert table.vacuum() > 0 and rows(table.read()) == sorted(FIRST, key=str)


def test_a_reader_keeps_its_version_and_a_second_writer_fails(spark, table, monkeypatch):
    table.publish(spark.createDataFrame(FIRST, DDL))
    reader = table.read()
    table.publish(spark.createDataFrame([(2023, "AA", 7)], DDL))
    assert rows(reader) == sorted(FIRST, key=str)                  # older folders stay until vacuum
    stale = Published(spark, table.path)
    old = replace(table.current(), version=1)
    monkeypatch.setattr(stale, "current", lambda: old)             # read before the other writer published
    with pytest.raises(PublishConflict):
        stale.publish(spark.createDataFrame([(2023, "AA", 8)], DDL))
    assert rows(table.read()) == [(2023, "AA", 7)]


@pytest.fixture(scope="module")
def inputs(spark, sf_small):
    return catalog.Src(spark, sf_small).inputs()


def test_refresh_computes_changed_units_only(spark, inputs, tmp_path, monkeypatch):
    path = str(tmp_path / "landscape")
    want = rows(ls.Landscape(inputs, Params(None)).final())
    units, first = refresh.refresh(inputs, Params(None), path)
    assert len(units) > 3 and rows(Published(spark, path).read()) == want
    assert refresh.refresh(inputs, Params(None), path) == ([], Published(spark, path).current())      # nothing changed
    # one plan's rates in one year: that whole year, as X7 ranks across states
    one = next(r[4] for r in want if r[0] == catalog.YEAR)
    dearer = replace(inputs, rate=inputs.rate.withColumn("individual_rate", F.when((F.col("plan_id") == one) & (F.col("business_year") == catalog.YEAR), F.lit(0)).otherwise(F.col("individual_rate"))
                                                         .cast(inputs.rate.schema["individual_rate"].dataType)))
    seen, plain = [], ls.Landscape
    monkeypatch.setattr(refresh, "Landscape", lambda inp, *a: seen.append(inp) or plain(inp, *a))
    units, second = refresh.refresh(dearer, Params(None), path)
    assert units == [{"business_year": catalog.YEAR}]
    assert {r.business_year for r in seen[0].rate.select("business_year").distinct().collect()} == {catalog.YEAR}
    got, full = rows(Published(spark, path).read()), rows(plain(dearer, Params(None)).final())
    assert got == full != want
    other = lambda m: [f for f in m.folders if f"business_year={catalog.YEAR}" not in f]
    assert other(first) == other(second)
    # a year that vanishes, and enrollment of another one
    less = replace(inputs, plan=inputs.plan.where(F.col("business_year") != 1995),
                   enrollment=inputs.enrollment.where((F.col("year") != 1996) | (F.col("issuer_hios_id") % 2 == 0)))
    units, _ = refresh.refresh(less, Params(None), path)
    assert [u["business_year"] for u in units] == [1995, 1996, catalog.YEAR]
    assert rows(Published(spark, path).read()) == rows(plain(less, Params(None)).final())
    # a whole-table input reaches everything
    units, _ = refresh.refresh(replace(less, parent=inputs.parent.where("hios_issuer_id % 2 = 0")), Params(None), path)
    assert len(units) == len({f.split("/")[0] for f in first.folders} | {"business_year=1995"}) or len(units) > 3


def test_refresh_by_state_computes_that_state_only(spark, inputs, tmp_path):
    path, opts = str(tmp_path / "by_state"), ls.Options(overall_keys=("state_code", "county", "metal_level"))
    refresh.refresh(inputs, Params(catalog.YEAR), path, opts)
    changed = replace(inputs, rate=inputs.rate.where((F.col("state_code") != catalog.STATE) | (F.col("business_year") != catalog.YEAR) | (F.col("issuer_id") % 2 == 0)))
    units, _ = refresh.refresh(changed, Params(catalog.YEAR), path, opts)
    assert units == [{"business_year": catalog.YEAR, "state_code": catalog.STATE}]
    assert rows(Published(spark, path).read()) == rows(ls.Landscape(changed, Params(catalog.YEAR), opts).final())


def test_fingerprints_ignore_order_and_see_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "k int, v string")
    assert refresh.fingerprint(a, ["k"]) == refresh.fingerprint(a.orderBy(F.desc("v")), ["k"])
    twice = refresh.fingerprint(a.union(a.where("v = 'y'")), ["k"])
    assert twice[(2,)] == refresh.fingerprint(a, ["k"])[(2,)] and twice[(1,)] != refresh.fingerprint(a, ["k"])[(1,)]
    assert json.dumps(refresh.fingerprint(a.limit(0)).get((), ""))
