"""Every registered query against its DuckDB oracle, on the smallest test tables."""
import pytest

from grainline import catalog, testing

KEYS = sorted(catalog.REGISTRY)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, duck_small, key):
    fn, sql = catalog.REGISTRY[key]
    df = fn(spark, sf_small)
    if sql is None:
        assert df.count() >= 0
        return
    ok, msg = testing.compare(df, duck_small, sql)
    assert ok, msg


#: Seconds that an oracle statement may take at the driver's scale.
LIMIT = 5


@pytest.mark.parametrize("key", [k for k in KEYS if k.startswith(("landscape", "missing", "parent", "sink", "pipeline", "published"))])
def test_landscape_oracles_are_quick_at_the_drivers_scale(key):
    import time
    for threads in (1, 8):
        con = testing.duck("/root/testdata/sf0.01")
        con.execute(f"SET threads = {threads}")
        begin = time.monotonic()
        rows = con.execute(catalog.REGISTRY[key][1]).fetchall()
        assert rows and time.monotonic() - begin < LIMIT


@pytest.mark.parametrize("key", ["landscape_current_year", "landscape_all_years_skew_split", "landscape_current_year_as_written"])
def test_landscape_at_the_drivers_scale(spark, key):
    fn, sql = catalog.REGISTRY[key]
    ok, msg = testing.compare(fn(spark, "/root/testdata/sf0.01"), testing.duck("/root/testdata/sf0.01"), sql)
    assert ok, msg


def test_queries_without_the_corpus_part(monkeypatch):
    """A package that only the corpus operators need is absent: the rest is still registered."""
    import importlib
    import sys

    import __spark_entry__ as e
    for name in [n for n in sys.modules if n.startswith("grainline.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    for name in ("xxhash", "public_tokenizers", "ahocorasick", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, name, None)
    importlib.reload(e)
    assert set(e.queries()) == set(catalog.queries()) and set(e.oracle_sql()) == set(catalog.oracle_sql())
    monkeypatch.undo()
    importlib.reload(e)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert len(df.columns) == 21
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
