"""Table profiling: session probe, samples, counts, distinct counts, grain checks.

All of these are aggregations that Spark computes partially on each map task before
the shuffle, so a hot key costs one pre-aggregated row, not a hot task. None multiplies its input rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import format_count


def _asc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def session_info(spark: SparkSession, probe: DataFrame) -> DataFrame:
    """Connection smoke check: catalog, database, user, time, and the probe table's
    row count (proves the table is readable)."""
    return probe.agg(F.count(F.lit(1)).alias("probe_rows")).select(
        F.current_catalog().alias("catalog_name"),
        F.current_database().alias("database_name"),
        F.current_user().alias("connected_user"),
        F.current_timestamp().alias("connected_at"),
        "probe_rows")


def sample_rows(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """``LIMIT n`` made deterministic by a sort key (defaults to every column).
    Planned as TakeOrderedAndProject: each task keeps its own top n, no full sort."""
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*_asc(keys)).limit(n)


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def row_count_formatted(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return row_count(df, "_n").select(format_count("_n").alias(name))


_INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: Values of one bitmap, and the widest range of integers that is counted in bitmaps (32 KB of them a column and task).
BITMAP_VALUES = 32768
BITMAP_SPAN = 8 * BITMAP_VALUES


def _narrow(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Integer columns whose values span little, with least value and number of bitmaps: one pass over these columns (over
    footers only, if the table is stored and not filtered)."""
    whole = [f.name for f in df.schema if f.name in cols and f.dataType.simpleString() in _INTEGERS]
    if not whole:
        return {}
    ends = df.agg(*[f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(whole) for n, f in (("a", F.min), ("b", F.max))]).first()
    found = {c: (ends[f"a{i}"], ends[f"b{i}"]) for i, c in enumerate(whole)}
    return {c: (a, (b - a) // BITMAP_VALUES + 1) for c, (a, b) in found.items() if a is not None and b - a < BITMAP_SPAN}


def distinct_counts(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None,
                    approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row, ``COUNT(DISTINCT c)`` per column, exact and without multiplying rows by columns.

    Integer columns that span little are counted together in one pass as bitmaps: a task sends a few kilobytes, however
    many rows and distinct values it has. Every other column is its own pruned scan and one distinct aggregation, combined
    map-side: a columnar table is read once in all, as each scan reads its own column. ``approx`` switches to
    HyperLogLog++ (one pass)."""
    names = list(names) if names else [f"distinct_{c}" for c in cols]
    if approx:
        return df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(n) for c, n in zip(cols, names)])
    if len(cols) == 1:
        return df.agg(F.count_distinct(F.col(cols[0])).alias(names[0]))
    narrow = _narrow(df, cols)
    parts = []
    if narrow:
        def count(c: str) -> Column:
            least, bitmaps = narrow[c]
            at = F.col(c).cast("bigint") - F.lit(least)
            total = F.lit(0).cast("bigint")
            for k in range(bitmaps):
                here = F.when(F.floor(at / BITMAP_VALUES) == k, (at % BITMAP_VALUES).cast("bigint"))
                total = total + F.bitmap_count(F.bitmap_construct_agg(here))
            return total

        row = df.agg(*[count(c).alias(c) for c in narrow])
        parts.append(row.select(F.explode(F.create_map(*[x for c in narrow for x in (F.lit(c), F.col(c))])).alias("c", "n")))
    for c in dict.fromkeys(cols):
        if c not in narrow:
            parts.append(df.select(c).distinct().agg(F.lit(c).alias("c"), F.count(F.col(c)).alias("n")))
    tall = parts[0]
    for part in parts[1:]:
        tall = tall.unionByName(part)
    return tall.agg(*[F.max(F.when(F.col("c") == F.lit(c), F.col("n"))).alias(n) for c, n in zip(cols, names)])


def distinct_counts_tall(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None,
                         approx: bool = False) -> DataFrame:
    """The same counts as (metric, value) rows."""
    wide = distinct_counts(df, cols, names, approx)
    return wide.unpivot([], wide.columns, "metric", "value")


def count_by(df: DataFrame, cols: Sequence[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def summary_by(df: DataFrame, key: str, value: str, with_minmax: bool = True,
               extra_avgs: dict[str, str] | None = None) -> DataFrame:
    """Rows, min, max and mean rounded to 2 per group; money leaves as double."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if with_minmax:
        aggs += [F.min(value).cast("double").alias("min_rate"),
                 F.max(value).cast("double").alias("max_rate"),
                 F.round(F.avg(value), 2).cast("double").alias("avg_rate")]
    for out, col in (extra_avgs or {}).items():
        aggs.append(F.round(F.avg(col), 2).cast("double").alias(out))
    return df.groupBy(key).agg(*aggs)


def count_and_distinct_by(df: DataFrame, key: str, distinct_col: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"),
                               F.count_distinct(distinct_col).alias("distinct_plans"))


def distinct_values(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols).distinct()


def value_inventory(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as (column_name, value) rows: one pruned scan and one distinct a column, combined
    map-side."""
    out = None
    for c in cols:
        part = df.select(F.col(c).alias("value")).distinct().select(F.lit(c).alias("column_name"), F.col("value").cast("string").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def grain_top(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """Candidate key with the largest row counts first: any count > 1 disproves it."""
    counts = count_by(df, keys)
    return counts.orderBy(F.col("row_count").desc_nulls_first(), *_asc(keys)).limit(n)


def grain_report(df: DataFrame, candidates: dict[str, Sequence[str]]) -> DataFrame:
    """One row per candidate key: rows, distinct keys, keys seen more than once,
    the largest group and whether the key is unique.

    Each candidate is one pruned scan and one aggregation by its own columns, combined map-side: rows are not multiplied
    by candidates, and no shuffled row carries another candidate's columns."""
    out = None
    for name, keys in candidates.items():
        part = count_by(df, keys, "n").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
            F.count(F.when(F.col("n") > 1, F.lit(1))).alias("dup_keys"), F.max("n").alias("max_rows"))
        part = part.select(F.lit(name).alias("candidate"), F.lit(",".join(keys)).alias("key_columns"), "rows", "distinct_keys",
                           "dup_keys", "max_rows", (F.col("dup_keys") == 0).cast("int").alias("is_unique"))
        out = part if out is None else out.unionByName(part)
    return out


def frequent_groups(df: DataFrame, keys: Sequence[str], n: int = 20, tracked: int = 1 << 16) -> tuple[DataFrame, bool]:
    """``grain_top`` with few shuffled groups where that can be proved, and whether it was.

    A mergeable frequent-items sketch of key hashes (one narrow pass, fixed size) proposes groups, which are counted
    exactly. A group that the sketch did not propose has at most the largest of twice the sketch's error (3.5 / ``tracked``
    of the rows) and its smallest proposal's estimate. If the n-th exact count is above that, the proposals hold the whole
    answer, ties included; if not (few frequent groups, or many ties), every group is counted as in ``grain_top``."""
    key = F.xxhash64(*keys)
    most = 8 * n
    sketch = df.select(key.alias("k")).agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(k, {most}, {tracked})").alias("top")).first()
    top = sketch.top or []
    bound = max(2 * 3.5 / tracked * sketch["rows"], min((t["count"] for t in top), default=0) if len(top) == most else 0)
    few = grain_top(df.where(key.isin([t["item"] for t in top])), keys, n) if top else None
    counts = [r.row_count for r in few.select("row_count").collect()] if top else []
    if len(counts) == n and counts[-1] > bound:
        return few, True
    return grain_top(df, keys, n), False


def step_counts(steps: Sequence[tuple[str, DataFrame]], by: str = "state_code") -> DataFrame:
    """Rows per ``by`` value for each named intermediate, stacked."""
    out = None
    for name, df in steps:
        part = df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("step"), F.col(by), "row_count")
        out = part if out is None else out.unionByName(part)
    return out
