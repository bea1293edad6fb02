"""Group minimum, rank flags, row numbers and n-th rows.

Two ways, by what is asked for, never by the size of the data:

* aggregates (minimum, rank 1/2 flags and the first row): per-group
  statistics from ``groupBy`` aggregations, joined back on the group key. Aggregations
  combine on the map side, so a group holding a third of all rows is one
  pre-aggregated row per task, not one giant task; the join back is broadcast by AQE
  when the per-group table is small and otherwise a shuffle join with skew splitting.
* windows: over pre-aggregated counts (``rank_by_counts``), inside cells of a group that learned splitters
  cut (``split_row_numbers``), or trimmed to n rows per map task (``nth_row``, WindowGroupLimit), so that
  no window task holds a whole hot group of rows.

Ordering is always ascending with NULLs last (a NULL rate never wins), matching the
PostgreSQL default the analyses were written for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a group that one window task may hold before learned splitters cut the group.
CELL_ROWS = 1_000_000
#: Bounds of the sketch that the splitters are learned from: sampled rows in all, and sampled rows of a cell at least.
MOST_SAMPLE, CELL_SAMPLE = 1_000_000, 32


def _null_safe_join(df: DataFrame, stats: DataFrame, keys: Sequence[str],
                    bounded: bool = False) -> DataFrame:
    """Left join of rows to a per-group table on NULL-safe keys. ``bounded``: the caller
    knows the number of groups has a fixed bound (e.g. geography x metal level), so
    the per-group side is broadcast from the start instead of after a shuffle."""
    renamed = stats.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                           *[c for c in stats.columns if c not in keys])
    if bounded:
        renamed = F.broadcast(renamed)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(renamed[f"__k_{k}"])
        cond = c if cond is None else cond & c
    out = df.join(renamed, cond, "left")
    return out.drop(*[f"__k_{k}" for k in keys])


def with_group_min(df: DataFrame, keys: Sequence[str], val: str, out: str,
                   method: str = "aggregate", groups_bounded: bool = False) -> DataFrame:
    """``MIN(val) OVER (PARTITION BY keys)`` on every row."""
    if method == "window":
        return df.withColumn(out, F.min(val).over(Window.partitionBy(*keys)))
    stats = df.groupBy(*keys).agg(F.min(val).alias(out))
    return _null_safe_join(df, stats, keys, groups_bounded)


def rank_stats(df: DataFrame, keys: Sequence[str], val: str,
               groups_bounded: bool = False) -> DataFrame:
    """Per group: ``m1`` smallest value, ``c1`` rows at it, ``m2`` next distinct value.
    Two partial aggregations and one join; enough to decide RANK/DENSE_RANK 1 and 2."""
    g1 = df.groupBy(*keys).agg(F.min(val).alias("__m1"))
    j = _null_safe_join(df.select(*keys, val), g1, keys, groups_bounded)
    v, m1 = F.col(val), F.col("__m1")
    return j.groupBy(*keys).agg(
        F.min(m1).alias("__m1"),
        F.count(F.when(v == m1, F.lit(1))).alias("__c1"),
        F.min(F.when(v > m1, v)).alias("__m2"))


def _rank_is(v: Column, n: int, method: str) -> Column:
    m1, c1, m2 = F.col("__m1"), F.col("__c1"), F.col("__m2")
    if n == 1:
        # all-NULL group: every row ties at rank 1
        return v.eqNullSafe(m1)
    second = (m2.isNotNull() & (v == m2)) | (m2.isNull() & v.isNull())
    if method == "rank":
        return m1.isNotNull() & (c1 == 1) & second
    return m1.isNotNull() & second                       # dense_rank


def flag_rank(df: DataFrame, keys: Sequence[str], val: str, n: int, out: str,
              method: str = "rank", where: Column | None = None,
              order_tiebreak: Sequence[str] = (), groups_bounded: bool = False) -> DataFrame:
    """``CASE WHEN <method>() OVER (PARTITION BY keys ORDER BY val) = n [AND where]
    THEN 1 ELSE 0 END`` as column ``out``.

    ``rank``/``dense_rank`` with n in (1, 2) use group statistics (skew-safe); other
    cases use a window, with ``order_tiebreak`` appended for ``row_number``.
    """
    cond_extra = F.lit(True) if where is None else where
    if method in ("rank", "dense_rank") and n in (1, 2):
        stats = rank_stats(df, keys, val, groups_bounded)
        j = _null_safe_join(df, stats, keys, groups_bounded)
        flag = F.when(F.coalesce(_rank_is(F.col(val), n, method), F.lit(False)) & cond_extra,
                      F.lit(1)).otherwise(F.lit(0))
        return j.withColumn(out, flag).drop("__m1", "__c1", "__m2")
    order = [F.col(val).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in order_tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    flag = F.when((fn().over(w) == n) & cond_extra, F.lit(1)).otherwise(F.lit(0))
    return df.withColumn(out, flag)


def rank_flags(df: DataFrame, keys: Sequence[str], val: str, min_out: str | None = None,
               flags: Sequence[tuple[str, int, str, Column | None]] = (),
               groups_bounded: bool = False) -> DataFrame:
    """Group minimum and several RANK/DENSE_RANK = 1/2 flags from one set of group
    statistics (two partial aggregations) and a single join back to the rows.

    ``flags`` holds ``(out, n, method, where)`` with n in (1, 2) and method ``rank``
    or ``dense_rank``; ``where`` is an extra row condition (e.g. metal = Silver).
    """
    stats = rank_stats(df, keys, val, groups_bounded)
    j = _null_safe_join(df, stats, keys, groups_bounded)
    if min_out:
        j = j.withColumn(min_out, F.col("__m1"))
    for out, n, method, where in flags:
        if n not in (1, 2) or method not in ("rank", "dense_rank"):
            raise ValueError("rank_flags handles rank/dense_rank = 1 or 2; use flag_rank")
        cond = F.coalesce(_rank_is(F.col(val), n, method), F.lit(False))
        if where is not None:
            cond = cond & where
        j = j.withColumn(out, F.when(cond, F.lit(1)).otherwise(F.lit(0)))
    return j.drop("__m1", "__c1", "__m2")


def rank_by_counts(df: DataFrame, keys: Sequence[str], val: str, rank_out: str | None = None,
                   dense_out: str | None = None, groups_bounded: bool = False) -> DataFrame:
    """``RANK()`` and ``DENSE_RANK()`` over (keys ORDER BY val, NULLs last) on every row, from counts per
    distinct value: the window runs over one row a (group, value), never over a group's rows, so a value
    or group with a third of all rows is one pre-aggregated row per task."""
    sizes = df.groupBy(*keys, val).agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(*keys).orderBy(F.col(val).asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, val, (F.coalesce(F.sum("__n").over(before), F.lit(0)) + 1).alias("__rank"),
                         F.row_number().over(order).cast("bigint").alias("__dense"))
    out = _null_safe_join(df, sizes, [*keys, val], groups_bounded)
    for name, have in ((rank_out, "__rank"), (dense_out, "__dense")):
        if name:
            out = out.withColumn(name, F.col(have))
    return out.drop("__rank", "__dense")


def order_struct(order: Sequence[str], payload: Sequence[str]) -> Column:
    """A struct whose natural ordering is ``order`` ascending with NULLs last."""
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"__n{i}"), F.col(c).alias(f"__o{i}")]
    fields += [F.col(c).alias(c) for c in payload]
    return F.struct(*fields)


def nth_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
            payload: Sequence[str]) -> DataFrame:
    """The n-th row of each group under ``order`` (ascending, NULLs last; make the order
    unique for a deterministic answer), as ``keys + payload`` columns.

    n = 1 is a ``min(struct)`` aggregation (map-side combined: a hot group costs nothing extra); larger n
    uses a row_number window with the limit adjacent, which Spark trims to n rows per group and map task.
    """
    if n == 1:
        first = df.groupBy(*keys).agg(F.min(order_struct(order, payload)).alias("__s"))
        return first.select(*keys, *[F.col(f"__s.{c}").alias(c) for c in payload])
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == n)
            .select(*keys, *payload))


def learn_splitters(df: DataFrame, keys: Sequence[str], order: Sequence[str], cell_rows: int,
                    most_sample: int = MOST_SAMPLE) -> DataFrame | None:
    """Where to cut groups with more than about ``cell_rows`` rows: ``keys`` and ``__cuts``, the ascending first
    order keys of all cells but the first. None if no group needs a cut.

    The sketch is a threshold sample: the rows whose hash of the order columns is small, the same ones on every run and
    mergeable over partitions. Every group's sample holds the same share of its rows, so each k-th sampled row in order
    is a quantile of the group, whatever columns make the order and however many rows tie in the first of them. Up to three
    short jobs: a count (from footers, if ``df`` is a stored table), the groups' sizes, and, only if one is above
    ``cell_rows``, one pass over the keys and order columns. At most about
    ``most_sample`` rows are sampled, so the cuts have a fixed bound; beyond it cells grow with the table.
    """
    rows = df.count()
    if rows <= cell_rows or df.groupBy(*keys).count().agg(F.max("count")).first()[0] <= cell_rows:
        return None
    share = min(1.0, most_sample / rows)
    # sampled rows of a cell; with few of them cells would vary too much in size
    each = max(int(cell_rows * share), CELL_SAMPLE if share < 1 else 1)
    place = F.pmod(F.xxhash64(F.lit(17), *order), F.lit(1 << 30))
    sample = df.select(*keys, order_struct(order, ()).alias("__o")).where(place < F.lit(int(share * (1 << 30))))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__o"))
    # the group's first sampled row of every cell but the first
    cuts = (sample.withColumn("__n", nth).where((F.col("__n") > each) & (F.col("__n") % each == (1 % each)))
            .groupBy(*keys).agg(F.sort_array(F.collect_list("__o")).alias("__cuts")))
    found = cuts.collect()
    return df.sparkSession.createDataFrame(found, cuts.schema) if found else None


#: With at most so many cuts a group, they are compared one after another.
FEW_CUTS = 16


def _cell(cuts: Column, here: Column, most: int) -> Column:
    """How many of a group's ascending cuts (at most ``most``) are at or below ``here``: of few all are compared, of more
    a binary search is done, in as many steps as ``most`` cuts need."""
    def place(mine: Column) -> Column:
        if most <= FEW_CUTS:
            return F.size(F.filter(cuts, lambda cut: cut <= mine))

        def step(at: Column, _: Column) -> Column:
            middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
            below = F.get(cuts, middle) <= mine
            return F.when(at["lo"] >= at["hi"], at).otherwise(F.struct(
                F.when(below, middle + 1).otherwise(at["lo"]).cast("int").alias("lo"),
                F.when(below, at["hi"]).otherwise(middle).cast("int").alias("hi")))

        start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(most.bit_length())), start, step)["lo"]

    # ``here`` is made once a row, not once a comparison
    return F.when(cuts.isNull(), F.lit(0)).otherwise(F.transform(F.array(here), place)[0])


def split_row_numbers(df: DataFrame, outs: Mapping[str, Sequence[str]], order: Sequence[str],
                      cell_rows: int = CELL_ROWS, most_sample: int = MOST_SAMPLE) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` for each ``out -> keys`` of ``outs`` (ascending,
    NULLs last; make the order unique), with groups above ``cell_rows`` rows cut into cells of the whole order.

    ``df`` is read more than once: give a stored table. The first entry's keys must be among every other's; its groups
    are cut by learned splitters, so a group with a third of all rows spreads over many tasks even if all of them tie in
    the first order column. Rows are numbered inside (keys, cell), from the rows of the group's lower cells on: prefix sums
    over one pre-aggregated row a (group, cell), of cut groups only, that join the rows as marks in front of their cell. So
    the rows are shuffled once: all windows share one exchange, and no join follows.
    """
    first = list(next(iter(outs.values())))
    if any(not set(first) <= set(keys) for keys in outs.values()):
        raise ValueError("the first entry's keys must be among every other entry's")
    order_cols = [F.col(c).asc_nulls_last() for c in order]
    splitters = learn_splitters(df, first, order, cell_rows, most_sample)
    if splitters is None:
        for name, keys in outs.items():
            w = Window.partitionBy(*keys).orderBy(*order_cols)
            df = df.withColumn(name, F.row_number().over(w).cast("bigint"))
        return df
    most = splitters.agg(F.max(F.size("__cuts"))).first()[0]
    # the cuts have a fixed bound (MOST_SAMPLE / CELL_SAMPLE)
    cells = _null_safe_join(df, splitters, first, bounded=True).withColumn(
        "__cell", _cell(F.col("__cuts"), order_struct(order, ()), most)).withColumn("__cut", F.col("__cuts").isNotNull()).drop("__cuts")
    # the rows of all (keys, cell) at the finest grain, counted in one pass
    finest = list(dict.fromkeys(k for keys in outs.values() for k in keys))
    sizes = cells.where("__cut").groupBy(*finest, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    out = cells.drop("__cut").withColumn("__mark", F.lit(None).cast("int")).withColumn("__lower", F.lit(None).cast("bigint"))
    for i, keys in enumerate(outs.values()):
        mine = sizes if set(keys) == set(finest) else sizes.groupBy(*keys, "__cell").agg(F.sum("__n").alias("__n"))
        lower = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
        marks = mine.select(*keys, "__cell", F.lit(i).alias("__mark"), F.sum("__n").over(lower).alias("__lower"))
        out = out.unionByName(marks.where(F.col("__lower") > 0), allowMissingColumns=True)
    for i, (name, keys) in enumerate(outs.items()):
        # a cell's own mark, its rows, the marks of other entries
        place = F.when(F.col("__mark") == i, F.lit(0)).when(F.col("__mark").isNull(), F.lit(1)).otherwise(F.lit(2))
        w = Window.partitionBy(*keys, "__cell").orderBy(place, *order_cols)
        # the mark takes a number itself
        start = F.first(F.when(F.col("__mark") == i, F.col("__lower") - 1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out = out.withColumn(name, F.row_number().over(w).cast("bigint") + F.coalesce(start, F.lit(0)))
    return out.where(F.col("__mark").isNull()).drop("__cell", "__mark", "__lower")
