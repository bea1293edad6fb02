"""Joins that respect grain: audited before they run.

``audit`` and ``audit_steps`` answer "how many rows will this join produce, and why"
from per-key counts on each side (sum over keys of left_count * right_count), so the
exploded join is never materialised and a hot key is a single pre-aggregated row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OnSpec = Sequence[str] | Sequence[tuple[str, str]]


def _pairs(on: OnSpec) -> list[tuple[str, str]]:
    if isinstance(on, str):
        on = [on]
    pairs = [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]
    if not pairs:
        # Spark runs a join without a condition as a cartesian product; refuse it.
        raise ValueError("join keys are required: an empty 'on' would be a cross join")
    return pairs


def join(left: DataFrame, right: DataFrame, on: OnSpec, how: str = "inner") -> DataFrame:
    """Equi-join on named keys; same-named keys are merged into one column."""
    pairs = _pairs(on)
    if all(a == b for a, b in pairs):
        return left.join(right, [a for a, _ in pairs], how)
    cond = None
    for a, b in pairs:
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def _count_join(left: DataFrame, right: DataFrame, on: OnSpec,
                lconds: Sequence[Column] = (), rconds: Sequence[Column] = ()) -> DataFrame:
    """Per join key: ``cl`` left rows, ``cr`` right rows (NULL when a side has none),
    plus conditional counts ``cl_i`` / ``cr_i``, as if the two per-key count tables
    were full-outer joined, but computed in one tagged aggregation (one shuffle,
    combined map-side). Rows with a NULL key never match, as in the join itself: they
    are grouped per side so they can only count as unmatched."""
    pairs = _pairs(on)
    keys = [f"k{i}" for i in range(len(pairs))]
    one, zero = F.lit(1), F.lit(0)

    def side(df: DataFrame, cols: list[str], is_left: bool) -> DataFrame:
        mine, other = (lconds, rconds) if is_left else (rconds, lconds)
        flags = [F.when(c, one).otherwise(zero) for c in mine]
        pad = [zero for _ in other]
        lflags, rflags = (flags, pad) if is_left else (pad, flags)
        return df.select(*[F.col(c).alias(k) for c, k in zip(cols, keys)],
                         (one if is_left else zero).alias("_l"),
                         (zero if is_left else one).alias("_r"),
                         *[f.alias(f"_l{i}") for i, f in enumerate(lflags)],
                         *[f.alias(f"_r{i}") for i, f in enumerate(rflags)])

    u = side(left, [a for a, _ in pairs], True).unionByName(
        side(right, [b for _, b in pairs], False))
    null_key = None
    for k in keys:
        c = F.col(k).isNull()
        null_key = c if null_key is None else null_key | c
    sep = F.when(null_key, F.col("_l")).otherwise(zero)
    g = u.groupBy(*keys, sep.alias("__sep")).agg(
        F.sum("_l").alias("cl"), F.sum("_r").alias("cr"),
        *[F.sum(f"_l{i}").alias(f"cl_{i}") for i in range(len(lconds))],
        *[F.sum(f"_r{i}").alias(f"cr_{i}") for i in range(len(rconds))])
    return g.select(*keys, F.nullif("cl", zero).alias("cl"), F.nullif("cr", zero).alias("cr"),
                    *[f"cl_{i}" for i in range(len(lconds))],
                    *[f"cr_{i}" for i in range(len(rconds))])


def audit(left: DataFrame, right: DataFrame, on: OnSpec) -> DataFrame:
    """One row: left_rows, right_rows, joined_rows (inner), fanout = joined/left,
    left_unmatched, right_unmatched, max_right_dups (the largest number of right rows
    one matched left key meets)."""
    j = _count_join(left, right, on)
    cl, cr = F.col("cl"), F.col("cr")
    out = j.agg(
        F.coalesce(F.sum(cl), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(cr), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(cl * cr), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.sum(F.when(cr.isNull(), cl)), F.lit(0)).alias("left_unmatched"),
        F.coalesce(F.sum(F.when(cl.isNull(), cr)), F.lit(0)).alias("right_unmatched"),
        F.max(F.when(cl.isNotNull(), cr)).alias("max_right_dups"))
    return out.select("left_rows", "right_rows", "joined_rows",
                      F.round(F.col("joined_rows") / F.col("left_rows"), 6).alias("fanout"),
                      "left_unmatched", "right_unmatched", "max_right_dups")


def audit_steps(left: DataFrame, right: DataFrame, on: OnSpec,
                steps: Sequence[tuple[str, Column | None, Column | None]]) -> DataFrame:
    """Joined row count after each cumulative filter step, in one pass per side.

    A step is ``(name, left_predicate, right_predicate)``; step i applies the
    predicates of steps 0..i. Counts come from conditional per-key counts, so the
    result equals counting the filtered join without running it.
    """
    lconds, rconds = [], []
    lacc = racc = F.lit(True)
    for _, lp, rp in steps:
        lacc = lacc if lp is None else lacc & lp
        racc = racc if rp is None else racc & rp
        lconds.append(lacc)
        rconds.append(racc)
    j = _count_join(left, right, on, lconds, rconds)
    sums = [F.coalesce(F.sum(F.col(f"cl_{i}") * F.col(f"cr_{i}")), F.lit(0)).alias(f"s{i}")
            for i in range(len(steps))]
    wide = j.agg(*sums)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                 F.col(f"s{i}").alias("joined_rows"))
        for i, (name, _, _) in enumerate(steps)]))
    return wide.select(stacked.alias("s")).select("s.*")


def _size_sketch(df: DataFrame, cols: Sequence[str], width: int, rows: int) -> DataFrame:
    """bucket, s0 .. s<rows-1>: per bucket of key hashes, the sums of independent random signs of the keys."""
    t = df.select(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(cols)]).na.drop()
    keys = [f"k{i}" for i in range(len(cols))]
    # one hash deals keys out over buckets; the bits of another are their signs
    t = t.select(F.pmod(F.xxhash64(F.lit("bucket"), *keys), F.lit(width)).alias("bucket"), F.xxhash64(F.lit("sign"), *keys).alias("h"))
    sign = lambda i: F.when(F.shiftrightunsigned("h", 2 * i + 1).bitwiseAND(1) == 1, 1).otherwise(-1)
    return t.groupBy("bucket").agg(*[F.sum(sign(i)).alias(f"s{i}") for i in range(rows)])


def estimate_size(left: DataFrame, right: DataFrame, on: OnSpec, width: int = 1 << 16, rows: int = 5) -> DataFrame:
    """One row: the estimated number of rows of the inner join, and a bound of the estimate's error (about four standard
    deviations), from join-size sketches.

    Each side becomes ``width`` buckets of signed counts in one narrow pass: a task sends at most that many short rows,
    however many keys there are, where ``audit`` shuffles a row for every key. Products of the two sides' counts,
    summed over buckets, estimate the size for each of ``rows`` sets of signs; their median is taken. The error falls with
    the root of ``width`` and grows with both sides' own repetition. Keys are compared as text; NULL keys never match."""
    pairs = _pairs(on)
    a = _size_sketch(left, [x for x, _ in pairs], width, rows)
    b = _size_sketch(right, [y for _, y in pairs], width, rows).select("bucket", *[F.col(f"s{i}").alias(f"t{i}") for i in range(rows)])
    both = a.join(b, "bucket", "full")

    def middle(of) -> Column:
        each = [F.coalesce(F.sum(of(i)), F.lit(0.0)) for i in range(rows)]
        return F.sort_array(F.array(*each))[rows // 2]

    s, t = (lambda i: F.col(f"s{i}").cast("double")), (lambda i: F.col(f"t{i}").cast("double"))
    out = both.agg(middle(lambda i: s(i) * t(i)).alias("size"), middle(lambda i: s(i) * s(i)).alias("left"),
                   middle(lambda i: t(i) * t(i)).alias("right"))
    return out.select(F.greatest(F.lit(0), F.round("size")).cast("bigint").alias("estimated_rows"),
                      F.ceil(4 * F.sqrt(2 * F.col("left") * F.col("right") / width)).cast("bigint").alias("error_bound"))


def key_overlap(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """Shape of two join keys: distinct values on each side, in a only / b only / both,
    and the key lengths seen (a mismatch in format shows up here first).

    Both sides' keys are tagged and grouped once (deduplicated map-side), so the
    overlap costs one shuffle rather than two distincts and a full outer join.
    """
    one, zero = F.lit(1), F.lit(0)
    ka = a.select(F.col(a_key).cast("string").alias("k"), one.alias("in_a"), zero.alias("in_b"))
    kb = b.select(F.col(b_key).cast("string").alias("k"), zero.alias("in_a"), one.alias("in_b"))
    keys = (ka.unionByName(kb).where(F.col("k").isNotNull()).groupBy("k")
            .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b")))
    in_a, in_b, length = F.col("in_a") == 1, F.col("in_b") == 1, F.length("k")
    return keys.agg(
        F.count(F.when(in_a, one)).alias("a_keys"), F.count(F.when(in_b, one)).alias("b_keys"),
        F.count(F.when(in_a & ~in_b, one)).alias("a_only"),
        F.count(F.when(in_b & ~in_a, one)).alias("b_only"),
        F.count(F.when(in_a & in_b, one)).alias("both"),
        F.min(F.when(in_a, length)).cast("bigint").alias("a_min_len"),
        F.max(F.when(in_a, length)).cast("bigint").alias("a_max_len"),
        F.min(F.when(in_b, length)).cast("bigint").alias("b_min_len"),
        F.max(F.when(in_b, length)).cast("bigint").alias("b_max_len"))


def left_lookup(df: DataFrame, dim: DataFrame, on: OnSpec, bounded: bool = False) -> DataFrame:
    """Left join to a lookup. ``bounded=True`` asserts the lookup has a size bound that
    does not grow with the data (states, counties) and broadcasts it; otherwise AQE
    decides at run time from the materialised size, falling back to a shuffle join."""
    return join(df, F.broadcast(dim) if bounded else dim, on, "left")


def unmatched(left: DataFrame, right: DataFrame, on: OnSpec, value_col: str) -> DataFrame:
    """Rows whose looked-up ``value_col`` IS NULL after a left join: both left rows with
    no partner and rows whose partner holds NULL (not a plain anti-join)."""
    return join(left, right, on, "left").where(F.col(value_col).isNull())


def anti(left: DataFrame, right: DataFrame, on: OnSpec) -> DataFrame:
    """Left rows with no partner at all."""
    return join(left, right, on, "left_anti")


def key_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.xxhash64(*[df[c] for c in cols])


def heavy_hitters(df: DataFrame, cols: Sequence[str], share: float = 0.01, tracked: int = 8192) -> list[int]:
    """``xxhash64`` of the keys that hold at least ``share`` of the rows, hottest first (at most 1 / share of them).

    One narrow pass with a mergeable frequent-items sketch, whose size does not grow with the number of keys: its counts
    are too high by at most 3.5 / ``tracked`` of the rows, so no such key is missed.
    """
    if not 3.5 / tracked < share <= 1:
        raise ValueError("share must be above the sketch's error, 3.5 / tracked, and at most 1")
    most = int(1 / (share - 3.5 / tracked)) + 1
    row = df.select(key_hash(df, cols).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {tracked})").alias("top")).first()
    return [t["item"] for t in row.top or () if t["count"] >= share * row.n]


def skew_join(big: DataFrame, small: DataFrame, on: OnSpec, how: str = "inner",
              buckets: int = 32, hot: Sequence[int] | None = None) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big``, and only those, over ``buckets`` tasks.

    ``hot``: key hashes as ``heavy_hitters`` gives them; by default they are learned from ``big`` (one narrow job).
    Rows of ``big`` with a hot key get a salt from a hash of the row and its input partition, deterministic under retries;
    rows of ``small`` with a hot key are repeated once per salt. All other rows join as ever: ``small`` grows by at most
    buckets / share rows for each of its rows per key, not ``buckets``-fold. ``how`` is ``inner`` or ``left`` (``big`` is
    the left side); rows with NULL keys are spread like others. Without a hot key this is the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins with the big side on the left")
    pairs = _pairs(on)
    # a hash tells the type, too: only columns of equal types on both sides are hashed
    same = [(a, b) for a, b in pairs if big.schema[a].dataType == small.schema[b].dataType]
    if not same:
        raise ValueError("skew_join needs a key column of one type on both sides")
    mine, theirs = [a for a, _ in same], [b for _, b in same]
    hot = heavy_hitters(big, mine) if hot is None else list(hot)
    if not hot:
        return join(big, small, on, how)
    salt = F.pmod(F.xxhash64(*big.columns, F.spark_partition_id()), F.lit(buckets)).cast("int")
    b = big.withColumn("__salt", F.when(key_hash(big, mine).isin(hot), salt).otherwise(F.lit(0)))
    s = small.withColumn("__salt", F.explode(F.when(key_hash(small, theirs).isin(hot), F.sequence(F.lit(0), F.lit(buckets - 1)))
                                             .otherwise(F.array(F.lit(0)))))
    return join(b, s, [*pairs, ("__salt", "__salt")], how).drop("__salt")
