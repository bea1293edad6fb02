"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key. Documents are range-sorted by it within their source: the key space is cut
into equal ranges, so even one source with a third of all rows is ordered by as many tasks as it has ranges. Prefix
sums of the word counts are then distributed: one sum per (source, range), a running total over those few sums, and
a running total inside each range. A source's budget cuts its sequence at the exact word. A budget above the source's
size takes the whole sequence first (an epoch) and cuts the repeated sequence at what is left.

Targets: each source's share of the total is proportional to its weight, at most ``most_epochs`` times its own size;
what a full source cannot take is shared among the others by weight. That is water-filling, solved by one sort of the
sources by (limit / weight).

Defined results. Null or empty text: size 0, taken 0. Null source: a source of its own, after all others. Rows with
the same id and text are interchangeable; ties of the key are broken by id and text hash. Empty table: no rows. Other
columns are carried along untouched (own columns named like results give way; ``__mix`` names are reserved). Only the per-source table (one row
a source) is ordered by one task; it is an aggregate, and a corpus has far fewer sources than documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Ranges of the random key per source; a range is what one task orders at a time.
KEY_RANGES = 4096


def word_count(text: Column) -> Column:
    """Words of the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most_epochs: int) -> DataFrame:
    """``sizes``: source, source_size. Adds ``target`` (double). Sources by code point, null last, take the weights in turn."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("__mix_w", weight).withColumn("__mix_cap", (F.col("source_size") * most_epochs).cast("double"))
         .withColumn("__mix_fill", F.col("__mix_cap") / F.col("__mix_w")))
    fill = Window.orderBy("__mix_fill", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the level at which this source and all that fill later would share what the earlier ones leave
    left = F.sum("source_size").over(every) * share - F.coalesce(F.sum("__mix_cap").over(before), F.lit(0.0))
    weight_left = F.sum("__mix_w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("__mix_level", left / weight_left)
    # the first source that does not fill fixes the level (what later ones would get without it is less)
    level = F.max(F.when(F.col("__mix_level") <= F.col("__mix_fill"), F.col("__mix_level"))).over(every)
    full = F.col("__mix_level") > F.col("__mix_fill")
    target = F.when(full, F.col("__mix_cap")).otherwise(F.coalesce(F.least("__mix_cap", F.col("__mix_w") * level), F.lit(0.0)))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most_epochs: int = 2,
        seed: int = 0) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, source at least), with size, source_size, target and taken.

    ``taken``: words that the mix takes from the document, repeats counted; the document at which the budget ends
    gives its first words only, so that a source's taken words are its target, rounded."""
    docs = docs.drop("size", "source_size", "target", "taken")
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest))
    # one non-null name per source, so that the window and the join below share one partitioning
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    d = docs.withColumn("size", word_count(F.col("text"))).withColumn("__mix_key", key).withColumn("__mix_source", name)
    sizes = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, share, most_epochs).withColumn("__mix_budget", F.round("target").cast("long"))
    bits = (KEY_RANGES - 1).bit_length()
    d = d.withColumn("__mix_range", F.shiftright(F.conv(F.substring("__mix_key", 1, 8), 16, 10).cast("long"), 32 - bits))
    ranges = d.groupBy("__mix_source", "__mix_range").agg(F.sum("size").alias("__mix_sum"))
    ahead = Window.partitionBy("__mix_source").orderBy("__mix_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__mix_ahead", F.coalesce(F.sum("__mix_sum").over(ahead), F.lit(0))).drop("__mix_sum")
    ranges = ranges.join(plan.withColumn("__mix_source", name).drop("source"), "__mix_source")
    inside = (Window.partitionBy("__mix_source", "__mix_range").orderBy("__mix_key", "doc_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__mix_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(ranges, ["__mix_source", "__mix_range"])
    start = F.col("__mix_ahead") + F.col("__mix_inside")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), F.col("__mix_budget") - F.col("source_size") * e - start))
                 for e in range(most_epochs)), F.lit(0))
    return d.withColumn("taken", taken.cast("long")).drop(*[c for c in d.columns if c.startswith("__mix")])


def materialise(mixed: DataFrame, columns: Sequence[str], most_epochs: int = 2) -> DataFrame:
    """The mixed corpus itself: each document once for every epoch that takes at least half of its words."""
    passes = F.least(F.lit(most_epochs), F.when(F.col("size") > 0, F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))))
                     .otherwise(F.lit(0))).cast("int")
    return (mixed.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), passes))).select(*columns))


#: The same result for the query ``op5_mixing`` in DuckDB SQL.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM per_source),
leveled AS (
  SELECT a.source, a.source_size, a.cap, a.w,
         (SELECT 1.5 * sum(source_size) FROM per_source) AS total,
         (SELECT coalesce(sum(b.cap), 0) FROM weighed b WHERE b.cap / b.w < a.cap / a.w) AS full_before,
         (SELECT sum(b.w) FROM weighed b WHERE b.cap / b.w >= a.cap / a.w) AS open_weight
  FROM weighed a),
level AS (SELECT max((total - full_before) / open_weight) FILTER ((total - full_before) / open_weight <= cap / w) AS lv FROM leveled),
goal AS (SELECT source, source_size, least(cap, w * (SELECT lv FROM level))::DOUBLE AS target FROM weighed),
placed AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized)
SELECT p.doc_id, p.size, g.source_size, g.target,
       (greatest(0, least(p.size, round(g.target) - p.ahead)) + greatest(0, least(p.size, round(g.target) - g.source_size - p.ahead)))::BIGINT AS taken
FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
"""
