"""The plan landscape: one row per plan x county with rank, benchmark and parent.

Steps (each a function, DataFrame in / DataFrame out):

  X0 fips_ra        distinct county -> rating-area lookup
  X1 sa_expanded    service areas expanded to counties (operators.coverage)
  X2 summary        rates -> plan attributes -> service areas -> county map; age 21,
                    base variants, individual market, parameters as literals
  X3 ranking        metal_rank and issuer_rank row numbers (one exchange for both)
                    from here on steps read X2's stored rows
  X4 min_metal      cheapest plan per county and metal level
  X5 slcsp          second-lowest Silver rate per county (the benchmark)
  X6 diffs          every ranked row with its distance to X4 and X5
  X7 overall_rank   each issuer's cheapest plan ranked across issuers, + enrollment
                    (the winners, with their enrollment, are stored before they are ranked)
  X8 landscape      X3 joined to X7, X0 and the parent-company map: 21 columns

``business_year`` is part of every partition and join key, so the same code builds
one year or all years and states in one pass. Row numbers order by rate (NULLs last)
then by ``tie_break`` columns, which must make the order unique.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import coverage, joins, lookups
from ..operators import rank as rank_op
from ..sources import sink
from ..sources.steps import Steps
from .params import Params

RATE = "individual_rate"
ISSUER_NAME = "issuer_market_place_marketing_name"
# The filters that define the landscape population.
AGE = "21"
MARKET = "Individual"
BENCHMARK_METAL = "Silver"

FINAL_COLUMNS = [
    "business_year", "state_code", "issuer_id", "issuer_market_place_marketing_name",
    "plan_id", "plan_marketing_name", "plan_type", "metal_level", "individual_rate",
    "deductible", "oopm", "county", "fips", "metal_rank", "issuer_rank",
    "issuer_overall_rank", "issuer_avg_enrollment", "rating_area", "company_name",
    "parent_name", "year"]


@dataclass
class Inputs:
    """The source tables: years are int and FIPS padded; enrollment is still text (Options.enrollment)."""
    rate: DataFrame
    plan: DataFrame
    service_area: DataFrame
    counties: DataFrame          # usps, geoid
    county_map: DataFrame        # fips, county, rating_area
    zip_rating_area: DataFrame   # fips, state, rate_area (finer than county)
    enrollment: DataFrame        # issuer_hios_id, year, county_fips, avg_enrollment
    parent: DataFrame            # hios_issuer_id, company_name, parent_name


@dataclass
class Options:
    tie_break: Sequence[str] = ("plan_id", "row_key", "fips")
    # X7 ranks within (county, metal) as written; ("state_code", "county",
    # "metal_level") keeps same-named counties of different states apart.
    overall_keys: Sequence[str] = ("county", "metal_level")
    # Enrollment per issuer, year and county: "largest" parses the numbers (sentinel and malformed text
    # are NULL) and keeps the largest of duplicate rows; "as_written" joins the raw text rows, so that a
    # duplicate repeats an issuer's winner and shifts X7's ranks.
    enrollment: str = "largest"
    only_missing_enrollment: bool = False
    parent_name: str | None = None
    carry: Sequence[str] = field(default_factory=lambda: ["row_key"])
    # Groups with more rows than this are cut by learned splitters before they are numbered (operators.rank).
    cell_rows: int = rank_op.CELL_ROWS
    # Spread hot keys of X2's rate join over so many salts (operators.joins.skew_join); None leaves them to AQE.
    salt_buckets: int | None = None


def fips_ra(inp: Inputs) -> DataFrame:
    return lookups.distinct_lookup(inp.zip_rating_area, ["fips", "state", "rate_area"])


def sa_expanded(inp: Inputs, params: Params) -> DataFrame:
    # the county lookup's size is set by geography
    return coverage.expand(params.apply(inp.service_area), inp.counties, counties_bounded=True)


def summary(inp: Inputs, params: Params, opts: Options | None = None) -> DataFrame:
    opts = opts or Options()
    r = params.apply(inp.rate).where(F.col("age") == AGE)
    pl = (params.apply(inp.plan)
          .where(clean.is_base_variant("plan_id") & (F.col("market_coverage") == MARKET))
          .select(F.col("standard_component_id").alias("p_plan"),
                  F.col("business_year").alias("p_year"), F.col("state_code").alias("p_state"),
                  F.col("issuer_id").alias("p_issuer"), "service_area_id", ISSUER_NAME,
                  "plan_marketing_name", "plan_type", "metal_level",
                  clean.deductible_text("tehb_ded_inn_tier1_individual",
                                        "mehb_ded_inn_tier1_individual",
                                        "tehb_ded_inn_tier1_family_per_person").alias("deductible"),
                  clean.deductible_text("tehb_inn_tier1_individual_moop",
                                        "tehb_inn_tier1_family_per_person_moop").alias("oopm")))
    # one row per service area with its counties (a state's at most): a plan meets its rates as one row, not one a county
    sa = sa_expanded(inp, params).groupBy(
        F.col("business_year").alias("s_year"), F.col("state_code").alias("s_state"),
        F.col("issuer_id").alias("s_issuer"), F.col("service_area_id").alias("s_area")).agg(
        F.collect_list(clean.pad_fips("county")).alias("s_counties"))
    # County map: one row per county and rating area of the country: bounded.
    cm = F.broadcast(inp.county_map.select(F.col("fips").alias("c_fips"),
                                           F.col("county").alias("c_county"),
                                           F.col("rating_area").alias("c_area")))
    on_plan = [("plan_id", "p_plan"), ("business_year", "p_year"), ("state_code", "p_state"),
               ("issuer_id", "p_issuer")]
    # Plans meet their service areas first (both far smaller than the rate table), so the
    # rate table takes part in one keyed join only: a broadcast join, with no shuffle of
    # rates, when AQE measures the plan side as small; one shuffle otherwise. Counties are
    # spread after it, next to the broadcast county map.
    on_area = [("service_area_id", "s_area"), ("p_issuer", "s_issuer"), ("p_year", "s_year"),
               ("p_state", "s_state")]
    covered = joins.join(pl, sa, on_area)
    if opts.salt_buckets is None:
        j = joins.join(r, covered, on_plan)
    else:
        j = joins.skew_join(r, covered, on_plan, "inner", opts.salt_buckets)
    j = j.select("*", F.explode("s_counties").alias("s_fips")).drop("s_counties")
    j = j.join(cm, (cm.c_fips == F.col("s_fips")) & (cm.c_area == F.col("rating_area_id")))
    return j.select(
        "business_year", "state_code", "issuer_id", ISSUER_NAME, "plan_id",
        "plan_marketing_name", "plan_type",
        clean.map_values("metal_level", clean.METAL_LEVEL_MAP).alias("metal_level"),
        "age", "rating_area_id", RATE, "deductible", "oopm",
        F.col("c_fips").alias("fips"), F.col("c_county").alias("county"), *opts.carry)


RANK_KEYS = ["business_year", "state_code", "county", "metal_level"]


def ranking(summ: DataFrame, opts: Options | None = None) -> DataFrame:
    """metal_rank and issuer_rank of X2's rows (give them stored). Both row numbers share one exchange, as the issuer
    window's keys are a superset; groups above ``cell_rows`` rows are cut, so that no window task holds a hot one."""
    opts = opts or Options()
    return rank_op.split_row_numbers(
        summ, {"metal_rank": RANK_KEYS, "issuer_rank": [*RANK_KEYS, ISSUER_NAME]},
        [RATE, *opts.tie_break], opts.cell_rows)


def min_metal(rank: DataFrame) -> DataFrame:
    return rank.where(F.col("metal_rank") == 1).select(
        "business_year", "county", "state_code", "metal_level",
        F.col(ISSUER_NAME).alias("min_issuer"), F.col(RATE).alias("min_rate"))


def slcsp(rank: DataFrame) -> DataFrame:
    return rank.where((F.col("metal_rank") == 2) & (F.col("metal_level") == BENCHMARK_METAL)).select(
        "business_year", "county", "state_code", F.col(RATE).alias("slcsp_rate"))


def diffs(rank: DataFrame) -> DataFrame:
    # X4 and X5 hold one row per county, metal level and year: bounded by geography, so the ranked rows
    # are not shuffled on those few keys
    m = F.broadcast(min_metal(rank))
    s = F.broadcast(slcsp(rank))
    return (rank.join(m, ["business_year", "county", "state_code", "metal_level"])
            .join(s, ["business_year", "county", "state_code"], "left")
            .withColumn("diff_from_min", F.col(RATE) - F.col("min_rate"))
            .withColumn("diff_from_slcsp", F.col(RATE) - F.col("slcsp_rate"))
            .drop("min_rate", "slcsp_rate"))


def enrollment_by_key(enr: DataFrame, how: str = "largest") -> DataFrame:
    """``largest``: one numeric row per issuer, year and county (see Options.enrollment)."""
    e = enr.select("issuer_hios_id", "year", "county_fips", "avg_enrollment")
    if how == "as_written":
        return e
    if how != "largest":
        raise ValueError("enrollment is 'largest' or 'as_written'")
    return e.groupBy("issuer_hios_id", "year", "county_fips").agg(
        F.max(clean.parse_number("avg_enrollment")).alias("avg_enrollment"))


def winners(summ: DataFrame, opts: Options | None = None) -> DataFrame:
    """Each issuer's cheapest plan per county and metal level (issuer_rank 1): an aggregation of X2."""
    opts = opts or Options()
    return rank_op.nth_row(summ, [*RANK_KEYS, ISSUER_NAME], [RATE, *opts.tie_break], 1,
                           ["issuer_id", *opts.tie_break, RATE])


def entrants(best: DataFrame, inp: Inputs, opts: Options | None = None) -> DataFrame:
    """The rows that X7 ranks: winners (or those of a ranking, X3) with their enrollment."""
    opts = opts or Options()
    if "issuer_rank" in best.columns:
        best = best.where(F.col("issuer_rank") == 1)
    enr = enrollment_by_key(inp.enrollment, opts.enrollment)
    j = best.join(enr, (best.issuer_id == enr.issuer_hios_id)
                  & (best.business_year == enr.year)
                  & (enr.county_fips == best.fips), "left")
    return j.select("business_year", "state_code", "county", "metal_level", "issuer_id", "fips", RATE,
                    *[c for c in opts.tie_break if c != "fips"], "avg_enrollment")


def overall_rank(rows: DataFrame, opts: Options | None = None) -> DataFrame:
    """``rows``: the entrants (give them stored). The enrollment orders the copies that duplicate enrollment rows make of a
    winner. A (county name, metal level) with very many winners is cut like X3's groups."""
    opts = opts or Options()
    ranked = rank_op.split_row_numbers(rows, {"issuer_overall_rank": ["business_year", *opts.overall_keys]},
                                       [RATE, *opts.tie_break, "avg_enrollment"], opts.cell_rows)
    return ranked.select("business_year", "issuer_id", "fips", "metal_level",
                         "issuer_overall_rank",
                         F.col("avg_enrollment").alias("issuer_avg_monthly_enrollment"))


def final(rank: DataFrame, o: DataFrame, inp: Inputs, opts: Options | None = None) -> DataFrame:
    """``rank``: X3; ``o``: X7."""
    opts = opts or Options()
    # Counties x rating areas: bounded by geography.
    f = F.broadcast(fips_ra(inp).select(F.col("fips").alias("f_fips"),
                                        F.col("state").alias("f_state"), "rate_area"))
    pm = inp.parent.select("hios_issuer_id", "company_name", "parent_name")
    # parents meet X7's rows, which are fewer than X3's; X3's rows without a place in X0 end before they are shuffled
    o = o.join(pm, o.issuer_id == pm.hios_issuer_id, "left")
    place = (F.col("fips") == f.f_fips) & (F.col("state_code") == f.f_state)
    out = (rank.join(f, place, "left_semi")
           .join(o, ["business_year", "issuer_id", "fips", "metal_level"])
           .join(f, place))
    if opts.only_missing_enrollment:
        out = out.where(F.col("issuer_avg_monthly_enrollment").isNull())
    if opts.parent_name is not None:
        out = out.where(F.col("parent_name") == F.lit(opts.parent_name))
    return out.select(
        "business_year", "state_code", "issuer_id", ISSUER_NAME, "plan_id",
        "plan_marketing_name", "plan_type", "metal_level", RATE, "deductible", "oopm",
        "county", "fips", "metal_rank", "issuer_rank", "issuer_overall_rank",
        F.col("issuer_avg_monthly_enrollment").alias("issuer_avg_enrollment"),
        F.col("rate_area").alias("rating_area"), "company_name", "parent_name",
        F.col("business_year").alias("year"))


def standings(rank: DataFrame, opts: Options | None = None) -> DataFrame:
    """What X7 and X8 read of a ranking, to be stored: X8's columns, and the other order columns of the rows that X7 ranks."""
    opts = opts or Options()
    kept = ["business_year", "state_code", "issuer_id", ISSUER_NAME, "plan_id", "plan_marketing_name", "plan_type", "metal_level",
            RATE, "deductible", "oopm", "county", "fips", "metal_rank", "issuer_rank"]
    return rank.select(*kept, *[F.when(F.col("issuer_rank") == 1, F.col(c)).alias(c) for c in opts.tie_break if c not in kept])


class Landscape:
    """The chain's steps for one set of inputs and parameters::

        with Steps(spark) as steps:                                   # or Landscape(...).write(path)
            Landscape(inputs, Params(2024, "TX"), steps=steps).final().write.parquet(...)

    X2 is a step boundary: its rows are stored once, so the rate table is scanned and joined once however many steps
    follow, and a run that fails later goes on from there (``steps`` with the same run id). X7's entrants are stored,
    too. ``final`` also stores what X7 and X8 read of X3, so that X7's winners are picked from it and X2's rows are shuffled
    once. Frames read the stored rows; release the steps when they are done.
    """

    def __init__(self, inp: Inputs, params: Params, opts: Options | None = None, steps: Steps | None = None):
        self.inp, self.params, self.opts = inp, params, opts or Options()
        self.steps = steps or Steps(inp.rate.sparkSession)
        # a run may hold the steps of several parameters
        self._tag = hashlib.sha1(repr((params, self.opts)).encode()).hexdigest()[:12]

    def summary(self) -> DataFrame:
        return self.steps.table(f"summary-{self._tag}", lambda: summary(self.inp, self.params, self.opts))

    def ranking(self) -> DataFrame:
        return ranking(self.summary(), self.opts)

    def diffs(self) -> DataFrame:
        return diffs(self.ranking())

    def _standings(self) -> DataFrame:
        return self.steps.table(f"standings-{self._tag}", lambda: standings(self.ranking(), self.opts))

    def _overall_rank(self, best: Callable[[], DataFrame]) -> DataFrame:
        rows = self.steps.table(f"entrants-{self._tag}", lambda: entrants(best(), self.inp, self.opts))
        return overall_rank(rows, self.opts)

    def overall_rank(self) -> DataFrame:
        return self._overall_rank(lambda: winners(self.summary(), self.opts))

    def final(self) -> DataFrame:
        ranked = self._standings()
        return final(ranked, self._overall_rank(lambda: ranked), self.inp, self.opts)

    def write(self, path: str, mode: str = "replace") -> None:
        """The final table into the partitioned sink. Stored steps are released after success and kept after a failure."""
        with self.steps:
            sink.write_partitioned(self.final(), path, mode)
