"""Every registered query: key -> (Spark builder, oracle SQL or None).

Spark builders take ``(spark, sf_dir)``, derive the marketplace stand-ins from the
test tables and call the library operators. Outputs are made portable at the edge:
money (decimal) leaves as double and dates as ISO text, in Spark and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .functions import clean
from .operators import coverage, joins, keys, lookups, pivot, profile, rank
from .plans import landscape as ls
from .plans import refresh
from .plans.params import Params
from .sources import published, sink, standins, tables
from .sources.steps import Steps

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

# Fixed parameters of the registered queries (one year and state of the test data).
YEAR = 1997
STATE = "NATION_3"
PARENT = "Parent 3"


def register(key: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def portable(df: DataFrame) -> DataFrame:
    """decimal -> double, date -> 'yyyy-MM-dd' text; other types unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _present(body: str, doubles=(), texts=()) -> str:
    """SQL twin of ``portable`` for the named columns."""
    reps = [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    reps += [f"CAST({c} AS VARCHAR) AS {c}" for c in texts]
    if not reps:
        return body
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM ({body}) q"


class Src:
    """Stand-in tables for one scale-factor directory (built lazily, once)."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize

    def _b(self, name):
        if self.materialize:
            return standins.materialized(self.spark, self.sf_dir, name)
        return standins.build(self.spark, self.sf_dir, name)

    rate = cached_property(lambda s: s._b("st_rate"))
    plan = cached_property(lambda s: s._b("st_plan_attr"))
    sa = cached_property(lambda s: s._b("st_service_area"))
    county = cached_property(lambda s: s._b("st_county"))
    cmap = cached_property(lambda s: s._b("st_rating_area_county"))
    cmap_raw = cached_property(lambda s: s._b("st_rating_area_county_raw"))
    zip_ra = cached_property(lambda s: s._b("st_zip_rating_area"))
    enrollment = cached_property(lambda s: s._b("st_enrollment"))
    parent = cached_property(lambda s: s._b("st_parent"))
    t0a = cached_property(lambda s: s._b("st_t0a"))

    @cached_property
    def t0a_ind(self) -> DataFrame:
        return self.t0a.where(F.col("market_coverage") == "Individual")

    def inputs(self) -> ls.Inputs:
        return ls.Inputs(rate=self.rate, plan=self.plan, service_area=self.sa,
                         counties=self.county, county_map=self.cmap,
                         zip_rating_area=self.zip_ra, enrollment=self.enrollment,
                         parent=self.parent)


# ---------------------------------------------------------------- scans & profile

@register("session_info", None)
def q_session_info(spark, d):
    return profile.session_info(spark, Src(spark, d).rate)


@register("session_probe", oracle.sql(
    "SELECT count(*) AS probe_rows, true AS has_user, true AS has_time FROM st_rate", "st_rate"))
def q_session_probe(spark, d):
    """The part of the session probe that is the same everywhere."""
    return profile.session_info(spark, Src(spark, d).rate).select(
        "probe_rows", F.col("connected_user").isNotNull().alias("has_user"),
        F.col("connected_at").isNotNull().alias("has_time"))


@register("quoted_names", oracle.sql(
    "SELECT usps AS state_code, geoid AS geo_id, county AS county_name FROM st_county", "st_county"))
def q_quoted_names(spark, d):
    """Quoted, case-sensitive source names, renamed at load."""
    raw = Src(spark, d).county.select(F.col("usps").alias("State Code"), F.col("geoid").alias("GeoId"),
                                      F.col("county").alias("COUNTY-Name"))
    return tables.snake_case_columns(raw)


@register("sample_rows", oracle.sql(_present(
    "SELECT * FROM st_rate ORDER BY row_key ASC NULLS LAST LIMIT 20",
    doubles=("individual_rate", "individual_tobacco_rate"), texts=("rate_effective_date",)),
    "st_rate"))
def q_sample_rows(spark, d):
    return portable(profile.sample_rows(Src(spark, d).rate, 20, ["row_key"]))


@register("sample_filtered", oracle.sql(
    "SELECT * FROM st_plan_attr WHERE market_coverage = 'Individual' "
    "ORDER BY plan_id ASC NULLS LAST, business_year ASC NULLS LAST LIMIT 20", "st_plan_attr"))
def q_sample_filtered(spark, d):
    p = Src(spark, d).plan
    return profile.sample_rows(p.where(F.col("market_coverage") == "Individual"), 20,
                               ["plan_id", "business_year"])


@register("row_count", oracle.sql("SELECT count(*) AS total_rows FROM st_rate", "st_rate"))
def q_row_count(spark, d):
    return profile.row_count(Src(spark, d).rate)


@register("row_count_formatted", oracle.sql(
    "SELECT format('{:,}', count(*)) AS total_rows FROM st_rate", "st_rate"))
def q_row_count_formatted(spark, d):
    return profile.row_count_formatted(Src(spark, d).rate)


T0A_DISTINCT = [("business_year", "years_count"), ("state_code", "states_count"),
                ("issuer_id", "issuers_count"), ("plan_id", "plans_count"),
                ("rating_area_id", "rating_areas_count"), ("metal_level", "metal_levels_count"),
                ("age", "ages_count")]
_T0A_DISTINCT_SQL = ("SELECT " + ", ".join(f"count(DISTINCT {c}) AS {n}" for c, n in T0A_DISTINCT)
                     + " FROM st_t0a WHERE market_coverage = 'Individual'")


@register("distinct_counts_wide", oracle.sql(_T0A_DISTINCT_SQL, "st_t0a"))
def q_distinct_counts_wide(spark, d):
    cols, names = zip(*T0A_DISTINCT)
    return profile.distinct_counts(Src(spark, d).t0a_ind, cols, names)


@register("distinct_counts_tall", oracle.sql(
    "SELECT v.metric, v.value FROM t CROSS JOIN LATERAL (VALUES "
    + ", ".join(f"('{n}', t.{n})" for _, n in T0A_DISTINCT) + ") AS v(metric, value)",
    "st_t0a", ctes=(("t", _T0A_DISTINCT_SQL),)))
def q_distinct_counts_tall(spark, d):
    cols, names = zip(*T0A_DISTINCT)
    return profile.distinct_counts_tall(Src(spark, d).t0a_ind, cols, names)


@register("count_by_value", oracle.sql(
    "SELECT metal_level, count(*) AS row_count FROM st_plan_attr GROUP BY metal_level",
    "st_plan_attr"))
def q_count_by_value(spark, d):
    return profile.count_by(Src(spark, d).plan, ["metal_level"])


@register("count_by_plan_type", oracle.sql(
    f"SELECT plan_type, count(*) AS row_count FROM st_plan_attr WHERE business_year = {YEAR} "
    f"AND state_code = '{STATE}' GROUP BY plan_type", "st_plan_attr"))
def q_count_by_plan_type(spark, d):
    p = Params(YEAR, STATE).apply(Src(spark, d).plan)
    return profile.count_by(p, ["plan_type"])


@register("rate_summary_by_age", oracle.sql(
    "SELECT age, count(*) AS row_count, CAST(min(individual_rate) AS DOUBLE) AS min_rate, "
    "CAST(max(individual_rate) AS DOUBLE) AS max_rate, "
    "CAST(round(avg(individual_rate), 2) AS DOUBLE) AS avg_rate FROM st_rate GROUP BY age",
    "st_rate"))
def q_rate_summary_by_age(spark, d):
    return profile.summary_by(Src(spark, d).rate, "age", "individual_rate")


@register("tobacco_summary", oracle.sql(
    "SELECT tobacco, count(*) AS row_count, "
    "CAST(round(avg(individual_rate), 2) AS DOUBLE) AS avg_individual_rate, "
    "CAST(round(avg(individual_tobacco_rate), 2) AS DOUBLE) AS avg_tobacco_rate "
    "FROM st_rate GROUP BY tobacco", "st_rate"))
def q_tobacco_summary(spark, d):
    return profile.summary_by(Src(spark, d).rate, "tobacco", "individual_rate", with_minmax=False,
                              extra_avgs={"avg_individual_rate": "individual_rate",
                                          "avg_tobacco_rate": "individual_tobacco_rate"})


@register("rate_periods", oracle.sql(
    "SELECT CAST(rate_effective_date AS VARCHAR) AS rate_effective_date, count(*) AS row_count, "
    "count(DISTINCT plan_id) AS distinct_plans FROM st_rate GROUP BY rate_effective_date",
    "st_rate"))
def q_rate_periods(spark, d):
    return portable(profile.count_and_distinct_by(Src(spark, d).rate, "rate_effective_date",
                                                  "plan_id"))


@register("distinct_values", oracle.sql(
    "SELECT DISTINCT CAST(rate_effective_date AS VARCHAR) AS rate_effective_date, version_number "
    f"FROM st_rate WHERE business_year = {YEAR}", "st_rate"))
def q_distinct_values(spark, d):
    r = Src(spark, d).rate.where(F.col("business_year") == YEAR)
    return portable(profile.distinct_values(r, ["rate_effective_date", "version_number"])).orderBy(
        "rate_effective_date", "version_number")


@register("variant_suffixes", oracle.sql(
    "SELECT DISTINCT right(plan_id, 1) AS suffix FROM st_plan_attr", "st_plan_attr"))
def q_variant_suffixes(spark, d):
    return profile.distinct_values(Src(spark, d).plan,
                                   [F.right("plan_id", F.lit(1)).alias("suffix")])


@register("distinct_count_filtered", oracle.sql(
    f"SELECT 'plan_attributes' AS source, count(DISTINCT standard_component_id) AS distinct_keys "
    f"FROM st_plan_attr WHERE business_year = {YEAR} UNION ALL "
    f"SELECT 'rates', count(DISTINCT plan_id) FROM st_rate WHERE business_year = {YEAR}",
    "st_plan_attr", "st_rate"))
def q_distinct_count_filtered(spark, d):
    """Distinct join-key values on each side for one year, as two rows."""
    s = Src(spark, d)
    a = profile.distinct_counts(s.plan.where(F.col("business_year") == YEAR),
                                ["standard_component_id"], ["distinct_keys"])
    b = profile.distinct_counts(s.rate.where(F.col("business_year") == YEAR),
                                ["plan_id"], ["distinct_keys"])
    return (a.select(F.lit("plan_attributes").alias("source"), "distinct_keys")
            .unionByName(b.select(F.lit("rates").alias("source"), "distinct_keys")))


T0A_SPOT_COLUMNS = ["business_year", "state_code", "metal_level", "age", "tobacco",
                    "csr_variation_type"]


@register("distinct_values_by_column", oracle.sql(
    "\nUNION\n".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM "
                      f"st_t0a WHERE market_coverage = 'Individual'" for c in T0A_SPOT_COLUMNS),
    "st_t0a"))
def q_distinct_values_by_column(spark, d):
    return profile.value_inventory(Src(spark, d).t0a_ind, T0A_SPOT_COLUMNS)


@register("state_rows_ordered", oracle.sql(
    f"SELECT * FROM st_service_area WHERE state_code = '{STATE}'", "st_service_area"))
def q_state_rows_ordered(spark, d):
    sa = Src(spark, d).sa.where(F.col("state_code") == STATE)
    return sa.orderBy(*[F.col(c).asc_nulls_last() for c in
                        ("service_area_id", "cover_entire_state", "county_name")])


GRAIN_GUESS_1 = ["business_year", "plan_id", "rating_area_id", "age"]
GRAIN_GUESS_2 = ["business_year", "rate_effective_date", "plan_id", "rating_area_id", "age"]


def _grain_sql(keys, n=20):
    k = ", ".join(keys)
    order = ", ".join(f"{c} ASC NULLS LAST" for c in keys)
    return (f"SELECT {k}, count(*) AS row_count FROM st_rate GROUP BY {k} "
            f"ORDER BY row_count DESC NULLS FIRST, {order} LIMIT {n}")


@register("grain_top20", oracle.sql(
    _present(_grain_sql(GRAIN_GUESS_2), texts=("rate_effective_date",)), "st_rate"))
def q_grain_top20(spark, d):
    return portable(profile.grain_top(Src(spark, d).rate, GRAIN_GUESS_2, 20))


@register("grain_top20_guess1", oracle.sql(_grain_sql(GRAIN_GUESS_1), "st_rate"))
def q_grain_top20_guess1(spark, d):
    return profile.grain_top(Src(spark, d).rate, GRAIN_GUESS_1, 20)


T0A_GRAIN = ["business_year", "state_code", "plan_id", "rating_area_id", "age", "tobacco"]


@register("t0a_grain_top20", oracle.sql(_grain_sql(T0A_GRAIN).replace("st_rate", "st_t0a"), "st_t0a"))
def q_t0a_grain_top20(spark, d):
    """Grain of the analysis table."""
    return profile.grain_top(Src(spark, d).t0a, T0A_GRAIN, 20)


GRAIN_CANDIDATES = {"guess_1": GRAIN_GUESS_1, "guess_2": GRAIN_GUESS_2,
                    "with_tobacco": GRAIN_GUESS_2 + ["tobacco", "version_number"],
                    "row_key": ["row_key"]}


def _grain_report_sql():
    parts = []
    for name, keys in GRAIN_CANDIDATES.items():
        k = ", ".join(keys)
        parts.append(
            f"SELECT '{name}' AS candidate, '{','.join(keys)}' AS key_columns, sum(n) AS rows, "
            f"count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS dup_keys, "
            f"max(n) AS max_rows, CAST(count(*) FILTER (WHERE n > 1) = 0 AS INTEGER) AS is_unique "
            f"FROM (SELECT {k}, count(*) AS n FROM st_rate GROUP BY {k}) g")
    return "\nUNION ALL\n".join(parts)


@register("grain_report", oracle.sql(
    f"SELECT candidate, key_columns, CAST(rows AS BIGINT) AS rows, distinct_keys, dup_keys, "
    f"max_rows, is_unique FROM ({_grain_report_sql()}) r", "st_rate"))
def q_grain_report(spark, d):
    return profile.grain_report(Src(spark, d).rate, GRAIN_CANDIDATES)


def _keys_sql(table: str, cols: list[str], most: int) -> str:
    """Every column set counted, then the unique ones that hold no smaller unique one."""
    sets = [c for n in range(1, most + 1) for c in combinations(cols, n)]
    parts = [f"SELECT {list(c)} AS names FROM t HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT {', '.join(c)} FROM t) d)" for c in sets]
    return oracle.sql("SELECT array_to_string(names, ',') AS key_columns, len(names)::INTEGER AS n_columns FROM found f WHERE NOT EXISTS ("
                      "SELECT 1 FROM found g WHERE len(g.names) < len(f.names) AND list_has_all(f.names, g.names))", table,
                      ctes=(("t", f"SELECT {', '.join(cols)} FROM {table}"), ("found", "\nUNION ALL ".join(parts)),))


T0A_KEY_COLUMNS = ["business_year", "plan_id", "rating_area_id", "age", "tobacco", "metal_level", "individual_rate", "row_key"]
RATE_KEY_COLUMNS = ["business_year", "plan_id", "rating_area_id", "age", "tobacco", "rate_effective_date", "individual_rate"]


@register("keys_of_t0a", _keys_sql("st_t0a", T0A_KEY_COLUMNS, 4))
def q_keys_of_t0a(spark, d):
    return keys.key_report(Src(spark, d).t0a, T0A_KEY_COLUMNS, 4)


@register("keys_of_rate", _keys_sql("st_rate", RATE_KEY_COLUMNS, 6))
def q_keys_of_rate(spark, d):
    """Without the surrogate key: which business columns identify a rate, if any do."""
    return keys.key_report(Src(spark, d).rate, RATE_KEY_COLUMNS, 6)


@register("keys_of_service_area", _keys_sql("st_service_area", ["business_year", "state_code", "issuer_id", "service_area_id", "county"], 5))
def q_keys_of_service_area(spark, d):
    return keys.key_report(Src(spark, d).sa, ["business_year", "state_code", "issuer_id", "service_area_id", "county"], 5)


@register("grain_top20_sketch", oracle.sql(_present(_grain_sql(GRAIN_GUESS_2), texts=("rate_effective_date",)), "st_rate"))
def q_grain_top20_sketch(spark, d):
    """The grain check's largest groups from a frequent-items sketch, or in full where it proves nothing."""
    return portable(profile.frequent_groups(Src(spark, d).rate, GRAIN_GUESS_2, 20)[0])


@register("frequent_state_years", oracle.sql(_grain_sql(["business_year", "state_code"], 5), "st_rate"))
def q_frequent_state_years(spark, d):
    """Few groups with many rows each: the sketch's proposals are the answer."""
    return profile.frequent_groups(Src(spark, d).rate, ["business_year", "state_code"], 5)[0]


# ---------------------------------------------------------------- filters & functions

CURATED = ["business_year", "state_code", "standard_component_id", "plan_id", "service_area_id",
           "metal_level", "plan_type", "csr_variation_type", "dental_only_plan",
           "plan_marketing_name"]
_CUR = ", ".join(CURATED)


@register("curated_columns", oracle.sql(
    f"SELECT {_CUR} FROM st_plan_attr WHERE business_year = {YEAR} AND right(plan_id, 1) = '1'",
    "st_plan_attr"))
def q_curated_columns(spark, d):
    p = Src(spark, d).plan
    return (p.where((F.col("business_year") == YEAR) & clean.is_base_variant("plan_id"))
            .select(*CURATED))


@register("filter_equality", oracle.sql(
    f"SELECT {_CUR} FROM st_plan_attr WHERE state_code = '{STATE}' AND dental_only_plan = 'No' "
    "AND metal_level = 'Gold'", "st_plan_attr"))
def q_filter_equality(spark, d):
    p = Src(spark, d).plan
    return p.where((F.col("state_code") == STATE) & (F.col("dental_only_plan") == "No")
                   & (F.col("metal_level") == "Gold")).select(*CURATED)


@register("filter_equality_silver", oracle.sql(
    f"SELECT {_CUR} FROM st_plan_attr WHERE state_code = '{STATE}' AND dental_only_plan = 'No' "
    "AND metal_level = 'Silver'", "st_plan_attr"))
def q_filter_equality_silver(spark, d):
    """The same conjunctive filter on a level with both clean and '\\r'-suffixed flags:
    only the clean ones pass an exact '= No' test."""
    p = Src(spark, d).plan
    return p.where((F.col("state_code") == STATE) & (F.col("dental_only_plan") == "No")
                   & (F.col("metal_level") == "Silver")).select(*CURATED)


@register("flag_prefix_filter", oracle.sql(
    "SELECT business_year, state_code, issuer_id, service_area_id, county, "
    "CAST(dental_only_plan = 'No' AS INTEGER) AS exact_no "
    "FROM st_service_area WHERE left(dental_only_plan, 1) = 'N'", "st_service_area"))
def q_flag_prefix_filter(spark, d):
    sa = Src(spark, d).sa
    return sa.where(clean.flag_is_no("dental_only_plan")).select(
        "business_year", "state_code", "issuer_id", "service_area_id", "county",
        (F.col("dental_only_plan") == "No").cast("int").alias("exact_no"))


@register("variant_suffix_filter", oracle.sql(
    "SELECT business_year, plan_id, standard_component_id, csr_variation_type FROM st_plan_attr "
    "WHERE right(plan_id, 1) = '1'", "st_plan_attr"))
def q_variant_suffix_filter(spark, d):
    return Src(spark, d).plan.where(clean.is_base_variant("plan_id")).select(
        "business_year", "plan_id", "standard_component_id", "csr_variation_type")


@register("param_filter", oracle.sql(
    f"SELECT {_CUR} FROM st_plan_attr WHERE business_year = {YEAR} AND state_code = '{STATE}'",
    "st_plan_attr"))
def q_param_filter(spark, d):
    return Params(YEAR, STATE).apply(Src(spark, d).plan).select(*CURATED)


@register("param_filter_all_states", oracle.sql(
    f"SELECT {_CUR} FROM st_plan_attr WHERE business_year = {YEAR}", "st_plan_attr"))
def q_param_filter_all(spark, d):
    return Params(YEAR, "All").apply(Src(spark, d).plan).select(*CURATED)


_MAPPED = "CASE WHEN metal_level = 'Expanded Bronze' THEN 'Bronze' ELSE metal_level END"


@register("metal_mapped_counts", oracle.sql(
    f"SELECT state_code, {_MAPPED} AS metal_level, count(*) AS row_count FROM st_plan_attr "
    f"GROUP BY state_code, {_MAPPED}", "st_plan_attr"))
def q_metal_mapped_counts(spark, d):
    p = Src(spark, d).plan.select(
        "state_code", clean.map_values("metal_level", clean.METAL_LEVEL_MAP).alias("metal_level"))
    return profile.count_by(p, ["state_code", "metal_level"])


@register("metal_counts_as_written", oracle.sql(
    f"SELECT state_code, {_MAPPED} AS metal_level, count(*) AS row_count FROM st_plan_attr "
    "GROUP BY state_code, st_plan_attr.metal_level", "st_plan_attr"))
def q_metal_counts_as_written(spark, d):
    # grouped by the raw column, the mapped value shown: 'Bronze' can appear twice
    p = Src(spark, d).plan
    g = p.groupBy("state_code", "metal_level").agg(F.count(F.lit(1)).alias("row_count"))
    return g.select("state_code",
                    clean.map_values("metal_level", clean.METAL_LEVEL_MAP).alias("metal_level"),
                    "row_count")


@register("sort_rating_area", oracle.sql(
    "SELECT DISTINCT rating_area_id, TRY_CAST(split_part(rating_area_id, ' ', 3) AS INTEGER) "
    "AS rating_area_number FROM st_t0a", "st_t0a"))
def q_sort_rating_area(spark, d):
    t = Src(spark, d).t0a
    return (t.select("rating_area_id", clean.rating_area_number("rating_area_id").alias("rating_area_number")).distinct()
            .orderBy(F.col("rating_area_number").asc_nulls_last(), "rating_area_id"))


_DED = ("replace(replace(coalesce(tehb_ded_inn_tier1_individual, mehb_ded_inn_tier1_individual, "
        "tehb_ded_inn_tier1_family_per_person), 'per person', ''), '$', '')")
_OOPM = ("replace(replace(coalesce(tehb_inn_tier1_individual_moop, "
         "tehb_inn_tier1_family_per_person_moop), 'per person', ''), '$', '')")


def _money_sql(text: str) -> str:
    """First amount of a text, percentages aside."""
    bare = f"regexp_replace({text}, '[0-9][0-9.,]* ?%', '', 'g')"
    found = f"regexp_extract({bare}, '-?\\$? ?[0-9][0-9,]*(\\.[0-9]+)?')"
    return f"CAST(TRY_CAST(nullif(regexp_replace({found}, '[$, ]', '', 'g'), '') AS DECIMAL(12,2)) AS DOUBLE)"


def _ded_cols(p):
    return (clean.deductible_text("tehb_ded_inn_tier1_individual", "mehb_ded_inn_tier1_individual",
                                  "tehb_ded_inn_tier1_family_per_person"),
            clean.deductible_text("tehb_inn_tier1_individual_moop",
                                  "tehb_inn_tier1_family_per_person_moop"))


@register("deductible_text", oracle.sql(
    f"SELECT plan_marketing_name, {_DED} AS deductible, {_OOPM} AS oopm, count(*) AS row_count "
    f"FROM st_plan_attr GROUP BY 1, 2, 3", "st_plan_attr"))
def q_deductible_text(spark, d):
    p = Src(spark, d).plan
    ded, oopm = _ded_cols(p)
    return p.groupBy("plan_marketing_name", ded.alias("deductible"), oopm.alias("oopm")).agg(
        F.count(F.lit(1)).alias("row_count"))


@register("deductible_amount", oracle.sql(
    "SELECT plan_marketing_name, "
    f"{_money_sql(_DED)} AS deductible_amount, {_money_sql(_OOPM)} AS oopm_amount, "
    "count(*) AS row_count FROM st_plan_attr GROUP BY 1, 2, 3",
    "st_plan_attr"))
def q_deductible_amount(spark, d):
    p = Src(spark, d).plan
    ded, oopm = _ded_cols(p)
    g = p.groupBy("plan_marketing_name",
                  clean.parse_money(ded).alias("deductible_amount"),
                  clean.parse_money(oopm).alias("oopm_amount")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return portable(g)


@register("money_first_amount", oracle.sql(
    f"SELECT text, {_money_sql('text')} AS amount, count(*) AS row_count FROM (SELECT "
    "tehb_ded_inn_tier1_individual || ' / 20% | ' || tehb_ded_inn_tier1_family_per_person AS text FROM st_plan_attr "
    "UNION ALL SELECT '10% / ' || mehb_ded_inn_tier1_individual FROM st_plan_attr "
    "UNION ALL SELECT metal_level FROM st_plan_attr) x GROUP BY 1, 2", "st_plan_attr"))
def q_money_first_amount(spark, d):
    """Texts with two amounts, with a percentage before the amount, and without an amount."""
    p = Src(spark, d).plan
    texts = (p.select(F.concat("tehb_ded_inn_tier1_individual", F.lit(" / 20% | "), "tehb_ded_inn_tier1_family_per_person").alias("text"))
             .union(p.select(F.concat(F.lit("10% / "), "mehb_ded_inn_tier1_individual")))
             .union(p.select("metal_level")))
    return portable(texts.groupBy("text", clean.parse_money("text").alias("amount")).agg(F.count(F.lit(1)).alias("row_count")))


@register("pad_fips", oracle.sql(
    "SELECT fips AS fips_raw, lpad(fips, 5, '0') AS fips, county, rating_area "
    "FROM st_rating_area_county_raw", "st_rating_area_county_raw"))
def q_pad_fips(spark, d):
    raw = Src(spark, d).cmap_raw
    return raw.select(F.col("fips").alias("fips_raw"), clean.pad_fips("fips").alias("fips"),
                      "county", "rating_area")


@register("sentinel_audit", oracle.sql(
    "SELECT state, count(*) AS row_count, "
    "count(*) FILTER (WHERE avg_enrollment IS NULL) AS null_rows, "
    "count(*) FILTER (WHERE trim(avg_enrollment) = 'NULL') AS sentinel_rows, "
    "count(*) FILTER (WHERE TRY_CAST(nullif(trim(avg_enrollment), 'NULL') AS DOUBLE) = 0) AS zero_rows, "
    "count(TRY_CAST(nullif(trim(avg_enrollment), 'NULL') AS DOUBLE)) AS numeric_rows, "
    "sum(TRY_CAST(nullif(trim(avg_enrollment), 'NULL') AS DOUBLE)) AS enrollment_total "
    "FROM st_enrollment GROUP BY state", "st_enrollment"))
def q_sentinel_audit(spark, d):
    e = Src(spark, d).enrollment
    num = clean.parse_number("avg_enrollment")
    return e.groupBy("state").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(F.col("avg_enrollment").isNull(), F.lit(1))).alias("null_rows"),
        F.count(F.when(F.trim("avg_enrollment") == "NULL", F.lit(1))).alias("sentinel_rows"),
        F.count(F.when(num == 0, F.lit(1))).alias("zero_rows"),
        F.count(num).alias("numeric_rows"),
        F.sum(num).alias("enrollment_total"))


# ---------------------------------------------------------------- joins

@register("join_rate_plan", oracle.sql(_present(
    "SELECT r.state_code, r.plan_id, r.rating_area_id, r.age, r.individual_rate, r.row_key, "
    "pa.metal_level, pa.plan_type, pa.plan_marketing_name, pa.plan_id AS variant_id, "
    "pa.business_year AS plan_year "
    "FROM st_rate r JOIN st_plan_attr pa ON r.plan_id = pa.standard_component_id "
    f"WHERE r.state_code = '{STATE}' AND r.business_year = {YEAR} AND r.age = '21'",
    doubles=("individual_rate",)), "st_rate", "st_plan_attr"))
def q_join_rate_plan(spark, d):
    s = Src(spark, d)
    r = s.rate.where((F.col("state_code") == STATE) & (F.col("business_year") == YEAR)
                     & (F.col("age") == "21"))
    pa = s.plan.select("standard_component_id", "metal_level", "plan_type", "plan_marketing_name",
                       F.col("plan_id").alias("variant_id"), F.col("business_year").alias("plan_year"))
    j = joins.join(r, pa, [("plan_id", "standard_component_id")])
    return portable(j.select("state_code", "plan_id", "rating_area_id", "age", "individual_rate",
                             "row_key", "metal_level", "plan_type", "plan_marketing_name",
                             "variant_id", "plan_year"))


@register("join_composite", oracle.sql(_present(
    "SELECT r.business_year, r.state_code, r.issuer_id, r.plan_id, r.rating_area_id, "
    "r.individual_rate, r.row_key, p.plan_id AS variant_id, p.csr_variation_type, p.metal_level "
    "FROM st_rate r JOIN st_plan_attr p ON r.plan_id = p.standard_component_id "
    "AND r.business_year = p.business_year AND r.state_code = p.state_code "
    f"AND r.issuer_id = p.issuer_id WHERE r.age = '21' AND r.business_year = {YEAR}",
    doubles=("individual_rate",)), "st_rate", "st_plan_attr"))
def q_join_composite(spark, d):
    s = Src(spark, d)
    r = s.rate.where((F.col("age") == "21") & (F.col("business_year") == YEAR))
    p = s.plan.select(F.col("standard_component_id").alias("plan_id"), "business_year",
                      "state_code", "issuer_id", F.col("plan_id").alias("variant_id"),
                      "csr_variation_type", "metal_level")
    j = joins.join(r, p, ["plan_id", "business_year", "state_code", "issuer_id"])
    return portable(j.select("business_year", "state_code", "issuer_id", "plan_id",
                             "rating_area_id", "individual_rate", "row_key", "variant_id",
                             "csr_variation_type", "metal_level"))


# covered counties: a whole-state row stands for each county of its state, a county row for its own
_SA_EXPANDED_SQL = """
  SELECT DISTINCT area.business_year, area.state_code, area.issuer_id, area.service_area_id,
         CASE WHEN area.whole THEN place.geoid ELSE right(area.county, 5) END AS county
  FROM (SELECT *, cover_entire_state = 'Yes' AS whole FROM st_service_area
        WHERE cover_entire_state IN ('Yes', 'No', 'false') AND starts_with(dental_only_plan, 'N')) area
  LEFT JOIN st_county place ON area.whole AND place.usps = area.state_code
  WHERE NOT area.whole OR place.geoid IS NOT NULL"""


@register("join_padded_key", oracle.sql(
    "SELECT sa.business_year, sa.state_code, sa.issuer_id, sa.service_area_id, sa.county, "
    "cm.fips AS map_fips, cm.county AS county_name, cm.rating_area FROM sa_expanded sa "
    "JOIN st_rating_area_county_raw cm ON lpad(cm.fips, 5, '0') = lpad(sa.county, 5, '0')",
    "st_service_area", "st_county", "st_rating_area_county_raw",
    ctes=(("sa_expanded", _SA_EXPANDED_SQL),)))
def q_join_padded_key(spark, d):
    s = Src(spark, d)
    sa = coverage.expand(s.sa, s.county, counties_bounded=True).withColumn("__k", clean.pad_fips("county"))
    cm = F.broadcast(s.cmap_raw.select(F.col("fips").alias("map_fips"),
                                       F.col("county").alias("county_name"), "rating_area")
                     .withColumn("__k", clean.pad_fips("map_fips")))
    return joins.join(sa, cm, ["__k"]).drop("__k")


@register("join_fanout_audit", oracle.sql("""
SELECT (SELECT count(*) FROM st_rate) AS left_rows,
       (SELECT count(*) FROM st_plan_attr) AS right_rows,
       (SELECT count(*) FROM st_rate r JOIN st_plan_attr p ON r.plan_id = p.standard_component_id) AS joined_rows,
       round((SELECT count(*) FROM st_rate r JOIN st_plan_attr p ON r.plan_id = p.standard_component_id)
             / (SELECT count(*) FROM st_rate), 6) AS fanout,
       (SELECT count(*) FROM st_rate r WHERE NOT EXISTS
          (SELECT 1 FROM st_plan_attr p WHERE p.standard_component_id = r.plan_id)) AS left_unmatched,
       (SELECT count(*) FROM st_plan_attr p WHERE NOT EXISTS
          (SELECT 1 FROM st_rate r WHERE p.standard_component_id = r.plan_id)) AS right_unmatched,
       (SELECT max(c) FROM (SELECT standard_component_id, count(*) AS c FROM st_plan_attr
          WHERE standard_component_id IN (SELECT plan_id FROM st_rate)
          GROUP BY standard_component_id) x) AS max_right_dups""", "st_rate", "st_plan_attr"))
def q_join_fanout_audit(spark, d):
    s = Src(spark, d)
    return joins.audit(s.rate, s.plan, [("plan_id", "standard_component_id")])


_STEPS_SQL = """
SELECT s.step_no, s.step, s.joined_rows FROM (
  SELECT 0 AS step_no, 'joined' AS step, count(*) AS joined_rows
    FROM st_rate r JOIN st_plan_attr pa ON r.plan_id = pa.standard_component_id
  UNION ALL
  SELECT 1, 'year_age', count(*) FROM st_rate r JOIN st_plan_attr pa ON r.plan_id = pa.standard_component_id
    WHERE r.business_year = {y} AND r.age = '21'
  UNION ALL
  SELECT 2, 'no_dental_exact', count(*) FROM st_rate r JOIN st_plan_attr pa ON r.plan_id = pa.standard_component_id
    WHERE r.business_year = {y} AND r.age = '21' AND pa.dental_only_plan = 'No'
  UNION ALL
  SELECT 3, 'base_variant', count(*) FROM st_rate r JOIN st_plan_attr pa ON r.plan_id = pa.standard_component_id
    WHERE r.business_year = {y} AND r.age = '21' AND pa.dental_only_plan = 'No' AND right(pa.plan_id, 1) = '1'
  UNION ALL
  SELECT 4, 'same_year', count(*) FROM st_rate r JOIN st_plan_attr pa ON r.plan_id = pa.standard_component_id
    WHERE r.business_year = {y} AND r.age = '21' AND pa.dental_only_plan = 'No' AND right(pa.plan_id, 1) = '1'
      AND pa.business_year = {y}
) s""".format(y=YEAR)


SIZED_JOINS = {
    "rate_plan": ("st_rate", "st_plan_attr", [("plan_id", "standard_component_id")]),
    "rate_plan_year": ("st_rate", "st_plan_attr", [("plan_id", "standard_component_id"), ("business_year", "business_year")]),
    "rate_state": ("st_rate", "st_service_area", [("state_code", "state_code")]),
    "rate_parent": ("st_rate", "st_parent", [("issuer_id", "hios_issuer_id")]),
    "area_enrollment": ("st_service_area", "st_enrollment", [("issuer_id", "issuer_hios_id"), ("business_year", "year")]),
}


@register("join_size_estimates", oracle.sql("\nUNION ALL ".join(
    f"SELECT '{name}' AS join_name, count(*) AS joined_rows, true AS within_bound FROM {a} l JOIN {b} r ON "
    + " AND ".join(f"l.{x} = r.{y}" for x, y in on) for name, (a, b, on) in SIZED_JOINS.items()),
    *{t for a, b, _ in SIZED_JOINS.values() for t in (a, b)}))
def q_join_size_estimates(spark, d):
    """The exact size of each join, and whether the sketches' estimate is within its own stated error of it."""
    s = Src(spark, d)
    out = None
    for name, (a, b, on) in SIZED_JOINS.items():
        left, right = s._b(a), s._b(b)
        exact = joins.audit(left, right, on).select("joined_rows")
        one = (exact.unionByName(joins.estimate_size(left, right, on), allowMissingColumns=True)
               .agg(*[F.max(c).alias(c) for c in ("joined_rows", "estimated_rows", "error_bound")]))
        one = one.select(F.lit(name).alias("join_name"), "joined_rows",
                         (F.abs(F.col("estimated_rows") - F.col("joined_rows")) <= F.col("error_bound")).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@register("join_filter_steps", oracle.sql(_STEPS_SQL, "st_rate", "st_plan_attr"))
def q_join_filter_steps(spark, d):
    s = Src(spark, d)
    steps = [
        ("joined", None, None),
        ("year_age", (F.col("business_year") == YEAR) & (F.col("age") == "21"), None),
        ("no_dental_exact", None, F.col("dental_only_plan") == "No"),
        ("base_variant", None, clean.is_base_variant("plan_id")),
        ("same_year", None, F.col("business_year") == YEAR),
    ]
    return joins.audit_steps(s.rate, s.plan, [("plan_id", "standard_component_id")], steps)


@register("key_overlap", oracle.sql("""
SELECT count(ka) AS a_keys, count(kb) AS b_keys,
       count(*) FILTER (WHERE kb IS NULL) AS a_only, count(*) FILTER (WHERE ka IS NULL) AS b_only,
       count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) AS both,
       CAST(min(length(ka)) AS BIGINT) AS a_min_len, CAST(max(length(ka)) AS BIGINT) AS a_max_len,
       CAST(min(length(kb)) AS BIGINT) AS b_min_len, CAST(max(length(kb)) AS BIGINT) AS b_max_len
FROM (SELECT DISTINCT plan_id AS ka FROM st_rate WHERE plan_id IS NOT NULL) a
FULL OUTER JOIN (SELECT DISTINCT standard_component_id AS kb FROM st_plan_attr
                 WHERE standard_component_id IS NOT NULL) b ON a.ka = b.kb""",
    "st_rate", "st_plan_attr"))
def q_key_overlap(spark, d):
    s = Src(spark, d)
    return joins.key_overlap(s.rate, "plan_id", s.plan, "standard_component_id")


@register("left_lookup", oracle.sql(
    "SELECT i.issuer_id, i.state_code, pm.company_name, pm.parent_name "
    "FROM (SELECT DISTINCT issuer_id, state_code FROM st_rate) i "
    "LEFT JOIN st_parent pm ON i.issuer_id = pm.hios_issuer_id", "st_rate", "st_parent"))
def q_left_lookup(spark, d):
    s = Src(spark, d)
    issuers = s.rate.select("issuer_id", "state_code").distinct()
    return joins.left_lookup(issuers, s.parent, [("issuer_id", "hios_issuer_id")]).select(
        "issuer_id", "state_code", "company_name", "parent_name")


_SA_ENR = ("SELECT sa.business_year, sa.state_code, sa.issuer_id, sa.service_area_id, sa.county, "
           "e.avg_enrollment FROM sa_expanded sa LEFT JOIN st_enrollment e "
           "ON sa.issuer_id = e.issuer_hios_id AND sa.business_year = e.year "
           "AND e.county_fips = sa.county")


def _sa_enrollment(s: Src) -> DataFrame:
    sa = coverage.expand(s.sa, s.county, counties_bounded=True)
    e = s.enrollment.select("issuer_hios_id", "year", "county_fips", "avg_enrollment")
    return joins.join(sa, e, [("issuer_id", "issuer_hios_id"), ("business_year", "year"),
                              ("county", "county_fips")], "left").select(
        "business_year", "state_code", "issuer_id", "service_area_id", "county", "avg_enrollment")


@register("left_enrollment", oracle.sql(
    _SA_ENR, "st_service_area", "st_county", "st_enrollment",
    ctes=(("sa_expanded", _SA_EXPANDED_SQL),)))
def q_left_enrollment(spark, d):
    return _sa_enrollment(Src(spark, d))


@register("unmatched_enrollment", oracle.sql(
    f"SELECT * FROM ({_SA_ENR}) x WHERE avg_enrollment IS NULL",
    "st_service_area", "st_county", "st_enrollment", ctes=(("sa_expanded", _SA_EXPANDED_SQL),)))
def q_unmatched_enrollment(spark, d):
    s = Src(spark, d)
    e = s.enrollment.select("issuer_hios_id", "year", "county_fips", "avg_enrollment")
    return joins.unmatched(coverage.expand(s.sa, s.county, counties_bounded=True), e,
                           [("issuer_id", "issuer_hios_id"), ("business_year", "year"), ("county", "county_fips")],
                           "avg_enrollment").select(
        "business_year", "state_code", "issuer_id", "service_area_id", "county", "avg_enrollment")


@register("anti_enrollment", oracle.sql(
    "SELECT sa.* FROM sa_expanded sa WHERE NOT EXISTS (SELECT 1 FROM st_enrollment e "
    "WHERE sa.issuer_id = e.issuer_hios_id AND sa.business_year = e.year "
    "AND e.county_fips = sa.county)",
    "st_service_area", "st_county", "st_enrollment", ctes=(("sa_expanded", _SA_EXPANDED_SQL),)))
def q_anti_enrollment(spark, d):
    s = Src(spark, d)
    sa = coverage.expand(s.sa, s.county, counties_bounded=True)
    return joins.anti(sa, s.enrollment, [("issuer_id", "issuer_hios_id"), ("business_year", "year"),
                                         ("county", "county_fips")])


# ---------------------------------------------------------------- coverage & lookups

@register("sa_expanded", oracle.sql(_SA_EXPANDED_SQL, "st_service_area", "st_county"))
def q_sa_expanded(spark, d):
    s = Src(spark, d)
    return coverage.expand(s.sa, s.county, counties_bounded=True)


@register("coverage_audit", oracle.sql(
    "SELECT cover_entire_state, CASE WHEN cover_entire_state IN ('Yes') THEN 'whole' "
    "WHEN cover_entire_state IN ('No', 'false') THEN 'part' ELSE 'dropped' END AS treatment, "
    "count(*) AS row_count FROM st_service_area GROUP BY 1, 2", "st_service_area"))
def q_coverage_audit(spark, d):
    return coverage.coverage_audit(Src(spark, d).sa)


@register("expansion_report", oracle.sql("""
SELECT s.state_code, coalesce(r.raw_sa_rows, 0) AS raw_sa_rows,
       coalesce(c.county_count, 0) AS county_count, coalesce(e.expanded_rows, 0) AS expanded_rows
FROM (SELECT state_code FROM st_service_area UNION SELECT usps FROM st_county
      UNION SELECT state_code FROM sa_expanded) s
LEFT JOIN (SELECT state_code, count(*) AS raw_sa_rows FROM st_service_area
           WHERE dental_only_plan = 'No' GROUP BY state_code) r ON r.state_code = s.state_code
LEFT JOIN (SELECT usps, count(*) AS county_count FROM st_county GROUP BY usps) c ON c.usps = s.state_code
LEFT JOIN (SELECT state_code, count(*) AS expanded_rows FROM sa_expanded GROUP BY state_code) e
       ON e.state_code = s.state_code""",
    "st_service_area", "st_county", ctes=(("sa_expanded", _SA_EXPANDED_SQL),)))
def q_expansion_report(spark, d):
    s = Src(spark, d)
    return coverage.expansion_report(s.sa, s.county, coverage.expand(s.sa, s.county, counties_bounded=True))


@register("sa_expanded_state", oracle.sql(
    f"SELECT * FROM ({_SA_EXPANDED_SQL}) x WHERE state_code = '{STATE}'", "st_service_area", "st_county"))
def q_sa_expanded_state(spark, d):
    """One state's expansion, in order."""
    s = Src(spark, d)
    one = coverage.expand(s.sa.where(F.col("state_code") == STATE), s.county, counties_bounded=True)
    return one.orderBy("business_year", "issuer_id", "service_area_id", "county")


@register("lookup_temp_table", oracle.sql(
    "SELECT rate_area, count(*) AS places FROM (SELECT DISTINCT fips, state, rate_area FROM st_zip_rating_area) t "
    "GROUP BY rate_area", "st_zip_rating_area"))
def q_lookup_temp_table(spark, d):
    """The lookup stored once, then read by SQL text through its temp view."""
    look = lookups.distinct_lookup(Src(spark, d).zip_ra, ["fips", "state", "rate_area"])
    lookups.temp_table(look, "fips_ra_lookup", Steps(spark))
    return spark.sql("SELECT rate_area, count(*) AS places FROM fips_ra_lookup GROUP BY rate_area")


@register("distinct_lookup", oracle.sql(
    "SELECT DISTINCT fips, state, rate_area FROM st_zip_rating_area", "st_zip_rating_area"))
def q_distinct_lookup(spark, d):
    return lookups.distinct_lookup(Src(spark, d).zip_ra, ["fips", "state", "rate_area"])


# ---------------------------------------------------------------- windows & pivots (t0A)

T0A_KEYS = ["state_code", "rating_area_id", "metal_level"]
# The written form leaves the state out: rating areas of the same name in different states form one group.
T0A_WRITTEN = ["rating_area_id", "metal_level"]
# Groups of these keys number at most states x rating areas x metal levels: a bound
# set by geography, not by data volume, so their per-group tables are broadcast.
T0A_GROUPS_BOUNDED = True
_T0A_IND = "SELECT * FROM st_t0a WHERE market_coverage = 'Individual'"
# One state and year, the slice that the written form was meant for.
_T0A_SLICE = _T0A_IND + f" AND state_code = '{STATE}' AND business_year = {YEAR}"


def _t0a_slice(s: Src) -> DataFrame:
    return s.t0a_ind.where((F.col("state_code") == STATE) & (F.col("business_year") == YEAR))


def _over(keys) -> str:
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY individual_rate ASC NULLS LAST)"


def _t0a_window_sql(keys, *extra: str, rows: str = _T0A_IND) -> str:
    more = "".join(", " + e for e in extra)
    return oracle.sql(_present(
        f"SELECT *, min(individual_rate) OVER (PARTITION BY {', '.join(keys)}) AS min_rate_area_metal{more} "
        f"FROM ({rows}) t", doubles=("individual_rate", "min_rate_area_metal")), "st_t0a")


def _is_min(keys) -> str:
    return f"CASE WHEN rank() {_over(keys)} = 1 THEN 1 ELSE 0 END AS is_min"


def _is_slcsp(keys, fn: str) -> str:
    return f"CASE WHEN {fn}() {_over(keys)} = 2 AND metal_level = 'Silver' THEN 1 ELSE 0 END AS is_slcsp"


def _t0a_flags(t: DataFrame, keys, slcsp: str | None) -> DataFrame:
    flags = [("is_min", 1, "rank", None)]
    if slcsp:
        flags.append(("is_slcsp", 2, slcsp, F.col("metal_level") == "Silver"))
    return portable(rank.rank_flags(t, keys, "individual_rate", "min_rate_area_metal", flags, T0A_GROUPS_BOUNDED))


def _t0a_winners(t: DataFrame, keys) -> DataFrame:
    """Rows at RANK() = 1, rank kept in a column named is_min (as written). Rank 1 is
    "equal to the group minimum", so this is group statistics and a join back: a group
    where a third of all rows tie at the minimum never lands in one window task."""
    f = rank.rank_flags(t, keys, "individual_rate", flags=[("__is_min", 1, "rank", None)],
                        groups_bounded=T0A_GROUPS_BOUNDED)
    return f.where(F.col("__is_min") == 1).select(
        "state_code", "rating_area_id", "issuer_id", "plan_id", "metal_level", "individual_rate",
        "row_key", F.lit(1).cast("bigint").alias("is_min"))


def _t0a_winners_sql(keys) -> str:
    return ("SELECT state_code, rating_area_id, issuer_id, plan_id, metal_level, individual_rate, row_key, "
            f"is_min FROM (SELECT *, rank() {_over(keys)} AS is_min FROM ({_T0A_IND}) t) w WHERE is_min = 1")


PIVOT_MIN_LEVELS = ["Catastrophic", "Bronze", "Silver", "Gold"]
PIVOT_COUNT_LEVELS = ["Bronze", "Silver", "Gold", "Platinum", "Catastrophic"]


def _pivot_min_sql(rows) -> str:
    cols = ", ".join(f"CAST(min(individual_rate) FILTER (WHERE metal_level = '{m}') AS DOUBLE) AS {m.lower()}"
                     for m in PIVOT_MIN_LEVELS)
    r = ", ".join(rows)
    return oracle.sql(f"SELECT {r}, {cols}, TRY_CAST(split_part(rating_area_id, ' ', 3) AS INTEGER) AS rating_area_number "
                      f"FROM ({_T0A_IND}) t GROUP BY {r}", "st_t0a")


def _pivot_min(s: Src, rows) -> DataFrame:
    p = pivot.pivot_min(s.t0a_ind, rows, "metal_level", "individual_rate", PIVOT_MIN_LEVELS)
    return (p.withColumn("rating_area_number", clean.rating_area_number("rating_area_id"))
            .orderBy(F.col("rating_area_number").asc_nulls_last(), *rows))


def _pivot_count_sql(keys, total: bool) -> str:
    cols = ", ".join(f"count(issuer_id) FILTER (WHERE metal_level = '{m}') AS {m.lower()}"
                     for m in PIVOT_COUNT_LEVELS)
    if total:
        cols += ", count(issuer_id) AS grand_total"
    return oracle.sql(f"SELECT issuer_id, {cols} FROM ({_t0a_winners_sql(keys)}) w GROUP BY issuer_id", "st_t0a")


def _issuer_min_counts(s: Src, keys, total: str | None) -> DataFrame:
    return pivot.pivot_count(_t0a_winners(s.t0a_ind, keys), ["issuer_id"], "metal_level",
                             "issuer_id", PIVOT_COUNT_LEVELS, total=total)


@register("window_min", _t0a_window_sql(T0A_KEYS))
def q_window_min(spark, d):
    return portable(rank.with_group_min(Src(spark, d).t0a_ind, T0A_KEYS, "individual_rate",
                                        "min_rate_area_metal", groups_bounded=T0A_GROUPS_BOUNDED))


@register("window_min_as_written", _t0a_window_sql(T0A_WRITTEN))
def q_window_min_as_written(spark, d):
    return portable(rank.with_group_min(Src(spark, d).t0a_ind, T0A_WRITTEN, "individual_rate",
                                        "min_rate_area_metal", groups_bounded=T0A_GROUPS_BOUNDED))


@register("is_min_flag", _t0a_window_sql(T0A_KEYS, _is_min(T0A_KEYS)))
def q_is_min_flag(spark, d):
    return _t0a_flags(Src(spark, d).t0a_ind, T0A_KEYS, None)


@register("is_min_flag_as_written", _t0a_window_sql(T0A_WRITTEN, _is_min(T0A_WRITTEN)))
def q_is_min_flag_as_written(spark, d):
    return _t0a_flags(Src(spark, d).t0a_ind, T0A_WRITTEN, None)


@register("is_slcsp_flag", _t0a_window_sql(T0A_KEYS, _is_min(T0A_KEYS), _is_slcsp(T0A_KEYS, "rank")))
def q_is_slcsp_flag(spark, d):
    return _t0a_flags(Src(spark, d).t0a_ind, T0A_KEYS, "rank")


@register("is_slcsp_dense", _t0a_window_sql(T0A_KEYS, _is_min(T0A_KEYS), _is_slcsp(T0A_KEYS, "dense_rank")))
def q_is_slcsp_dense(spark, d):
    return _t0a_flags(Src(spark, d).t0a_ind, T0A_KEYS, "dense_rank")


@register("is_slcsp_as_written", _t0a_window_sql(T0A_WRITTEN, _is_min(T0A_WRITTEN), _is_slcsp(T0A_WRITTEN, "rank")))
def q_is_slcsp_as_written(spark, d):
    return _t0a_flags(Src(spark, d).t0a_ind, T0A_WRITTEN, "rank")


@register("is_slcsp_dense_as_written",
          _t0a_window_sql(T0A_WRITTEN, _is_min(T0A_WRITTEN), _is_slcsp(T0A_WRITTEN, "dense_rank")))
def q_is_slcsp_dense_as_written(spark, d):
    return _t0a_flags(Src(spark, d).t0a_ind, T0A_WRITTEN, "dense_rank")


@register("is_slcsp_as_written_slice",
          _t0a_window_sql(T0A_WRITTEN, _is_min(T0A_WRITTEN), _is_slcsp(T0A_WRITTEN, "rank"), rows=_T0A_SLICE))
def q_is_slcsp_as_written_slice(spark, d):
    """The written grouping on one state and year, where it separates what it should."""
    return _t0a_flags(_t0a_slice(Src(spark, d)), T0A_WRITTEN, "rank")


@register("is_slcsp_window", _t0a_window_sql(T0A_KEYS, _is_min(T0A_KEYS), _is_slcsp(T0A_KEYS, "rank")))
def q_is_slcsp_window(spark, d):
    # the same flags from full ranks: a window over the distinct rates of each group, not over its rows
    t = rank.with_group_min(Src(spark, d).t0a_ind, T0A_KEYS, "individual_rate", "min_rate_area_metal",
                            groups_bounded=T0A_GROUPS_BOUNDED)
    t = rank.rank_by_counts(t, T0A_KEYS, "individual_rate", rank_out="rank_in_group")
    t = (t.withColumn("is_min", (F.col("rank_in_group") == 1).cast("int"))
         .withColumn("is_slcsp", ((F.col("rank_in_group") == 2) & (F.col("metal_level") == "Silver")).cast("int")))
    return portable(t.drop("rank_in_group"))


@register("min_rate_winners", oracle.sql(_present(_t0a_winners_sql(T0A_KEYS), doubles=("individual_rate",)), "st_t0a"))
def q_min_rate_winners(spark, d):
    return portable(_t0a_winners(Src(spark, d).t0a_ind, T0A_KEYS))


@register("min_rate_winners_as_written",
          oracle.sql(_present(_t0a_winners_sql(T0A_WRITTEN), doubles=("individual_rate",)), "st_t0a"))
def q_min_rate_winners_as_written(spark, d):
    return portable(_t0a_winners(Src(spark, d).t0a_ind, T0A_WRITTEN))


@register("pivot_min_rate", _pivot_min_sql(["state_code", "rating_area_id"]))
def q_pivot_min_rate(spark, d):
    return _pivot_min(Src(spark, d), ["state_code", "rating_area_id"])


@register("pivot_min_rate_as_written", _pivot_min_sql(["rating_area_id"]))
def q_pivot_min_rate_as_written(spark, d):
    return _pivot_min(Src(spark, d), ["rating_area_id"])


@register("pivot_issuer_min_count", _pivot_count_sql(T0A_KEYS, False))
def q_pivot_issuer_min_count(spark, d):
    return _issuer_min_counts(Src(spark, d), T0A_KEYS, None)


@register("pivot_issuer_min_count_as_written", _pivot_count_sql(T0A_WRITTEN, False))
def q_pivot_issuer_min_count_as_written(spark, d):
    return _issuer_min_counts(Src(spark, d), T0A_WRITTEN, None)


@register("pivot_grand_total", _pivot_count_sql(T0A_KEYS, True))
def q_pivot_grand_total(spark, d):
    return _issuer_min_counts(Src(spark, d), T0A_KEYS, "grand_total")


@register("pivot_grand_total_as_written", _pivot_count_sql(T0A_WRITTEN, True))
def q_pivot_grand_total_as_written(spark, d):
    return _issuer_min_counts(Src(spark, d), T0A_WRITTEN, "grand_total")


def _nth_sql(n: int) -> str:
    k = ", ".join(T0A_KEYS)
    return oracle.sql(_present(
        f"SELECT {k}, plan_id, row_key, individual_rate FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {k} ORDER BY individual_rate ASC NULLS LAST, plan_id ASC NULLS LAST, "
        f"row_key ASC NULLS LAST) AS rn FROM ({_T0A_IND}) t) w WHERE rn = {n}",
        doubles=("individual_rate",)), "st_t0a")


def _nth(s: Src, n: int) -> DataFrame:
    return portable(rank.nth_row(s.t0a_ind, T0A_KEYS, ["individual_rate", "plan_id", "row_key"], n,
                                 ["plan_id", "row_key", "individual_rate"]))


@register("nth_row_benchmark", _nth_sql(2))
def q_nth_row_benchmark(spark, d):
    return _nth(Src(spark, d), 2)


@register("nth_row_third", _nth_sql(3))
def q_nth_row_third(spark, d):
    return _nth(Src(spark, d), 3)


# ---------------------------------------------------------------- landscape pipeline

def _ordered_by(*more: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in ("individual_rate", "plan_id", "row_key", "fips", *more))


def _places(ids: str, name: str, rows: str, keys: str, order: str) -> str:
    """Each id's place in its group's ordered list, from 1."""
    return (f"SELECT unnest(ids) AS {ids}, generate_subscripts(ids, 1) AS {name} "
            f"FROM (SELECT list({ids} ORDER BY {order}) AS ids FROM {rows} GROUP BY {keys}) lists")


_MARKET = "business_year, state_code, county, metal_level"
_SHELF = f"{_MARKET}, issuer_market_place_marketing_name"


_NUMERIC_ENROLLMENT = ("SELECT issuer_hios_id, year, county_fips, max(TRY_CAST(nullif(trim(avg_enrollment), 'NULL') AS DOUBLE)) "
                       "AS avg_enrollment FROM st_enrollment GROUP BY ALL")
_RAW_ENROLLMENT = "SELECT issuer_hios_id, year, county_fips, avg_enrollment FROM st_enrollment"


def landscape_ctes(year: int | None, state: str = "All",
                   overall_keys: tuple[str, ...] = ("county", "metal_level"),
                   enrollment: str = _NUMERIC_ENROLLMENT) -> tuple:
    """The steps as SQL over the stand-ins; names say what a row is."""
    def only(*conditions: str) -> str:
        parts = [*conditions, *([] if year is None else [f"business_year = {year}"]), *([] if state == "All" else [f"state_code = '{state}'"])]
        return " WHERE " + " AND ".join(parts) if parts else ""

    return (
        ("covered", _SA_EXPANDED_SQL),
        # a rate of a plan in one county that the plan's service area covers
        ("offers", f"""
  SELECT rt.business_year, rt.state_code, rt.issuer_id, about.seller AS issuer_market_place_marketing_name,
         rt.plan_id, about.plan_marketing_name, about.plan_type, about.metal_level, rt.age, rt.rating_area_id,
         rt.individual_rate, about.deductible, about.oopm, spot.fips, spot.county, rt.row_key
  FROM (SELECT business_year, state_code, issuer_id, standard_component_id AS plan_id, service_area_id,
               issuer_market_place_marketing_name AS seller, plan_marketing_name, plan_type,
               {_MAPPED} AS metal_level, {_DED} AS deductible, {_OOPM} AS oopm
        FROM st_plan_attr{only("market_coverage = 'Individual'", "ends_with(plan_id, '1')")}) about
  JOIN covered USING (business_year, state_code, issuer_id, service_area_id)
  JOIN (SELECT lpad(fips, 5, '0') AS fips, county, rating_area FROM st_rating_area_county_raw) spot
    ON spot.fips = lpad(covered.county, 5, '0')
  JOIN (SELECT * FROM st_rate{only("age = '21'")}) rt
    ON rt.business_year = about.business_year AND rt.state_code = about.state_code AND rt.issuer_id = about.issuer_id
   AND rt.plan_id = about.plan_id AND rt.rating_area_id = spot.rating_area"""),
        ("numbered", "SELECT row_number() OVER () AS offer, * FROM offers"),
        # ranks are places in the groups' ordered lists
        ("market_places", _places("offer", "metal_rank", "numbered", _MARKET, _ordered_by())),
        ("shelf_places", _places("offer", "issuer_rank", "numbered", _SHELF, _ordered_by())),
        ("ordered", """
  SELECT numbered.* EXCLUDE (offer), metal_rank, issuer_rank
  FROM numbered JOIN market_places USING (offer) JOIN shelf_places USING (offer)"""),
        ("cheapest", f"""
  SELECT {_MARKET}, first(issuer_market_place_marketing_name ORDER BY {_ordered_by()}) AS min_issuer,
         first(individual_rate ORDER BY {_ordered_by()}) AS min_rate
  FROM offers GROUP BY {_MARKET}"""),
        ("benchmark", f"""
  SELECT business_year, state_code, county, rates[2] AS slcsp_rate
  FROM (SELECT {_MARKET}, list(individual_rate ORDER BY {_ordered_by()}) AS rates FROM offers
        WHERE metal_level = 'Silver' GROUP BY {_MARKET}) silver
  WHERE len(rates) > 1"""),
        ("gaps", """
  SELECT ordered.*, cheapest.min_issuer, ordered.individual_rate - cheapest.min_rate AS diff_from_min,
         ordered.individual_rate - benchmark.slcsp_rate AS diff_from_slcsp
  FROM ordered
  JOIN cheapest USING (business_year, state_code, county, metal_level)
  LEFT JOIN benchmark USING (business_year, state_code, county)"""),
        ("seats", enrollment),
        ("entrants", f"""
  SELECT row_number() OVER () AS entrant, best.*, seats.avg_enrollment
  FROM (SELECT {_MARKET}, pick.* FROM (
          SELECT {_SHELF}, first(struct_pack(issuer_id, plan_id, row_key, fips, individual_rate) ORDER BY {_ordered_by()}) AS pick
          FROM offers GROUP BY {_SHELF}) shelves) best
  LEFT JOIN seats ON seats.issuer_hios_id = best.issuer_id AND seats.year = best.business_year AND seats.county_fips = best.fips"""),
        ("entrant_places", _places("entrant", "issuer_overall_rank", "entrants", ", ".join(("business_year", *overall_keys)),
                                   _ordered_by("avg_enrollment"))),
        ("standing", """
  SELECT business_year, issuer_id, fips, metal_level, issuer_overall_rank, avg_enrollment AS issuer_avg_monthly_enrollment
  FROM entrants JOIN entrant_places USING (entrant)"""),
    )


# the 21 columns: ranked offers with their issuer's standing, the place's rating area and the parent
_FINAL_SELECT = """
SELECT business_year, state_code, issuer_id, issuer_market_place_marketing_name, plan_id, plan_marketing_name, plan_type,
       metal_level, CAST(individual_rate AS DOUBLE) AS individual_rate, deductible, oopm, county, fips, metal_rank, issuer_rank,
       issuer_overall_rank, issuer_avg_monthly_enrollment AS issuer_avg_enrollment, place.rate_area AS rating_area,
       owner.company_name, owner.parent_name, business_year AS year
FROM ordered
JOIN standing USING (business_year, issuer_id, fips, metal_level)
JOIN (SELECT fips, state AS state_code, rate_area FROM st_fips_ra) place USING (fips, state_code)
LEFT JOIN (SELECT hios_issuer_id AS issuer_id, company_name, parent_name FROM st_parent) owner USING (issuer_id)"""

_LS_STANDINS = ("st_rate", "st_plan_attr", "st_service_area", "st_county",
                "st_rating_area_county_raw", "st_enrollment", "st_fips_ra", "st_parent")


def landscape_sql(body: str, year: int | None = YEAR, state: str = "All",
                  overall_keys=("county", "metal_level"), enrollment: str = _NUMERIC_ENROLLMENT) -> str:
    return oracle.sql(body, *_LS_STANDINS, ctes=landscape_ctes(year, state, tuple(overall_keys), enrollment))


def _run(spark, d, year=YEAR, state="All", materialize=True, **opts) -> ls.Landscape:
    return ls.Landscape(Src(spark, d, materialize).inputs(), Params(year, state), ls.Options(**opts))


@register("landscape_summary", landscape_sql(_present(
    "SELECT * FROM offers", doubles=("individual_rate",))))
def q_landscape_summary(spark, d):
    return portable(_run(spark, d).summary())


@register("landscape_ranking", landscape_sql(_present(
    "SELECT * FROM ordered", doubles=("individual_rate",))))
def q_landscape_ranking(spark, d):
    return portable(_run(spark, d).ranking())


# Small cells cut every group into many pieces: the answer must not move.
_SPLIT = dict(cell_rows=3)


@register("landscape_ranking_skew_split", landscape_sql(_present(
    "SELECT * FROM ordered", doubles=("individual_rate",))))
def q_landscape_ranking_skew_split(spark, d):
    return portable(_run(spark, d, **_SPLIT).ranking())


@register("landscape_all_years_skew_split", landscape_sql(_FINAL_SELECT, year=None))
def q_landscape_all_years_skew_split(spark, d):
    return portable(_run(spark, d, year=None, **_SPLIT).final())


@register("landscape_current_year_salted", landscape_sql(_FINAL_SELECT))
def q_landscape_current_year_salted(spark, d):
    # the hot keys of X2's rate join are salted: the answer must not move
    return portable(_run(spark, d, salt_buckets=4).final())


@register("landscape_min_metal", landscape_sql(_present(
    "SELECT * FROM cheapest", doubles=("min_rate",))))
def q_landscape_min_metal(spark, d):
    return portable(ls.min_metal(_run(spark, d).ranking()))


@register("landscape_slcsp", landscape_sql(_present(
    "SELECT * FROM benchmark", doubles=("slcsp_rate",))))
def q_landscape_slcsp(spark, d):
    return portable(ls.slcsp(_run(spark, d).ranking()))


@register("landscape_diffs", landscape_sql(_present(
    "SELECT * FROM gaps", doubles=("individual_rate", "diff_from_min", "diff_from_slcsp"))))
def q_landscape_diffs(spark, d):
    return portable(_run(spark, d).diffs())


@register("landscape_overall_rank", landscape_sql("SELECT * FROM standing"))
def q_landscape_overall_rank(spark, d):
    return _run(spark, d).overall_rank()


@register("landscape_overall_rank_as_written",
          landscape_sql("SELECT * FROM standing", enrollment=_RAW_ENROLLMENT))
def q_landscape_overall_rank_as_written(spark, d):
    """X7 after the raw enrollment join: text values, and a duplicate row repeats a winner."""
    return _run(spark, d, enrollment="as_written").overall_rank()


@register("landscape_current_year_as_written", landscape_sql(_FINAL_SELECT, enrollment=_RAW_ENROLLMENT))
def q_landscape_current_year_as_written(spark, d):
    """X8 with the raw enrollment text, sentinel included."""
    return portable(_run(spark, d, enrollment="as_written").final())


def _register_all_years() -> None:
    """X2-X7 over all years and states in one pass."""
    steps = {"summary": ("offers", ("individual_rate",), lambda r: r.summary()),
             "ranking": ("ordered", ("individual_rate",), lambda r: r.ranking()),
             "min_metal": ("cheapest", ("min_rate",), lambda r: ls.min_metal(r.ranking())),
             "slcsp": ("benchmark", ("slcsp_rate",), lambda r: ls.slcsp(r.ranking())),
             "diffs": ("gaps", ("individual_rate", "diff_from_min", "diff_from_slcsp"), lambda r: r.diffs()),
             "overall_rank": ("standing", (), lambda r: r.overall_rank())}
    for name, (cte, doubles, step) in steps.items():
        register(f"landscape_{name}_all_years", landscape_sql(_present(f"SELECT * FROM {cte}", doubles=doubles), year=None))(
            lambda spark, d, step=step: portable(step(_run(spark, d, year=None))))


_register_all_years()


_BY_STATE = ("state_code", "county", "metal_level")


@register("landscape_overall_rank_by_state",
          landscape_sql("SELECT * FROM standing", overall_keys=_BY_STATE))
def q_landscape_overall_rank_by_state(spark, d):
    return _run(spark, d, overall_keys=_BY_STATE).overall_rank()


@register("landscape_current_year", landscape_sql(_FINAL_SELECT))
def q_landscape_current_year(spark, d):
    return portable(_run(spark, d).final())


@register("landscape_state", landscape_sql(_FINAL_SELECT, state=STATE))
def q_landscape_state(spark, d):
    return portable(_run(spark, d, state=STATE).final())


@register("landscape_all_years", landscape_sql(_FINAL_SELECT, year=None))
def q_landscape_all_years(spark, d):
    return portable(_run(spark, d, year=None).final())


@register("landscape_by_state", landscape_sql(_FINAL_SELECT, overall_keys=_BY_STATE))
def q_landscape_by_state(spark, d):
    return portable(_run(spark, d, overall_keys=_BY_STATE).final())


@register("missing_enrollment", landscape_sql(
    f"SELECT * FROM ({_FINAL_SELECT}) x WHERE issuer_avg_enrollment IS NULL"))
def q_missing_enrollment(spark, d):
    return portable(_run(spark, d, only_missing_enrollment=True).final())


@register("parent_filter", landscape_sql(
    f"SELECT * FROM ({_FINAL_SELECT}) x WHERE parent_name = '{PARENT}'"))
def q_parent_filter(spark, d):
    return portable(_run(spark, d, parent_name=PARENT).final())


@register("pipeline_step_counts", landscape_sql("""
SELECT 'sa_expanded' AS step, state_code, count(*) AS row_count FROM covered
 WHERE business_year = {y} GROUP BY state_code
UNION ALL SELECT 'summary', state_code, count(*) FROM offers GROUP BY state_code
UNION ALL SELECT 'min_metal', state_code, count(*) FROM cheapest GROUP BY state_code
UNION ALL SELECT 'slcsp', state_code, count(*) FROM benchmark GROUP BY state_code
UNION ALL SELECT 'final', state_code, count(*) FROM ({f}) x GROUP BY state_code""".format(
    y=YEAR, f=_FINAL_SELECT)))
def q_pipeline_step_counts(spark, d):
    run = _run(spark, d)
    rk = run.ranking()
    return profile.step_counts([("sa_expanded", ls.sa_expanded(run.inp, run.params)),
                                ("summary", run.summary()), ("min_metal", ls.min_metal(rk)),
                                ("slcsp", ls.slcsp(rk)), ("final", run.final())])


@register("sink_roundtrip", landscape_sql(_FINAL_SELECT, year=None))
def q_sink_roundtrip(spark, d):
    """All years written partitioned by (business_year, state_code) to the shared
    folder, then read back whole."""
    path = sink.shared_path(spark, "landscape", d)
    sink.write_partitioned(portable(_run(spark, d, year=None).final()), path)
    back = sink.read_partitioned(spark, path)
    return back.select(*ls.FINAL_COLUMNS)


@register("sink_pruned_read", landscape_sql(
    f"SELECT * FROM ({_FINAL_SELECT}) x WHERE state_code = '{STATE}'"))
def q_sink_pruned_read(spark, d):
    """One year and state read back from the partitioned sink: partition pruning."""
    path = sink.shared_path(spark, "landscape_pruned", d)
    sink.write_partitioned(portable(_run(spark, d, year=None).final()), path)
    # one year's folders again: the others stay
    sink.write_partitioned(portable(_run(spark, d).final()), path, mode="partitions")
    return sink.read_partitioned(spark, path, YEAR, STATE).select(*ls.FINAL_COLUMNS)


@register("published_read", landscape_sql(f"SELECT * FROM ({_FINAL_SELECT}) x WHERE state_code = '{STATE}'", year=None))
def q_published_read(spark, d):
    """All years published whole, one year's partitions then replaced, one state read from the current manifest."""
    table = published.Published(spark, sink.shared_path(spark, "landscape_published", d))
    table.publish(_run(spark, d, year=None).final())
    table.publish(_run(spark, d).final(), [{"business_year": YEAR}])
    return portable(table.read(state_code=STATE))


@register("landscape_refreshed", landscape_sql(_FINAL_SELECT, year=None))
def q_landscape_refreshed(spark, d):
    """A landscape published from older rates of one year and without another year's plans, then refreshed: whole again."""
    inp = _run(spark, d).inp
    older = replace(inp, rate=inp.rate.withColumn("individual_rate", F.when(
        F.col("business_year") == YEAR, F.col("individual_rate") + 1).otherwise(F.col("individual_rate")).cast(inp.rate.schema["individual_rate"].dataType)),
        plan=inp.plan.where(F.col("business_year") != YEAR - 1))
    path = sink.shared_path(spark, "landscape_refreshed", d)
    refresh.refresh(older, Params(None), path)
    refresh.refresh(inp, Params(None), path)
    return portable(published.Published(spark, path).read())


def queries() -> dict[str, Builder]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in REGISTRY.items() if s is not None}
