"""ACA-shaped stand-in tables derived from the TPC-H-style test tables.

The analyses run on marketplace tables (rates, plan attributes, service areas,
county and rating-area lookups, enrollment, parent companies) that are not in the
test data, so each one is derived here from the star schema, as a lazy DataFrame
whose size grows with the source tables. The mapping (FIXTURES.md §C) is:
state = nation, issuer = supplier, plan = supplier x k, county = nation x region
slot, year = ship year. ``grainline.oracle`` states the same mapping in SQL.

Dirty values are produced on purpose: ``No\\r`` flags, ``false`` for "no", money as
text, FIPS codes with their leading zeros dropped, a text ``NULL`` sentinel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from . import tables
from .steps import file_system

# Fixed values of the stand-in mapping (FIXTURES.md §C), in index order.
METAL_BY_K = ["Expanded Bronze", "Bronze", "Silver", "Silver", "Gold", "Platinum",
              "Catastrophic", "High", "Low"]
PLAN_TYPE_BY_K_MOD_3 = ["HMO", "PPO", "EPO"]
CSR_BY_V = ["Off Exchange", "On Exchange", "73% AV"]
PLANS_PER_ISSUER = 9            # the ninth has no rates
VARIANTS_PER_PLAN = 3
COUNTIES_PER_STATE = 5          # one per region slot
CR = "\r"


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(values: list[str], idx: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def _range(n: int) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _nation(spark, sf_dir) -> DataFrame:
    # 25 rows at every scale factor: a bounded dimension, safe to broadcast.
    return F.broadcast(tables.load(spark, sf_dir, "nation", ["n_nationkey", "n_name"]))


def county(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County lookup (usps, geoid): five counties per state, named after regions."""
    region = F.broadcast(tables.load(spark, sf_dir, "region", ["r_regionkey", "r_name"]))
    slots = tables.load(spark, sf_dir, "nation", ["n_nationkey", "n_name"]).select(
        "n_nationkey", "n_name", _range(COUNTIES_PER_STATE).alias("rk"))
    return (slots.join(region, slots.rk == region.r_regionkey)
            .select(F.col("n_name").alias("usps"),
                    F.concat(F.lpad(_s("n_nationkey"), 2, "0"),
                             F.lpad(_s(F.col("rk") * 2 + 1), 3, "0")).alias("geoid"),
                    F.col("r_name").alias("county"),
                    F.col("rk")))


def rating_area_county(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """County -> rating area map. ``raw`` keeps the FIPS with leading zeros dropped, as
    the source delivers it; the default pads it back once, at load."""
    c = county(spark, sf_dir)
    fips = clean.strip_leading_zeros("geoid")
    # the last county of each state is split between two rating areas
    areas = F.when(F.col("rk") == 4, F.array(F.lit(2), F.lit(3))).otherwise(F.array((F.col("rk") % 3 + 1).cast("int")))
    return c.select((fips if raw else clean.pad_fips(fips)).alias("fips"), "county", F.explode(areas).alias("area")).select(
        "fips", "county", F.concat(F.lit("Rating Area "), _s("area")).alias("rating_area"))


def rate(spark: SparkSession, sf_dir: str, spread: Callable[[DataFrame], DataFrame] | None = None,
         order: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rate table: one row per line item, keyed by a unique ``row_key``.

    ``spread`` (an exchange by ``business_year``) and ``order`` (inside its partitions) lay the rows out while they hold the
    numbers of the source only: texts are made last, so none is shuffled or sorted."""
    li = tables.load(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])
    sup = tables.load(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    ext = F.col("l_extendedprice").cast("decimal(12,2)")
    day = F.col("l_shipdate").cast("date")
    joined = li.join(sup, li.l_suppkey == sup.s_suppkey).drop("s_suppkey").withColumn("business_year", F.year("l_shipdate"))
    if spread:
        joined = spread(joined)
    joined = (joined.join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
              .withColumnRenamed("n_name", "state_code").drop("s_nationkey", "n_nationkey"))
    if order:
        joined = order(joined)
    return joined.select(
        "business_year",
        "state_code",
        F.col("l_suppkey").alias("issuer_id"),
        # some rates name a plan that no plan attributes describe
        F.concat(_s("l_suppkey"), F.lit("-"), _s(F.when(F.col("l_partkey") % 40 == 39, F.lit(9).cast("bigint"))
                                                 .otherwise(F.col("l_partkey") % 8))).alias("plan_id"),
        F.concat(F.lit("Rating Area "), _s(F.col("l_linenumber") % 3 + 1)).alias("rating_area_id"),
        _s((F.lit(21) + F.col("l_quantity") % 3).cast("int")).alias("age"),
        F.when(F.col("l_returnflag") == "N", F.lit("No Preference"))
         .otherwise(F.lit("Tobacco User/Non-Tobacco User")).alias("tobacco"),
        F.when(F.col("l_discount") == 0.0, F.lit(None).cast("decimal(12,2)"))
         .otherwise(ext).alias("individual_rate"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("decimal(12,2)"))
         .otherwise((ext + F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(12,2)"))
         .alias("individual_tobacco_rate"),
        day.alias("rate_effective_date"),
        F.col("l_linenumber").alias("version_number"),
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                    _s("l_suppkey"), _s(ext), _s(day)).alias("row_key"),
    )


def _issuer_years(spark, sf_dir) -> DataFrame:
    """(issuer, year, state) for every year an issuer has rate rows: a partial-
    aggregated distinct over two columns of the rate source."""
    li = tables.load(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate"])
    years = li.select("l_suppkey", F.year("l_shipdate").alias("business_year")).distinct()
    sup = tables.load(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    return (years.join(sup, years.l_suppkey == sup.s_suppkey)
            .join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("business_year", "s_suppkey", "s_name", "n_name", "s_nationkey"))


def plan_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan attributes: issuer x year x plan k (0..8) x cost-sharing variant v (0..2)."""
    base = _issuer_years(spark, sf_dir).select(
        "*", _range(PLANS_PER_ISSUER).alias("k")).select(
        "*", _range(VARIANTS_PER_PLAN).alias("v"))
    k, sk = F.col("k"), F.col("s_suppkey")
    ded_a = F.when(k % 3 == 0, F.concat(F.lit("$"), _s(k * 100 + 1000)))
    ded_b = F.when(k % 3 == 1, F.lit("$1,500 per person"))
    ded_c = F.when(k != 5, F.lit("$900 per person"))
    return base.select(
        "business_year",
        F.col("n_name").alias("state_code"),
        sk.alias("issuer_id"),
        F.col("s_name").alias("issuer_market_place_marketing_name"),
        F.concat(_s(sk), F.lit("-"), _s(k)).alias("standard_component_id"),
        F.concat(_s(sk), F.lit("-"), _s(k), F.lit("-0"), _s("v")).alias("plan_id"),
        F.concat(F.lit("SA"), _s(k % 2)).alias("service_area_id"),
        _pick(METAL_BY_K, k).alias("metal_level"),
        _pick(PLAN_TYPE_BY_K_MOD_3, k % 3).alias("plan_type"),
        _pick(CSR_BY_V, F.col("v")).alias("csr_variation_type"),
        F.when(k == 7, F.lit("Yes")).when((k % 2 == 0) & ~((k == 4) & (sk % 2 == 1)), F.lit("No" + CR))
         .otherwise(F.lit("No")).alias("dental_only_plan"),
        F.when(sk % 10 == 9, F.lit("SHOP (Small Group)")).otherwise(F.lit("Individual"))
         .alias("market_coverage"),
        F.concat(F.lit("Plan "), _s(k)).alias("plan_marketing_name"),
        ded_a.alias("tehb_ded_inn_tier1_individual"),
        ded_b.alias("mehb_ded_inn_tier1_individual"),
        ded_c.alias("tehb_ded_inn_tier1_family_per_person"),
        ded_a.alias("tehb_inn_tier1_individual_moop"),
        ded_c.alias("tehb_inn_tier1_family_per_person_moop"),
    )


def service_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service areas: per issuer-year, SA0 covers the whole state (one row, no county)
    and SA1 lists three counties of the issuer's state."""
    iy = _issuer_years(spark, sf_dir).select(
        "*", _range(2).alias("a"))
    iy = iy.select("*", F.explode(F.when(F.col("a") == 0, F.array(F.lit(0)))
                                   .otherwise(F.array(F.lit(0), F.lit(1), F.lit(2)))).alias("slot"))
    cty = F.broadcast(county(spark, sf_dir))   # 5 x 25 rows: bounded
    j = iy.join(cty, (iy.n_name == cty.usps) & (iy.slot == cty.rk))
    a, sk = F.col("a"), F.col("s_suppkey")
    return j.select(
        "business_year",
        F.col("n_name").alias("state_code"),
        sk.alias("issuer_id"),
        F.concat(F.lit("SA"), _s(a)).alias("service_area_id"),
        F.when((a == 0) & (sk % 10 == 5), F.lit("true")).when(a == 0, F.lit("Yes"))
         .when(sk % 2 == 0, F.lit("No")).otherwise(F.lit("false"))
         .alias("cover_entire_state"),
        F.when(a == 1, F.concat(F.col("n_name"), F.lit(" - "), F.col("geoid"))).alias("county"),
        F.when(a == 1, F.col("county")).alias("county_name"),
        F.when(sk % 4 == 0, F.lit("No" + CR)).when(sk % 50 == 7, F.lit("Yes"))
         .otherwise(F.lit("No")).alias("dental_only_plan"),
    )


def zip_rating_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finer-than-county rating-area rows (one per customer): fips, state, rate_area."""
    cust = tables.load(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    slot = F.col("c_custkey") % 5
    return (cust.join(_nation(spark, sf_dir), cust.c_nationkey == F.col("n_nationkey"))
            .select(F.concat(F.lpad(_s("c_nationkey"), 2, "0"),
                             F.lpad(_s(slot * 2 + 1), 3, "0")).alias("fips"),
                    F.col("n_name").alias("state"),
                    F.concat(F.lit("Rating Area "), _s(F.when(F.col("c_custkey") % 10 == 9, F.lit(3).cast("bigint"))
                                                       .otherwise(slot % 3 + 1))).alias("rate_area")))


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issuer x year x county enrollment as text: a ``'NULL'`` sentinel, true NULLs, and for some issuers a
    second row with another value."""
    sup = tables.load(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    n_sup = sup.count()     # one number: the modulus that maps orders to issuers
    orders = tables.load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    j = (orders.join(sup, (orders.o_custkey % F.lit(n_sup)) == sup.s_suppkey)
         .join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))
    g = j.groupBy(
        F.col("s_suppkey").alias("issuer_hios_id"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lpad(_s("s_nationkey"), 2, "0"),
                 F.lpad(_s((F.col("o_orderkey") % 5) * 2 + 1), 3, "0")).alias("county_fips"),
        F.col("n_name").alias("state"),
    ).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    first = F.when(n > 8, F.lit("NULL")).when(n != 3, _s(n))
    values = F.when(F.col("issuer_hios_id") % 9 == 4, F.array(first, _s(n + 7))).otherwise(F.array(first))
    return g.select("issuer_hios_id", "year", "county_fips", F.explode(values).alias("avg_enrollment"), "state")


def parent_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = tables.load(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    return sup.where(F.col("s_suppkey") % 6 != 5).select(
        F.col("s_suppkey").alias("hios_issuer_id"),
        F.col("s_name").alias("company_name"),
        F.concat(F.lit("Parent "), _s(F.col("s_suppkey") % 7)).alias("parent_name"))


T0A_COLUMNS = ["market_coverage", "business_year", "state_code", "issuer_id", "plan_id",
               "rating_area_id", "metal_level", "age", "tobacco", "csr_variation_type",
               "individual_rate", "row_key"]


def t0a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared analysis table: age-21 base-variant rate rows with plan attributes,
    rates bucketed to 500 so that true ties occur."""
    r = rate(spark, sf_dir).where(F.col("age") == "21")
    p = plan_attributes(spark, sf_dir).where(clean.is_base_variant("plan_id")).select(
        "standard_component_id", F.col("business_year").alias("p_year"), "market_coverage",
        "metal_level", "csr_variation_type")
    j = r.join(p, (r.plan_id == p.standard_component_id) & (r.business_year == p.p_year))
    bucket = (F.floor(F.col("individual_rate") / 500) * 500).cast("decimal(12,2)")
    return j.withColumn("individual_rate", bucket).select(*T0A_COLUMNS)


BUILDERS = {
    "st_county": county,
    "st_rating_area_county": rating_area_county,
    "st_rating_area_county_raw": lambda s, d: rating_area_county(s, d, raw=True),
    "st_rate": rate,
    "st_plan_attr": plan_attributes,
    "st_service_area": service_area,
    "st_zip_rating_area": zip_rating_area,
    "st_enrollment": enrollment,
    "st_parent": parent_map,
    "st_t0a": t0a,
}


def build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


# ----------------------------------------------------------------- materialisation

# Bump when a builder changes: materialised copies are keyed by it.
STANDIN_VERSION = 2
# Stored Hive-style by year (literal year filters prune whole folders) and sorted by
# state inside each file (state filters skip row groups by min/max statistics): the
# write needs its rows by partition column first, so that is the leading sort key.
PARTITION_BY_YEAR = {"st_rate", "st_plan_attr", "st_service_area", "st_t0a"}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Of the tables that the stand-ins read: every file's size and time, as their file system reports them."""
    import hashlib
    h = hashlib.sha1(f"{STANDIN_VERSION}|{sf_dir.rstrip('/')}".encode())
    for name in sorted(tables.CONTRACTS):
        path, fs = file_system(spark, tables.table_path(sf_dir, name))
        if not fs.exists(path):
            continue
        for f in [fs.getFileStatus(path)] if fs.getFileStatus(path).isFile() else sorted(fs.listStatus(path), key=lambda x: x.getPath().getName()):
            h.update(f"{name}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def _laid_out(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in as it is written: see PARTITION_BY_YEAR."""
    def spread(df: DataFrame) -> DataFrame:
        return df.hint("rebalance", "business_year")

    def order(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions("business_year", "state_code")

    if name == "st_rate":
        return rate(spark, sf_dir, spread, order)
    df = build(spark, sf_dir, name)
    return order(spread(df)) if name in PARTITION_BY_YEAR else df


def materialized(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in as a stored parquet table under the shared checkpoint folder,
    built on first use and read (with pushdown and pruning) afterwards."""
    from ..session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/grainline_standins/{_fingerprint(spark, sf_dir)}/{name}"
    done, fs = file_system(spark, f"{path}/_SUCCESS")
    schema = _SCHEMAS.get(path)
    if not fs.exists(done):
        df = _laid_out(spark, sf_dir, name)
        write = df.write.mode("overwrite")
        (write.partitionBy("business_year") if name in PARTITION_BY_YEAR else write).parquet(path)
        schema = _SCHEMAS[path] = df.schema
    if schema is None:
        df = spark.read.parquet(path)
        if name in PARTITION_BY_YEAR:
            df = df.withColumn("business_year", F.col("business_year").cast("int"))
        _SCHEMAS[path] = df.schema
        return df
    # a known schema skips the footer-reading job of schema inference; the partition
    # column is declared with its type, so no cast is needed
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


_SCHEMAS: dict = {}
