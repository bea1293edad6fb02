"""Independent SQL statements of every query, for DuckDB.

The oracle is written from the semantics, not generated from the Spark code: each
stand-in table and each query is plain SQL text over the driver's views (region,
nation, customer, supplier, orders, lineitem). ``sql(body, *standins)`` prefixes the
stand-in CTEs a statement needs, in dependency order.

Conventions shared with the Spark side: NULLs-last ordering written out, every
row_number with a unique tie-break, ranks and counts as BIGINT, money outputs as
DOUBLE, dates as text.
"""

from __future__ import annotations

STANDINS: dict[str, tuple[tuple[str, ...], str]] = {
    "st_county": ((), """
  SELECT n.n_name AS usps,
         lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') || lpad(CAST(k.rk * 2 + 1 AS VARCHAR), 3, '0') AS geoid,
         r.r_name AS county, k.rk AS rk
  FROM nation n
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS rk FROM range(5)) k
  JOIN region r ON r.r_regionkey = k.rk"""),
    "st_rating_area_county_raw": (("st_county",), """
  SELECT ltrim(geoid, '0') AS fips, county,
         'Rating Area ' || CAST(unnest(CASE WHEN rk = 4 THEN [2, 3] ELSE [rk % 3 + 1] END) AS VARCHAR) AS rating_area
  FROM st_county"""),
    "st_rating_area_county": (("st_rating_area_county_raw",), """
  SELECT lpad(fips, 5, '0') AS fips, county, rating_area FROM st_rating_area_county_raw"""),
    "st_rate": ((), """
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS business_year,
         n.n_name AS state_code,
         l.l_suppkey AS issuer_id,
         CAST(l.l_suppkey AS VARCHAR) || '-' ||
           CAST(CASE WHEN l.l_partkey % 40 = 39 THEN 9 ELSE l.l_partkey % 8 END AS VARCHAR) AS plan_id,
         'Rating Area ' || CAST(l.l_linenumber % 3 + 1 AS VARCHAR) AS rating_area_id,
         CAST(CAST(21 + l.l_quantity % 3 AS INTEGER) AS VARCHAR) AS age,
         CASE WHEN l.l_returnflag = 'N' THEN 'No Preference'
              ELSE 'Tobacco User/Non-Tobacco User' END AS tobacco,
         CASE WHEN l.l_discount = 0.0 THEN NULL
              ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END AS individual_rate,
         CASE WHEN l.l_returnflag = 'N' THEN NULL
              ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) + CAST(l.l_quantity AS DECIMAL(12,2))
                        AS DECIMAL(12,2)) END AS individual_tobacco_rate,
         CAST(l.l_shipdate AS DATE) AS rate_effective_date,
         l.l_linenumber AS version_number,
         concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                   CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
                   CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR),
                   CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR)) AS row_key
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "st_issuer_years": ((), """
  SELECT y.business_year, s.s_suppkey, s.s_name, n.n_name, s.s_nationkey
  FROM (SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS business_year FROM lineitem) y
  JOIN supplier s ON y.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "st_plan_attr": (("st_issuer_years",), """
  SELECT iy.business_year,
         iy.n_name AS state_code,
         iy.s_suppkey AS issuer_id,
         iy.s_name AS issuer_market_place_marketing_name,
         CAST(iy.s_suppkey AS VARCHAR) || '-' || CAST(k.k AS VARCHAR) AS standard_component_id,
         CAST(iy.s_suppkey AS VARCHAR) || '-' || CAST(k.k AS VARCHAR) || '-0' || CAST(v.v AS VARCHAR) AS plan_id,
         'SA' || CAST(k.k % 2 AS VARCHAR) AS service_area_id,
         CASE k.k WHEN 0 THEN 'Expanded Bronze' WHEN 1 THEN 'Bronze' WHEN 2 THEN 'Silver'
                  WHEN 3 THEN 'Silver' WHEN 4 THEN 'Gold' WHEN 5 THEN 'Platinum'
                  WHEN 6 THEN 'Catastrophic' WHEN 7 THEN 'High' ELSE 'Low' END AS metal_level,
         CASE k.k % 3 WHEN 0 THEN 'HMO' WHEN 1 THEN 'PPO' ELSE 'EPO' END AS plan_type,
         CASE v.v WHEN 0 THEN 'Off Exchange' WHEN 1 THEN 'On Exchange' ELSE '73% AV' END AS csr_variation_type,
         CASE WHEN k.k = 7 THEN 'Yes' WHEN k.k = 4 AND iy.s_suppkey % 2 = 1 THEN 'No'
              WHEN k.k % 2 = 0 THEN 'No' || chr(13) ELSE 'No' END AS dental_only_plan,
         CASE WHEN iy.s_suppkey % 10 = 9 THEN 'SHOP (Small Group)' ELSE 'Individual' END AS market_coverage,
         'Plan ' || CAST(k.k AS VARCHAR) AS plan_marketing_name,
         CASE WHEN k.k % 3 = 0 THEN '$' || CAST(1000 + 100 * k.k AS VARCHAR) END AS tehb_ded_inn_tier1_individual,
         CASE WHEN k.k % 3 = 1 THEN '$1,500 per person' END AS mehb_ded_inn_tier1_individual,
         CASE WHEN k.k <> 5 THEN '$900 per person' END AS tehb_ded_inn_tier1_family_per_person,
         CASE WHEN k.k % 3 = 0 THEN '$' || CAST(1000 + 100 * k.k AS VARCHAR) END AS tehb_inn_tier1_individual_moop,
         CASE WHEN k.k <> 5 THEN '$900 per person' END AS tehb_inn_tier1_family_per_person_moop
  FROM st_issuer_years iy
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(9)) k
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS v FROM range(3)) v"""),
    "st_service_area": (("st_issuer_years", "st_county"), """
  SELECT iy.business_year,
         iy.n_name AS state_code,
         iy.s_suppkey AS issuer_id,
         'SA' || CAST(a.a AS VARCHAR) AS service_area_id,
         CASE WHEN a.a = 0 THEN CASE WHEN iy.s_suppkey % 10 = 5 THEN 'true' ELSE 'Yes' END
              WHEN iy.s_suppkey % 2 = 0 THEN 'No' ELSE 'false' END AS cover_entire_state,
         CASE WHEN a.a = 1 THEN iy.n_name || ' - ' || c.geoid END AS county,
         CASE WHEN a.a = 1 THEN c.county END AS county_name,
         CASE WHEN iy.s_suppkey % 4 = 0 THEN 'No' || chr(13) WHEN iy.s_suppkey % 50 = 7 THEN 'Yes'
              ELSE 'No' END AS dental_only_plan
  FROM st_issuer_years iy
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS a FROM range(2)) a
  JOIN st_county c ON c.usps = iy.n_name AND ((a.a = 0 AND c.rk = 0) OR (a.a = 1 AND c.rk < 3))"""),
    "st_zip_rating_area": ((), """
  SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || lpad(CAST((c.c_custkey % 5) * 2 + 1 AS VARCHAR), 3, '0') AS fips,
         n.n_name AS state,
         'Rating Area ' || CAST(CASE WHEN c.c_custkey % 10 = 9 THEN 3 ELSE (c.c_custkey % 5) % 3 + 1 END AS VARCHAR) AS rate_area
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "st_fips_ra": (("st_zip_rating_area",), """
  SELECT DISTINCT fips, state, rate_area FROM st_zip_rating_area"""),
    "st_enrollment": ((), """
  SELECT issuer_hios_id, year, county_fips,
         CASE WHEN copy = 1 THEN CAST(n + 7 AS VARCHAR) WHEN n > 8 THEN 'NULL' WHEN n <> 3 THEN CAST(n AS VARCHAR) END AS avg_enrollment,
         state
  FROM (SELECT *, unnest(CASE WHEN issuer_hios_id % 9 = 4 THEN [0, 1] ELSE [0] END) AS copy FROM (
    SELECT s.s_suppkey AS issuer_hios_id,
           CAST(year(o.o_orderdate) AS INTEGER) AS year,
           lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') || lpad(CAST((o.o_orderkey % 5) * 2 + 1 AS VARCHAR), 3, '0') AS county_fips,
           n.n_name AS state,
           count(*) AS n
    FROM orders o
    JOIN supplier s ON s.s_suppkey = o.o_custkey % (SELECT count(*) FROM supplier)
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    GROUP BY 1, 2, 3, 4) g) h"""),
    "st_parent": ((), """
  SELECT s_suppkey AS hios_issuer_id, s_name AS company_name,
         'Parent ' || CAST(s_suppkey % 7 AS VARCHAR) AS parent_name
  FROM supplier WHERE s_suppkey % 6 <> 5"""),
    "st_t0a": (("st_rate", "st_plan_attr"), """
  SELECT p.market_coverage, r.business_year, r.state_code, r.issuer_id, r.plan_id,
         r.rating_area_id, p.metal_level, r.age, r.tobacco, p.csr_variation_type,
         CAST(floor(r.individual_rate / 500) * 500 AS DECIMAL(12,2)) AS individual_rate,
         r.row_key
  FROM st_rate r
  JOIN st_plan_attr p ON r.plan_id = p.standard_component_id AND r.business_year = p.business_year
  WHERE right(p.plan_id, 1) = '1' AND r.age = '21'"""),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in STANDINS[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *standins: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH <stand-ins>, <ctes> <body>``; each of ``ctes`` is computed once, however often it is named."""
    parts = [f"{n} AS ({STANDINS[n][1]}\n)" for n in _order(standins)]
    parts += [f"{n} AS MATERIALIZED ({text}\n)" for n, text in ctes]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def standin_sql(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)
