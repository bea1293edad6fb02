"""Coverage expansion: service areas that cover a whole state become one row per
county of that state; county-level rows keep their county.

The whole-state branch is an equi-join on state to the county lookup (a bounded
geography table, broadcast). The union is deduplicated once (one shuffle); the
per-branch DISTINCTs of the original formulation would add two more aggregations and
change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import flag_is_no

# How the source spells whole-state and county-level coverage.
WHOLE_STATE = ("Yes",)
PART_STATE = ("No", "false")


def expand(sa: DataFrame, counties: DataFrame, *,
           keys: Sequence[str] = ("business_year", "state_code", "issuer_id", "service_area_id"),
           state_col: str = "state_code", cover_col: str = "cover_entire_state",
           county_col: str = "county", dental_col: str = "dental_only_plan",
           lookup_state: str = "usps", lookup_county: str = "geoid",
           whole: Sequence[str] = WHOLE_STATE, part: Sequence[str] = PART_STATE,
           out: str = "county", counties_bounded: bool = False) -> DataFrame:
    """(keys..., out) with one row per covered county, medical plans only.

    County-level rows keep the last five characters of ``county_col`` (its FIPS).
    Coverage values in neither ``whole`` nor ``part`` are dropped, as in the source
    analysis; ``coverage_audit`` reports them. ``counties_bounded``: the caller knows that the
    lookup's size is set by geography, so it is broadcast from the start.
    """
    medical = flag_is_no(dental_col)
    part_rows = (sa.where(F.col(cover_col).isin(*part) & medical)
                 .select(*keys, F.right(F.col(county_col), F.lit(5)).alias(out)))
    whole_sa = sa.where(F.col(cover_col).isin(*whole) & medical).select(*keys)
    lookup = counties.select(F.col(lookup_state).alias("__st"), F.col(lookup_county).alias(out))
    if counties_bounded:
        lookup = F.broadcast(lookup)
    whole_rows = (whole_sa.join(lookup, whole_sa[state_col] == lookup["__st"])
                  .select(*keys, out))
    return part_rows.unionByName(whole_rows).distinct()


def coverage_audit(sa: DataFrame, cover_col: str = "cover_entire_state",
                   whole: Sequence[str] = WHOLE_STATE,
                   part: Sequence[str] = PART_STATE) -> DataFrame:
    """Rows per coverage value and how ``expand`` treats it: whole / part / dropped."""
    c = F.col(cover_col)
    cls = (F.when(c.isin(*whole), F.lit("whole")).when(c.isin(*part), F.lit("part"))
           .otherwise(F.lit("dropped")))
    return sa.groupBy(c.alias(cover_col), cls.alias("treatment")).agg(
        F.count(F.lit(1)).alias("row_count"))


def expansion_report(sa: DataFrame, counties: DataFrame, expanded: DataFrame,
                     state_col: str = "state_code", lookup_state: str = "usps",
                     dental_col: str = "dental_only_plan") -> DataFrame:
    """Per state: raw service-area rows (dental flag exactly ``No``, as the check was
    written), counties in the lookup, and rows after expansion.

    The three sources are tagged and summed in one aggregation (one shuffle, combined
    map-side); every state seen in any of them gets a row, with 0 where it is absent.
    """
    one, zero = F.lit(1), F.lit(0)
    raw = sa.select(F.col(state_col),
                    F.when(F.col(dental_col) == F.lit("No"), one).otherwise(zero).alias("r"),
                    zero.alias("c"), zero.alias("e"))
    cty = counties.select(F.col(lookup_state).alias(state_col), zero.alias("r"), one.alias("c"),
                          zero.alias("e"))
    exp = expanded.select(F.col(state_col), zero.alias("r"), zero.alias("c"), one.alias("e"))
    return raw.unionByName(cty).unionByName(exp).groupBy(state_col).agg(
        F.sum("r").alias("raw_sa_rows"), F.sum("c").alias("county_count"),
        F.sum("e").alias("expanded_rows"))
