"""Cleaning helpers for dirty marketplace columns.

Each helper is ``Column -> Column`` over built-in functions, so it stays inside
whole-stage codegen. Flags that filters test often (base variant, yes/no) are best
derived once, as columns, right after the scan: a predicate wrapped in a function is
not pushed into the parquet reader.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metal-level folding the analyses apply.
METAL_LEVEL_MAP = {"Expanded Bronze": "Bronze"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_is_no(c: Column | str) -> Column:
    """First character is ``N``: tolerates ``No\\r`` and similar; NULL stays NULL."""
    return F.left(_col(c), F.lit(1)) == F.lit("N")


def is_base_variant(c: Column | str) -> Column:
    """Plan variant id ends in ``1`` (the standard, non cost-sharing variant)."""
    return F.right(_col(c), F.lit(1)) == F.lit("1")


def parse_number(c: Column | str, to: str = "double") -> Column:
    """Text number with a ``'NULL'`` sentinel -> number; malformed text -> NULL."""
    trimmed = F.trim(_col(c))
    return F.nullif(trimmed, F.lit("NULL")).try_cast(to)


def map_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """``CASE WHEN c = k THEN v ... ELSE c END``."""
    col = _col(c)
    out = None
    for old, new in mapping.items():
        out = (F.when(col == F.lit(old), F.lit(new)) if out is None
               else out.when(col == F.lit(old), F.lit(new)))
    return col if out is None else out.otherwise(col)


def pad_fips(c: Column | str, width: int = 5) -> Column:
    """Restore leading zeros lost by a numeric round trip (``1003`` -> ``01003``)."""
    return F.lpad(_col(c).cast("string"), width, "0")


def strip_leading_zeros(c: Column | str) -> Column:
    return F.ltrim(_col(c), F.lit("0"))


def rating_area_number(c: Column | str) -> Column:
    """``'Rating Area 12'`` -> 12; malformed -> NULL (a plain cast would raise)."""
    return F.split_part(_col(c), F.lit(" "), F.lit(3)).try_cast("int")


def deductible_text(*cols: Column | str) -> Column:
    """First non-NULL cost text with ``per person`` and ``$`` removed, as written
    (commas and a trailing blank stay: ``$1,500 per person`` -> ``1,500 ``)."""
    first = F.coalesce(*[_col(c) for c in cols])
    return F.replace(F.replace(first, F.lit("per person"), F.lit("")), F.lit("$"), F.lit(""))


def parse_money(c: Column | str, to: str = "decimal(12,2)") -> Column:
    """Money text -> its first amount: ``$1,500 per person | $3,000 per group`` -> 1500.00, ``-$5`` -> -5.00.
    Percentages are no amounts (``10% / $50`` -> 50.00); text without an amount gives NULL."""
    no_percent = F.regexp_replace(_col(c), r"[0-9][0-9.,]* ?%", "")
    first = F.regexp_extract(no_percent, r"-?\$? ?[0-9][0-9,]*(\.[0-9]+)?", 0)
    return F.nullif(F.regexp_replace(first, r"[$, ]", ""), F.lit("")).try_cast(to)


def format_count(c: Column | str) -> Column:
    """Thousands separators, no decimals: 1234567 -> ``1,234,567``."""
    return F.format_number(_col(c), 0)
