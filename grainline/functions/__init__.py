"""Column helpers built only from ``pyspark.sql.functions`` (JVM-side, codegen-able)."""
from .clean import (  # noqa: F401
    METAL_LEVEL_MAP, deductible_text, flag_is_no, format_count,
    is_base_variant, map_values, pad_fips, parse_money, parse_number,
    rating_area_number, strip_leading_zeros,
)
