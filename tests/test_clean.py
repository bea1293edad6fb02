from pyspark.sql import functions as F

from grainline.functions import clean


def _one(spark, expr, value, ddl="v string"):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(expr(F.col("v")).alias("o")).collect()[0]["o"]


def test_flag_is_no_tolerates_carriage_return(spark):
    assert _one(spark, clean.flag_is_no, "No\r") is True
    assert _one(spark, clean.flag_is_no, "No") is True
    assert _one(spark, clean.flag_is_no, "Yes") is False
    assert _one(spark, clean.flag_is_no, None) is None


def test_is_base_variant(spark):
    assert _one(spark, clean.is_base_variant, "12345-0-01") is True
    assert _one(spark, clean.is_base_variant, "12345-0-04") is False


def test_parse_number_sentinel_and_malformed(spark):
    assert _one(spark, clean.parse_number, "NULL") is None
    assert _one(spark, clean.parse_number, " 12 ") == 12.0
    assert _one(spark, clean.parse_number, "abc") is None
    assert _one(spark, clean.parse_number, "0") == 0.0


def test_map_values_keeps_others(spark):
    m = lambda c: clean.map_values(c, clean.METAL_LEVEL_MAP)
    assert _one(spark, m, "Expanded Bronze") == "Bronze"
    assert _one(spark, m, "Gold") == "Gold"
    assert _one(spark, m, None) is None


def test_pad_fips_restores_and_truncates(spark):
    assert _one(spark, clean.pad_fips, "1003") == "01003"
    assert _one(spark, clean.pad_fips, "48201") == "48201"
    assert _one(spark, clean.pad_fips, "123456") == "12345"   # lpad truncates, as in SQL


def test_strip_leading_zeros(spark):
    assert _one(spark, clean.strip_leading_zeros, "01003") == "1003"


def test_rating_area_number(spark):
    assert _one(spark, clean.rating_area_number, "Rating Area 12") == 12
    assert _one(spark, clean.rating_area_number, "Rating Area") is None   # '' -> NULL
    assert _one(spark, clean.rating_area_number, "Rating Area x") is None


def test_deductible_text_as_written(spark):
    df = spark.createDataFrame([("$1,500 per person", None, "$900"),
                                (None, "Not Applicable", "$900"),
                                (None, None, None)], "a string, b string, c string")
    out = [r[0] for r in df.select(clean.deductible_text("a", "b", "c")).collect()]
    assert out == ["1,500 ", "Not Applicable", None]


def test_parse_money(spark):
    assert float(_one(spark, clean.parse_money, "$1,500 per person")) == 1500.0
    assert _one(spark, clean.parse_money, "Not Applicable") is None
    assert float(_one(spark, clean.parse_money, "$2,350.50")) == 2350.5
    assert float(_one(spark, clean.parse_money, "$1,500 per person | $3,000 per group")) == 1500.0
    assert float(_one(spark, clean.parse_money, "10% / $50")) == 50.0
    assert float(_one(spark, clean.parse_money, "-$5")) == -5.0
    assert _one(spark, clean.parse_money, "20% coinsurance") is None


def test_format_count(spark):
    assert _one(spark, clean.format_count, 1234567, "v bigint") == "1,234,567"
    assert _one(spark, clean.format_count, 0, "v bigint") == "0"


def test_snake_case_columns(spark):
    from grainline.sources.tables import snake_case_columns
    df = spark.createDataFrame([(1, 2, 3, 4, 5)],
                               "GEOID int, AverageMonthlyEnrollment int, Parent_Name int, "
                               "IssuerHIOSID int, USPS int")
    assert snake_case_columns(df).columns == ["geoid", "average_monthly_enrollment", "parent_name",
                                              "issuer_hiosid", "usps"]


def test_checkpoint_dir_is_the_sessions(spark):
    from grainline.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir") == d
    assert checkpoint_dir(spark) == d          # stable: never replaced once set
