"""Named table scans with a schema contract.

``load`` reads one parquet table, checks the columns the caller relies on against the
contract (names and types come from the file footer, so the check costs no job) and
projects to them so the scan's ``ReadSchema`` holds only what is used.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Contract of the driver-provided tables the stand-ins read (column -> Spark type).
CONTRACTS: dict[str, dict[str, T.DataType]] = {
    "region": {"r_regionkey": T.IntegerType(), "r_name": T.StringType()},
    "nation": {"n_nationkey": T.IntegerType(), "n_name": T.StringType(),
               "n_regionkey": T.IntegerType()},
    "customer": {"c_custkey": T.LongType(), "c_name": T.StringType(),
                 "c_nationkey": T.IntegerType(), "c_acctbal": T.DoubleType(),
                 "c_mktsegment": T.StringType()},
    "supplier": {"s_suppkey": T.LongType(), "s_name": T.StringType(),
                 "s_nationkey": T.IntegerType(), "s_acctbal": T.DoubleType()},
    "orders": {"o_orderkey": T.LongType(), "o_custkey": T.LongType(),
               "o_orderstatus": T.StringType(), "o_totalprice": T.DoubleType(),
               "o_orderdate": T.TimestampNTZType(), "o_orderpriority": T.StringType()},
    "lineitem": {"l_orderkey": T.LongType(), "l_partkey": T.LongType(),
                 "l_suppkey": T.LongType(), "l_linenumber": T.IntegerType(),
                 "l_quantity": T.DoubleType(), "l_extendedprice": T.DoubleType(),
                 "l_discount": T.DoubleType(), "l_tax": T.DoubleType(),
                 "l_returnflag": T.StringType(), "l_linestatus": T.StringType(),
                 "l_shipdate": T.TimestampNTZType()},
}

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def snake_case(name: str) -> str:
    """``GEOID`` -> ``geoid``, ``AverageMonthlyEnrollment`` -> ``average_monthly_enrollment``,
    ``Parent_Name`` -> ``parent_name``, ``Rating_Area`` -> ``rating_area``."""
    import re
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    return re.sub(r"[^0-9a-zA-Z]+", "_", s).strip("_").lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename quoted, case-sensitive source names once at load (Spark resolves names
    case-insensitively, so ``"FIPS"`` and ``fips`` would otherwise collide)."""
    return df.toDF(*[snake_case(c) for c in df.columns])


class SchemaMismatch(ValueError):
    pass


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def check_schema(df: DataFrame, contract: Mapping[str, T.DataType],
                 columns: Iterable[str] | None = None, name: str = "table") -> None:
    """Raise if a required column is missing or of an incompatible type."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for col in columns if columns is not None else contract:
        if col not in fields:
            raise SchemaMismatch(f"{name}: missing column {col!r}")
        want, got = contract.get(col), fields[col]
        if want is None or got == want:
            continue
        if isinstance(want, _TIMESTAMPS) and isinstance(got, _TIMESTAMPS):
            continue
        raise SchemaMismatch(f"{name}.{col}: expected {want.simpleString()}, got {got.simpleString()}")


def load(spark: SparkSession, sf_dir: str, name: str,
         columns: Iterable[str] | None = None) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet`` projected to ``columns`` (all if None)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    cols = list(columns) if columns is not None else None
    if name in CONTRACTS:
        check_schema(df, CONTRACTS[name], cols, name)
    return df.select(*cols) if cols is not None else df


def load_table(spark: SparkSession, name: str, columns: Iterable[str] | None = None,
               contract: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Read a catalog table (``spark.table``), optionally checked against a contract."""
    df = spark.table(name)
    cols = list(columns) if columns is not None else None
    if contract is not None:
        check_schema(df, contract, cols, name)
    return df.select(*cols) if cols is not None else df


def load_jdbc(spark: SparkSession, options: Mapping[str, str], table: str,
              partition_column: str | None = None,
              bounds: tuple[int, int] | None = None,
              num_partitions: int = 64) -> DataFrame:
    """Read a table from a remote database in parallel slices.

    Without ``partition_column`` the whole table arrives through one task, so pass a
    numeric, roughly uniform column and its bounds for any table of size. ``options``
    carries url, user, password, driver, fetchsize, and so on.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("bounds=(lower, upper) is required with partition_column")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds[0]))
                  .option("upperBound", str(bounds[1]))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
