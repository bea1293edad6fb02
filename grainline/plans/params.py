"""Run parameters as Python literals.

A parameter table cross-joined into the query leaves a cartesian product in the plan;
literal predicates instead fold to constants and reach the parquet scan as pushed
filters (and partition filters on a partitioned sink).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "All"


@dataclass(frozen=True)
class Params:
    business_year: int | None = None   # None: every year in one pass
    state: str = ALL                   # a state code, or "All"

    def apply(self, df: DataFrame, year_col: str = "business_year",
              state_col: str | None = "state_code") -> DataFrame:
        if self.business_year is not None:
            df = df.where(F.col(year_col) == F.lit(int(self.business_year)))
        if state_col is not None and self.state != ALL:
            df = df.where(F.col(state_col) == F.lit(self.state))
        return df
