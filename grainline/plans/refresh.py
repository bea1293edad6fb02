"""Incremental refresh of a published landscape: only what changed inputs reach is computed again.

Every input table is fingerprinted: rates, plans and service areas per (year, state), enrollment per year, the geography
and parent tables as a whole. A fingerprint is a row count with two order-free sums of row hashes, one partially
aggregated pass a table. The published manifest carries the fingerprints it was made from; those that differ name the units
to compute. The unit is a year, because X7 ranks winners of all states of a year against each other (counties of different
states share names); it is a (year, state) if X7's groups hold the state. Units that vanished from the inputs are replaced by
nothing. A change of the whole-table inputs, parameters or options reaches every unit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.published import Manifest, Published
from ..sources.steps import Steps
from .landscape import Inputs, Landscape, Options
from .params import Params

BY_PART = ("rate", "plan", "service_area")
WHOLE = ("counties", "county_map", "zip_rating_area", "parent")


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> dict[tuple, str]:
    """Of each group of rows: the same for the same rows in any order, with their repeats."""
    columns = sorted(df.columns)
    a, b = (F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string") for seed in (1, 2))
    rows = df.groupBy(*by).agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), a, b).alias("f")).collect()
    return {tuple(r[k] for k in by): r.f for r in rows}


def fingerprints(inp: Inputs, params: Params) -> dict:
    """Years x states numbers: bounded by geography."""
    parts: dict[str, dict[str, str]] = {}
    for name in BY_PART:
        table = params.apply(getattr(inp, name)).where("business_year IS NOT NULL AND state_code IS NOT NULL")
        for (year, state), f in fingerprint(table, ["business_year", "state_code"]).items():
            parts.setdefault(f"{year}|{state}", {})[name] = f
    years = {str(y): f for (y,), f in fingerprint(inp.enrollment.where("year IS NOT NULL"), ["year"]).items()}
    return {"parts": parts, "years": years, "whole": {name: fingerprint(getattr(inp, name)).get((), "") for name in WHOLE}}


def changed_parts(old: dict, new: dict) -> list[tuple[int, str]]:
    """(year, state) of every part whose inputs differ, vanished ones included."""
    def differs(key: str) -> bool:
        year = key.split("|", 1)[0]
        return (old["whole"] != new["whole"] or old["parts"].get(key) != new["parts"].get(key)
                or old["years"].get(year) != new["years"].get(year))

    return sorted((int(k.split("|", 1)[0]), k.split("|", 1)[1]) for k in old["parts"].keys() | new["parts"].keys() if differs(k))


def only(inp: Inputs, units: Sequence[dict]) -> Inputs:
    """The inputs of some units, as literal filters that reach the scans."""
    def pick(df: DataFrame) -> DataFrame:
        years = sorted({u["business_year"] for u in units})
        df = df.where(F.col("business_year").isin(years))
        if "state_code" in units[0]:
            either = F.lit(False)
            for y in years:
                either = either | ((F.col("business_year") == y) & F.col("state_code").isin([u["state_code"] for u in units if u["business_year"] == y]))
            df = df.where(either)
        return df

    return replace(inp, **{name: pick(getattr(inp, name)) for name in BY_PART})


def refresh(inp: Inputs, params: Params, path: str, opts: Options | None = None, steps: Steps | None = None) -> tuple[list[dict], Manifest]:
    """Bring the landscape published at ``path`` up to date. Returns the units that were computed and the manifest."""
    opts = opts or Options()
    spark = inp.rate.sparkSession
    table = Published(spark, path)
    before = table.current()
    made_from = {"run": repr((params, opts)), **fingerprints(inp, params)}
    with steps or Steps(spark) as run:
        if before is None or before.notes.get("run") != made_from["run"]:
            units = None
            manifest = table.publish(Landscape(inp, params, opts, run).final(), notes=made_from)
        else:
            by_state = "state_code" in opts.overall_keys
            parts = changed_parts(before.notes, made_from)
            units = [{"business_year": y, "state_code": s} for y, s in parts] if by_state else [{"business_year": y} for y in sorted({y for y, _ in parts})]
            if not units:
                return [], before
            rows = Landscape(only(inp, units), params, opts, run).final()
            manifest = table.publish(rows, units, made_from)
    every = sorted({int(k.split("|", 1)[0]) for k in made_from["parts"]})
    return (units if units is not None else [{"business_year": y} for y in every]), manifest
