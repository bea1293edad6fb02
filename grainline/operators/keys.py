"""Key discovery: the minimal column sets that identify a row.

The lattice of column sets is searched by size. A set that holds a known key is a key and not minimal; a set inside a known
*agree set* (columns on which two different rows agree) is none. Agree sets come from two places: pairs of rows of a bounded
sample, which refute most sets at once, and rows of the whole table that a check found to share a key. What neither settles
is checked exactly on the whole table: first on a slice of the key space, which shows most repeated keys and moves a small share of
the rows, then by hashes of the keys, whose repeats are counted again by the columns. Every reported key is proved.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

#: Rows of the sample that the driver holds, of the candidate columns only.
SAMPLE_ROWS = 20_000
#: A check looks at one of so many slices of the key space before it takes the whole.
SLICES = 64
#: Repeated hashes that are looked at without a join; if there are more, and none of these is a repeated key, all are joined.
FEW = 1000
#: Types whose equal values have equal hashes, whatever their form (0.0 and -0.0 differ in theirs).
_HASHED = ("tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp", "string", "decimal")


def _sample(df: DataFrame, cols: Sequence[str], rows: int) -> list[Row]:
    """The rows with the smallest hashes: the same ones on every run. Equal rows stand together."""
    return df.select(*cols).orderBy(F.xxhash64(F.lit(5), *cols)).limit(rows).collect()


def _twice(df: DataFrame, names: Sequence[str]) -> list[Row]:
    """Values of ``names`` that two rows hold, if any do. Nulls agree with each other."""
    def some(t: DataFrame, by: Sequence[str]) -> DataFrame:
        return t.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)

    if not all(df.schema[c].dataType.simpleString().split("(")[0] in _HASHED for c in names):
        return some(df, names).limit(1).collect()
    # equal keys fall into one slice, so it shows a repeat or holds none; then eight bytes of each key tell the rest
    h = F.xxhash64(*names)
    rows = df.select(*names, h.alias("__h"))
    found = some(rows.where(F.pmod("__h", F.lit(SLICES)) == 0), names).limit(1).collect()
    if found:
        return found
    hashes = some(df.select(h.alias("__h")), ["__h"]).select("__h")
    few = [r["__h"] for r in hashes.limit(FEW).collect()]
    # different keys may share a hash, so the rows with a repeated one are counted by the columns
    if few:
        found = some(rows.where(F.col("__h").isin(few)), names).limit(1).collect()
    if len(few) == FEW and not found:
        found = some(rows.join(hashes, "__h", "left_semi"), names).limit(1).collect()
    return found


def _pair(df: DataFrame, cols: Sequence[str], names: Sequence[str]) -> tuple[Row, Row] | None:
    """Two rows of the whole table that agree on ``names``; None proves a key. Nulls agree with each other."""
    twice = _twice(df, names)
    if not twice:
        return None
    same = F.lit(True)
    for c in names:
        same = same & (F.col(c).isNull() if twice[0][c] is None else F.col(c) == F.lit(twice[0][c]))
    a, b = df.where(same).select(*cols).limit(2).collect()
    return a, b


def _repeats(rows: Sequence[Row], names: Sequence[str]) -> frozenset | None:
    """Columns on which two sampled rows agree, if two agree on ``names``."""
    seen: dict[tuple, Row] = {}
    for r in rows:
        first = seen.setdefault(tuple(r[c] for c in names), r)
        if first is not r:
            return frozenset(c for c in r.asDict() if r[c] == first[c])
    return None


def minimal_keys(df: DataFrame, cols: Sequence[str] | None = None, most_columns: int = 4,
                 sample_rows: int = SAMPLE_ROWS) -> tuple[list[tuple[str, ...]], int]:
    """The minimal keys of at most ``most_columns`` columns among ``cols`` (in the order of ``cols``), and the number of
    sets that were checked on the whole table. A table with a repeated row has none; one with fewer than two rows has every
    single column."""
    cols = list(cols or df.columns)
    rows = _sample(df, cols, sample_rows)
    keys: list[frozenset] = []
    agree: list[frozenset] = []
    checked = 0
    for size in range(1, min(most_columns, len(cols)) + 1):
        for names in combinations(cols, size):
            mine = frozenset(names)
            if any(k <= mine for k in keys) or any(mine <= a for a in agree):
                continue
            refuted = _repeats(rows, names)
            if refuted is None:
                checked += 1
                pair = _pair(df, cols, names)
                if pair is None:
                    keys.append(mine)
                    continue
                refuted = frozenset(c for c in cols if pair[0][c] == pair[1][c])
            agree = [a for a in agree if not a <= refuted] + [refuted]
    return [tuple(c for c in cols if c in k) for k in keys], checked


def key_report(df: DataFrame, cols: Sequence[str] | None = None, most_columns: int = 4) -> DataFrame:
    """The minimal keys as rows: key_columns (comma-joined), n_columns."""
    keys, _ = minimal_keys(df, cols, most_columns)
    return df.sparkSession.createDataFrame([(",".join(k), len(k)) for k in keys], "key_columns string, n_columns int")
