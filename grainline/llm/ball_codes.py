"""Vector codes: product quantisation with codebooks fitted by exact ball k-means.

Vectors of integers are cut into PARTS equal parts; each part position has a codebook of at most ENTRIES entries, and a code
names the nearest entry of each part (squared Euclidean distance, ties to the lower index). Everything is integer arithmetic,
so results are exact and the same on every run.

The first assignment compares a part with all entries. Every later one starts from the part's last entry and uses balls. The
ball of an entry holds the parts assigned to it; its radius is the largest distance of a member to the entry where it stands
now. An entry j is a neighbour of i only if half the distance between the two is no more than i's radius; no member can
belong to another entry. Neighbours in order of distance cut the ball into a core and rings:

* a member nearer to i than half the distance to the first neighbour (the stable core) stays without further work;
* a member in the ring between half the distances to neighbours k and k + 1 can only belong to i or to neighbours 1 .. k,
  and is compared with those.

"Nearer" is strict, so that a tie with a lower index is always compared. Members are sorted by their number of candidates, so
that every rank of neighbours is one numpy pass over the members that still have a candidate of that rank.

On Spark: a pass is one map over the stored table of vectors and codes, which writes the next such table, then one aggregation
over it for sums, counts or radii (PARTS x ENTRIES x part length numbers, whatever the number of rows). Codebooks and
neighbour lists have a fixed size and are broadcast with the closure. Nothing else reaches the driver.

Defined results. Vectors that are null, or hold null or non-finite components, are left out. Shorter vectors count as padded
with zeros up to the longest one, and that to a multiple of PARTS; empty vectors are all zeros. Components are limited to
+-LIMIT after scaling, so that sums of squares fit in 64 bits. The first entries are the parts of the vectors with the
smallest ids (null ids last, then by vector); fewer vectors than ENTRIES give so many entries. Equal entries: the lower index
wins, the others stay as they are. Repeated ids and rows are coded each. Null labels are one label. Empty table: no rows. Own
columns of the table other than vec_id, embedding and label are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LIMIT = 1 << 27
#: Rows whose parts are handled at once.
BATCH_ROWS = 4096
#: Labels up to this number are joined by a broadcast; beyond it, by salted keys.
FEW_LABELS, SALTS = 50_000, 32


def usable(table: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part, floor(scale * component)."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale).cast("long"))))
    return table.where(F.col("embedding").isNotNull()).where(whole).select(F.col("vec_id").cast("long"), "label", scaled.alias("v"))


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances, rows x entries."""
    return ((x[:, None, :] - book[None]) ** 2).sum(2)


class Balls:
    """Neighbour lists of one part's entries: ``near[i]`` by distance, ``square[i]`` their squared distances (-1 ends the list)."""

    def __init__(self, book: np.ndarray, radius: np.ndarray):
        """``radius``: squared radius of each entry's ball, -1 if it has no member."""
        between = distances(book, book)
        np.fill_diagonal(between, -1)
        # half the distance is at most the radius; entries without members, and entries beyond, are no neighbours
        may = (between >= 0) & (between <= 4 * radius[:, None])
        far = np.iinfo(np.int64).max
        order = np.argsort(np.where(may, between, far), axis=1, kind="stable")
        self.near = order
        self.square = np.where(np.take_along_axis(may, order, 1), np.take_along_axis(between, order, 1), far)


def assign(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance, by comparing with all."""
    d = distances(x, book)
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code]


def reassign(x: np.ndarray, book: np.ndarray, last: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from the members' last entries; also the number of distances computed."""
    own = ((x - book[last]) ** 2).sum(1)
    # the ring: how many neighbours are at most twice as far from the entry as the member is
    ring = np.zeros(len(x), np.int64)
    at = np.arange(len(x))
    for k in range(len(book) - 1):
        at = at[balls.square[last[at], k] <= 4 * own[at]]
        if not len(at):
            break
        ring[at] = k + 1
    code, best, compared = last.copy(), own.copy(), len(x)
    at = np.flatnonzero(ring)
    for k in range(int(ring.max(initial=0))):
        at = at[ring[at] > k]
        j = balls.near[last[at], k]
        d = ((x[at] - book[j]) ** 2).sum(1)
        compared += len(at)
        better = (d < best[at]) | ((d == best[at]) & (j < code[at]))
        code[at[better]], best[at[better]] = j[better], d[better]
    return code, best, compared


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).astype(np.int64).reshape(-1, PARTS, width)


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).astype(np.int64).reshape(-1, PARTS)


def first_codes(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` (vec_id, label, v of long) as packed vectors with their codes and squared distances."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                v = b.column("v")
                n = np.diff(v.offsets.to_numpy())
                x = np.zeros((b.num_rows, PARTS * width), np.int64)
                x[np.repeat(np.arange(b.num_rows), n), np.concatenate([np.arange(k) for k in n])] = v.flatten().to_numpy()
                yield _out(b, x.reshape(-1, PARTS, width), [assign(x.reshape(-1, PARTS, width)[:, p], books[p]) for p in range(PARTS)])

    return rows.mapInArrow(run, _schema(rows))


def next_codes(rows: DataFrame, books: np.ndarray, radius: np.ndarray) -> DataFrame:
    """The coded table with codes by ``books``, from the codes that it has."""
    width = books.shape[2]
    balls = [Balls(books[p], radius[p]) for p in range(PARTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                x, last = _vectors(b.column("v"), width), _codes(b.column("codes"))
                yield _out(b, x, [reassign(x[:, p], books[p], last[:, p], balls[p])[:2] for p in range(PARTS)])

    return rows.select("vec_id", "label", "v", "codes").mapInArrow(run, _schema(rows))


def _schema(rows: DataFrame) -> str:
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return f"vec_id long, label {kind['label']}, v binary, codes binary, error long"


def _out(b: pa.RecordBatch, x: np.ndarray, found: list) -> pa.RecordBatch:
    codes = np.column_stack([f[0] for f in found]).astype(np.uint8)
    error = sum(f[1] for f in found)
    packed = x.astype(np.int32)
    return pa.RecordBatch.from_arrays([
        b.column("vec_id"), b.column("label"), pa.array([r.tobytes() for r in packed], pa.binary()),
        pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(error, pa.int64())], ["vec_id", "label", "v", "codes", "error"])


def _slots(x: np.ndarray, codes: np.ndarray, entries: int) -> np.ndarray:
    return (np.arange(PARTS)[None] * entries + codes).reshape(-1)


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floored means of their parts; unused entries stay."""
    entries, width = books.shape[1:]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(PARTS * entries, np.int64)
        total = np.zeros((PARTS * entries, width), np.int64)
        for b in batches:
            x, codes = _vectors(b.column("v"), width), _codes(b.column("codes"))
            slot = _slots(x, codes, entries)
            count += np.bincount(slot, minlength=len(count))
            order = np.argsort(slot, kind="stable")
            begin = np.flatnonzero(np.diff(slot[order], prepend=-1))
            if len(begin):
                total[slot[order][begin]] += np.add.reduceat(x.reshape(-1, width)[order], begin, axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))),
                                          pa.array(np.repeat(count[used], width)), pa.array(total[used].reshape(-1))], ["slot", "place", "n", "total"])

    sums = rows.select("v", "codes").mapInArrow(add, "slot long, place long, n long, total long").groupBy("slot", "place")
    out = books.reshape(-1, width).copy()
    for r in sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.slot, r.place] = r.total // r.n
    return out.reshape(books.shape)


def radii(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Squared radius of every entry's ball: its last members' largest squared distance to where it stands now; -1 without any."""
    entries, width = books.shape[1:]

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.full(PARTS * entries, -1, np.int64)
        for b in batches:
            x, codes = _vectors(b.column("v"), width), _codes(b.column("codes"))
            d = ((x - books[np.arange(PARTS)[None], codes]) ** 2).sum(2)
            np.maximum.at(out, _slots(x, codes, entries), d.reshape(-1))
        used = np.flatnonzero(out >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(out[used])], ["slot", "square"])

    out = np.full(PARTS * entries, -1, np.int64)
    for r in rows.select("v", "codes").mapInArrow(widest, "slot long, square long").groupBy("slot").agg(F.max("square").alias("square")).collect():
        out[r.slot] = r.square
    return out.reshape(PARTS, entries)


def first_books(rows: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """PARTS x entries x part length: the parts of the vectors with the smallest ids."""
    longest = rows.agg(F.max(F.size("v")).alias("n")).first().n or 1
    width = max(1, -(-longest // PARTS))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    x = np.zeros((len(first), PARTS * width), np.int64)
    for row, r in zip(x, first, strict=True):
        row[:len(r.v)] = r.v
    return np.ascontiguousarray(x.reshape(-1, PARTS, width).transpose(1, 0, 2))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of error over rows of equal labels (nulls are one label), as label_error."""
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    few = sums.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    same = F.col("label").eqNullSafe(F.col("__label"))
    if few:
        return rows.join(F.broadcast(sums), same).drop("__label")
    # many labels, one of them perhaps on a third of the rows: rows are dealt over salts, and each label's sum to every salt
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "v"), F.lit(SALTS)))
    sums = sums.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(sums, same & (F.col("__salt") == F.col("__at"))).drop("__label", "__salt", "__at")


def compress(table: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """``table``: vec_id, embedding, label. Coded rows (vec_id, label, v, codes, error) and the final codebooks."""
    rows = usable(table)
    books = first_books(rows, entries)
    coded = written(first_codes(rows, books), "codes-0")
    for k in range(rounds):
        books = moved(coded, books)
        coded = written(next_codes(coded, books, radii(coded, books)), f"codes-{k + 1}")
    return coded, books


def report(table: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that takes part."""
    coded, books = compress(table)
    return with_label_error(coded).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                                          F.lit(digest(books)).alias("codebooks_sha256"))


def _assign_sql(book: str) -> str:
    return (f"SELECT x.id, x.part, x.x, arg_min(b.entry, d * 64 + b.entry) AS entry, min(d) AS d FROM (SELECT x.*, b.entry, "
            f"list_sum(list_transform(list_zip(x.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM parts x JOIN {book} b USING (part)) x "
            f"JOIN {book} b USING (part, entry) GROUP BY x.id, x.part, x.x")


def _move_sql(book: str, last: str) -> str:
    return (f"SELECT b.part, b.entry, CASE WHEN m.x IS NULL THEN b.x ELSE m.x END AS x FROM {book} b LEFT JOIN ("
            f"SELECT part, entry, list(floor_mean ORDER BY place) AS x FROM (SELECT part, entry, place, "
            f"((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor_mean FROM ("
            f"SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM {last}) GROUP BY ALL) GROUP BY part, entry) m USING (part, entry)")


#: The same rows by plain k-means in DuckDB SQL (vectors whose length is a multiple of 16).
CODES_SQL = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT id, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x FROM v, range(16) t(part)),
b0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x FROM parts WHERE id <= 64),
a0 AS MATERIALIZED ({_assign_sql("b0")}), b1 AS MATERIALIZED ({_move_sql("b0", "a0")}),
a1 AS MATERIALIZED ({_assign_sql("b1")}), b2 AS MATERIALIZED ({_move_sql("b1", "a1")}),
a2 AS MATERIALIZED ({_assign_sql("b2")}),
books AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS h FROM (
  SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM b2)),
coded AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY id)
SELECT v.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, books.h AS codebooks_sha256
FROM v JOIN coded c USING (id), books
"""
