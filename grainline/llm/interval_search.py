"""Ranked lexical search: best-first over document intervals, bounded by range maxima of posting lists.

A shard holds some documents, numbered by ascending id, and for every term that the queries use a posting list: documents and
impacts (the term's exact integer contribution to the score), with a sparse table of range maxima, the position of the
greatest impact of every run of 2^j postings. For a query, an interval of documents is bounded by the sum over its terms of
the greatest impact that the term's list has there: two table look-ups a term. The search takes the intervals with the
greatest bounds, splits each at the document that holds its greatest single impact, scores that document exactly, and bounds
the two remaining parts. Intervals that cannot reach the k-th best score so far go away unread; so do intervals that could
only equal it with a greater id. Intervals with few postings are scored outright. Bounds are exact integers, so results are too.

On Spark: one map reads every text once and writes the shards (lengths of all documents, postings of query terms); document
counts and frequencies are aggregations over all rows. Shards are searched where they lie, without a shuffle: first some
shards of about SEED_DOCUMENTS documents, whose k-th best scores are a lower bound for all, then every shard from that bound
on. Each task returns at most k rows a query and shard; a window with a group limit makes the final ranks. Queries are taken
in blocks of about BLOCK_TERMS terms (the size that the driver holds and broadcasts), one pass over the corpus each. Terms
are compared by two independent 64-bit hashes.

Defined results. Null texts hold no term; a query without terms has no rows. Rows with the same query id are one query with
the terms of all; a null id is an id. Documents are rows: a repeated id ranks once for each row; null ids rank last among
equal scores. Texts are whole, of any length. Empty tables: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scan
from .store import written

#: A shard ends after so many documents or postings.
SHARD_DOCUMENTS, SHARD_POSTINGS = 1 << 15, 1 << 20
SEED_DOCUMENTS = 1 << 15
BLOCK_TERMS = 200_000
#: Queries searched at once in a task, intervals split at once for each, and postings up to which an interval is scored outright.
TOGETHER, WAVE, LEAF = 16, 48, 48

_TERM_ENDS = np.ones(256, bool)
_TERM_ENDS[0x80:] = False
_TERM_ENDS[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False


def _terms(block: scan.Block) -> tuple[scan.Words, np.ndarray, scan.Hasher]:
    """A block's terms, their hashes, and the hasher of their second hash."""
    low = scan.LOWER[block.data]
    w = scan.words(block, _TERM_ENDS)
    return w, scan.Hasher(low).ranges(w.start, w.end), scan.Hasher(low ^ np.uint8(0x55))


@dataclass
class Queries:
    """A block of queries. Terms are numbered by their first hash."""

    ids: list                       # query ids
    first: np.ndarray               # per query, its first entry in ``terms``; one entry more than queries
    terms: np.ndarray
    hashes: np.ndarray              # per term, uint64, ascending
    second: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Queries:
        """``rows``: (item_id, h1, h2), distinct, ordered by item_id."""
        h = np.array([r.h1 for r in rows], np.int64).view(np.uint64)
        hashes, at, terms = np.unique(h, return_index=True, return_inverse=True)
        second = np.array([r.h2 for r in rows], np.int64).view(np.uint64)[at]
        begin = [i for i, r in enumerate(rows) if i == 0 or r.item_id != rows[i - 1].item_id]
        return cls([rows[i].item_id for i in begin], np.array([*begin, len(rows)]), terms, hashes, second)


def query_terms(items: DataFrame) -> DataFrame:
    """``items``: item_id, text. Distinct (item_id, h1, h2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in scan.blocks(batch.column("text")):
                w, h, again = _terms(b)
                yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(w.doc + b.first)), pa.array(h.view(np.int64)),
                                                  pa.array(again.ranges(w.start, w.end).view(np.int64))], ["item_id", "h1", "h2"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, h1 long, h2 long").distinct()


_SHARD = "n_docs long, n_terms long, ids array<bigint>, size array<bigint>, term binary, doc binary, tf binary"


def shards(docs: DataFrame, queries: Queries) -> DataFrame:
    """``docs``: doc_id, text. Shards with the lengths of all their documents that hold a term, and the postings of query terms."""
    shared = docs.sparkSession.sparkContext.broadcast((queries.hashes, queries.second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, second = shared.value
        ids: list = []
        size, term, doc, tf = ([np.zeros(0, np.int64)] for _ in range(4))
        postings = 0

        def packed() -> pa.RecordBatch:
            n, t, d, c = (np.concatenate(x) for x in (size, term, doc, tf))
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            number = np.empty(len(ids), np.int64)
            number[order] = np.arange(len(ids))
            d = number[d]
            by = np.lexsort((d, t))
            return pa.RecordBatch.from_arrays([
                pa.array([len(ids)], pa.int64()), pa.array([int(n.sum())], pa.int64()), pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
                pa.array([n[order].tolist()], pa.list_(pa.int64())), *(pa.array([x[by].astype(np.int32).tobytes()], pa.binary()) for x in (t, d, c))],
                ["n_docs", "n_terms", "ids", "size", "term", "doc", "tf"])

        for batch in batches:
            for b in scan.blocks(batch.column("text")):
                w, h, again = _terms(b)
                n = np.diff(w.first)
                holds = np.flatnonzero(n)
                if not len(holds):
                    continue
                number = np.zeros(b.size, np.int64)
                number[holds] = len(ids) + np.arange(len(holds))
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == h)
                hit = hit[second[at[hit]] == again.ranges(w.start[hit], w.end[hit])]
                key, count = np.unique(at[hit] * b.size + w.doc[hit], return_counts=True)
                ids += batch.column("doc_id").take(pa.array(holds + b.first)).to_pylist()
                size.append(n[holds])
                term.append(key // b.size)
                doc.append(number[key % b.size])
                tf.append(count)
                postings += len(key)
                if len(ids) >= SHARD_DOCUMENTS or postings >= SHARD_POSTINGS:
                    yield packed()
                    ids, postings = [], 0
                    size, term, doc, tf = ([np.zeros(0, np.int64)] for _ in range(4))
        if ids:
            yield packed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SHARD)


def frequencies(table: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(terms, np.int64)
        for b in batches:
            for x in b.column("term").to_pylist():
                n += np.bincount(np.frombuffer(x, np.int32), minlength=terms)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], ["term", "n"])

    out = np.zeros(terms, np.int64)
    for r in table.select("term").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def length_norm(size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if len(size) and 50 * int(size.max()) * n_docs >= 1 << 63:
        return np.array([50 + 50 * int(n) * n_docs // n_terms for n in size], np.int64)
    return 50 + 50 * size * n_docs // n_terms


@dataclass
class Pool:
    """Intervals of some queries. Each has entries, one for each of its query's lists that has postings there."""

    query: np.ndarray               # per interval
    bound: np.ndarray
    lowest: np.ndarray              # its first document
    split: np.ndarray               # the first document that holds its greatest impact
    postings: np.ndarray
    of: np.ndarray                  # per entry: its interval, ascending
    lo: np.ndarray
    hi: np.ndarray

    def take(self, keep: np.ndarray) -> Pool:
        number = np.cumsum(keep) - 1
        e = keep[self.of]
        return Pool(*(x[keep] for x in (self.query, self.bound, self.lowest, self.split, self.postings)), number[self.of[e]], self.lo[e], self.hi[e])

    def add(self, other: Pool) -> Pool:
        of = np.concatenate([self.of, other.of + len(self.query)])
        return Pool(*(np.concatenate([getattr(self, k), getattr(other, k)]) for k in ("query", "bound", "lowest", "split", "postings")), of,
                    np.concatenate([self.lo, other.lo]), np.concatenate([self.hi, other.hi]))


class Index:
    """One shard's posting lists in one run of postings, ordered by term and document, with their sparse table."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int):
        self.docs, self.doc, self.impact = docs, doc.astype(np.int64), impact
        self.key = term.astype(np.int64) * docs + self.doc
        self.begin = np.searchsorted(term, np.arange(terms + 1))
        longest = int(np.diff(self.begin).max(initial=1))
        # level j: position of the greatest impact of 2^j postings from here on, the first of equal ones. Runs across the end
        # of a list are never asked for.
        level = np.arange(len(doc), dtype=np.int32)
        levels = [level]
        step = 1
        while 2 * step <= longest:
            level = level.copy()
            a, b = level[:-step], levels[-1][step:]
            level[:-step] = np.where(impact[b] > impact[a], b, a)
            levels.append(level)
            step *= 2
        self.table = np.stack(levels)
        self.log = np.zeros(longest + 1, np.int64)
        for i in range(1, len(levels)):
            self.log[1 << i:] = i

    def greatest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Position of the greatest impact of each range lo .. hi - 1 inside a list, the first of equal ones."""
        k = self.log[hi - lo]
        a, b = self.table[k, lo], self.table[k, hi - (1 << k)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def pool(self, query: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Pool:
        """Intervals ``of`` (ascending labels of entries); ``query`` per label."""
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        best = self.greatest(lo, hi)
        value = self.impact[best]
        number = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(of))))
        if not len(begin):
            none = np.zeros(0, np.int64)
            return Pool(none, none, none, none, none, none, none, none)
        top = np.maximum.reduceat(value, begin)
        return Pool(query[of[begin]], np.add.reduceat(value, begin), np.minimum.reduceat(self.doc[lo], begin),
                    np.minimum.reduceat(np.where(value == top[number], self.doc[best], self.docs), begin),
                    np.add.reduceat(hi - lo, begin), number, lo, hi)

    def search(self, lists: list[np.ndarray], k: int, floor: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The k best documents of each query (an array of terms) with a score above 0: query, score, document; and how many
        documents were scored. Scores under ``floor`` of the query are not wanted, nor equal ones of documents from ``cut`` on."""
        floor, cut = floor.copy(), cut.copy()
        of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        term = np.concatenate(lists)
        lo, hi = self.begin[term], self.begin[term + 1]
        some = hi > lo
        pool = self.pool(np.arange(len(lists)), of[some], lo[some], hi[some])
        found = [np.zeros(0, np.int64)] * 3
        scored = 0
        while True:
            pool = pool.take((pool.bound > floor[pool.query]) | ((pool.bound == floor[pool.query]) & (pool.lowest < cut[pool.query])))
            if not len(pool.query):
                break
            order = np.lexsort((pool.lowest, -pool.bound, pool.query))
            begin = np.searchsorted(pool.query[order], np.arange(len(lists)))
            now = np.zeros(len(order), bool)
            now[order[np.arange(len(order)) - begin[pool.query[order]] < WAVE]] = True
            rest, wave = pool.take(~now), pool.take(now)
            small = wave.postings <= LEAF
            # small intervals: the sum of their postings' impacts by document
            leaf = wave.take(small)
            size = leaf.hi - leaf.lo
            at = np.repeat(leaf.lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)
            key, where = np.unique(np.repeat(leaf.query[leaf.of], size) * self.docs + self.doc[at], return_inverse=True)
            score = np.zeros(len(key), np.int64)
            np.add.at(score, where, self.impact[at])
            new = [[key // self.docs, score, key % self.docs]]
            # others: score the document at which they split, and bound what lies on both sides of it
            wave = wave.take(~small)
            if len(wave.query):
                split = wave.split[wave.of]
                at = np.searchsorted(self.key, self.key[wave.lo] - self.doc[wave.lo] + split)
                there = at < wave.hi
                there[there] = self.doc[at[there]] == split[there]
                begin = np.flatnonzero(np.diff(wave.of, prepend=-1))
                new.append([wave.query, np.add.reduceat(np.where(there, self.impact[np.minimum(at, len(self.impact) - 1)], 0), begin), wave.split])
                of = np.concatenate([2 * wave.of, 2 * wave.of + 1])
                lo, hi = np.concatenate([wave.lo, at + there]), np.concatenate([at, wave.hi])
                some = np.flatnonzero(hi > lo)
                some = some[np.argsort(of[some], kind="stable")]
                rest = rest.add(self.pool(np.repeat(wave.query, 2), of[some], lo[some], hi[some]))
            pool = rest
            scored += sum(len(x[0]) for x in new)
            query, score, doc = (np.concatenate([x[i] for x in new]) for i in range(3))
            may = (score > 0) & ((score > floor[query]) | ((score == floor[query]) & (doc < cut[query])))
            if may.any():
                query, score, doc = (np.concatenate([a, b[may]]) for a, b in zip(found, (query, score, doc), strict=True))
                order = np.lexsort((doc, -score, query))
                query, score, doc = query[order], score[order], doc[order]
                place = np.arange(len(query)) - np.searchsorted(query, query)
                last = place == k - 1
                # the k-th best so far: equal scores count only with a smaller document
                floor[query[last]], cut[query[last]] = score[last], doc[last]
                found = [x[place < k] for x in (query, score, doc)]
        return *found, scored


def _search(table: DataFrame, queries: Queries, n_docs: int, n_terms: int, weight: np.ndarray, k: int, floors: list | None) -> DataFrame:
    """``q`` (number of the query), doc_id and score: the k best of each shard. ``floors``: per query None or (score, doc_id)."""
    shared = table.sparkSession.sparkContext.broadcast((queries.first, queries.terms, weight, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, terms, weight, floors = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                size = batch.column("size")[row].values.to_numpy()
                term, doc, tf = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int32).astype(np.int64) for c in ("term", "doc", "tf"))
                impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * length_norm(size, n_docs, n_terms)[doc]))
                index = Index(term, doc, impact, len(weight), len(size))
                known = ids.drop_null().to_numpy()
                for q in range(0, len(first) - 1, TOGETHER):
                    some = range(q, min(q + TOGETHER, len(first) - 1))
                    floor, cut = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                    for i, f in enumerate(floors[j] for j in some) if floors else ():
                        if f:
                            floor[i], cut[i] = f[0], len(ids) if f[1] is None else np.searchsorted(known, f[1], "right")
                    query, score, found, _ = index.search([terms[first[j]:first[j + 1]] for j in some], k, floor, cut)
                    yield pa.RecordBatch.from_arrays([pa.array(query + q), ids.take(pa.array(found)), pa.array(score)], ["q", "doc_id", "score"])

    return table.select("ids", "size", "term", "doc", "tf").mapInArrow(run, "q long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS, seed_documents: int = SEED_DOCUMENTS) -> DataFrame:
    """``docs``: doc_id, text; ``items``: item_id, text. item_id, rank, doc_id, score of each item's k best documents."""
    spark = docs.sparkSession
    asked = written(query_terms(items), "query-terms")
    blocks = max(1, -(-asked.count() // block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = None
    for i in range(blocks):
        rows = asked.where(block == i).orderBy("item_id", "h1", "h2").collect()
        if not rows:
            continue
        queries = Queries.of(rows)
        table = written(shards(docs, queries), "postings")
        size = table.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
        if not size.docs:
            continue
        weight = weights(size.docs, frequencies(table, len(queries.hashes)))
        # the k-th best of some shards is a lower bound of the k-th best of all
        share = min(1.0, seed_documents / size.docs)
        seeds = table.where(F.pmod(F.xxhash64(F.col("ids")[0], "n_terms"), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1))
        floors: list = [None] * len(queries.ids)
        for r in _ranked(_search(seeds, queries, size.docs, size.terms, weight, k, None), k).where(F.col("rank") == k).collect():
            floors[r.q] = (r.score, r.doc_id)
        names = spark.createDataFrame(list(enumerate(queries.ids)), "q long, item_id long")
        best = _ranked(_search(table, queries, size.docs, size.terms, weight, k, floors), k)
        # at most k rows for each query of the block
        part = best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


#: The same rows by scoring everything in DuckDB SQL.
TOP_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (
  SELECT row_id, doc_id, term, size, count(*)::BIGINT AS tf
  FROM (SELECT row_id, doc_id, len(terms)::BIGINT AS size, unnest(terms) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * s.n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, s.n),
i AS (
  SELECT row_id, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * s.n) // s.l))) AS impact
  FROM p JOIN w USING (term), s),
r AS (SELECT item_id, row_id, doc_id, sum(impact)::BIGINT AS score FROM q JOIN i USING (term) GROUP BY ALL HAVING sum(impact) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50
"""
