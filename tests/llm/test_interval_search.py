import math
import re

import duckdb
import numpy as np
import pytest

from grainline.llm import interval_search, queries

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k=50):
    found = [(i, terms(t)) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    n, total = len(found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, t in found:
            m, score = 50 + 50 * len(t) * n // total, 0
            for x in wanted & set(t):
                tf = t.count(x)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["random", "skewed", "equal"])
def test_search_of_one_shard_equals_brute_force(kind):
    rng = np.random.default_rng(4)
    docs, n_terms = 3000, 60
    hit = rng.random((n_terms, docs)) < rng.random((n_terms, 1)) ** 3
    value = {"random": rng.integers(1, 1000, (n_terms, docs)), "skewed": (rng.pareto(1, (n_terms, docs)) * 50).astype(np.int64) + 1,
             "equal": np.full((n_terms, docs), 7)}[kind]
    impact = np.where(hit, value, 0)
    term, doc = np.nonzero(impact)
    index = interval_search.Index(term, doc, impact[term, doc], n_terms, docs)
    for _ in range(300):                                                 # the tables
        t = rng.integers(0, n_terms)
        lo, hi = np.sort(rng.integers(index.begin[t], index.begin[t + 1] + 1, 2)) if index.begin[t + 1] > index.begin[t] else (0, 0)
        if hi > lo:
            assert index.greatest(np.array([lo]), np.array([hi]))[0] == lo + index.impact[lo:hi].argmax()
    lists = [rng.choice(n_terms, size, replace=False) for size in (1, 3, 8, 20, 60)]
    none = np.zeros(len(lists), np.int64)
    want = []
    for q, t in enumerate(lists):
        s = impact[t].sum(0)
        want += [(q, int(s[d]), int(d)) for d in np.lexsort((np.arange(docs), -s))[:10] if s[d]]
    query, score, found, scored = index.search(lists, 10, none, none)
    assert list(zip(query.tolist(), score.tolist(), found.tolist(), strict=True)) == want
    if kind == "skewed":
        assert scored < 0.5 * docs * len(lists)                          # most documents are never looked at
    # from the bound of an earlier search: only what may still change the result
    floor = np.array([[w[1] for w in want if w[0] == q][4] for q in range(len(lists))])
    cut = np.array([[w[2] for w in want if w[0] == q][4] for q in range(len(lists))]) + 1
    query, score, found, fewer = index.search(lists, 10, floor, cut)
    assert list(zip(query.tolist(), score.tolist(), found.tolist(), strict=True)) == [
        w for q in range(len(lists)) for w in [x for x in want if x[0] == q][:5]] and fewer <= scored


def test_given_documents_equal_brute_force_and_the_sql(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op11_interval_search(spark, sf_small).collect()), key=str)
    assert got == brute(docs, items)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    assert sorted(con.execute(interval_search.TOP_SQL).fetchall(), key=str) == got


def test_shards_blocks_ties_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    words = ["Alpha", "beta", "GAMMA", "délta", "É", "x1", "x-2", "the", "日本"]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 12), p=[.3, .2, .1, .1, .05, .05, .05, .1, .05]))) for i in range(400)]
    docs += [(1000 + i, "the same passage of rare words stands here") for i in range(120)]
    docs += [(None, "beta gamma"), (None, "beta gamma"), (7, None), (8, ""), (9, "... !"), (5, "alpha alpha"), (5, "alpha alpha"), (1, "the " * 100_000)]
    items = [(1, "the same passage of rare words"), (2, "ALPHA beta"), (2, "gamma"), (None, "délta é É"), (4, None), (5, "?"), (6, "absent"), (7, "x 1 x1")]
    frame = spark.createDataFrame([(*d, 3) for d in docs], "doc_id long, text string, score int").repartition(6)
    asked = spark.createDataFrame([(*i, "mine") for i in items], "item_id long, text string, doc_id string")
    want = brute(docs, items)
    assert sorted((tuple(r) for r in interval_search.search(frame, asked).collect()), key=str) == want
    monkeypatch.setattr(interval_search, "SHARD_DOCUMENTS", 20)
    monkeypatch.setattr(interval_search, "LEAF", 0)
    got = interval_search.search(frame, asked, block_terms=4, seed_documents=100)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert interval_search.search(frame, asked.limit(0)).count() == 0
    assert interval_search.search(frame.limit(0), asked).count() == 0
