import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainline.llm import bagminhash as B


def bag(text):
    w = (text or "").lower().split()
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(sum(a.values()) + sum(b.values()) - both, 1)


def variants(seed, words, changes):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 5000, words)]
    for n in changes:
        t = list(base)
        for i in rng.choice(words, n, replace=False):
            t[i] = f"z{rng.integers(1 << 30)}"
        yield " ".join(t)


def test_overlap_is_exact_and_signatures_unbiased():
    texts = list(variants(1, 300, [0, 1, 3, 6, 12])) + ["a b c d e f " * 30, "a b c d e f " * 22 + "q r s"]
    d = B.describe(pa.array(texts))
    s = np.frombuffer(b"".join(d["signature"]), np.uint32).reshape(-1, B.SLOTS)
    for i, j in itertools.combinations(range(len(texts)), 2):
        want = jaccard(bag(texts[i]), bag(texts[j]))
        assert B.overlap(d["bag"][i], d["bag"][j]) == pytest.approx(want)
        assert abs((s[i] == s[j]).mean() - want) < 0.17


def brute_classes(rows):
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= 0.8:
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def test_classes_equal_brute_force(spark):
    texts = [t for s in range(12) for t in variants(s, 60 + 20 * s, [0, 0, 1, 2, 2, 3, 4, 40])]
    texts += ["one two", "One TWO", "one two three", "x " * 500, "x " * 480, "x " * 100]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in B.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_classes(rows)
    assert {d: r.class_id for d, r in got.items()} == want
    assert sorted(d for d, r in got.items() if r.kept) == sorted(set(want.values()))


def test_nulls_empty_repeats_and_clashing_columns(spark):
    text = next(variants(3, 80, [0]))
    rows = [(None, text, "u"), (7, text, "u"), (7, text, "u"), (8, None, "u"), (9, "", "u"), (9, " \n ", "u"), (None, None, "u"), (2, text + " end", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid string")
    got = B.classes(df).collect()
    assert len(got) == len(rows)
    assert {r.class_id for r in got if r.n_shingles} == {2}
    assert sum(r.kept for r in got if r.n_shingles) == 1
    assert all(r.kept and r.class_id == r.doc_id for r in got if not r.n_shingles)
    left = B.keep_first(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 2, 8, 9, 9]
    assert B.classes(df.limit(0)).count() == 0


def test_common_passage_does_not_join_texts(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, passage + " " + next(variants(i, 60, [0]))) for i in range(300)]
    got = B.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in got)


def test_chain_of_links_is_one_class(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300)], "a long, b long")
    got = {r.node: r.label for r in B.connected(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def test_families_that_one_pair_joins(spark):
    # copies of two versions: 0.75 to 0.79 across, but for one pair over 0.8, late in the order
    rng = np.random.default_rng(11)
    texts, families = [], 25
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(350)]
        drifted = list(base)
        for i in range(8, 320, 40):
            drifted[i] = f"f{f}d{i}"
        for version, between in ((base, drifted), (drifted, base)):
            for k in range(12):
                t = list(version)
                for i in rng.choice(350, 2, replace=False):
                    t[i] = f"z{rng.integers(1 << 40)}"
                if k == 11 and version is base:
                    t = list(version)
                    for i in (8, 48):
                        t[i] = between[i]
                texts.append(" ".join(t))
    rows = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in B.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_prefixes_name_every_similar_pair(spark):
    texts = [t for s in range(6) for t in variants(s, 100, [0, 1, 2, 3, 4, 5, 6, 7, 8])]
    texts += ["x y " * n for n in (40, 44, 48, 60)] + [" ".join(f"q{i}" for i in range(n)) for n in (80, 90, 99)]
    raw = B.describe(pa.array(texts))["bag"]
    named = spark.createDataFrame([(1, i, i) for i in range(len(raw))], "band long, uid long, label long")
    bags = spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(raw)], "uid long, bag binary")
    got = {(r.a, r.b) for r in B._across(bags)(named).collect()}
    want = {(i, j) for i, j in itertools.combinations(range(len(raw)), 2) if B.overlap(raw[i], raw[j]) >= B.SIMILARITY}
    assert want and want <= got
    # texts around one long passage: the passage pairs none of them
    passage = " ".join(f"p{i}" for i in range(70))
    raw = B.describe(pa.array([passage + " " + next(variants(90 + i, 30, [0])) for i in range(200)]))["bag"]
    named = spark.createDataFrame([(1, i, i) for i in range(len(raw))], "band long, uid long, label long")
    bags = spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(raw)], "uid long, bag binary")
    assert B._across(bags)(named).count() == 0


def test_blocks_bound_both_sides(spark):
    n = 1500
    rows = [(1, i, i, 100, 0, True) for i in range(n)] + [(2, i, 0, 100, 0, True) for i in range(n)]
    found = spark.createDataFrame(rows, "element long, uid long, label long, size long, at long, shorter boolean")
    left, right = B._in_blocks(found)
    for side in (left, right):
        assert side.groupBy("element", "out", "home").count().agg({"count": "max"}).first()[0] < 1.3 * B.BLOCK_TEXTS
    pairs = left.alias("l").join(right.alias("r"), ["element", "out", "home"])
    assert pairs.where("element = 1").selectExpr("l.uid", "r.uid").distinct().count() == (n - 1) * n
    assert pairs.where("element = 2").isEmpty()


def test_kept_rows_are_the_same_on_every_run(spark):
    rows = [(1, "one two three four five six", lang, source) for lang in ("a", "b", None) for source in ("x", "y")] + [(2, "other words", "a", "x")]
    got = set()
    for seed in range(3):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).orderBy(F.rand(seed))
        out = B.keep_first(df.withColumn("__id", F.lit("mine")))
        assert out.columns == ["doc_id", "text", "lang", "source"]
        got.add(tuple(sorted(map(tuple, out.collect()), key=str)))
    assert len(got) == 1 and len(got.pop()) == 2


def test_hot_elements_are_dealt_over_salts(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("element"), F.col("id").alias("uid"))
    keys = rows.select("element").distinct().where("element % 3 <> 0")
    out = B._salted(rows, keys, "element")
    assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString() and out.columns == ["element", "uid"]
    want = rows.join(keys, "element")
    assert out.count() == want.count() and out.exceptAll(want).count() == 0
