import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainline.llm import langid, licences, quality, queries, toxicity


def held_out_accuracy(frame, truth):
    rows = [r for r in frame.collect() if r.held_out and r.doc_id in truth]
    return rows, np.mean([truth[r.doc_id] for r in rows])


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op9_language(spark, sf)
    rows = out.collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_language_edge_cases(spark):
    rows = [(1, "el gato come pan " * 5, "es"), (2, "der hund isst das brot " * 5, "de"), (3, None, "de"), (None, "el pan", None), (5, "", "es"), (5, "12 ?!", "es")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, lang string, score string")
    model = langid.fit(df)
    got = langid.identify(df, model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id or 0)] == ["es", "es", "de", "und", "und", "und"]
    assert langid.fit(df.limit(0)).predict("el pan") == ("und", 0.0)
    assert langid.identify(df.limit(0), model).count() == 0


def test_language_scores_equal_a_plain_sum():
    rng = random.Random(2)
    model = langid.Model(["a", "b"], np.log(np.random.default_rng(1).dirichlet(np.ones(langid.BUCKETS), 2).T), np.log([0.5, 0.5]))
    text = "".join(rng.choices("abc déf. ", k=300))
    total = model.prior + sum(model.log_probability[g] for g in langid.grams(text))
    assert model.predict(text)[0] == "ab"[int(np.argmax(total))]


def test_language_fit_and_scores_equal_plain_counting(spark, sf_small):
    """The fitted matrix and the query's scores, text by text and gram by gram."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang")
    train = docs.where(langid.fold(docs.doc_id, 3) != 1)
    model = langid.fit(train)
    counts, sizes = {}, {}
    for r in train.collect():
        if r.lang is not None and r.text is not None:
            sizes[r.lang] = sizes.get(r.lang, 0) + 1
            text = "".join(c if c.isalpha() else " " for c in r.text.lower())
            if not text.strip():
                continue
            text = " " + " ".join(text.split()) + " "
            mine = counts.setdefault(r.lang, [0] * langid.BUCKETS)
            for n in (1, 2, 3):
                for i in range(len(text) - n + 1):
                    h = 0
                    for k in range(n):
                        h = (h * 0x01000193 + ord(text[i + k]) + k + 1) % (1 << 32)
                    mine[(h * 0x9E3779B1) % (1 << 32) >> 17] += 1
    assert model.languages == sorted(sizes)
    for k, lang in enumerate(model.languages):
        want = np.array(counts[lang]) + langid.SMOOTHING
        assert np.allclose(model.log_probability[:, k], np.log(want / want.sum()), atol=1e-5)
        assert model.prior[k] == pytest.approx(np.log(sizes[lang] / sum(sizes.values())))
    texts = [r.text for r in docs.collect()] + [None, "", "12 ?!", "a", "x" * 500_000]
    names, score = model.predict_batch(texts)
    for t, name, p in zip(texts, names, score, strict=True):
        g = langid.grams(t)
        if g is None:
            assert (name, p) == ("und", 0.0)
            continue
        total = model.prior + model.log_probability[g].astype(float).sum(0)
        assert name == model.languages[int(np.argmax(total))] and p == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-3)


def test_licence_notices_on_one_line_take_linear_time():
    import time
    scanner = licences.Scanner()
    begin = time.monotonic()
    assert "MIT-short" in scanner.scan("Released under the MIT License. And so on, with other words. " * 16_000)
    assert time.monotonic() - begin < 25


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted for r in tested if truth[r.doc_id] == 1]) > 0.9
    assert np.mean([r.predicted for r in tested if truth[r.doc_id] == 0]) < 0.01


def test_grammar_reads_clauses():
    g = toxicity.Grammar({w: 2.0 for w in toxicity.INSULTS} | {"lowei*": 2.0})
    plain, at_you = g.clause("a real idiot"), g.clause("you are an idiot")
    assert at_you > plain > g.clause("i do not think idiot is right") > 0
    assert plain > g.clause('he said "idiot"')
    assert g.clause("i will kill you") == 3.0 and g.clause("you will win") == 0
    assert g.clauses("Nothing here. What an IDIOT! Loweischaft? idiotic") == [2.0, 2.0]
    assert g.clauses("") == [] and g.features([None, ""])[:, 1].tolist() == [0, 0]


def test_composed_machine_equals_its_parts():
    rng = random.Random(4)
    scopes, patterns = [toxicity.NEGATED, toxicity.REPORTED, toxicity.TARGETED], [toxicity.INSULTING, toxicity.THREATENING]
    for _ in range(300):
        state, states = 0, [t.start for t in scopes + patterns]
        for c in rng.choices(toxicity.CLASSES, k=20):
            state, got = toxicity.MACHINE[state, c]
            moved = [t.step(s, c) for t, s in zip(scopes + patterns, states, strict=True)]
            states = [m[0] for m in moved]
            factor = np.prod([m[1] for m in moved[:3]])
            assert got == pytest.approx([m[1] * factor for m in moved[3:]])


def test_toxicity_without_labels_and_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "you idiot", 1), (2, "", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    g = toxicity.fit(df, labels)
    got = toxicity.judge(df, g).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 2
    assert toxicity.judge(df.limit(0), g).count() == 0


def brute_licences(text):
    words = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

    def bag(t):
        w = ["", *words.findall(t.lower()), ""]
        return Counter(zip(w, w[1:])) if len(w) > 2 else Counter()

    lines = text.split("\n")
    runs = [r for r in re.split(r"\n(?:[^\w\n]|_)*(?=\n)", text)]
    out = {}
    for piece in [*lines, *runs, text]:
        a, best = bag(piece), None
        for name, t in sorted(licences.TEMPLATES.items()):
            b = bag(t)
            d = 2 * sum((a & b).values()) / max(sum(a.values()) + sum(b.values()), 1)
            if d >= licences.THRESHOLD and (best is None or d > best[1]):
                best = name, d
        if best:
            out[best[0]] = max(out.get(best[0], 0), best[1])
    return out


def test_licences_equal_brute_force(spark, sf_small):
    scanner = licences.Scanner()
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    mit = licences.TEMPLATES["MIT"].split()
    texts += ["\n".join(" ".join(mit[i:i + 9]) for i in range(0, len(mit), 9)), "released under MIT license", "Title\n\n" + licences.TEMPLATES["ISC"] + "\n\nend",
              "RELEASED under the MIT License\nLicensed under the Apache License, Version 2.0", "", "..."]
    for t in texts:
        assert scanner.scan(t) == pytest.approx(brute_licences(t)), t[:80]


def test_licences_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "Released under the MIT License."), (3, "word " * 50_000)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licences.scan(df).collect()}
    assert got == {1: "", 2: "", None: "MIT-short", 3: ""}
    assert licences.scan(df.limit(0)).count() == 0


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_rule_counts_equal_brute_force(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    texts += [None, "", "\n\n", "a", "é\xa0b c\n" * 9, "x y z " * 40, "same\nsame\n same\nsame", "a b c d e f g h a b c d e f g h"]
    c = quality.rule_counts(pa.array(texts))
    for i, t in enumerate(texts):
        assert [c[k][i] for k in quality.COUNTS] == plain_counts(t), t
    assert len(quality.rule_counts(pa.array([], pa.string()))["n_words"]) == 0


def test_isolation_forest_paths_and_threshold():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (2000, 3)), rng.normal(8, 1, (40, 3))])
    f = quality.IsolationForest.fit(x)
    s = f.score(x)
    assert s[2000:].min() > np.percentile(s[:2000], 97)
    row = x[2005]

    def depth(at):
        while f.child[at] >= 0:
            at = f.child[at] + (row[f.feature[at]] >= f.cut[at])
        return f.depth[at]

    want = 2 ** (-np.mean([depth(r) for r in f.roots]) / quality.path_constant(f.rows))
    assert f.score(row[None])[0] == pytest.approx(float(want))
    assert quality.calibrate(s, np.arange(len(s)) < 2000) > 0.5
    assert quality.calibrate(np.array([0.1]), np.array([True])) == quality.DEFAULT_THRESHOLD


def test_quality_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op1_quality_rules(spark, sf).collect() if r.doc_id in truth and not r.base_failed]
    assert np.mean([r.kept for r in rows if truth[r.doc_id] == 1]) > 0.99
    assert np.mean([r.kept for r in rows if truth[r.doc_id] == 0]) < 0.1


def test_quality_odd_rows(spark):
    df = spark.createDataFrame([(1, None, True), (1, "", True), (None, "w " * 30, False)], "doc_id long, text string, kept boolean")
    f = quality.fit(df, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality.score(df, f).collect()
    assert [r.base_failed for r in got] == [True] * 3 and all(p.threshold == quality.DEFAULT_THRESHOLD for _, p in f.parts)
    assert quality.score(df.limit(0), f).count() == 0


def test_quality_verdicts_recomputed_one_by_one(spark, sf_small):
    """The query's verdict from plain counts, tree walks and thresholds; and an id with differing labels counts as its lowest."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    f = quality.fit(docs, labels)
    both = quality.fit(docs.union(docs.limit(20)), labels.union(labels.withColumn("quality", 1 + 0 * labels.quality)))
    assert [p.threshold for _, p in both.parts] == [p.threshold for _, p in f.parts]

    def walk(forest, row):
        depths = []
        for at in forest.roots:
            while forest.child[at] >= 0:
                at = forest.child[at] + (row[forest.feature[at]] >= forest.cut[at])
            depths.append(forest.depth[at])
        return 2 ** (-np.mean(depths) / quality.path_constant(forest.rows)) if depths else 0.5

    got = {r.doc_id: r for r in queries.op1_quality_rules(spark, sf_small).collect()}
    for r in docs.collect():
        c = quality.rule_counts(pa.array([r.text], pa.string()))
        x = quality.statistics(c)[0]
        n_words, repeat = c["n_words"][0], c["n_repeat_words"][0]
        failed = n_words < 20 or 100 * repeat > 30 * n_words
        excess = max(walk(p, x[cols]) - p.threshold for cols, p in f.parts)
        assert got[r.doc_id].base_failed == failed and got[r.doc_id].anomaly == pytest.approx(excess)
        assert got[r.doc_id].kept == (not failed and excess <= 0)
    # no statistic is flat where the counts differ: a text with more repeats always has a greater rate
    few = {k: np.array([10 if k in ("n_words", "n_lines") else 5] * 8) for k in quality.COUNTS + quality.EXTRA} | {
        "n_repeat_words": np.arange(8), "n_dup_lines": np.arange(8)}
    assert (np.diff(quality.statistics(few)[:, 5:], axis=0) > 0).all()


def test_quality_learns_from_every_document(spark):
    """Bad documents that stand last in any order by hash of the id, behind 12,800 good ones, still set the threshold; and trees
    hold every document."""
    rng = np.random.default_rng(3)
    ids = [r.id for r in spark.range(13_000).orderBy(F.xxhash64(F.lit(7), "id")).collect()]
    words = [f"w{i}" for i in range(500)]
    rows = []
    for place, i in enumerate(ids):
        w = list(rng.choice(words, 30, replace=False))
        rows.append((i, " ".join(w if place < 12_800 else [x + "#$|<>&" * int(rng.integers(1, 4)) for x in w]), int(place < 12_800)))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    f = quality.fit(table.select("doc_id", "text"), table.select("doc_id", "quality"))
    assert f.parts[0][1].threshold != quality.DEFAULT_THRESHOLD and f.parts[0][1].rows == 130
    kept = {r.doc_id: r.kept for r in quality.score(table.select("doc_id", "text"), f).collect()}
    assert not any(kept[i] for i in ids[12_800:]) and np.mean([kept[i] for i in ids[:12_800]]) > 0.99
    key = rng.integers(0, 2**63, 5000).astype(np.uint64)
    for share in (0.01, 128 / 5000, 1.0):
        row, tree = quality._members(key, share)
        assert set(row) == set(range(5000)) and abs(len(row) / 5000 / quality.TREES - share) < 0.002


def test_licence_wordings(spark):
    scanner = licences.Scanner()
    bsd = licences.TEXTS["BSD-3-Clause-text"]
    for text, name in [("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0-short"), ("Licensed under CC BY-ND 3.0", "CC-BY-ND-3.0-short"),
                       ("SPDX-License-Identifier: MIT", "MIT-spdx"), ("Copyright 2020 A\n\n" + bsd, "BSD-3-Clause-text"),
                       (licences.TEXTS["GPL-3.0-text"], "GPL-3.0-text"), (licences.TEMPLATES["Apache-2.0-url"], "Apache-2.0-url")]:
        assert name in scanner.scan(text), name
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    lines = {x.strip() for t in texts for x in t.split("\n") if re.match(r"(Licensed|Released) under|This work is licensed|SPDX-License", x)}
    assert lines and all(scanner.scan(x) for x in lines)


def test_licences_within_lines():
    scanner = licences.Scanner()
    apache = licences.TEMPLATES["Apache-2.0-header"]
    for text, name in [("See below. Released under the MIT License. Thanks to all contributors for their work on this.", "MIT-short"),
                       ("Copyright 2021 Acme Inc. All rights reserved.", "All-Rights-Reserved"),
                       ("Copyright 2021 Acme Inc and its many authors over the years " + apache, "Apache-2.0-header"),
                       ("one two three four five six seven eight nine released under\nthe MIT license and so on for a while longer", "MIT-short"),
                       ("word " * 3000 + licences.TEXTS["MIT-text"] + " word" * 3000, "MIT-text")]:
        assert list(scanner.scan(text)) == [name], text[:80]
    assert scanner.scan("the license of all rights was released by the author under the stars") == {}
