import itertools

import numpy as np
import pyarrow as pa
import pytest

from grainline.llm import line_crf, queries, scan


def chain(seed=0, size=0.7):
    return line_crf.Chain(np.random.default_rng(seed).normal(0, size, line_crf.SIZE))


def some_lines(lengths, seed=1):
    rng = np.random.default_rng(seed)
    n = sum(lengths)
    return line_crf.Lines(rng.integers(0, line_crf.NONE, (n, line_crf.N)).astype(np.uint8), rng.integers(1, 50, n).astype(float),
                          np.concatenate([[0], np.cumsum(lengths)]))


def path_scores(c, near):
    """Every labelling of one document's lines and its unnormalised log score, term by term."""
    w, pair, start = c.theta[:3 * line_crf.N * line_crf.K].reshape(3, line_crf.N, line_crf.K), c.theta[-6:-2].reshape(2, 2), c.theta[-2:]
    for path in itertools.product((0, 1), repeat=len(near)):
        total = start[path[0]]
        for t, s in enumerate(path):
            total += (1 if s else -1) / 2 * sum(w[o, f, near[t, o, f]] for o in range(3) for f in range(line_crf.N))
            total += pair[path[t - 1], s] if t else 0
        yield path, total


def test_marginals_and_likelihood_equal_brute_force_over_all_labellings():
    c, lengths = chain(), [1, 5, 2, 1, 7]
    x = some_lines(lengths)
    near = line_crf.neighbours(x)
    p = c.infer(near, x.first)[-1]
    label = np.array([0, 1, 1, 0, 0])
    weight = np.array([1.0, 0.5, 2.0, 1.0, 0.3])
    loss = 0.0
    for d, (i, j) in enumerate(zip(x.first[:-1], x.first[1:], strict=True)):
        scores = dict(path_scores(c, near[i:j]))
        z = sum(np.exp(s) for s in scores.values())
        want = [sum(np.exp(s) for path, s in scores.items() if path[t]) / z for t in range(j - i)]
        assert np.allclose(p[i:j], want)
        loss -= weight[d] * (scores[(label[d],) * (j - i)] - np.log(z))
    got, gradient = c.loss(near, x.first, label, weight)
    assert got == pytest.approx(loss)
    for k in np.random.default_rng(3).choice(line_crf.SIZE, 25, replace=False).tolist() + list(range(line_crf.SIZE - 6, line_crf.SIZE)):
        step = np.zeros(line_crf.SIZE)
        step[k] = 1e-5
        up, down = (line_crf.Chain(c.theta + s).loss(near, x.first, label, weight)[0] for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / 2e-5, abs=1e-5)
    mean, _ = c.quality(x)
    assert np.allclose(mean, [np.average(p[i:j], weights=x.weight[i:j]) for i, j in zip(x.first[:-1], x.first[1:], strict=True)])


def test_very_long_documents_stay_finite_and_equal_their_parts_far_away():
    c, x = chain(4, 1.5), some_lines([40_000, 3])
    p = c.infer(line_crf.neighbours(x), x.first)[-1]
    assert np.isfinite(p).all()
    alone = line_crf.Lines(x.codes[40_000:], x.weight[40_000:], np.array([0, 3]))
    assert np.allclose(p[40_000:], c.infer(line_crf.neighbours(alone), alone.first)[-1])


def plain_codes(text):
    """The bins by Python string work."""
    rows, seen = [], set()
    words = [(n, w) for n, line in enumerate(text.split("\n")) for w in line.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    lower = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for _, w in words]
    grams = {}
    for i in range(len(lower) - 7):
        grams.setdefault(tuple(lower[i:i + 8]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(8)}
    all_lines = text.split("\n")
    for n, line in enumerate(all_lines):
        mine = [i for i, (k, _) in enumerate(words) if k == n]
        own, size = [words[i][1] for i in mine], len(line.encode())
        many, long = max(len(own), 1), max(size, 1)
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
        last = 0 if not own else 1 if own[-1][-1] in ".!?" else 2 if own[-1][-1].isascii() and not own[-1][-1].isalnum() else 3
        values = [len(own), sum(len(w.encode()) for w in own) / many, sum(line.count(c) for c in "#*$%&|<>") / many, sum(line.count(c) for c in "!?") / many,
                  sum("A" <= c <= "Z" for c in line) / long, sum("0" <= c <= "9" for c in line) / long, last, sum(i in covered for i in mine) / many,
                  folded in seen and bool(own), (1 - len({lower[i] for i in mine}) / many) if own else 0, 2 * (n == 0) + (n == len(all_lines) - 1)]
        seen.add(folded)
        rows.append([sum(v > e for e in edges) for v, edges in zip(values, line_crf.BINS.values(), strict=True)])
    return rows


def test_bins_equal_plain_string_work():
    rng = np.random.default_rng(5)
    texts = ["", None, "\n", "a", "One line.\n\nOne line.\n", " \t \n x"]
    alphabet = [*"abcdeABé#!?.1 \n\t", "one two ", "the same words again and again for ever ", "\n"]
    texts += ["".join(rng.choice(alphabet, rng.integers(1, 120))) for _ in range(60)]
    for most in (64, 1 << 20):
        got = []
        for b in scan.blocks(pa.array(texts), most):
            x = line_crf.lines(b)
            got += [x.codes[i:j].tolist() for i, j in zip(x.first[:-1], x.first[1:], strict=True)]
        assert got == [plain_codes(t or "") for t in texts]


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op13_line_crf(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.n_bad_lines <= r.n_lines for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted for r in tested if truth[r.doc_id] == 1]) > 0.99
    assert np.mean([r.predicted for r in tested if truth[r.doc_id] == 0]) < 0.1


def test_edge_cases(spark):
    good, bad = "A plain sentence of words stands here.\nAnd another one follows it.", "BUY!! NOW!! $$$ | | | |\nBUY!! NOW!! $$$ | | | |"
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(None, good), (70, None), (71, ""), (72, "x" * 300_000), (73, "a b\n" * 50_000), (1, good), (1, bad)]
    docs = spark.createDataFrame([(*r, 9.0, "mine") for r in rows], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (1, 0), (None, 1), (2, 7), (70, 1)], "doc_id long, quality int")
    c = line_crf.fit(docs, labels)
    got = line_crf.judge(docs, c)
    assert got.columns == ["doc_id", "label", "score", "n_lines", "n_bad_lines"]
    got = got.collect()
    assert len(got) == len(rows) and all(r.label == "mine" and 0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (1,)}
    assert all((by_id[i].score >= 0.5) == bool(i % 2) for i in range(2, 60)) and by_id[70].score == by_id[71].score and by_id[73].n_lines == 50_001
    assert line_crf.judge(docs.limit(0), c).count() == 0
    untaught = line_crf.fit(docs, labels.limit(0))
    assert {r.score for r in line_crf.judge(docs, untaught).collect()} == {0.5}
    assert line_crf.fit(docs, labels.where("quality = 1")).theta.any() == False  # noqa: E712
