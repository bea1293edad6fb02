import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from grainline.llm import ngram_lm as L


def test_elias_fano_round_trip_and_successor():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1 << 60), (5, 4), (9000, 1 << 63), (20_000, 30_000), (12_000, 1 << 40)):
        x = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        e = L.EliasFano.encode(x)
        assert np.array_equal(np.concatenate([np.zeros(0, np.uint64), *(e.chunk(k) for k in range(-(-n // L.CHUNK)))]), x)
        at = np.sort(rng.integers(0, max(n, 1), 300)) if n else np.zeros(0, np.int64)
        assert np.array_equal(e[at], x[at])
        q = np.sort(np.concatenate([rng.integers(0, top, 500, dtype=np.uint64), x[:100]]))
        pos, same = e.successor(q)
        assert np.array_equal(pos, np.searchsorted(x, q)) and np.array_equal(same, np.isin(q, x))


def test_trie_mapped_and_from_file(tmp_path):
    rng = np.random.default_rng(2)
    pairs = sorted({(int(v), int(w)) for v, w in zip(rng.integers(0, 40, 5000) * 10**17, rng.integers(0, 900, 5000), strict=True)})
    v, w = (np.array(c, np.uint64) for c in zip(*pairs, strict=True))
    codes = rng.integers(1, 65536, len(v)).astype(np.uint16)
    contexts = np.append(np.unique(v), np.uint64(10**19))          # one context without continuations
    weights = rng.integers(1, 65535, len(contexts)).astype(np.uint16)
    made = L.Trie.arrays(contexts, weights, v, w, codes)
    L.Trie.save(made, str(tmp_path / "trie"))
    ask = sorted({*pairs[::3], *((int(a), 901) for a in v[::50]), (7, 7), (10**19, 3)})
    av, aw = (np.array(c, np.uint64) for c in zip(*ask, strict=True))
    held, weight = dict(zip(pairs, codes.tolist(), strict=True)), dict(zip(contexts.tolist(), weights.tolist(), strict=True))
    for trie in (L.Trie.mapped(made), L.Trie.load(str(tmp_path / "trie"))):
        got, back_off = trie.lookup(av, aw)
        assert got.tolist() == [held.get(p, 0) for p in ask]
        assert back_off.tolist() == [weight.get(p[0], 65535) for p in ask]
        assert np.array_equal(trie.pointer[np.arange(len(contexts) + 1)], np.searchsorted(v, np.append(contexts, np.uint64(2**64 - 1))))


def test_packing_and_codes():
    a, b = np.array([1, 2**63, 5], np.uint64), np.zeros(0, np.uint8)
    got = L.unpack(L.pack(a, b, L._narrow(np.array([3, 2**40 - 1, 2**41 + 1]), 5)))
    assert got[0].tolist() == a.tolist() and len(got[1]) == 0 and got[2].tolist() == [3, 2**40 - 1, 1]
    p = np.array([0, 1, 0.5, 1e-5, 3e-9])
    assert np.allclose(L.dequantise(L.quantise(p, 10**9), 10**9), p, rtol=0.0003, atol=0)


def brute(rows, folds=10):
    texts = [(d, zlib.crc32(str("" if d is None else d).encode()) % folds == 0, [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), "</s>"]) for d, t in rows]
    c, pair, ctx = Counter(), Counter(), Counter()
    for _, held, w in texts:
        if not held:
            c.update(w)
            pair.update(zip(["<s>", *w], w, strict=False))
            ctx.update(["<s>", *w[:-1]])
    n, v = sum(c.values()), len(c)
    one = lambda w: (max(c[w] - L.DISCOUNT, 0) + L.DISCOUNT * max(v, 1) / (v + 1)) / max(n, 1)
    out = []
    for d, held, w in texts:
        s = sum(math.log10((pair[a, b] + L.MU * one(b)) / (ctx[a] + L.MU)) for a, b in zip(["<s>", *w], w, strict=False))
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((d, held, len(w), sum(c[x] > 0 for x in w), n, base, s))
    return out


def compare(got, want):
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    # probabilities are quantised: less than 1e-4 a token
    assert all(abs(a[6] - b[6]) < 1e-4 * b[2] for a, b in zip(got, want, strict=True))


def test_scores_equal_brute_force_in_one_shard_and_many(spark, sf_small, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    rows += [(None, "The the THE"), (3, rows[3][1]), (999, None), (998, ""), (997, "w " * 20_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, held_out int").repartition(4)
    want = brute(rows)
    compare(L.score(df).collect(), want)
    monkeypatch.setattr(L, "SHARD_TOKENS", 9000)      # frequent contexts are split over shards
    compare(L.score(df).collect(), want)
    monkeypatch.setattr(L, "BLOCK_BYTES", 20_000)     # many blocks, three hops
    monkeypatch.setattr(L, "FAN_BITS", 2)
    compare(L.score(df).collect(), want)


def test_probabilities_after_a_context_add_up_to_one():
    count = np.array([40, 7, 1, 1])
    share, weight = count / (count.sum() + L.MU), L.MU / (count.sum() + L.MU)
    total = 10**6
    code, back = L.quantise(share, total), L.quantise(np.array([weight]), total)
    assert L.dequantise(code, total).sum() + L.dequantise(back, total)[0] == pytest.approx(1, rel=1e-3)


def test_packets_of_a_block_and_of_a_node_do_not_grow_with_the_shards():
    rng = np.random.default_rng(5)
    v, w = np.sort(rng.integers(0, 2**63, 30_000, dtype=np.uint64) * np.uint64(2)), rng.integers(0, 1 << 40, 30_000, dtype=np.uint64)
    for bits, blocks in ((0, 1), (5, 40), (7, 200), (13, 12_000), (20, 1 << 21), (26, 1 << 27)):
        r = L.Routes(bits, blocks)
        shard = r.shard(v, w, np.zeros(0, np.uint64))
        sent = r.packets(0, 12345, v, w, np.ones(len(v), np.int64), shard)
        assert len(sent) <= 1 << L.FAN_BITS
        assert all(r.upto[j + 1] - r.upto[j] <= L.FAN_BITS for j in range(r.hops))
        # a node takes in about as many packets as a block sends
        sources = [blocks, *r.batches[1:]]
        assert all(sources[j] / r.batches[j + 1] <= (4 << L.FAN_BITS) for j in range(r.hops))
        # keys reach the node of their shard
        for level in range(1, r.hops):
            source, node, payload = sent[-1]
            m = L._Merged([payload, payload])
            assert (r.shard(m.v, m.w, np.zeros(0, np.uint64)) >> (bits - r.upto[level]) == r.prefix(node, level)).all()
            assert m.count.sum() == 2 * L.unpack(payload)[3].astype(int).sum()
            sent = r.packets(level, node, m.v, m.w, m.count, r.shard(m.v, m.w, np.zeros(0, np.uint64)))
            assert len(sent) <= 1 << L.FAN_BITS


def test_model_beats_the_base_on_held_out_texts_and_handles_no_training(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = [r for r in L.score(df).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    only = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = L.score(only).collect()
    assert [r.train_tokens for r in got] == [0, 0] and all(r.held_out and r.n_known == 0 for r in got)
    assert L.score(only.limit(0)).count() == 0
