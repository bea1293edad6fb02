import hashlib

import duckdb
import numpy as np
import pytest

from grainline.llm import ball_codes, queries


def brute(rows, entries=64, rounds=2):
    """Plain k-means in Python integers. ``rows``: (vec_id, vector, label)."""
    kept = [(i, [min(max(int(np.floor(256 * float(x))), -ball_codes.LIMIT), ball_codes.LIMIT) for x in v], k) for i, v, k in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // 16))
    kept = [(i, v + [0] * (16 * width - len(v)), k) for i, v, k in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))]
    x = np.array([v for _, v, _ in kept], dtype=object).reshape(-1, 16, width)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(16):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = [int(t) // len(mine) for t in mine.sum(0)]
    code, d = nearest()
    sha = hashlib.sha256(",".join(str(c) for c in books.reshape(-1)).encode()).hexdigest()
    error = [int(r.sum()) for r in d]
    by_label = {}
    for (_, _, k), e in zip(kept, error, strict=True):
        by_label[k] = by_label.get(k, 0) + e
    return sorted((i, "".join(f"{c:02x}" for c in row), e, by_label[k], sha) for (i, _, k), row, e in zip(kept, code, error, strict=True) if i is not None)


def result(frame):
    return sorted(tuple(r) for r in frame.collect() if r.vec_id is not None)


@pytest.mark.parametrize("kind", ["clusters", "random", "ties", "equal"])
def test_balls_give_the_entries_of_a_full_comparison(kind):
    rng = np.random.default_rng(2)
    n = 4000
    centre = rng.normal(0, 400, (40, 4))
    x = {"clusters": centre[rng.integers(0, 40, n)] + rng.normal(0, 12, (n, 4)), "random": rng.normal(0, 90, (n, 4)),
         "ties": rng.integers(-2, 3, (n, 4)), "equal": np.ones((n, 4))}[kind].astype(np.int64)
    book = x[:64].copy()
    compared = 0
    last, _ = ball_codes.assign(x, book)
    for _ in range(4):
        new = book.copy()
        for e in range(64):
            if (last == e).any():
                new[e] = x[last == e].sum(0) // (last == e).sum()
        own = ((x - new[last]) ** 2).sum(1)
        radius = np.array([own[last == e].max(initial=-1) for e in range(64)])
        code, d, seen = ball_codes.reassign(x, new, last, ball_codes.Balls(new, radius))
        want, want_d = ball_codes.assign(x, new)
        assert (code == want).all() and (d == want_d).all()
        compared, last, book = compared + seen, code, new
    if kind == "clusters":
        assert compared < 0.2 * 4 * 64 * n
    if kind == "random":
        assert compared < 0.6 * 4 * 64 * n


def test_given_vectors_equal_plain_k_means_and_the_sql(spark, sf_small):
    path = f"{sf_small}/embeddings.parquet"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(path).collect()]
    got = result(queries.op12_ball_codes(spark, sf_small))
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
    assert sorted(con.execute(ball_codes.CODES_SQL).fetchall()) == got


def test_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 1, 32).round(1).tolist(), i % 3 if i % 7 else None) for i in range(150)]
    rows += [(200, None, 1), (201, [1.0, None] * 16, 1), (202, [float("nan")] * 32, 1), (203, [float("-inf")] * 32, 1), (204, [], 2),
             (205, [1e300] * 32, 2), (206, [-0.001] * 20, None), (3, rows[3][1], 0), (3, rows[9][1], None), (None, rows[5][1], 2)]
    frame = spark.createDataFrame([(*r, "mine") for r in rows], "vec_id long, embedding array<double>, label int, code string").repartition(5)
    want = brute(rows)
    assert result(ball_codes.report(frame)) == want
    monkeypatch.setattr(ball_codes, "FEW_LABELS", 2)                    # many labels: joined by salted keys
    salted = ball_codes.report(frame)
    assert result(salted) == want and salted.count() == len(want) + 1
    few = frame.where("vec_id < 5")
    assert result(ball_codes.report(few)) == brute([r for r in rows if r[0] is not None and r[0] < 5])
    assert ball_codes.report(frame.limit(0)).count() == 0
