"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its features are counts of the line (words, symbols, marks, capitals, digits, repeated windows
and lines, ...), each in a few bins, together with the same bins of the line above and the line below. Forward-backward
gives every line's marginal probability of being good; a document's quality is their mean, weighted by line length, then
calibrated on labelled documents.

The chain has two states, so a step is a 2 x 2 matrix and the recursions are running matrix products: they are taken for
all lines of a batch at once by doubling, in log2(lines of the longest document) numpy passes. The first line of a document
has a matrix with equal rows, which cuts it off from the document before it.

The fit: the lines of at most FIT_DOCUMENTS labelled documents (picked by hash; a documented bound) become a stored table of
bins, whatever the number of their lines. A line's label is its document's. Each step of L-BFGS is one Spark job in which
tasks sum the gradient over their part of that table; the driver sees sums of fixed size only.

Defined results. A null text is an empty one: one empty line, scored like any other. A text of k line breaks has k + 1
lines; an empty line weighs 1, every line its bytes + 1. Texts are whole, of any length, on one line or many. No labels, or
labels of one kind only: every score is 0.5. Repeated rows: the same score each; in the fit, an id's least text and highest
label stand for it. Labels other than 0 and 1, and null ids, teach nothing. Empty table: no rows. Own columns named like
results (score, n_lines, n_bad_lines) give way; other extra columns stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import add_columns, bounded_sample, written
from .toxicity import logistic

#: At most so many labelled documents are learned from.
FIT_DOCUMENTS = 8000
WINDOW = 8
RIDGE = 1.0
STEPS = 30
#: Bytes of text whose lines are handled at once (a longer document is a block of its own).
BLOCK_BYTES = 1 << 18
#: Files of the stored table of bins, so that a step of the fit has so many small tasks, however the documents are dealt.
FIT_FILES = 16

_SHARES = [0.0, 0.02, 0.05, 0.1, 0.25, 0.5, 0.8]
#: Upper ends of the bins of each feature; a value above all of them has the last bin.
BINS: dict[str, list[float]] = {
    "words": [0, 1, 2, 5, 10, 20, 50], "word_bytes": [2, 3, 4, 5, 6, 7, 9], "symbols": _SHARES, "marks": _SHARES,
    "capitals": _SHARES, "digits": _SHARES, "last": [0, 1, 2], "in_repeats": _SHARES, "seen_line": [0],
    "same_words": _SHARES, "place": [0, 1, 2],
}
N, K = len(BINS), 9                 # features, and bins with one for "no such line"
NONE = K - 1
SIZE = 3 * N * K + 6                # weights of the line above, the line, the line below; 4 transitions, 2 starts


def _set(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOL, _MARK, _CAPITAL, _DIGIT = _set("#*$%&|<>"), _set("!?"), _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _set("0123456789")
_LAST = np.zeros(256, np.int64)     # the line's last byte: 1 ends a sentence, 2 other ASCII punctuation, 3 the rest
_LAST[:] = 3
_LAST[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
_LAST[list(b".!?")] = 1


@dataclass
class Lines:
    """The lines of some documents, in order."""

    codes: np.ndarray               # lines x N bins
    weight: np.ndarray              # bytes + 1
    first: np.ndarray               # per document, its first line; one entry more than documents


def lines(block: scan.Block) -> Lines:
    data, docs = block.data, block.size
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([block.offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(docs), np.searchsorted(block.offsets, breaks, "right") - 1])
    order = np.lexsort((start, doc))
    start, doc = start[order], doc[order]
    first = np.searchsorted(doc, np.arange(docs + 1))
    end = np.append(start[1:] - 1, 0)
    end[first[1:] - 1] = block.offsets[1:]
    size = end - start

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[end] - total[start]

    w = scan.words(block)
    hasher = scan.Hasher(scan.LOWER[data])
    own = scan.mix64(np.arange(1, docs + 1))
    word = hasher.ranges(w.start, w.end)
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    n = b - a
    # words inside a window that the document holds twice or more
    key, at = scan.windows(word, w.doc, WINDOW)
    at = at[scan.repeated(key ^ own[w.doc[at]])] if len(at) else at
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    # lines equal to an earlier one
    seen = np.ones(len(start), bool)
    seen[np.unique(hasher.ranges(start, end) ^ own[doc], return_index=True)[1]] = False
    # distinct words of each line
    of = np.repeat(np.arange(len(start)), n)
    distinct = np.bincount(of[np.unique(word ^ scan.mix64(of + 1), return_index=True)[1]], minlength=len(start)) if len(word) else 0 * n
    many, long = np.maximum(n, 1), np.maximum(size, 1)
    last = np.where(n > 0, _LAST[data[w.end[np.maximum(b - 1, 0)] - 1]] if len(word) else 0, 0)
    place = 2 * (np.arange(len(start)) == first[doc]) + (np.arange(len(start)) == first[doc + 1] - 1)
    values = {
        "words": n, "word_bytes": (per_line(~scan.SEPARATOR[data])) / many, "symbols": per_line(_SYMBOL[data]) / many,
        "marks": per_line(_MARK[data]) / many, "capitals": per_line(_CAPITAL[data]) / long, "digits": per_line(_DIGIT[data]) / long,
        "last": last, "in_repeats": (covered[b] - covered[a]) / many, "seen_line": seen & (n > 0),
        "same_words": 1 - distinct / many * (n > 0) - (n == 0), "place": place,
    }
    codes = np.column_stack([np.searchsorted(BINS[k], values[k], "left") for k in BINS]).astype(np.uint8)
    return Lines(codes, size + 1.0, first)


def neighbours(x: Lines) -> np.ndarray:
    """lines x 3 x N: the bins of the line above, the line, and the line below."""
    out = np.full((len(x.codes), 3, N), NONE, np.uint8)
    out[:, 1] = x.codes
    out[1:, 0], out[:-1, 2] = x.codes[:-1], x.codes[1:]
    out[x.first[:-1], 0] = NONE
    out[x.first[1:] - 1, 2] = NONE
    return out


def _products(m: np.ndarray, longest: int) -> np.ndarray:
    """Running products m[0] .. m[t], each up to a factor, over at least ``longest`` matrices back."""
    step = 1
    while step < min(longest, len(m)):
        x, y = m[:-step], m[step:]
        new = x[:, :, :1] * y[:, :1, :] + x[:, :, 1:] * y[:, 1:, :]
        m = np.concatenate([m[:step], new / new.max((1, 2), keepdims=True)])
        step *= 2
    return m


@dataclass
class Chain:
    """States: 0 bad, 1 good. ``weights`` (3 x N x K) speak for good; ``calibration``: intercept and slope on the mean's log odds."""

    theta: np.ndarray = field(default_factory=lambda: np.zeros(SIZE))
    calibration: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def infer(self, near: np.ndarray, first: np.ndarray):
        """Steps' matrices, normalised forward and backward vectors, and marginals of good."""
        weights, pair, start = self.theta[:3 * N * K].reshape(3, N, K), self.theta[-6:-2].reshape(2, 2), self.theta[-2:]
        good = np.clip(weights[np.arange(3)[:, None], np.arange(N)[None], near].sum((1, 2)), -30, 30)
        emit = np.exp(np.column_stack([-good / 2, good / 2]))
        step = np.exp(np.clip(pair, -12, 12))[None] * emit[:, None, :]
        heads, tails = first[:-1], first[1:] - 1
        step[heads] = (np.exp(np.clip(start, -12, 12)) * emit[heads])[:, None, :]
        longest = int(np.diff(first).max())
        ahead = _products(step, longest)[:, 0]
        ahead /= ahead.sum(1, keepdims=True)
        back = np.ones_like(step)
        back[:-1] = step[1:]
        back[tails] = 1.0
        # products from the right: of the transposes, in reversed order
        behind = _products(back[::-1].transpose(0, 2, 1), longest)[::-1].transpose(0, 2, 1).sum(2)
        behind /= behind.sum(1, keepdims=True)
        both = ahead * behind
        return good, step, ahead, behind, both[:, 1] / both.sum(1)

    def loss(self, near: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted negative log likelihood of the documents' labels, one for all lines of a document, and its gradient."""
        good, step, ahead, behind, p = self.infer(near, first)
        n = np.diff(first)
        y, w = np.repeat(label, n), np.repeat(weight, n)
        heads = np.zeros(len(y), bool)
        heads[first[:-1]] = True
        inner = np.flatnonzero(~heads)
        norm = np.empty(len(y))
        norm[heads] = step[heads][:, 0].sum(1)
        joint = ahead[inner - 1][:, :, None] * step[inner]
        norm[inner] = joint.sum((1, 2))
        pair, start = np.clip(self.theta[-6:-2], -12, 12).reshape(2, 2), np.clip(self.theta[-2:], -12, 12)
        have = np.where(y == 1, good / 2, -good / 2) + np.where(heads, start[y], pair[y, y])
        grad = np.zeros(SIZE)
        slot = (np.arange(3)[:, None] * N + np.arange(N)[None]) * K + near.astype(np.int64)
        grad[:3 * N * K] = np.bincount(slot.reshape(-1), np.repeat(w * (p - y), 3 * N), 3 * N * K)
        joint *= behind[inner][:, None, :]
        joint *= (w[inner] / joint.sum((1, 2)))[:, None, None]
        same = np.bincount(y[inner], w[inner], 2)
        grad[-6:-2] = (joint.sum(0) - np.diag(same)).reshape(-1)
        grad[-2:] = np.bincount(np.ones(heads.sum(), int), weight * p[heads], 2) - np.bincount(label, weight, 2)
        grad[-2] = (weight * (1 - p[heads])).sum() - weight[label == 0].sum()
        return float((w * (np.log(norm) - have)).sum()), grad

    def quality(self, x: Lines) -> tuple[np.ndarray, np.ndarray]:
        """Per document the length-weighted mean of its lines' marginals; and the marginals."""
        p = self.infer(neighbours(x), x.first)[-1]
        return np.add.reduceat(p * x.weight, x.first[:-1]) / np.add.reduceat(x.weight, x.first[:-1]), p

    def calibrated(self, mean: np.ndarray) -> np.ndarray:
        z = self.calibration[0] + self.calibration[1] * log_odds(mean)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = STEPS, memory: int = 8) -> np.ndarray:
    """L-BFGS with halving steps for a convex function; ``value`` gives (loss, gradient)."""
    f, g = value(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, kept = -g, []
        for s, y in reversed(past):
            a = s @ d / (s @ y)
            kept.append(a)
            d = d - a * y
        if past:
            s, y = past[-1]
            d = d * (s @ y) / (y @ y)
        else:
            d = d / max(1.0, float(np.abs(g).sum()))
        for (s, y), a in zip(past, reversed(kept), strict=True):
            d = d + (a - y @ d / (s @ y)) * s
        size = 1.0
        while True:
            new, new_g = value(x + size * d)
            if new <= f + 1e-4 * size * (g @ d) or size < 1e-4:
                break
            size /= 2
        if new >= f:
            break
        s, y = size * d, new_g - g
        if s @ y > 1e-10:
            past = [*past[-memory + 1:], (s, y)]
        done = f - new < 2e-4 * max(1.0, abs(new))
        x, f, g = x + s, new, new_g
        if done:
            break
    return x


def line_table(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, label, text (one row an id). label, weights (float64) and codes (uint8) of each document's lines."""

    def compute(batch: pa.RecordBatch) -> list:
        codes, weights = [], []
        for b in scan.blocks(batch.column("text"), BLOCK_BYTES):
            x = lines(b)
            for i, j in zip(x.first[:-1], x.first[1:], strict=True):
                codes.append(x.codes[i:j].tobytes())
                weights.append(x.weight[i:j].tobytes())
        return [codes, weights]

    return add_columns(docs, {"codes": "binary", "weights": "binary"}, compute, drop=["text"])


def _read(batch: pa.RecordBatch) -> tuple[Lines, np.ndarray]:
    codes = [np.frombuffer(x, np.uint8).reshape(-1, N) for x in batch.column("codes").to_pylist()]
    weights = np.concatenate([np.frombuffer(x) for x in batch.column("weights").to_pylist()])
    first = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    return Lines(np.concatenate(codes), weights, first), batch.column("label").to_numpy().astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_DOCUMENTS) -> Chain:
    """Learn from at most ``rows`` labelled documents. ``docs``: doc_id, text; ``labels``: doc_id, quality (training rows only)."""
    spark = docs.sparkSession
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    picked = bounded_sample(known, ["doc_id"], rows)
    if len({r.label for r in picked}) < 2:
        return Chain()
    few = F.broadcast(spark.createDataFrame(picked, known.schema))
    # a repeated id would pass the bound: its least text stands for it
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(few, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    table = written(line_table(sample.repartition(FIT_FILES)), "line-bins")

    def gradient(theta: np.ndarray) -> tuple[float, np.ndarray]:
        chain = Chain(theta)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, grad, docs_seen = 0.0, np.zeros(SIZE), 0
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    x, label = _read(whole.slice(at, 512))
                    # a long document counts more than a short one, but less than by its lines
                    one, g = chain.loss(neighbours(x), x.first, label, np.diff(x.first) ** -0.5)
                    total, grad, docs_seen = total + one, grad + g, docs_seen + len(label)
            if docs_seen:
                yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([grad.tobytes()])], ["loss", "gradient"])

        got = table.select("label", "codes", "weights").mapInArrow(add, "loss double, gradient binary").collect()
        f, g = sum(r.loss for r in got), sum((np.frombuffer(r.gradient) for r in got), np.zeros(SIZE))
        return f + RIDGE / 2 * float(theta @ theta), g + RIDGE * theta

    chain = Chain(minimise(gradient, np.zeros(SIZE)))

    def means(batch: pa.RecordBatch) -> list:
        return [chain.quality(_read(batch)[0])[0]]

    # one pair of numbers for each document of the bounded sample
    got = add_columns(table, {"mean": "double"}, means, drop=["codes", "weights"], rows=512).select("label", "mean").collect()
    odds = log_odds(np.array([r["mean"] for r in got]))
    chain.calibration = logistic(np.column_stack([np.ones(len(odds)), odds]), np.array([r.label for r in got], float))
    return chain


def judge(docs: DataFrame, chain: Chain) -> DataFrame:
    """All columns of ``docs`` but its text, with score (document quality, 0 to 1), n_lines and n_bad_lines."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batch: pa.RecordBatch) -> list:
        score, n, bad = [], [], []
        for b in scan.blocks(batch.column("text"), BLOCK_BYTES):
            x = lines(b)
            mean, p = shared.value.quality(x)
            score.append(shared.value.calibrated(mean))
            n.append(np.diff(x.first))
            bad.append(np.add.reduceat((p < 0.5).astype(np.int64), x.first[:-1]))
        return [np.concatenate(c) if c else [] for c in (score, n, bad)]

    return add_columns(docs, {"score": "double", "n_lines": "long", "n_bad_lines": "long"}, run, drop=["text"])
