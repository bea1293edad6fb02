"""Quality rules: statistics of each text, hard rules on some, and isolation forests on all of them.

A forest's trees split the documents at random thresholds of random statistics. A text that few splits isolate is anomalous:
its score is 2 ** (-mean path length / expected path length). The statistics form groups, each with a
forest and a threshold of its own: how a text's characters and words are made up, how much of it repeats its own passages,
and how many of its lines are copies. What is unusual in one group may be usual among good documents in another, and one
threshold for all would hide that. Labelled rows (quality 0 or 1) calibrate the thresholds one after the other, on the rows
that earlier groups keep: the score at which the two error rates' weighted sum is least, clean documents weighing more.

Nothing is sampled. Every document that passes the base rules is dealt to a tree by its hash (few documents to several, so
that a tree has about ``TREE_ROWS``), and all trees grow together, a level a job: executors send each node's count and
ranges, of which there are a bounded number. Every labelled document counts in the thresholds, through counts by score.

Defined results. Null text: no words, and ``base_failed``. Empty text: the same. Very long texts: whole, in blocks
of their own. No usable labels: every threshold is ``DEFAULT_THRESHOLD``. Repeated rows: the same verdict each; in the fit an id
counts once, by its smallest counts. A labelled id with several labels counts as its lowest. Rows with a null id take part like
any other, without a label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import add_columns, small_batches, written

#: Trees of a forest, rows of a tree at least (if there are as many), and levels of one that grows over the whole table.
TREES, TREE_ROWS, LEVELS = 100, 128, 9
#: Scores closer than this are one step of a threshold.
SCORE_STEP = 2.0 ** -16
#: Columns of ``statistics`` that have a forest together.
GROUPS = [[0, 1, 2, 3, 4], [5], [6]]
DEFAULT_THRESHOLD = 0.62
#: How much more a rejected clean document costs than a kept bad one.
CLEAN_COST = 10.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars", "n_lines", "n_distinct", "n_upper", "n_marks"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?.,;:")] = True


def rule_counts(column: pa.Array, repeat_width: int = 8) -> dict[str, np.ndarray]:
    """The counts in COUNTS and EXTRA for every text of an Arrow column."""
    parts: dict[str, list[np.ndarray]] = {k: [] for k in COUNTS + EXTRA}
    for b in scan.blocks(column):
        w = scan.words(b)
        n = np.diff(w.first)
        lead = (b.data & 0xC0) != 0x80
        chars, separators = b.per_doc(lead), b.per_doc(scan.SEPARATOR[b.data])
        hasher = scan.Hasher(b.data)
        h = hasher.ranges(w.start, w.end)
        doc_key = scan.mix64(np.arange(b.size, dtype=np.uint64) + np.uint64(1))
        # words inside windows that the text holds twice or more
        keys, at = scan.windows(h, w.doc, repeat_width)
        twice = at[scan.repeated(keys ^ doc_key[w.doc[at]])]
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, twice, 1)
        np.add.at(step, twice + repeat_width, -1)
        covered = np.cumsum(step[:-1]) > 0
        n_repeat = np.bincount(w.doc[covered], minlength=b.size)
        distinct_keys = np.unique(h ^ doc_key[w.doc], return_index=True)[1]
        n_distinct = np.bincount(w.doc[distinct_keys], minlength=b.size)
        # lines with a word, and how many of them are new
        breaks = np.flatnonzero(b.data == 10)
        start = np.unique(np.concatenate([b.offsets[:-1], breaks + 1]))
        start = start[start < len(b.data)]
        end = np.append(start[1:], len(b.data))[:len(start)]
        end -= b.data[end - 1] == 10
        worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
        start, end = start[worded], end[worded]
        line_doc = np.searchsorted(b.offsets, start, "right") - 1
        line_key = hasher.ranges(start, end) ^ doc_key[line_doc]
        n_lines = np.bincount(line_doc, minlength=b.size)
        new = np.bincount(line_doc[np.unique(line_key, return_index=True)[1]], minlength=b.size)
        for k, v in {"n_words": n, "word_chars": chars - separators, "n_symbols": b.per_doc(_SYMBOL[b.data]),
                     "n_dup_lines": n_lines - new, "n_repeat_words": n_repeat, "n_chars": chars, "n_lines": n_lines,
                     "n_distinct": n_distinct, "n_upper": b.per_doc(_UPPER[b.data]), "n_marks": b.per_doc(_MARK[b.data])}.items():
            parts[k].append(v.astype(np.int64))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in parts.items()}


def statistics(c: dict[str, np.ndarray], prior_words: float = 30.0) -> np.ndarray:
    """Rates that the forest splits on, one row a document.

    ``prior_words`` average words, none of them repeated, are added to each text (and two lines, neither of them a copy), so
    that a short one's rates don't look odd by chance."""
    n, chars = c["n_words"] + prior_words, c["n_chars"] + 6 * prior_words
    return np.column_stack([
        (c["word_chars"] + 5 * prior_words) / n, np.log1p(c["n_symbols"] / n * 100),
        np.log1p((c["n_upper"] + 0.1 * prior_words) / chars * 100), np.log1p((c["n_marks"] + 0.15 * prior_words) / n * 10),
        # distinct words, compared with what a text of this length usually has
        np.log(c["n_distinct"] + prior_words) - 0.87 * np.log(n),
        c["n_repeat_words"] / n, c["n_dup_lines"] / (c["n_lines"] + 2),
    ]).astype(np.float64)


def path_constant(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as flat arrays: per node the statistic, threshold, left child (right is next) and, at leaves, the depth."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    roots: np.ndarray
    rows: int
    threshold: float = DEFAULT_THRESHOLD

    @classmethod
    def fit(cls, x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 1) -> IsolationForest:
        rng = np.random.default_rng(seed)
        feature, cut, child, depth, roots = [], [], [], [], []
        rows = min(tree_rows, len(x))
        limit = int(np.ceil(np.log2(max(rows, 2)))) + 4
        for _ in range(trees if rows > 1 else 0):
            roots.append(len(feature))
            todo = [(x[rng.choice(len(x), rows, replace=False)], 0)]
            place = len(feature)
            for column in (feature, cut, child, depth):
                column.append(0)
            todo = [(todo[0][0], 0, place)]
            while todo:
                part, d, at = todo.pop()
                low, high = part.min(0), part.max(0)
                usable = np.flatnonzero(high > low)
                if len(part) <= 1 or d >= limit or not len(usable):
                    child[at], depth[at] = -1, d + float(path_constant(len(part)))
                    continue
                f = int(rng.choice(usable))
                c = rng.uniform(low[f], high[f])
                goes = part[:, f] < c
                feature[at], cut[at], child[at] = f, c, len(feature)
                for side in (part[goes], part[~goes]):
                    todo.append((side, d + 1, len(feature)))
                    for column in (feature, cut, child, depth):
                        column.append(0)
        return cls(np.array(feature, np.int32), np.array(cut, float), np.array(child, np.int32),
                   np.array(depth, float), np.array(roots, np.int32), rows)

    def leaves(self, x: np.ndarray, row: np.ndarray, tree: np.ndarray) -> np.ndarray:
        """The leaf that each (row of x, tree) pair comes to."""
        at = self.roots[tree]
        todo = np.flatnonzero(self.child[at] >= 0)
        while len(todo):
            node = at[todo]
            at[todo] = self.child[node] + (x[row[todo], self.feature[node]] >= self.cut[node])
            todo = todo[self.child[at[todo]] >= 0]
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1; 0.5 is an average row."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), 0.5)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                inner = self.child[at] >= 0
                if not inner.any():
                    break
                i, node = rows[inner], at[inner]
                at[i] = self.child[node] + (x[i, self.feature[node]] >= self.cut[node])
            total += self.depth[at]
        return 2.0 ** (-total / len(self.roots) / max(float(path_constant(self.rows)), 1e-9))


def calibrate(scores: np.ndarray, good: np.ndarray, clean_cost: float = CLEAN_COST, of: tuple[int, int] | None = None) -> float:
    """The score above which labelled rows are best called anomalous. ``of``: how many good and bad rows make the error
    rates, if these rows are what earlier groups keep of more."""
    if not good.any() or (good.all() and not of):
        return DEFAULT_THRESHOLD
    order = np.argsort(scores)
    s, g = scores[order], good[order].astype(np.int64)
    return _cheapest(s, s, g, 1 - g, clean_cost, of)


def _cheapest(low: np.ndarray, high: np.ndarray, good: np.ndarray, bad: np.ndarray, clean_cost: float, of: tuple[int, int] | None) -> float:
    """The threshold of ascending steps of scores, each from ``low`` to ``high`` with so many good and bad rows."""
    n_good, n_bad = of or (int(good.sum()), int(bad.sum()))
    # rejecting everything from position i on
    lost = np.append(np.cumsum(good[::-1])[::-1], 0) / n_good
    missed = np.append(0, np.cumsum(bad)) / n_bad
    cost = clean_cost * lost + missed
    cost[1:-1][low[1:] == high[:-1]] = np.inf
    i = int(np.argmin(cost))
    return float(low[0] if i == 0 else high[-1] + 1e-9 if i == len(low) else (high[i - 1] + low[i]) / 2)


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


@dataclass
class Forests:
    """One forest for each group of statistics."""

    parts: list[tuple[list[int], IsolationForest]]

    def excess(self, x: np.ndarray) -> np.ndarray:
        """How far the most anomalous group's score is above its threshold; kept texts have none above 0."""
        return np.max([f.score(x[:, columns]) - f.threshold for columns, f in self.parts], axis=0)


def fit(docs: DataFrame, labels: DataFrame) -> Forests:
    """Trees from every document that passes the base rules, thresholds from every labelled one of them."""
    names = COUNTS + EXTRA

    def count(batch: pa.RecordBatch) -> list:
        c = rule_counts(batch.column("text"))
        return [c[k] for k in names]

    counted = add_columns(docs.select("doc_id", "text"), dict.fromkeys(names, "long"), count, drop=["text"])
    # a repeated id's smallest counts stand for it; without an id, rows are told apart by their counts
    other = F.when(F.col("doc_id").isNull(), F.xxhash64(*names)).alias("__other")
    each = counted.groupBy("doc_id", other).agg(F.min(F.struct(*names)).alias("c")).select("doc_id", "c.*")
    passing = each.where("n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words")
    rows = written(passing.withColumn("__key", F.xxhash64(F.lit(11), "doc_id", *names)), "quality-counts")
    forests = grow(rows)
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    scores = [f"s{i}" for i in range(len(GROUPS))]

    def judge(batch: pa.RecordBatch) -> list:
        x = statistics(_counts(batch))
        return [f.score(x[:, columns]) for columns, f in forests.parts]

    kept = written(add_columns(rows.drop("__key").join(known, "doc_id"), dict.fromkeys(scores, "double"), judge, drop=names), "quality-scores")
    of = None
    for name, (_, forest) in zip(scores, forests.parts, strict=True):
        good = (F.col("quality") == 1).cast("long")
        steps = kept.groupBy(F.floor(F.col(name) / SCORE_STEP).alias("step")).agg(
            F.min(name).alias("low"), F.max(name).alias("high"), F.sum(good).alias("good"), F.sum(1 - good).alias("bad")).orderBy("step").toArrow()
        low, high, n_good, n_bad = (steps.column(c).to_numpy() for c in ("low", "high", "good", "bad"))
        if of is None:
            of = int(n_good.sum()), int(n_bad.sum())
        if n_good.any() and all(of):
            forest.threshold = _cheapest(low, high, n_good, n_bad, CLEAN_COST, of)
        kept = kept.where(F.col(name) <= F.lit(forest.threshold))
    return forests


def _counts(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {k: batch.column(k).to_numpy() for k in COUNTS + EXTRA}


def _members(key: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, tree) pairs: each row is in the tree that its hash names, and in every other with such a probability that a tree
    has ``share`` of the rows."""
    home = (key % np.uint64(TREES)).astype(np.int64)
    more = (share - 1 / TREES) / (1 - 1 / TREES)
    if more <= 0:
        return np.arange(len(key)), home
    draw = scan.mix64(key[:, None] ^ scan.mix64(np.arange(1, TREES + 1, dtype=np.uint64))[None, :]).astype(float) / 2.0 ** 64
    taken = draw < more
    taken[np.arange(len(key)), home] = True
    return np.nonzero(taken)


def grow(rows: DataFrame) -> Forests:
    """A forest for each group of statistics, from all rows (counts, and a hash as ``__key``; give them stored). A job a
    level: it sends the size and the ranges of every open node, at most TREES * 2 ** level a forest."""
    small_batches(rows.sparkSession)
    n = rows.count()
    share = min(1.0, max(TREE_ROWS / max(n, 1), 1 / TREES))
    trees = TREES if n > 1 else 0
    # nodes of a forest as lists; a node whose depth is -1 is open
    nodes = [{"feature": [0] * trees, "cut": [0.0] * trees, "child": [-1] * trees, "depth": [-1.0] * trees} for _ in GROUPS]
    wide = max(map(len, GROUPS))
    ends = [f"{e}{i}" for e in ("low", "high") for i in range(wide)]
    schema = ", ".join(["forest int, node int, n long", *(f"{e} double" for e in ends)])

    def built() -> Forests:
        return Forests([(columns, IsolationForest(
            np.array(t["feature"], np.int32), np.array(t["cut"], float), np.array(t["child"], np.int32), np.array(t["depth"], float),
            np.arange(trees, dtype=np.int64), max(2, round(n * share)))) for columns, t in zip(GROUPS, nodes, strict=True)])

    rng = np.random.default_rng(1)
    for level in range(LEVELS + 1 if trees else 0):
        forests = built()

        def measure(batches):
            for batch in batches:
                x = statistics(_counts(batch))
                row, tree = _members(batch.column("__key").to_numpy().view(np.uint64), share)
                for g, (columns, f) in enumerate(forests.parts):
                    mine = x[:, columns]
                    at = f.leaves(mine, row, tree)
                    here = f.depth[at] < 0
                    order = np.argsort(at[here], kind="stable")
                    node, first = np.unique(at[here][order], return_index=True)
                    if not len(node):
                        continue
                    part = mine[row[here][order]]
                    got = [np.minimum.reduceat(part, first), np.maximum.reduceat(part, first)]
                    cells = [np.hstack([e, np.zeros((len(node), wide - len(columns)))]).T for e in got]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(node), g, np.int32)), pa.array(node.astype(np.int32)), pa.array(np.diff(np.append(first, len(part)))),
                         *(pa.array(np.ascontiguousarray(c)) for e in cells for c in e)], ["forest", "node", "n", *ends])

        found = rows.mapInArrow(measure, schema).groupBy("forest", "node").agg(
            F.sum("n").alias("n"), *[(F.min if e.startswith("low") else F.max)(e).alias(e) for e in ends]).orderBy("forest", "node").toArrow()
        which, node, size = (found.column(c).to_numpy() for c in ("forest", "node", "n"))
        low, high = (np.column_stack([found.column(f"{e}{i}").to_numpy() for i in range(wide)]) for e in ("low", "high"))
        rest = path_constant(size)
        for t in nodes:
            # a side of a split that no row reached has no more path; the others follow
            t["depth"] = [float(level) if d < 0 else d for d in t["depth"]]
        for i in range(len(node)):
            t, at = nodes[which[i]], int(node[i])
            usable = np.flatnonzero(high[i] > low[i])
            if size[i] <= 1 or level == LEVELS or not len(usable):
                t["depth"][at] = level + float(rest[i])
                continue
            f = int(rng.choice(usable))
            t["feature"][at], t["cut"][at], t["child"][at] = f, rng.uniform(low[i, f], high[i, f]), len(t["child"])
            for k, v in (("feature", 0), ("cut", 0.0), ("child", -1), ("depth", -1.0)):
                t[k] += [v, v]
        if all(d >= 0 for t in nodes for d in t["depth"]):
            break
    return built()


def score(docs: DataFrame, forests: Forests) -> DataFrame:
    """Adds the counts, base_failed, anomaly (``Forests.excess``) and kept to all columns of ``docs`` (own columns of these names
    give way)."""
    added = {**dict.fromkeys(COUNTS, "long"), "base_failed": "boolean", "anomaly": "double", "kept": "boolean"}

    def judge(batch: pa.RecordBatch) -> list:
        c = rule_counts(batch.column("text"))
        bad, a = base_failed(c), forests.excess(statistics(c))
        return [*(c[k] for k in COUNTS), bad, a, ~bad & (a <= 0)]

    return add_columns(docs, added, judge)
