"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are read as classes (insult, threat verb, modal, target, negation, reporting verb, quotation mark, other). Five
transducers read the class string of a clause side by side: negation and reported speech rescale what stands in their
scope, target raises an insult or completes a threat near a person, insult and threat emit weights. Their composition is one
machine over tuples of states, built once. A clause weighs what the machine emits; a text is judged by its clauses.

Insults' weights are learned: words of labelled texts whose log odds of a toxic text are high, next to a small fixed list. A
logistic model over clause weights turns them into a score. Both are fitted on at most FIT_DOCUMENTS labelled rows by
hash order (a documented bound); clauses are found by an Aho-Corasick automaton over the lexicon, so that text without any
lexicon word is only skimmed.

Defined results. Null and empty texts: the score of a text without a matched clause. Texts are whole, of any length. No
usable labels: the fixed list and ``DEFAULT_MODEL``. An id with several labels counts as toxic if one says so. A null id
counts as the empty text in the fold's checksum. Repeated rows: the same score each. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import add_columns, bounded_sample

FIT_DOCUMENTS = 16_000
#: At most so many learned words, by log odds; each in at least LEAST_TEXTS toxic training texts.
LEARNED_WORDS, LEAST_TEXTS, LEAST_ODDS = 5000, 4, 2.5
#: Word beginnings of these lengths are learned like words (written with a star), with a higher bar.
STEMS, STEM_ODDS = (4, 5, 6), 4.0
DEFAULT_MODEL = np.array([-2.5, 1.2, 0.6, 0.4])

# fixed word lists
INSULTS = "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb imbecile vermin filth".split()
THREATS = "kill hurt beat destroy shoot stab crush strangle murder".split()
MODALS = "will gonna shall should must i'll we'll werde wirst vais voy".split()
TARGETS = "you your you're u he she they him her them his this these those people everyone du dich dein ihr euch er sie tu te toi vous il elle ils usted tú él ella ellos ustedes".split()
NEGATIONS = "not never no isn't aren't wasn't don't nobody nicht kein keine nie ne pas jamais nunca ni".split()
REPORTS = "said says wrote writes claimed claims called reported reports quoted quote sagte sagt schrieb dit écrit dijo dice escribió".split()

INSULT, THREAT, MODAL, TARGET, NEGATION, REPORT, QUOTE, OTHER = "itmynrqo"
CLASSES = INSULT + THREAT + MODAL + TARGET + NEGATION + REPORT + QUOTE + OTHER
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”„«»]")
_CLAUSE_END = re.compile(r"[.!?;\n]")
_ENDS = ".!?;\n"


@dataclass(frozen=True)
class Transducer:
    """``step(state, word class) -> (next state, emitted)``: emitted is a factor for scopes, a weight for patterns."""

    start: int
    step: Callable[[int, str], tuple[int, float]]


def _within(opens: str, reach: int, factor: float) -> Transducer:
    """Factor for the ``reach`` words after a word of the class; the state counts down."""
    return Transducer(0, lambda s, c: (reach, 1.0) if c == opens else (max(s - 1, 0), factor if s else 1.0))


#: A negated insult is milder, and so is one that the clause reports or quotes.
NEGATED = _within(NEGATION, 3, 0.4)
REPORTED = Transducer(0, lambda s, c: (1 if c == REPORT else 2 if c == QUOTE and s != 2 else 0 if c == QUOTE else s, 0.5 if s else 1.0))
#: A person within four words raises an insult.
TARGETED = _within(TARGET, 4, 1.3)
#: Emits 1 for an insult; the lexicon's weight multiplies it.
INSULTING = Transducer(0, lambda s, c: (0, 1.0 if c == INSULT else 0.0))
#: modal, threat verb, target in this order with at most two other words between: emitted at the target.
_THREAT_STEPS = {(0, MODAL): 1, (1, MODAL): 1, (2, MODAL): 1, (3, MODAL): 1, (1, THREAT): 4, (2, THREAT): 4, (3, THREAT): 4}


def _threat(s: int, c: str) -> tuple[int, float]:
    if s >= 4 and c == TARGET:
        return 0, 3.0
    if (s, c) in _THREAT_STEPS:
        return _THREAT_STEPS[s, c], 0.0
    return (s + 1 if s in (1, 2, 4, 5) else 0), 0.0


THREATENING = Transducer(0, _threat)


def compose(scopes: list[Transducer], patterns: list[Transducer]) -> dict[tuple[int, str], tuple[int, tuple[float, ...]]]:
    """One machine: numbered tuples of states; emits each pattern's weight times all scopes' factors."""
    parts = [*scopes, *patterns]
    first = tuple(t.start for t in parts)
    number, todo, table = {first: 0}, [first], {}
    while todo:
        state = todo.pop()
        for c in CLASSES:
            moved = [t.step(s, c) for t, s in zip(parts, state, strict=True)]
            then = tuple(m[0] for m in moved)
            if then not in number:
                number[then] = len(number)
                todo.append(then)
            factor = float(np.prod([m[1] for m in moved[:len(scopes)]]))
            table[number[state], c] = number[then], tuple(m[1] * factor for m in moved[len(scopes):])
    return table


MACHINE = compose([NEGATED, REPORTED, TARGETED], [INSULTING, THREATENING])


@dataclass
class Grammar:
    """Insult words with weights, the composed machine and the logistic model over a text's clauses."""

    weights: dict[str, float]
    model: np.ndarray = field(default_factory=lambda: DEFAULT_MODEL.copy())

    def __post_init__(self):
        self.classes = {w: c for words, c in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (MODALS, MODAL), (THREATS, THREAT))
                        for w in words} | dict.fromkeys(self.weights, INSULT)
        self.finder = ahocorasick.Automaton()
        for w in [*self.weights, *THREATS]:
            # a stem ends anywhere in a word; where a word and a stem are spelt alike, the stem covers both
            stem = w.endswith("*") or w + "*" in self.weights
            w = w.rstrip("*")
            self.finder.add_word(w, (len(w), stem))
        self.finder.make_automaton()

    def __reduce__(self):
        return Grammar, (self.weights, self.model)

    def clause(self, text: str) -> float:
        """Weight of one lower-cased clause."""
        state, total = 0, 0.0
        for word in _WORD.findall(text):
            c = QUOTE if word in "\"“”„«»" else self.classes.get(word)
            key = word
            if c is None:
                key = next((k for n in reversed(STEMS) if (k := word[:n] + "*") in self.weights), None)
                c = INSULT if key else OTHER
            state, (insult, threat) = MACHINE[state, c]
            if insult:
                total += insult * self.weights[key]
            total += threat
        return total

    def clauses(self, text: str) -> list[float]:
        """Weights of the matched clauses of a text."""
        text, out, done = text.lower(), [], 0
        for last, (size, stem) in self.finder.iter(text):
            at = last - size + 1
            if at < done or (at and text[at - 1].isalpha()) or (not stem and text[last + 1:last + 2].isalpha()):
                continue
            begin = max(done, max(text.rfind(c, done, at) for c in _ENDS) + 1)
            m = _CLAUSE_END.search(text, last + 1)
            done = m.end() if m else len(text)
            if (weight := self.clause(text[begin:done])) > 0:
                out.append(weight)
        return out

    def features(self, texts: list[str | None]) -> np.ndarray:
        found = [self.clauses(t) if t else [] for t in texts]
        return np.array([[1.0, max(f, default=0.0), np.log1p(sum(f)), np.log1p(len(f))] for f in found]).reshape(-1, 4)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.model, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_DOCUMENTS) -> Grammar:
    """Learn from at most ``rows`` labelled documents. ``labels``: doc_id, toxic (training rows only)."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = bounded_sample(known, ["doc_id"], rows)
    fixed = {w: 2.0 for w in INSULTS}
    if not picked or len({r.toxic for r in picked}) < 2:
        return Grammar(fixed)
    few = docs.sparkSession.createDataFrame(picked, known.schema)
    sample = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    size = {0: sum(r.toxic == 0 for r in picked), 1: sum(r.toxic == 1 for r in picked)}

    def words(batches):
        for b in batches:
            pairs = []
            for text, t in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                found = set(_WORD.findall((text or "").lower()))
                pairs += [(w, t) for w in found | {w[:n] + "*" for w in found for n in STEMS if len(w) > n}]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.int32())], ["word", "toxic"])

    seen = sample.mapInArrow(words, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (size[1] + 1.0)) - F.log((F.col("good") + 0.5) / (size[0] + 1.0))
    learned = (seen.where(F.col("bad") >= LEAST_TEXTS).withColumn("odds", odds)
               .where(F.col("odds") >= F.when(F.col("word").endswith("*"), STEM_ODDS).otherwise(LEAST_ODDS))
               .orderBy(F.desc("odds"), "word").limit(LEARNED_WORDS).collect())
    other = {*THREATS, *MODALS, *TARGETS, *NEGATIONS, *REPORTS}
    grammar = Grammar(fixed | {r.word: r.odds / 2 for r in learned if r.word[0].isalpha() and r.word not in other})

    def measure(batch: pa.RecordBatch) -> list:
        f = grammar.features(batch.column("text").to_pylist())
        return [f[:, 1], f[:, 2], f[:, 3]]

    got = add_columns(sample, {"a": "double", "b": "double", "c": "double"}, measure, drop=["text"])
    # a repeated id would pass the bound: its highest values stand for it
    got = got.groupBy("doc_id", "toxic").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.max("c").alias("c")).orderBy("doc_id").collect()
    x = np.array([[1.0, r.a, r.b, r.c] for r in got])
    y = np.array([r.toxic for r in got], float)
    if 0 < y.sum() < len(y):
        grammar.model = logistic(x, y)
    return grammar


def judge(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """All columns of ``docs`` but its text, with score and n_clauses (matched ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batch: pa.RecordBatch) -> list:
        f = shared.value.features(batch.column("text").to_pylist())
        return [shared.value.score(f), np.rint(np.expm1(f[:, 3])).astype(np.int64)]

    return add_columns(docs, {"score": "double", "n_clauses": "long"}, run, drop=["text"])
