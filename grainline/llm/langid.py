"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; whatever is no letter counts as a blank. Character n-grams of one to three code points are hashed
to BUCKETS. The model is a matrix of log probabilities (BUCKETS x languages, of fixed size per language) with log priors,
broadcast to the executors; a text is a sparse vector of bucket counts, scored by one product with its own rows of the matrix.

The fit learns from about FIT_DOCUMENTS documents of each language, picked by hash (a documented bound); priors come from
all training rows.

Defined results. Null text, or one without a letter: ``und``, score 0. Texts are whole, of any length. No training rows at
all: every text is ``und``. Ties go to the language that is first by code point. A null id counts as the empty text in the
fold's checksum. Repeated rows: the same answer each. Empty table: no rows. Own columns named like results give way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import add_columns

BUCKETS = 1 << 15
ORDERS = 3
#: About so many documents of each language are learned from.
FIT_DOCUMENTS = 4000
SMOOTHING = 0.5
#: Texts in one product.
CHUNK_TEXTS = 256
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def fold(of: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(of.cast("string"), F.lit(""))) % folds


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> np.ndarray | None:
    """Buckets of all n-grams of a text; None if it has no letter."""
    if not text:
        return None
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[c]
    if not letter.any():
        return None
    c = np.concatenate([[32], np.where(letter, c, 32), [32]]).astype(np.uint32)
    # runs of blanks are one blank
    c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
    out, h = [], np.zeros(len(c), np.uint32)
    for n in range(ORDERS):
        h = (h[:len(c) - n] if n == 0 else h[:-1]) * np.uint32(0x01000193) + c[n:] + np.uint32(n + 1)
        out.append(((h * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64))
    return np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray   # BUCKETS x languages
    prior: np.ndarray

    def predict_batch(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its probability for each text: one product of the sparse counts of all texts with the matrix."""
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for at in range(0, len(texts) if self.languages else 0, CHUNK_TEXTS):
            found = [grams(t) for t in texts[at:at + CHUNK_TEXTS]]
            there = [i for i, g in enumerate(found) if g is not None]
            if not there:
                continue
            # sparse counts as one run: (text, bucket) in order, with their number
            place = np.repeat(np.arange(len(there), dtype=np.uint32), [len(found[i]) for i in there]) * np.uint32(BUCKETS)
            key = np.sort(place + np.concatenate([found[i] for i in there]).astype(np.uint32))
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            count, key = np.diff(np.append(first, len(key))), key[first]
            row = np.searchsorted(key, np.arange(len(there), dtype=np.uint32) * np.uint32(BUCKETS))
            bucket = key & np.uint32(BUCKETS - 1)
            total = np.column_stack([np.add.reduceat(self.log_probability[bucket, k] * count, row) for k in range(len(self.languages))]) + self.prior
            best = total.argmax(1)
            share = 1 / np.exp(total - total[np.arange(len(there)), best][:, None]).sum(1)
            for i, k, p in zip(there, best.tolist(), share.tolist(), strict=True):
                names[at + i], score[at + i] = self.languages[k], p
        return names, score

    def predict(self, text: str | None) -> tuple[str, float]:
        names, score = self.predict_batch([text])
        return names[0], float(score[0])


def fit(train: DataFrame, documents: int = FIT_DOCUMENTS) -> Model:
    """``train``: doc_id, text, lang."""
    rows = train.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, documents / sizes[k]))])
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1_000_003)) / 1_000_003
    rows = rows.select("text", "lang").where(place < share[F.col("lang")]).repartition(8)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                if (found := grams(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + np.bincount(found, minlength=BUCKETS)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.astype(np.int64).tobytes() for x in sums.values()])], ["lang", "counts"])

    # eight tasks at most, one count vector of fixed size a language each
    total = np.full((BUCKETS, len(languages)), SMOOTHING)
    for r in rows.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        total[:, languages.index(r.lang)] += np.frombuffer(r.counts, np.int64)
    prior = np.log(np.array([sizes[k] for k in languages], float) / sum(sizes.values()))
    return Model(languages, np.log(total / total.sum(0)).astype(np.float32), prior)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but its text, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def guess(batch: pa.RecordBatch) -> list:
        return list(shared.value.predict_batch(batch.column("text").to_pylist()))

    return add_columns(docs, {"lang_pred": "string", "score": "double"}, guess, drop=["text"])
