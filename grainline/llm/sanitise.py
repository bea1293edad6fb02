"""Personal data: patterns for direct identifiers, and information-theoretic sanitisation of the terms around them.

Direct identifiers (email, ip, card, phone) are found by pattern and check rules; they are the protected entities. A term
near an entity may reveal it as well (a name that always stands by one address). Corpus co-occurrence estimates how much,
over the occurrences of terms: with N positions in the corpus, n(t) of them holding the term, n(e) standing near the entity
(among the CONTEXT_TERMS terms on either side of it, on whatever lines) and n(t,e) doing both,

    disclosure(t, e) = PMI(t; e) / IC(e) = log2(N n(t,e) / (n(t) n(e))) / log2(N / n(e)).

1 means that the term stands nowhere else. A term that reaches DISCLOSURE for some entity is marked wherever it occurs in the
corpus, near the entity or not: one of at least MOST_DISCLOSURE is removed, others are generalised. There is nothing to learn
from one passage that is copied around. So an entity needs SUPPORT different contexts, and so does a term beside it; and an
entity gives no estimate if the terms that stand in over half of its different contexts are those of a passage copied with
small changes: PASSAGE_TERMS of them, or so many that they make up COPIED of the contexts. A name and a few words that always
stand by an address are fewer.

Scale: the first pass writes only what stands near entities. n(t) is at least the number of t's occurrences near any entity,
which these rows tell; a term that cannot reach DISCLOSURE even so is no candidate, which rules out the corpus's common words.
Candidate terms go to the corpus as one automaton if there are at most FEW_TERMS, beyond that as a Bloom filter whose size
follows their number up to a fixed bound; counting n(t) sends one row a task and candidate. So do the terms to mark. The exact
joins afterwards drop the filter's errors.

Defined results. Null and empty texts: no spans, counts 0, the digest of the empty string; sanitised text stays as it is.
Repeated rows: the same spans each. Very long texts are whole, on one line or many; work is linear in their length. Empty
table: no rows. Own columns named like results, or like the working columns __id, __hash, __more and __text, give way.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import add_columns, row_key, written

KINDS = ["email", "ip", "card", "phone"]
CONTEXT_TERMS = 12
SUPPORT, PASSAGE_TERMS, COPIED = 3, 8, 0.8
DISCLOSURE, MOST_DISCLOSURE = 0.8, 0.95
#: Bits of a Bloom filter: so many a term, between these bounds (16 MB at most).
TERM_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
#: Terms that are broadcast as they are.
FEW_TERMS = 50_000

# patterns fixed by the contract
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern finds them. A match can only begin where the run of local characters before an @ begins."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every direct identifier, by kind, then start; in code points, end exclusive."""
    out = [("email", *s) for s in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def render(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _last_terms(text: str, begin: int, end: int) -> list[tuple[int, int]]:
    """The last CONTEXT_TERMS terms of a stretch, looked for from its end."""
    reach = 256
    while True:
        at = max(begin, end - reach)
        found = [m.span() for m in _TERM.finditer(text, at, end)]
        if at == begin:
            return found[-CONTEXT_TERMS:]
        if len(found) > CONTEXT_TERMS:                      # the first one may be cut
            return found[-CONTEXT_TERMS:]
        reach *= 4


def contexts(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[dict], list[str]]:
    """Per span: its value, the hash of its context (the CONTEXT_TERMS terms on either side of it outside of all spans), and
    those of these terms that stand near no earlier span of that value. And the terms near any span, each occurrence once."""
    blocks: list[list[int]] = []                            # stretches covered by spans
    for _, s, e in sorted(spans, key=lambda x: x[1:]):
        if blocks and s <= blocks[-1][1]:
            blocks[-1][1] = max(blocks[-1][1], e)
        else:
            blocks.append([s, e])
    edges = [0, *(x for b in blocks for x in b), len(text)]
    gaps = list(zip(edges[::2], edges[1::2], strict=True))
    before, after = [], []
    near: deque = deque(maxlen=CONTEXT_TERMS)
    for gap in gaps[:-1]:
        near.extend(_last_terms(text, *gap))
        before.append(list(near))
    near = deque(maxlen=CONTEXT_TERMS)
    for begin, end in reversed(gaps[1:]):
        first = []
        for m in _TERM.finditer(text, begin, end):
            first.append(m.span())
            if len(first) == CONTEXT_TERMS:
                break
        near.extendleft(reversed(first))
        after.append(list(near))
    after.reverse()
    starts, out, seen, every = [b[0] for b in blocks], [], {}, {}
    for kind, s, e in spans:
        i = bisect_right(starts, s) - 1
        value = f"{kind}:{text[s:e].lower()}"
        terms = [(text[a:b].lower(), a, b) for a, b in before[i] + after[i]]
        known = seen.setdefault(value, set())
        out.append({"value": value, "context": _hash("\n".join(t for t, _, _ in terms)),
                    "terms": [t for t, a, _ in terms if a not in known]})
        known.update(a for _, a, _ in terms)
        every.update((a, t) for t, a, _ in terms)
    return out, list(every.values())


_NEAR = "array<struct<value:string,context:bigint,terms:array<string>>>"
_NEAR_ARROW = pa.list_(pa.struct([("value", pa.string()), ("context", pa.int64()), ("terms", pa.list_(pa.string()))]))


def _look(batch: pa.RecordBatch) -> list:
    counts, digest, spans, places, near, around = [[] for _ in KINDS], [], [], [], [], []
    for text in batch.column("text").to_pylist():
        found = base_spans(text or "")
        n = Counter(k for k, _, _ in found)
        for c, k in zip(counts, KINDS, strict=True):
            c.append(n[k])
        spans.append(render(found))
        digest.append(hashlib.sha256(spans[-1].encode()).hexdigest())
        places.append(positions(text))
        mine, terms = contexts(text, found) if found else ([], [])
        near.append(mine)
        around.append(terms)
    return [*counts, digest, spans, places, pa.array(near, _NEAR_ARROW), pa.array(around, pa.list_(pa.string()))]


def bare(text: str | None) -> str:
    """The text with its emails blanked, the only identifiers that hold letters: what is left are its terms."""
    spans = _emails(text) if text and "@" in text else []
    edges = [0, *(x for s in spans for x in s), len(text or "")]
    parts = [text[a:b] if i % 2 == 0 else " " * (b - a) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))] if spans else [text or ""]
    return "".join(parts)


def positions(text: str | None) -> int:
    """A text's part of N: its blanks and line breaks, and one."""
    return text.count(" ") + text.count("\n") + 1 if text else 0


def find(docs: DataFrame) -> DataFrame:
    """doc_id and, per row: n_email, n_ip, n_card, n_phone, base_sha256, spans (base and terms), n_terms."""
    rows, told = _findings(docs.select("doc_id", "text"))
    columns = [f"n_{k}" for k in KINDS]
    if told is None:
        return rows.select("doc_id", *columns, "base_sha256", "spans", F.lit(0).cast("long").alias("n_terms"))
    spans = F.concat_ws(",", F.when(F.col("spans") != "", F.col("spans")), F.array_join(F.transform("__more", lambda m: F.concat_ws(":", F.lit("term"), m["from"], m["to"])), ","))
    return (rows.join(occurrences(docs, told), ["__id", "__hash"], "left")
            .select("doc_id", *columns, "base_sha256", F.when(F.col("__more").isNull(), F.col("spans")).otherwise(spans).alias("spans"),
                    F.when(F.col("__more").isNull(), 0).otherwise(F.size("__more")).cast("long").alias("n_terms")))


def _findings(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The written findings of every row, with its key; and term, disclosure of the disclosing terms (None if there are none)."""
    added = {**{f"n_{k}": "long" for k in KINDS}, "base_sha256": "string", "spans": "string", "positions": "long", "near": _NEAR, "around": "array<string>"}
    rows = written(add_columns(docs.select("doc_id", *row_key(docs), "text"), added, _look, drop=["text"]), "findings")
    near = rows.where(F.size("near") > 0).select(F.explode("near").alias("x")).select("x.*")
    entity = (near.groupBy("value").agg(F.count_distinct("context").alias("contexts"), F.sum(F.size("terms")).alias("n_value"))
              .where(F.col("contexts") >= SUPPORT))
    both = (near.select("value", "context", F.explode("terms").alias("term")).groupBy("value", "term")
            .agg(F.count("*").alias("n_both"), F.count_distinct("context").alias("with_term")))
    both = written(both.join(entity, "value"), "joint")
    constant = F.col("with_term") * 2 > F.col("contexts")
    copied = (both.groupBy("value").agg(F.count(F.when(constant, 1)).alias("constant"), F.sum(F.when(constant, F.col("with_term"))).alias("inside"),
                                        F.sum("with_term").alias("all")).where((F.col("constant") >= PASSAGE_TERMS) | (F.col("inside") >= COPIED * F.col("all"))))
    both = both.where(F.col("with_term") >= SUPPORT)
    total = F.lit(float(max(1, rows.agg(F.sum("positions")).first()[0] or 1)))

    def disclosure(n_term):
        pmi = F.log2(total * F.col("n_both") / (n_term * F.col("n_value")))
        return pmi / F.greatest(F.log2(total / F.col("n_value")), F.lit(1e-9))

    least = rows.where(F.size("around") > 0).select(F.explode("around").alias("term")).groupBy("term").agg(F.count("*").alias("n_least"))
    joint = both.join(copied, "value", "left_anti").join(least, "term").where(disclosure(F.col("n_least")) >= DISCLOSURE)
    joint = written(joint.select("value", "term", "n_both", "n_value"), "candidates")
    n_term = term_counts(docs, joint.select("term").distinct())
    if n_term is None:
        return rows, None
    told = (joint.join(n_term, "term").select("term", disclosure(F.col("n_term")).alias("disclosure"))
            .groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= DISCLOSURE))
    told = written(told, "told")
    return rows, None if told.isEmpty() else told


class TermFilter:
    """A Bloom filter of terms."""

    def __init__(self, bits: int):
        self.bits = bits
        self.flags = np.zeros(bits, bool)

    def slots(self, term: str) -> list[int]:
        h = xxhash.xxh3_128_intdigest(term)
        return [h % self.bits, (h >> 32) % self.bits, (h >> 64) % self.bits, (h >> 96) % self.bits]

    def __contains__(self, term: str) -> bool:
        flags = self.flags
        return all(flags[s] for s in self.slots(term))

    @classmethod
    def of(cls, terms: DataFrame, n: int) -> bytes:
        """Packed filter of a column of ``n`` terms."""
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (TERM_BITS * n - 1).bit_length()))

        def build(batches):
            mine = cls(bits)
            for b in batches:
                for term in b.column("term").to_pylist():
                    mine.flags[mine.slots(term)] = True
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(mine.flags).tobytes()])], ["bits"])

        # a few filters of a bounded size, however many terms there are
        out = np.zeros(bits // 8, np.uint8)
        for m in terms.select("term").coalesce(16).mapInArrow(build, "bits binary").toLocalIterator():
            out |= np.frombuffer(m.bits, np.uint8)
        return out.tobytes()

    @classmethod
    def unpack(cls, packed: bytes) -> TermFilter:
        out = cls(8)
        out.flags = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        out.bits = len(out.flags)
        return out


class Finder:
    """Where some terms occur in texts, whole and in any case: by an automaton of them, or by a filter (which may err)."""

    def __init__(self, packed: bytes | list[str]):
        self.filter = TermFilter.unpack(packed) if isinstance(packed, bytes) else frozenset(packed)
        self.known: dict[str, bool] = {}
        self.automaton = None
        if not isinstance(packed, bytes):
            self.automaton = ahocorasick.Automaton()
            for term in packed:
                self.automaton.add_word(term, term)
            self.automaton.make_automaton()

    @classmethod
    def packed(cls, terms: DataFrame) -> bytes | list[str] | None:
        """What makes a finder of a column of different terms: of a bounded size. None without terms."""
        few = [r.term for r in terms.select("term").limit(FEW_TERMS + 1).collect()]
        return None if not few else sorted(few) if len(few) <= FEW_TERMS else TermFilter.of(terms, terms.count())

    def _may(self, term: str) -> bool:
        hit = self.known.get(term)
        if hit is None:
            if len(self.known) > 300_000:
                self.known.clear()
            hit = self.known[term] = term in self.filter
        return hit

    def spans(self, text: str | None) -> Iterator[tuple[str, int, int]]:
        """(term, start, end) of the terms of a text outside of emails."""
        text = bare(text)
        # lower case may move places (a dotted capital I) or depend on what follows (a capital sigma)
        low = text.lower() if self.automaton and "\u03a3" not in text else ""
        if not self.automaton or len(low) != len(text):
            for m in _TERM.finditer(text):
                if self._may(term := m.group().lower()):
                    yield term, *m.span()
            return
        for last, term in self.automaton.iter(low):
            start, end = last + 1 - len(term), last + 1
            if not (start and _letter(low[start - 1]) or end < len(low) and _letter(low[end])):
                yield term, start, end


def _letter(c: str) -> bool:
    """As a term's characters."""
    return c.isalnum() and not c.isdecimal()


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame | None:
    """term, n_term: how often each of ``terms`` (a column ``term``) occurs in the corpus; None if there are none."""
    packed = Finder.packed(terms)
    if packed is None:
        return None
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def count(batches):
        finder, found = Finder(shared.value), Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"])
        for b in batches:
            for text in b.column("text").to_pylist():
                found.update(t for t, _, _ in finder.spans(text))
                if len(found) > 200_000:
                    yield flush()
                    found.clear()
        yield flush()

    counted = docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    return counted.join(terms, "term", "left_semi")


def occurrences(docs: DataFrame, told: DataFrame) -> DataFrame:
    """__id, __hash, __more: where the terms of ``told`` (term, disclosure) occur, of every row that holds one."""
    packed = Finder.packed(told)
    if packed is None:
        return told.sparkSession.createDataFrame([], "__id long, __hash long, __more array<struct<from:int,to:int,disclosure:double>>")
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    kind = pa.list_(pa.struct([("term", pa.string()), ("from", pa.int32()), ("to", pa.int32())]))
    made: list[Finder] = []                                 # one a task

    def look(batch: pa.RecordBatch) -> list:
        if not made:
            made.append(Finder(shared.value))
        return [pa.array([[{"term": t, "from": s, "to": e} for t, s, e in made[0].spans(text)] for text in batch.column("text").to_pylist()], kind)]

    found = add_columns(docs.select(*row_key(docs), "text"), {"at": "array<struct<term:string,from:int,to:int>>"}, look, drop=["text"])
    # repeated rows have one key; their terms are looked up once
    found = found.where(F.size("at") > 0).groupBy("__id", "__hash").agg(F.first("at").alias("at"))
    found = found.select("__id", "__hash", F.explode("at").alias("x")).select("__id", "__hash", "x.*").join(told, "term")
    more = F.array_sort(F.collect_list(F.struct("from", "to", "disclosure"))).alias("__more")
    return found.groupBy("__id", "__hash").agg(more)


def mask(text: str | None, more: list[dict] | None = None) -> str | None:
    """``text`` with identifiers and terms replaced: identifiers and lesser terms by their kind, most disclosing terms by nothing."""
    if not text:
        return text
    cuts = [(s, e, f"[{k}]") for k, s, e in base_spans(text)]
    cuts += [(m["from"], m["to"], "" if m["disclosure"] >= MOST_DISCLOSURE else "[term]") for m in more or ()]
    out, at = [], 0
    # of overlapping spans the first counts, and of those with the same start the longest
    for s, e, by in sorted(cuts, key=lambda c: (c[0], -c[1])):
        if s >= at:
            out += [text[at:s], by]
            at = e
        elif e > at:
            at = e
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, the text sanitised. An ``n_chars`` column, where there is one, counts the new text."""
    docs = docs.drop("__id", "__hash", "__more", "__text")
    _, told = _findings(docs.select("doc_id", "text"))
    rows = docs if told is None else docs.select("*", *row_key(docs)).join(occurrences(docs, told), ["__id", "__hash"], "left")

    marked = told is not None

    def cut(batch: pa.RecordBatch) -> list:
        texts = batch.column("text").to_pylist()
        more = batch.column("__more").to_pylist() if marked else [None] * len(texts)
        return [[mask(t, m) for t, m in zip(texts, more, strict=True)]]

    rows = add_columns(rows, {"__text": "string"}, cut, drop=["text", "__more", "__id", "__hash"])
    new = [F.col("__text").alias(c) if c == "text" else F.length("__text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return rows.select(*new)
