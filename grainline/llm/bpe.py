"""Byte-level BPE: encoding by merge ranks with segment trees, and decoding.

A text is split by the tokenizer's pattern; each piece starts as its bytes and the adjacent pair of lowest rank (leftmost
on ties) merges until no pair has a rank. A segment tree over the byte positions of a piece stores the lowest
(rank, position) of every range, so the root names the next merge. A merge changes three leaves (the merged position, the
one that dies and the live neighbour before) by point updates of logarithmic length.

Short pieces are merged many at a time: their trees are rows of one numpy array and every step advances all of them.
Long pieces use one tree each, O(n log n). Pieces repeat, so a bounded cache keeps what a task has encoded; when it is full, pieces
that have been asked for again stay, and those seen once go.

Defined results. Null text encodes like an empty one: no ids. Lone or odd bytes cannot occur (Spark strings are
UTF-8). Texts of any length are encoded whole. Strings of special tokens are ordinary text. Unknown ids in ``decode`` fail.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .store import give_back, small_batches

#: Pieces of at most so many bytes are merged in batches.
SHORT = 64
#: Pieces that a task remembers.
CACHE_PIECES = 60_000


class Tokenizer:
    """Ranks as in a rank file: token bytes -> rank, the rank being the token's id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        size = max(ranks.values()) + 1
        self.token: list[bytes] = [b""] * size
        for t, i in ranks.items():
            self.token[i] = t
        self.text_id = [str(i) for i in range(size)]
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.none = size
        # every pair of tokens whose bytes joined are a token, in order of (left, right)
        pairs = sorted((ranks[t[:k]] * size + ranks[t[k:]], i) for t, i in ranks.items() if len(t) > 1
                       for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self.pair = np.array([p for p, _ in pairs] or [-1], np.int64)
        self.pair_rank = np.array([r for _, r in pairs] or [size], np.int64)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.again: set[str] = set()            # pieces of the cache that were asked for again
        self.latest: set[str] = set()           # those of the texts before

    @classmethod
    def from_file(cls, raw: bytes, pattern: str) -> Tokenizer:
        """``raw``: the bytes of a rank file, one base64 token and its rank a line."""
        return cls({base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line)}, pattern)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.none + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], self.none)

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """One piece, one tree. Tree entries are rank * width + position, so that the least is the leftmost."""
        n, none, ranks, token = len(piece), self.none, self.ranks, self.token
        width = 1 << max(1, (n - 1).bit_length())
        worst = none * width
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = np.full(2 * width, worst, np.int64)
        if n > 1:
            a = np.array(ids, np.int64)
            r = self.rank_of(a[:-1], a[1:])
            tree[width:width + n - 1] = np.where(r < none, r * width + np.arange(n - 1), worst)
        level = width
        while level > 1:
            tree[level // 2:level] = np.minimum(tree[level:2 * level:2], tree[level + 1:2 * level:2])
            level //= 2
        tree = tree.tolist()

        def put(position: int, rank: int) -> None:
            i = position + width
            tree[i] = rank * width + position if rank < none else worst
            i >>= 1
            while i:
                least = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == least:
                    break
                tree[i] = least
                i >>= 1

        while tree[1] < worst:
            rank, p = divmod(tree[1], width)
            gone = after[p]
            ids[p], q = rank, after[gone]
            after[p] = q
            put(gone, none)
            put(p, ranks.get(token[rank] + token[ids[q]], none) if q < n else none)
            if q < n:
                before[q] = p
            if (o := before[p]) >= 0:
                put(o, ranks.get(token[ids[o]] + token[rank], none))
        out, p = [], 0
        while p < n:
            out.append(ids[p])
            p = after[p]
        return tuple(out)

    def merge_batch(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Pieces of at most ``width`` bytes (a power of two): one tree a row, all rows step together."""
        count, none = len(pieces), self.none
        worst = none * width
        length = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
        place = np.arange(width)
        live = place < length[:, None]
        ids = self.byte_id[raw]
        after = np.minimum(np.broadcast_to(place + 1, (count, width)), length[:, None])
        before = np.broadcast_to(place - 1, (count, width + 1 - 1)).copy()
        before = np.concatenate([before, np.full((count, 1), -1)], 1)  # a slot that writes past the end may use
        rank = self.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(count, width - 1)
        tree = np.full((count, 2 * width), worst, np.int64)
        tree[:, width:-1] = np.where(live[:, 1:] & (rank < none), rank * width + place[:-1], worst)
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        flat, ids_, after_, before_ = tree.ravel(), ids.ravel(), after.copy().ravel(), before.ravel()
        alive = live.copy().ravel()

        def put(row: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
            base = row * (2 * width)
            i = position + width
            flat[base + i] = np.where(rank < none, rank * width + position, worst)
            while True:
                i = i >> 1
                if not i[0]:
                    break
                flat[base + i] = np.minimum(flat[base + 2 * i], flat[base + 2 * i + 1])

        row = np.arange(count)
        while True:
            best = tree[row, 1]
            row = row[best < worst]
            if not len(row):
                break
            new, p = np.divmod(tree[row, 1], width)
            own, end = row * width, length[row]
            gone = after_[own + p]
            q = after_[own + np.minimum(gone, width - 1)]
            ids_[own + p], after_[own + p] = new, q
            alive[own + gone] = False
            before_[row * (width + 1) + np.where(q < end, q, width)] = p
            put(row, gone, np.full(len(row), none))
            follow = ids_[own + np.minimum(q, width - 1)]
            put(row, p, np.where(q < end, self.rank_of(new, follow), none))
            o = before_[row * (width + 1) + p]
            has = o >= 0
            if has.any():
                put(row[has], o[has], self.rank_of(ids_[own[has] + o[has]], new[has]))
        kept = ids_[alive].tolist()
        bound = np.concatenate([[0], np.cumsum(alive.reshape(count, width).sum(1))]).tolist()
        return [tuple(kept[bound[i]:bound[i + 1]]) for i in range(count)]

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces into the cache."""
        todo: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            b = p.encode()
            if (whole := self.ranks.get(b)) is not None:
                self.cache[p] = (whole,)
            elif len(b) > SHORT:
                self.cache[p] = self.merge_long(b)
            else:
                todo.setdefault(1 << (len(b) - 1).bit_length(), []).append((p, b))
        for width, some in todo.items():
            for at in range(0, len(some), 20_000):
                part = some[at:at + 20_000]
                self.cache.update(zip([p for p, _ in part], self.merge_batch([b for _, b in part], width)))

    def make_room(self) -> None:
        """Leave at most CACHE_PIECES pieces in a cache that holds more, or those of the texts before that were in it already."""
        if len(self.again) > CACHE_PIECES:
            self.again = self.latest
        self.cache = {p: self.cache[p] for p in self.again}

    def forget(self) -> None:
        self.cache, self.again, self.latest = {}, set(), set()

    def encode_batch(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text, a few texts at a time."""
        at = 0
        while at < len(texts):
            split, new, size = [], set(), 0
            if len(self.cache) > CACHE_PIECES:
                self.make_room()
            while at < len(texts) and (size < 2_000_000 or not split):
                text = texts[at] or ""
                split.append(self.split(text))
                new.update(split[-1])
                size += len(text)
                at += 1
            self.latest = new.intersection(self.cache)
            self.again |= self.latest
            self.learn(new - self.latest)
            get = self.cache.__getitem__
            for pieces in split:
                yield list(chain.from_iterable(map(get, pieces)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_loaded: dict[tuple[str, str], Tokenizer] = {}


def _tokenizer(raw: bytes, pattern: str) -> Tokenizer:
    """One tokenizer per Python worker and rank file."""
    key = (hashlib.sha256(raw).hexdigest(), pattern)
    if key not in _loaded:
        _loaded[key] = Tokenizer.from_file(raw, pattern)
    return _loaded[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, pattern: str, ids: bool = True, digests: bool = True, text: str = "text") -> DataFrame:
    """All columns but the text, and n_tokens; ``ids``: the ids (array of int); ``digests``: SHA-256 of the ids and of the
    bytes that the ids decode to. The rank file (a vocabulary of fixed size) is read by the driver and broadcast."""
    small_batches(docs.sparkSession)
    raw = docs.sparkSession.sparkContext.broadcast(_read(path))
    added = {"n_tokens": (pa.int64(), "long")}
    if ids:
        added["ids"] = (pa.list_(pa.int32()), "array<int>")
    if digests:
        added |= {"ids_sha256": (pa.string(), "string"), "decoded_sha256": (pa.string(), "string")}
    names = [c for c in docs.columns if c not in added and c != text]
    docs = docs.select(*names, text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text),
                        *(f"{k} {t}" for k, (_, t) in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(raw.value, pattern)
        gc.disable()                # nothing here is cyclic, and the collector would walk the whole cache again and again
        try:
            for batch in batches:
                for at in range(0, max(batch.num_rows, 1), 256):
                    yield rows_of(tok, batch.slice(at, 256))
        finally:
            gc.enable()
            tok.forget()            # the worker may go on to other tasks
            give_back()

    def rows_of(tok: Tokenizer, batch: pa.RecordBatch) -> pa.RecordBatch:
        name = tok.text_id.__getitem__
        got: dict[str, list] = {k: [] for k in added}
        for found in tok.encode_batch(batch.column(text).to_pylist()):
            got["n_tokens"].append(len(found))
            if ids:
                got["ids"].append(np.array(found, np.int32))
            if digests:
                got["ids_sha256"].append(hashlib.sha256(",".join(map(name, found)).encode()).hexdigest())
                got["decoded_sha256"].append(hashlib.sha256(tok.decode(found)).hexdigest())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(got[k], t) for k, (t, _) in added.items())],
                                          [*names, *added])

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """All columns but ``ids``, and ``out``: the text that the ids stand for (null for null ids)."""
    raw = tokens.sparkSession.sparkContext.broadcast(_read(path))
    names = [c for c in tokens.columns if c not in (ids, out)]
    tokens = tokens.select(*names, ids)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != ids), f"`{out}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(raw.value, "")
        for batch in batches:
            text = [None if x is None else tok.decode(x).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(text, pa.string())], [*names, out])

    return tokens.mapInArrow(run, schema)
