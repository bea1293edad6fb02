"""Language-model scores from Elias-Fano n-gram tries, built and queried in hash shards.

Model: hierarchical smoothing, P(w|v) = c(v,w) / (c(v) + MU) + MU / (c(v) + MU) P(w), where P(w) is the absolutely discounted
unigram, (max(c(w) - DISCOUNT, 0) + DISCOUNT V / (V + 1)) / N; an unknown word has c(w) = 0. The first term is the pair's smoothed
probability, the factor of P(w) its context's back-off weight; over all w they add up to 1. A text is its lower-case words and
one end token.

Trie of a shard: the first level holds the contexts v (Elias-Fano coded hashes) with their back-off weights and monotone
Elias-Fano pointers into the second, which holds their continuations w as w + rank(v) * 2^40, again one monotone Elias-Fano
sequence, so that the successor search for a continuation is relative to its context, with the smoothed probabilities of the
pairs. Probabilities and weights are quantised to 16 bits on a logarithmic scale; scores are read from them. All levels lie in
one memory-mapped region and are read through views; ``save`` and ``load`` map files.

On Spark, nothing that grows with the corpus is collected but the list of frequent words (at most four a shard):
1. documents become blocks (about 4 MB of text): sorted word hashes and token numbers, written to the shared folder;
2. word counts: each block sends its words to hash shards, which add them up and return the counts (written);
3. pairs: each block sends its different (v, w) to the shard of v; a shard adds up the training counts, builds its trie,
   looks up every pair of every block in sorted order, and returns quantised probabilities and weights. Frequent contexts (as
   words of over a quarter of a shard's mean) are split over all shards by w;
4. each block joins what has come back and adds up its documents' scores.
Rows that move are packed arrays, so shuffles carry a few bytes a token. Blocks reach shards in hops (``Routes``): a block sends at
most 2^FAN_BITS packets however many shards there are, and so does each node between, which adds up what about as many packets
bring. Rows therefore grow in proportion to the corpus (times the hops). Words are 64-bit hashes, continuations 40 bits.

Defined results. Null and empty texts: one end token. A null id counts as the empty text in the fold's checksum. Repeated rows:
learned from each, scored each. Very long texts are whole (a block of their own). No training rows: every probability is
that of an unknown word, train_tokens 0. Empty table: no rows.
"""

from __future__ import annotations

import mmap
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .langid import fold
from .store import written

MU, DISCOUNT = 100.0, 0.75
#: Tokens that one shard's task handles, about.
SHARD_TOKENS = 1_500_000
CHUNK = 4096
#: Text of one block; larger blocks send fewer different words and pairs.
BLOCK_BYTES = 4 << 20
END = np.uint64(0x9D39247E33776D41)
START = np.uint64(0x2AF7398005AAA5C7)
_W_BITS = 40
#: A block or node sends at most 2^FAN_BITS packets in a hop.
FAN_BITS = 12


class EliasFano:
    """A monotone sequence of integers: low bytes verbatim, high parts in unary, with a directory of chunks.

    The number of low bits is rounded up to whole bytes, so that the unary part has at most two bits a value."""

    FIELDS = ("low", "high", "sample", "place", "shape")

    def __init__(self, low, high, sample, place, shape):
        self.low, self.high, self.sample, self.place, self.shape = low, high, sample, place, shape
        self.n, self.width, self.base = int(shape[0]), int(shape[1]), shape[2]

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        base = values[0] if n else np.uint64(0)
        rest = values - base
        top = int(rest[-1]) if n else 0
        width = -(-max(0, (top // max(n, 1)).bit_length() - 1) // 8) if n else 0
        low = rest.view(np.uint8).reshape(n, 8)[:, :width].copy() if n else np.zeros((0, width), np.uint8)
        up = (rest >> np.uint64(8 * width)).astype(np.int64) if width < 8 else np.zeros(n, np.int64)
        ones = up + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, bool)
        bits[ones] = True
        return cls(low.ravel(), np.packbits(bits), values[::CHUNK].copy(), np.append(ones[::CHUNK], len(bits)).astype(np.uint64),
                   np.array([n, width, base], np.uint64))

    def chunk(self, k: int) -> np.ndarray:
        """Values of the k-th chunk."""
        i, j = k * CHUNK, min((k + 1) * CHUNK, self.n)
        a, b = int(self.place[k]), int(self.place[k + 1])
        bits = np.unpackbits(self.high[a // 8:-(-b // 8)])[a % 8:a % 8 + b - a]
        up = (np.flatnonzero(bits) + a - np.arange(i, j)).astype(np.uint64)
        low = np.zeros((j - i, 8), np.uint8)
        low[:, :self.width] = self.low[i * self.width:j * self.width].reshape(j - i, self.width)
        out = low.view(np.uint64).ravel()
        return out + (up << np.uint64(8 * self.width)) + self.base if self.width < 8 else out + self.base

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """Values at sorted positions."""
        out, chunks = np.zeros(len(at), np.uint64), at // CHUNK
        for k in np.unique(chunks).tolist():
            i, j = np.searchsorted(chunks, [k, k + 1])
            out[i:j] = self.chunk(k)[at[i:j] - k * CHUNK]
        return out

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted x: position of the first value >= x (n if none), and whether it equals x."""
        at, same = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        if not self.n or not len(x):
            return at, same
        of = np.maximum(np.searchsorted(self.sample, x, "right") - 1, 0)
        for k in np.unique(of).tolist():
            i, j = np.searchsorted(of, [k, k + 1])
            values = self.chunk(k)
            p = np.searchsorted(values, x[i:j])
            at[i:j] = p + k * CHUNK
            same[i:j] = values[np.minimum(p, len(values) - 1)] == x[i:j]
        return at, same


class Trie:
    """Two levels in one mapped region: contexts with back-off weights and pointers, continuations with probabilities."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        part = lambda name: EliasFano(*(arrays[f"{name}.{f}"] for f in EliasFano.FIELDS))
        self.context, self.pointer, self.word, self.code = part("context"), part("pointer"), part("word"), arrays["code"]
        self.weight = arrays["weight"]

    @staticmethod
    def arrays(contexts: np.ndarray, weights: np.ndarray, v: np.ndarray, w: np.ndarray, codes: np.ndarray) -> dict[str, np.ndarray]:
        """``contexts`` sorted, with a code each; ``v`` (all of them contexts), ``w`` sorted by v, then w, with a code a pair."""
        if len(contexts) >= 1 << (64 - _W_BITS):
            raise ValueError("too many contexts in one shard: use more shards")
        rank = np.searchsorted(contexts, v)
        levels = {"context": contexts, "pointer": np.searchsorted(rank, np.arange(len(contexts) + 1)).astype(np.uint64),
                  "word": (rank.astype(np.uint64) << np.uint64(_W_BITS)) | w}
        out = {"code": codes.astype(np.uint16), "weight": weights.astype(np.uint16)}
        for name, values in levels.items():
            e = EliasFano.encode(values)
            out |= {f"{name}.{f}": getattr(e, f) for f in EliasFano.FIELDS}
        return out

    @staticmethod
    def _layout(arrays: dict[str, np.ndarray]) -> tuple[list[tuple[str, str, int, int]], int]:
        places, at = [], 0
        for name, a in arrays.items():
            places.append((name, a.dtype.str, len(a), at))
            at += -(-a.nbytes // 8) * 8
        return places, at

    @classmethod
    def _views(cls, region, places) -> Trie:
        return cls({name: np.frombuffer(region, dtype, n, at) for name, dtype, n, at in places})

    @classmethod
    def mapped(cls, arrays: dict[str, np.ndarray]) -> Trie:
        """The levels in an anonymous memory map."""
        places, size = cls._layout(arrays)
        region = mmap.mmap(-1, max(size, 1))
        for (_, _, n, at), a in zip(places, arrays.values(), strict=True):
            region[at:at + a.nbytes] = a.tobytes()
        return cls._views(region, places)

    @classmethod
    def save(cls, arrays: dict[str, np.ndarray], path: str) -> None:
        places, _ = cls._layout(arrays)
        head = repr(places).encode()
        with open(path, "wb") as f:
            f.write(len(head).to_bytes(8, "little") + head + b"\0" * (-len(head) % 8))
            for a in arrays.values():
                f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))

    @classmethod
    def load(cls, path: str) -> Trie:
        """Levels of a file that ``save`` wrote, mapped read-only."""
        import ast
        with open(path, "rb") as f:
            region = mmap.mmap(f.fileno(), os.path.getsize(path), access=mmap.ACCESS_READ)
        n = int.from_bytes(region[:8], "little")
        start = 8 + n + (-n % 8)
        return cls._views(region, [(name, d, k, at + start) for name, d, k, at in ast.literal_eval(region[8:8 + n].decode())])

    def lookup(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of pairs sorted by (v, w), 0 for pairs that the trie does not hold, and of their contexts' back-off weights,
        that of 1 for contexts that it does not hold."""
        out, weight = np.zeros(len(v), np.uint16), np.full(len(v), 65535, np.uint16)
        new = _starts(v)
        at, known = self.context.successor(v[new])
        which = np.cumsum(new) - 1
        rank, known = at[which], known[which]
        i = np.flatnonzero(known)
        weight[i] = self.weight[rank[i]]
        place, same = self.word.successor((rank[i].astype(np.uint64) << np.uint64(_W_BITS)) | w[i])
        out[i[same]] = self.code[place[same]]
        return out, weight


def _starts(v: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before."""
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    return new


def _steps(total: float) -> float:
    """Codes a decade, so that 16 bits reach from 1 down to 1 / total."""
    return 65534 / (np.log10(max(total, 1)) + 1)


def quantise(p: np.ndarray, total: int) -> np.ndarray:
    """16-bit code of probabilities of at least 1 / total on a logarithmic scale; 0 is none."""
    return np.where(p > 0, np.clip(np.rint(65535 + _steps(total) * np.log10(np.maximum(p, 1e-300))), 1, 65535), 0).astype(np.uint16)


def dequantise(code: np.ndarray, total: int) -> np.ndarray:
    return np.where(code > 0, 10.0 ** ((code.astype(float) - 65535) / _steps(total)), 0.0)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers, byte planes apart, compressed."""
    parts = [len(arrays).to_bytes(2, "little")]
    for a in arrays:
        parts += [np.dtype(a.dtype).itemsize.to_bytes(1, "little"), len(a).to_bytes(8, "little"),
                  np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b""]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(raw: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    out, at = [], 2
    for _ in range(int.from_bytes(raw[:2], "little")):
        size, n = raw[at], int.from_bytes(raw[at + 1:at + 9], "little")
        planes = np.frombuffer(raw, np.uint8, size * n, at + 9).reshape(size, n)
        if size in (1, 2, 4, 8):
            out.append(np.ascontiguousarray(planes.T).view(f"u{size}").ravel())
        else:                                                   # narrow integers, widened
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :size] = planes.T
            out.append(wide.view(np.uint64).ravel())
        at += 9 + size * n
    return out


def _narrow(values: np.ndarray, size: int) -> np.ndarray:
    """The low ``size`` bytes of 64-bit integers, as one array of records."""
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :size]).view(f"V{size}").ravel()


def _least(values: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in scan.blocks(batch.column("text"), BLOCK_BYTES):
            b = scan.Block(b.first, scan.LOWER[b.data], b.offsets)
            w = scan.words(b)
            tokens = np.full(len(w.start) + b.size, END, np.uint64)
            tokens[np.arange(len(w.start)) + w.doc] = scan.Hasher(b.data).ranges(w.start, w.end)
            words, ids = np.unique(tokens, return_inverse=True)
            size = np.diff(w.first) + 1
            held = batch.column("held_out").slice(b.first, b.size)
            learned = int(size[~held.to_numpy(zero_copy_only=False)].sum())
            steps = words.copy()
            steps[1:] -= words[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("doc_id").slice(b.first, b.size).to_pylist()], pa.list_(pa.int64())), pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                 pa.array([pack(steps)], pa.binary()), pa.array([pack(_least(ids), _least(size))], pa.binary()),
                 pa.array([len(tokens)], pa.int64()), pa.array([learned], pa.int64())],
                ["doc_ids", "held", "words", "tokens", "n", "learned"])


def _tokens(raw: bytes, held: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers, their documents, and whether they are learned from."""
    ids, size = unpack(raw)
    doc = np.repeat(np.arange(len(size)), size.astype(np.int64))
    return ids.astype(np.int64), doc, ~np.array(held, bool)[doc]


def _pairs(ids: np.ndarray, doc: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (v, w) of a block in order of their numbers, and each token's pair. ``start`` is the start symbol's number."""
    before = np.full(len(ids), start)
    before[1:] = np.where(doc[1:] == doc[:-1], ids[:-1], start)
    key, pair = np.unique(before * (start + 1) + ids, return_inverse=True)
    return key // (start + 1), key % (start + 1), pair


class Routes:
    """How keys get from blocks to 2^``bits`` shards: in hops of at most 2^FAN_BITS packets.

    A shard's number is known hop by hop, from its highest bits. A node of level j holds the keys of one prefix (``upto[j]`` bits) of
    one batch of the blocks; batches merge from level to level, until a shard's node holds those of all blocks. A node takes in about as
    many packets as it sends."""

    def __init__(self, bits: int, blocks: int):
        hops = max(1, -(-bits // FAN_BITS))
        self.bits, self.hops = bits, hops
        self.upto = [-(-bits * j // hops) for j in range(hops + 1)]
        self.batches = [max(1, -(-blocks // (1 << u))) for u in self.upto[:-1]] + [1]

    def prefix(self, node, level: int):
        return node & ((1 << self.upto[level]) - 1)

    def shard(self, v: np.ndarray, w: np.ndarray, split: np.ndarray) -> np.ndarray:
        """Shards of pairs: of w (its high bits) where v is in the sorted list ``split``, of v elsewhere."""
        if not self.bits:
            return np.zeros(len(v), np.int64)
        place = np.minimum(np.searchsorted(split, v), max(len(split) - 1, 0))
        hot = split[place] == v if len(split) else np.zeros(len(v), bool)
        return np.where(hot, w >> np.uint64(_W_BITS - self.bits), v >> np.uint64(64 - self.bits)).astype(np.int64)

    def packets(self, level: int, source: int, v: np.ndarray, w: np.ndarray, count: np.ndarray, shard: np.ndarray) -> list[tuple[int, int, bytes]]:
        """(source, node, packet) rows from a source of ``level`` (0: a block) to the nodes of the next one that get any key."""
        to = shard >> (self.bits - self.upto[level + 1])
        order = np.argsort(to, kind="stable")
        to = to[order]
        batch = ((source * 0x9E3779B97F4A7C15 >> 20) if level == 0 else source >> self.upto[level]) % self.batches[level + 1]
        first = np.flatnonzero(_starts(to))
        out = []
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(to)], strict=True):
            o = order[i:j]
            out.append((source, (batch << self.upto[level + 1]) | int(to[i]), _packet(v[o], w[o], count[o])))
        return out


def _packet(v: np.ndarray, w: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs, equal v side by side."""
    new = np.flatnonzero(_starts(v))
    return pack(v[new], _least(np.diff(np.append(new, len(v)))), _narrow(w, 5), _least(count))


def _reply(code: np.ndarray, weight: np.ndarray, v: np.ndarray) -> bytes:
    """Answers for the pairs of a packet: a code a pair, a weight a run of v."""
    return pack(_least(code), weight[_starts(v)])


class _Merged:
    """The packets that reach a node, added up: different pairs in order, their counts, and each packet's pairs."""

    def __init__(self, packets: list[bytes]):
        parts = [unpack(x) for x in packets]
        v = np.concatenate([np.repeat(p[0], p[1].astype(np.int64)) for p in parts])
        w = np.concatenate([p[2] for p in parts])
        count = np.concatenate([p[3] for p in parts]).astype(np.int64)
        self.asked, self.edge = v, np.cumsum([0, *(len(p[2]) for p in parts)])
        order = np.lexsort((w, v))
        sv, sw = v[order], w[order]
        new = _starts(sv) | _starts(sw)
        first = np.flatnonzero(new)
        self.of = np.empty(len(v), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.v, self.w, self.count = sv[first], sw[first], np.add.reduceat(count[order], first) if len(first) else np.zeros(0, np.int64)

    def replies(self, code: np.ndarray, weight: np.ndarray) -> list[bytes]:
        """One a packet, from one answer a different pair."""
        return [_reply(code[self.of[i:j]], weight[self.of[i:j]], self.asked[i:j]) for i, j in zip(self.edge[:-1], self.edge[1:], strict=True)]


_MOVED = "source long, node long, payload binary"


def _moved(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
                                      ["source", "node", "payload"])


def _asked(packets: DataFrame, routes: Routes, split: np.ndarray, answer) -> DataFrame:
    """Replies to the blocks' ``packets``: source (the block), node, payload, told.

    ``answer(merged)`` gives a code and a weight for each of a shard's different pairs, and what the shard tells besides (a number
    and a packed list or None; rows with source -1)."""
    def at_shard(t: pa.Table) -> pa.Table:
        m = _Merged(t.column("payload").to_pylist())
        code, weight, told, listed = answer(m)
        n, node = t.num_rows, t.column("node")[0].as_py()
        return pa.table({"source": pa.array([*t.column("source").to_pylist(), -1], pa.int64()), "node": pa.array([node] * (n + 1), pa.int64()),
                         "payload": pa.array([*m.replies(code, weight), listed], pa.binary()), "told": pa.array([None] * n + [told], pa.int64())})

    with_told = _MOVED + ", told long"
    levels = [packets]
    for level in range(1, routes.hops):
        levels[-1] = written(levels[-1], "packets")
        levels.append(levels[-1].groupBy("node").applyInArrow(_onward(routes, split, level), _MOVED))
    back = levels[-1].groupBy("node").applyInArrow(at_shard, with_told)
    for level in range(routes.hops - 1, 0, -1):
        back = written(back, "replies")
        replies = back.where("source >= 0").withColumnRenamed("source", "by")
        down = levels[level - 1].groupBy("node").cogroup(replies.groupBy("by")).applyInArrow(_returned(routes, split, level), with_told)
        back = down.union(back.where("source < 0"))
    return back


def _onward(routes: Routes, split: np.ndarray, level: int):
    """What a node of ``level`` sends to the next one."""
    def run(t: pa.Table) -> pa.Table:
        m = _Merged(t.column("payload").to_pylist())
        return pa.Table.from_batches([_moved(routes.packets(level, t.column("node")[0].as_py(), m.v, m.w, m.count, routes.shard(m.v, m.w, split)))])

    return run


def _returned(routes: Routes, split: np.ndarray, level: int):
    """What a node of ``level`` replies to its sources, from their packets and the replies of the next level."""
    def run(asked: pa.Table, got: pa.Table) -> pa.Table:
        m = _Merged(asked.column("payload").to_pylist())
        to = routes.shard(m.v, m.w, split) >> (routes.bits - routes.upto[level + 1])
        order = np.argsort(to, kind="stable")
        code, weight = np.zeros(len(to), np.uint64), np.zeros(len(to), np.uint16)
        code[order], weight[order] = _in_order(got.column("node").to_numpy(), got.column("payload"), m.v[order], to[order])
        return pa.table({"source": asked.column("source"), "node": asked.column("node"), "payload": pa.array(m.replies(code, weight), pa.binary()),
                         "told": pa.array([None] * asked.num_rows, pa.int64())})

    return run


def _in_order(nodes: np.ndarray, payloads, v: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of pairs that were sent in the order of ``to``, from the replies of the nodes they went to."""
    code, weight = np.zeros(len(v), np.uint64), np.zeros(len(v), np.uint16)
    edges = np.flatnonzero(np.append(_starts(to), True)) if len(to) else np.zeros(1, np.int64)
    for k, (i, j) in zip(np.argsort(nodes).tolist(), zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True), strict=True):
        c, x = unpack(payloads[k].as_py())
        code[i:j] = c
        weight[i:j] = x[np.cumsum(_starts(v[i:j])) - 1]
    return code, weight


def score(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs`` (doc_id, text).

    Learns from the rows whose checksum modulo ``folds`` is not 0."""
    rows = docs.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    made = rows.mapInArrow(_blocks, "doc_ids array<long>, held array<boolean>, words binary, tokens binary, n long, learned long")
    blocks = written(made.withColumn("block", F.monotonically_increasing_id()), "blocks")
    size = blocks.agg(F.count("*").alias("blocks"), F.sum("n").alias("n"), F.sum("learned").alias("learned"), F.sum(F.aggregate(
        "held", F.lit(0).cast("long"), lambda a, h: a + F.when(h, 0).otherwise(1))).alias("documents")).first()
    total, starts = int(size.learned or 0), int(size.documents or 0)
    routes = Routes(max(0, (int(size.n or 0) // SHARD_TOKENS).bit_length()), size.blocks)
    often = total / (4 << routes.bits)
    scale = total + MU
    nothing = np.zeros(0, np.uint64)

    def word_packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = np.cumsum(unpack(r["words"])[0], dtype=np.uint64)
                ids, _, learn = _tokens(r["tokens"], r["held"])
                counts, zeros = np.bincount(ids[learn], minlength=len(words)), np.zeros(len(words), np.uint64)
                yield _moved(routes.packets(0, r["block"], words, zeros, counts, routes.shard(words, zeros, nothing)))

    def add_words(m: _Merged) -> tuple[np.ndarray, np.ndarray, int, bytes | None]:
        hot = m.count > often
        listed = pack(m.v[hot], m.count[hot].astype(np.uint64)) if hot.any() else None
        return m.count, np.zeros(len(m.v), np.uint16), int((m.count > 0).sum()), listed

    asking = blocks.select("block", "words", "tokens", "held")
    counts = written(_asked(asking.mapInArrow(word_packets, _MOVED), routes, nothing, add_words), "word-counts")
    told = counts.where("source < 0")
    distinct = int(told.agg(F.sum("told")).first()[0] or 0)
    # at most four words a shard are frequent
    listed = [unpack(r.payload) for r in told.where("payload is not null").select("payload").collect()]
    frequent = np.concatenate([np.array([START], np.uint64), *(x[0] for x in listed)])
    seen = np.concatenate([np.array([starts], np.uint64), *(x[1] for x in listed)])[np.argsort(frequent)].astype(np.int64)
    frequent = np.sort(frequent)

    def pair_packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = np.append(np.cumsum(unpack(r["words"])[0], dtype=np.uint64), START)
                ids, doc, learn = _tokens(r["tokens"], r["held"])
                v, w, pair = _pairs(ids, doc, len(words) - 1)
                count = np.bincount(pair[learn], minlength=len(v))
                v, w = words[v], words[w] >> np.uint64(64 - _W_BITS)
                yield _moved(routes.packets(0, r["block"], v, w, count, routes.shard(v, w, frequent)))

    def ask_trie(m: _Merged) -> tuple[np.ndarray, np.ndarray, None, None]:
        new = _starts(m.v)
        context = m.v[new]
        of_v = np.add.reduceat(m.count, np.flatnonzero(new)) if len(context) else np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(frequent, context), len(frequent) - 1)
        of_v = np.where(frequent[place] == context, seen[place], of_v)       # split contexts are counted over all shards
        mine, held = of_v > 0, m.count > 0
        trie = Trie.mapped(Trie.arrays(context[mine], quantise(MU / (of_v[mine] + MU), scale), m.v[held], m.w[held],
                                       quantise(m.count[held] / (of_v[np.cumsum(new) - 1][held] + MU), scale)))
        return *trie.lookup(m.v, m.w), None, None

    codes = _asked(asking.mapInArrow(pair_packets, _MOVED), routes, frequent, ask_trie)
    none_ids, none_held = F.lit(None).cast("array<long>").alias("doc_ids"), F.lit(None).cast("array<boolean>").alias("held")
    together = (blocks.select("block", F.lit(-1).cast("long").alias("node"), F.lit(0).alias("kind"), F.col("tokens").alias("payload"), "doc_ids", "held")
                .union(counts.where("source >= 0").select("source", "node", F.lit(1), "payload", none_ids, none_held))
                .union(codes.where("source >= 0").select("source", "node", F.lit(2), "payload", none_ids, none_held)))

    def finish(t: pa.Table) -> pa.Table:
        kind, node = t.column("kind").to_numpy(), t.column("node").to_numpy()
        head = int(np.flatnonzero(kind == 0)[0])
        held = t.column("held")[head].as_py()
        ids, doc, _ = _tokens(t.column("payload")[head].as_py(), held)
        # word numbers are in the order of their hashes, and so of their first nodes
        from_words = np.flatnonzero(kind == 1)[np.argsort(node[kind == 1])]
        parts = [unpack(t.column("payload")[int(i)].as_py())[0] for i in from_words]
        count = np.concatenate(parts).astype(float)
        prefix = np.append(np.repeat(routes.prefix(node[from_words], 1), [len(x) for x in parts]), 0)
        v, w, pair = _pairs(ids, doc, len(count))
        to = np.where(np.append(count > often, True)[v], prefix[w], prefix[v])
        order = np.argsort(to, kind="stable")
        from_pairs = np.flatnonzero(kind == 2)
        replies = t.column("payload").take(pa.array(from_pairs))
        code, weight = np.zeros(len(v), np.uint64), np.zeros(len(v), np.uint16)
        code[order], weight[order] = _in_order(node[from_pairs], replies, v[order], to[order])
        one = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * max(distinct, 1) / (distinct + 1)) / max(total, 1)
        each = np.log10(dequantise(code, scale) + dequantise(weight, scale) * one[w])
        base = np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))
        size = len(held)
        total_of = lambda x: np.bincount(doc, x, size)
        return pa.table({"doc_id": pa.array(t.column("doc_ids")[head].as_py(), pa.int64()), "held_out": held,
                         "n_tokens": np.bincount(doc, minlength=size), "n_known": total_of(count[ids] > 0).astype(np.int64),
                         "train_tokens": np.full(size, total, np.int64), "base_score": total_of(base[ids]), "score": total_of(each[pair])})

    return together.groupBy("block").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
