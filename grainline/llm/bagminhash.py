"""Near-duplicates by weighted Jaccard similarity of word shingles: BagMinHash, banding, verification, classes.

A text is the multiset of its five-word shingles. Each (shingle, weight range) owns a Poisson process over time; ranges are
dyadic ([0,1), [1,2), [2,4), ...), so a shingle that occurs c times takes part in about log2(c) processes, and a point whose
weight position is c or more is left out. Points fall on random signature slots and a slot keeps its earliest point. Two
texts agree on a slot with exactly the probability sum(min) / sum(max) of their counts. Processes run in time order
only until they pass the latest slot, so a text costs about (shingles + slots * log(slots)) points.

Then, on Spark:
1. texts with equal multisets (copies) become one text, by a partial aggregation;
2. bands of slots give buckets; every member of a bucket is paired with the bucket's first text (never all pairs);
3. pairs whose signatures agree enough are verified by exact multiset overlap;
4. verified links become components by minimum labels with pointer jumping, each round written to the shared folder;
5. where a bucket holds several components, the members outside its largest one are paired with a random member of it and
   with a random one of the others, twice. The texts of buckets that still hold several are joined by prefixes of their
   rarest shingles, which any similar pair shares; all such pairs of two components that their sizes and places allow are
   verified as in 3. Verified links complete the classes.

Defined results. Texts without words (null, empty, blank) are in no class but their own. Texts of one to four words have
one shingle, the whole text. Upper and lower case A-Z are the same. Equal rows share a class; its first row (least
doc_id, null last) is kept; of rows with its id and text but other columns, the one with the least hash of these. Very long
texts are whole. Empty table: no rows. Own columns named __id or __hash give way; others stay.

Hot groups: copies collapse before anything is shuffled by bucket; a bucket of any size costs one pair a member; joins by
bucket and by shingle are dealt over salts for the keys that a frequent-items sketch finds hot; a shingle that many texts of
several components have in their prefixes is compared in blocks of about BLOCK_TEXTS by BLOCK_TEXTS texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.operators.joins import heavy_hitters, skew_join

from . import scan
from .store import add_columns, row_key, written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SLOTS = 128
BANDS, BAND_SLOTS = 25, 5
#: Signature agreement that sends a pair to verification: 0.8 less four standard deviations.
PLAUSIBLE = SIMILARITY - 4 * float(np.sqrt(SIMILARITY * (1 - SIMILARITY) / SLOTS))
#: Texts whose shingles are counted, and most counts kept, to put frequent ones last. They bound no result.
ORDER_TEXTS, ORDER_ELEMENTS = 1 << 14, 1 << 18
#: Texts of one shingle in a block: a key of the pair join has about as many on each side.
BLOCK_TEXTS = 256
#: Rounds that pair a bucket's members with random ones of other components.
ROUNDS = 2
#: Share of the rows that makes a join key hot, and the tasks that it is dealt to.
HOT, SALTS = 0.002, 32
#: Hash slots of the filter that spares rows a shuffle; its broadcast holds at most one number a slot.
FILTER_SLOTS = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _times_golden(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLDEN) % (1 << 64))


def shingles(block: scan.Block, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document of a block: hash, document, count."""
    block = scan.Block(block.first, scan.LOWER[block.data], block.offsets)
    w = scan.words(block)
    h = scan.Hasher(block.data).ranges(w.start, w.end)
    keys, at = scan.windows(h, w.doc, width)
    docs = [w.doc[at]]
    found = [keys]
    n = np.diff(w.first)
    for short in range(1, width):
        few = np.flatnonzero(n == short)
        k, at = scan.windows(h, w.doc, short)
        mine = np.isin(w.doc[at], few)
        found.append(k[mine] + np.uint64(short))
        docs.append(w.doc[at][mine])
    keys, docs = np.concatenate(found), np.concatenate(docs)
    # by document, then shingle: the sort key has the document's rank in front only where needed, in two stable passes
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(docs[order], kind="stable")]
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    first = np.flatnonzero(new)
    return keys[first], docs[first], np.diff(np.append(first, len(keys)))


def bag_minhash(keys: np.ndarray, docs: np.ndarray, counts: np.ndarray, size: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (size x slots, float64 times of the earliest points) of the multisets of ``size`` documents."""
    earliest = np.full((size, slots), np.inf)
    flat = earliest.ravel()
    # one process per shingle and dyadic range of weights that its count reaches
    state, doc, count, low, span = [], [], [], [], []
    level, begin = 0, 0
    while True:
        reach = np.flatnonzero(counts > begin)
        if not len(reach):
            break
        width = max(1, begin)
        state.append(scan.mix64(keys[reach] + _times_golden(level)))
        doc.append(docs[reach])
        count.append(counts[reach])
        low.append(np.full(len(reach), begin))
        span.append(np.full(len(reach), width))
        level, begin = level + 1, begin + width
    if not state:
        return earliest
    state, doc, count, low, span = map(np.concatenate, (state, doc, count, low, span))
    time = np.zeros(len(state))
    point = 0
    latest = np.full(size, np.inf)
    while len(state):
        point += 1
        u = scan.mix64(state + _times_golden(point))
        time = time - np.log(((u >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / span
        go = time < latest[doc]
        state, doc, count, low, span, time, u = (a[go] for a in (state, doc, count, low, span, time, u))
        if not len(state):
            break
        v = scan.mix64(u + _GOLDEN)
        position = low + ((v >> np.uint64(32)).astype(np.float64) * 2.0 ** -32 * span).astype(np.int64)
        inside = position < count
        slot = (v & np.uint64(slots - 1)).astype(np.int64)
        np.minimum.at(flat, (doc * slots + slot)[inside], time[inside])
        touched = np.unique(doc) if len(doc) < size else np.arange(size)
        latest[touched] = earliest[touched].max(1)
    return earliest


def describe(column: pa.Array) -> dict[str, list]:
    """For each text: shingles counted, a 128-bit digest of the multiset, signature, band keys and packed shingles."""
    out: dict[str, list] = {k: [] for k in ("n_shingles", "digest_a", "digest_b", "signature", "bands", "bag")}
    for b in scan.blocks(column):
        keys, docs, counts = shingles(b)
        sums = np.zeros((2, b.size), np.uint64)
        for i, salt in enumerate((0x51ED270B, 0x2545F491)):
            np.add.at(sums[i], docs, scan.mix64(keys + np.uint64(salt)) * counts.astype(np.uint64))
        times = bag_minhash(keys, docs, counts, b.size)
        slots = scan.mix64(times.view(np.uint64))
        bands = np.zeros((b.size, BANDS), np.uint64)
        for j in range(BANDS):
            h = np.full(b.size, j + 1, np.uint64)
            for s in range(j * BAND_SLOTS, (j + 1) * BAND_SLOTS):
                h = scan.mix64(h * np.uint64(31) + slots[:, s])
            bands[:, j] = h
        bound = np.searchsorted(docs, np.arange(b.size + 1))
        small, counts32 = (keys >> np.uint64(32)).astype(np.uint32), counts.astype(np.uint32)
        total = np.add.reduceat(np.append(counts, 0), bound[:-1]) * (np.diff(bound) > 0)
        for d in range(b.size):
            i, j = bound[d], bound[d + 1]
            bag, c = small[i:j], counts32[i:j]
            # each shingle's hash; then, for repeated ones only, their places and counts
            many = np.flatnonzero(c > 1).astype(np.uint32)
            out["bag"].append(np.concatenate([[j - i], bag, many, c[many]]).astype(np.uint32).tobytes())
        out["n_shingles"] += total.tolist()
        out["digest_a"] += sums[0].view(np.int64).tolist()
        out["digest_b"] += sums[1].view(np.int64).tolist()
        out["signature"] += [r.tobytes() for r in slots.astype(np.uint32)]
        out["bands"] += bands.view(np.int64).tolist()
    return out


def _bag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(raw, np.uint32)
    n = int(x[0])
    counts = np.ones(n, np.int64)
    more = (len(x) - 1 - n) // 2
    counts[x[1 + n:1 + n + more]] = x[1 + n + more:]
    return x[1:1 + n], counts


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    (ka, ca), (kb, cb) = _bag(a), _bag(b)
    _, i, j = np.intersect1d(ka, kb, return_indices=True)
    both = np.minimum(ca[i], cb[j]).sum()
    return float(both / max(ca.sum() + cb.sum() - both, 1))


def _agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint32).reshape(-1, SLOTS)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint32).reshape(-1, SLOTS)
    return (x == y).mean(1)


def connected(links: DataFrame) -> DataFrame:
    """``links``: a, b (longs). Returns node, label: the least node of its component.

    Each round takes the least label among neighbours and then the label's own label; rounds grow with the logarithm of a
    component's diameter, and each is a table in the shared folder."""
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        own = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        own = written(own.join(of_label, "label").select("node", "old", F.least("label", "jump").alias("label")), "labels")
        labels = own.drop("old")
        if own.where("old <> label").isEmpty():
            return labels


def classes(docs: DataFrame) -> DataFrame:
    """One row a row of ``docs``: doc_id, class_id (least doc_id of the class), kept (the class's first row), n_shingles,
    n_links (verified links of its text to different texts), and the row's key columns."""
    names = {"n_shingles": "long", "digest_a": "long", "digest_b": "long", "signature": "binary", "bands": "array<bigint>", "bag": "binary"}
    rows = docs.select("doc_id", *row_key(docs), "text")
    rows = add_columns(rows, names, lambda batch: list(describe(batch.column("text")).values()), drop=["text"], rows=512)
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()), "signatures")
    digest = ["digest_a", "digest_b"]
    worded = rows.where("n_shingles > 0")
    # the first row of every distinct multiset stands for all its copies
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    texts = written(worded.groupBy(*digest).agg(first).select(*digest, "first", F.col("first.uid").alias("uid")), "texts")
    heads = rows.join(texts.select("uid"), "uid")
    members = written(heads.select("uid", F.explode("bands").alias("band")), "bands")
    buckets = members.groupBy("band").agg(F.min("uid").alias("head"), F.count("*").alias("n")).where("n > 1")
    members = written(_salted(members, buckets.select("band", "head"), "band"), "members")
    signature, bags = rows.select("uid", "signature"), rows.select("uid", "bag")
    signature = _among(signature, members)
    links = _linked(members.where("uid <> head").select(F.col("head").alias("a"), F.col("uid").alias("b")), signature, bags)
    labels = connected(links)
    members = members.select("band", "uid")
    for propose in [*(_random_partners(seed) for seed in range(1, ROUNDS + 1)), _across(bags)]:
        named = members.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
        more = propose(written(named, "labelled")).join(links, ["a", "b"], "left_anti")
        links = written(links.unionByName(_linked(more, signature, bags)), "links")
        labels = connected(links)
    degree = (links.select(F.col("a").alias("uid")).union(links.select(F.col("b").alias("uid")))
              .groupBy("uid").agg(F.count("*").alias("n_links")))
    texts = (texts.join(labels.withColumnRenamed("node", "uid"), "uid", "left").join(degree, "uid", "left")
             .withColumn("label", F.coalesce("label", "uid")))
    top = texts.groupBy("label").agg(F.min("first").alias("top"))
    texts = texts.join(top, "label").select(*digest, "top", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # texts without words have no digest to join on
    every = rows.select("doc_id", "__id", "__hash", "uid", "n_shingles", *[F.when(F.col("n_shingles") > 0, F.col(c)).alias(c) for c in digest])
    out = every.join(texts, digest, "left")
    return out.select("doc_id", F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("class_id"),
                      F.coalesce(F.col("top.uid") == F.col("uid"), F.lit(True)).alias("kept"), "n_shingles",
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "__id", "__hash")


def _salted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Inner join of many rows to a table with one row a key; keys with more than HOT of the rows go to SALTS tasks."""
    return skew_join(rows, keys, [key], buckets=SALTS, hot=heavy_hitters(rows, [key], HOT))


def _among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose uid may be in ``wanted``: those in its hash slots. A later join by uid is exact; this one only keeps
    most other rows out of the shuffle, and broadcasts at most FILTER_SLOTS numbers, however much is wanted."""
    slot = F.pmod(F.xxhash64("uid"), F.lit(FILTER_SLOTS)).alias("__slot")
    return rows.select("*", slot).join(F.broadcast(wanted.select(slot).distinct()), "__slot", "left_semi").drop("__slot")


def _linked(pairs: DataFrame, signature: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough: by signatures first, then exactly. Written."""
    pairs = pairs.distinct()
    side = lambda c: signature.select(F.col("uid").alias(c), F.col("signature").alias(f"of_{c}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b")
    pairs = add_columns(pairs, {"agree": "double"}, lambda t: [_agreement(t.column("of_a"), t.column("of_b"))], drop=["of_a", "of_b"])
    pairs = written(pairs.where(F.col("agree") >= PLAUSIBLE).select("a", "b"), "candidates")
    bags = _among(bags, pairs.select(F.explode(F.array("a", "b")).alias("uid")))
    p = (pairs.join(bags.select(F.col("uid").alias("b"), F.col("bag").alias("bag_b")), "b")
         .join(bags.select(F.col("uid").alias("a"), F.col("bag").alias("bag_a")), "a"))
    p = add_columns(p, {"similarity": "double"}, lambda t: [[overlap(x.as_py(), y.as_py()) for x, y in zip(t.column("bag_a"), t.column("bag_b"))]],
                    drop=["bag_a", "bag_b"], rows=512)
    return written(p.where(F.col("similarity") >= SIMILARITY).select("a", "b"), "links")


def _mixed(named: DataFrame, seed: int = 0) -> DataFrame:
    """Buckets with several components: n, the largest one's label (main), and a random member of it and of the others."""
    pick = F.min(F.struct(F.xxhash64(F.lit(seed), "band", "uid").alias("h"), "uid")).alias("pick")
    parts = named.groupBy("band", "label").agg(F.count("*").alias("n"), pick)
    main = (parts.groupBy("band").agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.max(F.struct("n", "label", "pick")).alias("top"))
            .where("labels > 1").select("band", "n", F.col("top.label").alias("main"), F.col("top.pick.uid").alias("inside")))
    others = (parts.drop("n").join(main, "band").where("label <> main").groupBy("band", "n", "main", "inside")
              .agg(F.min("pick").alias("pick")))
    return others.select("band", "n", "main", "inside", F.col("pick.uid").alias("outside"))


def _random_partners(seed: int):
    def propose(named: DataFrame) -> DataFrame:
        m = named.join(_mixed(named, seed), "band").where("label <> main")
        m = m.select("uid", F.explode(F.array("inside", "outside")).alias("other")).where("uid <> other")
        return m.select(F.least("uid", "other").alias("a"), F.greatest("uid", "other").alias("b"))

    return propose


def _elements(raw: bytes) -> np.ndarray:
    """A packed multiset as a set: a shingle's first occurrence is its hash, each further one a hash of its own."""
    keys, counts = _bag(raw)
    keys = keys.astype(np.uint64)
    many = np.flatnonzero(counts > 1)
    again = np.repeat(keys[many], counts[many] - 1)
    ends = np.cumsum(counts[many] - 1)
    nth = np.arange(len(again)) - np.repeat(ends - (counts[many] - 1), counts[many] - 1) + 1
    return np.concatenate([keys, scan.mix64(again + nth.astype(np.uint64) * _GOLDEN) | np.uint64(1 << 63)])


def _common(near: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Elements that several of a sample of texts hold, sorted, and in how many. They only order the elements: any order
    gives the same pairs, one by frequency the fewest candidates."""
    def count(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                bags = b.column("bag").slice(at, 512).to_pylist()
                e, n = np.unique(np.concatenate([_elements(x) for x in bags]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)), pa.array(n)], ["element", "n"])

    texts = near.count()
    share = F.pmod(F.xxhash64(F.lit(3), "uid"), F.lit(1 << 20)) < int(min(1.0, ORDER_TEXTS / max(texts, 1)) * (1 << 20))
    counted = (near.where(share).select("bag").mapInArrow(count, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
               .where("n > 1").orderBy(F.desc("n"), "element").limit(ORDER_ELEMENTS).toArrow())
    element, n = counted.column("element").to_numpy().view(np.uint64), counted.column("n").to_numpy()
    order = np.argsort(element)
    return element[order], n[order]


def _prefixes(near: DataFrame) -> DataFrame:
    """element, uid, label, size, at: the elements of each text, rarest first, of which one is common to any similar pair.

    Texts of sizes x >= y and similarity s share at least s * (x + y) / (1 + s) elements, so at least s * x of x's and
    2s / (1 + s) * y of y's own. The first common element of the two therefore stands among the first x - s * x + 1 and
    y - 2s / (1 + s) * y + 1. ``shorter``: it stands where the text may be the shorter of the two."""
    element, n = _common(near)
    shared = near.sparkSession.sparkContext.broadcast((element, n))
    names = ["element", "uid", "label", "size", "at", "shorter"]

    def cut(batches):
        element, n = shared.value
        for b in batches:
            for start in range(0, b.num_rows, 512):
                part = b.slice(start, 512)
                out: list[list[np.ndarray]] = [[] for _ in names]
                for uid, label, raw in zip(*(part.column(c).to_pylist() for c in ("uid", "label", "bag")), strict=True):
                    e = _elements(raw)
                    place = np.minimum(np.searchsorted(element, e), max(len(element) - 1, 0))
                    often = np.where(element[place] == e, n[place], 0) if len(element) else np.zeros(len(e), np.int64)
                    size = len(e)
                    keep = size - int(np.ceil(SIMILARITY * size - 1e-6)) + 1
                    e = e[np.lexsort((e, often))[:keep]]
                    at = np.arange(len(e))
                    short = at <= size - int(np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * size - 1e-6))
                    for o, v in zip(out, (e.view(np.int64), np.full(len(e), uid), np.full(len(e), label), np.full(len(e), size), at, short), strict=True):
                        o.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names)

    return near.select("uid", "label", "bag").mapInArrow(cut, "element long, uid long, label long, size long, at long, shorter boolean")


def _in_blocks(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the pair join on element, out, home: an element's members outside its largest component, and all of
    its members, each dealt into blocks of about BLOCK_TEXTS; every block meets every block of the other side."""
    parts = found.groupBy("element", "label").agg(F.count("*").alias("n"))
    main = parts.groupBy("element").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK_TEXTS).cast("int")
    main = main.select("element", F.col("top.label").alias("main"), blocks(F.col("n")).alias("homes"), blocks(F.col("n") - F.col("top.n")).alias("outs"))
    found = _salted(found, main.where("outs > 0"), "element")
    block = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "uid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = found.where("label <> main").withColumn("out", block(1, "outs")).withColumn("home", every("homes"))
    return left, found.withColumn("home", block(2, "homes")).withColumn("out", every("outs"))


def _across(bags: DataFrame):
    """Every pair of texts of different components that may be similar, of all texts in buckets that hold several.

    Texts that only share a passage have it behind their rarer shingles, so that it pairs nothing, however many they are."""
    def propose(named: DataFrame) -> DataFrame:
        near = named.join(_mixed(named).select("band"), "band").select("uid", "label").distinct()
        near = written(near.join(_among(bags, near), "uid"), "mixed")
        found = written(_prefixes(near), "prefixes")
        mixed = (found.groupBy("element").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max("shorter").alias("paired"))
                 .where("least <> most and paired").select("element"))
        found = written(_salted(found, mixed, "element"), "shared")
        left, right = _in_blocks(found)
        pairs = left.alias("l").join(right.alias("r"), ["element", "out", "home"])
        need = F.ceil(F.lit(SIMILARITY / (1 + SIMILARITY)) * (F.col("l.size") + F.col("r.size")) - 1e-6)
        rest = F.least(F.col("l.size") - F.col("l.at"), F.col("r.size") - F.col("r.at"))
        pairs = pairs.where((F.col("l.label") != F.col("r.label")) & (rest >= need))
        return pairs.select(F.least("l.uid", "r.uid").alias("a"), F.greatest("l.uid", "r.uid").alias("b")).distinct()

    return propose


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the first row of every class, all columns."""
    docs = docs.drop("__id", "__hash")
    kept = classes(docs).where("kept").select("__id", "__hash")
    keyed = docs.select("*", *row_key(docs))
    others = [f.name for f in docs.schema if f.name != "text" and "map<" not in f.dataType.simpleString()]
    # rows of one id and text: the same one on every run
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*others)).alias("x")
    return keyed.join(kept, ["__id", "__hash"]).groupBy("__id", "__hash").agg(one).select(*[F.col("x")[c].alias(c) for c in docs.columns])
