"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

1. Shingles are five words. Their weight is (1 + ln tf) x idf, where idf is ln(N / df) / ln N with `share` None (the
   query and the pipeline): the inverse document frequency, in units of that of a shingle of one document (a unit
   changes no similarity), LEAST at least. With a share it is ln(N / df) / ln(1 / share), 1 at most. Every shingle is
   counted: those of all texts travel packed to a part of their hash, are counted there, and the numbers of those in
   several documents travel back to their texts, by a hash of the text; so neither a task nor the driver holds them all.
2. Each document draws BANDS x ROWS weighted samples (Ioffe 2010); a band's samples make a bucket key. Documents
   of the same words are one node.
3. In a bucket every node is compared with a hub, its least node; buckets that still hold several classes then take
   HUBS more hubs, and only nodes of another class than their hub's are compared. The nodes of buckets that are mixed
   after that get prefixes: their rarest shingles, so many that a pair as similar as `least` has one in common. Nodes
   of a prefix shingle that stands in several classes are compared with its least node; nodes without such a shingle,
   and pairs that have one for themselves, are settled then, so documents that share no more than boilerplate end here.
   Where a bucket is still mixed, the nodes outside its largest class meet each other and that class in blocks of
   BLOCK, and there only nodes of different classes are compared, a link joining its classes at once; so no group is
   held whole by a task, pairs within a class are not made, and a large class costs a row for each block of the others.
4. A pair is a link if the weighted Jaccard similarity of its whole vectors is at least `least`; classes are the
   connected components of the links. With `plain` (the query and the pipeline) a pair is also a link if the Jaccard
   similarity of its sets of shingles is: a group's own number lowers the weights of what its members share, but not
   of their edits. Bands are then drawn from unit weights too.

Null and empty texts, and those of white space only, are alone in their class. Texts under five words have one
shingle, of all their words. Repeated rows share their class; a row without doc_id has the class of its text if
another row with one holds it, else none. Other columns are ignored; an empty table gives no
rows. The class id is the smallest doc_id of the class. Case and white space don't count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, hash_long, materialize, member_filter, mix, partitions_for, shingle_hashes, small_batches, tidy, word_hashes
from .graph import components
from .op3_chains import PACK, _batch, _by, _starts, unpack

WORDS, BANDS, ROWS, RARE, LEAST, BLOCK, HUBS, HEAVIEST = 5, 10, 3, 0.1, 0.05, 256, 2, 1000
_ID = np.uint64((1 << 52) - 1)
LINK = "a binary, b binary, similarity double"


def _vectors(texts: list[str], chars: int = 500_000) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first index, digests of the word sequences (empty: no words), and the distinct shingles
    in order of text and hash, as text indices within the run, 52-bit hashes and counts."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and hi - lo < 2048 and (size == 0 or size + len(texts[hi]) <= chars):
            size += len(texts[hi])
            hi += 1
        h, doc, _, _ = word_hashes(texts[lo:hi])
        cuts = np.searchsorted(doc, np.arange(hi - lo + 1)).tolist()
        raw = memoryview(h.tobytes())
        digest = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else b"" for a, b in zip(cuts, cuts[1:])]
        s, d, _ = shingle_hashes(h, doc, WORDS)
        key = np.sort(d.astype(np.uint64) << np.uint64(52) | s >> np.uint64(12))
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate((at, [len(key)])))
        key = key[at]
        yield lo, digest, (key >> np.uint64(52)).astype(np.int64), key & _ID, count
        lo = hi


def _occurrences(parts: int, most: int = 1_500_000):
    """The shingles of the texts (key, text) by part, packed: the text's key, the shingle, and the rows with that text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        docs = size = 0

        def close() -> pa.RecordBatch:
            key, of, ids = (np.concatenate(c) for c in zip(*held))
            # a text that the block repeats goes out once, with its number
            _, first, back, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            own = first[back[of]] == of
            of, ids = of[own], ids[own].astype(np.int64)
            return _batch(_by(ids % parts, 0, key[of], ids // parts, n[back[of]]))

        for batch in batches:
            keys, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for lo, digest, doc, ids, _ in _vectors(texts):
                held.append((keys[lo : lo + len(digest)], doc + docs, ids))
                docs, size = docs + len(digest), size + len(ids)
            if size >= most:
                yield close()
                held, docs, size = [], 0, 0
        if held:
            yield close()

    return run


def _count(parts: int):
    """The documents of each shingle of a part, packed by part of the text's key, for shingles in several: key, shingle, df."""

    def run(table: pa.Table) -> pa.Table:
        key, ids, n = unpack(table.column("data").to_pylist(), 3)
        order = np.argsort(ids)
        key, ids, n = key[order], ids[order], n[order]
        begin = _starts(ids)
        df = np.repeat(np.add.reduceat(n, begin), np.diff(np.append(begin, len(ids)))) if len(ids) else ids
        several = df > 1
        key, ids, df = key[several], ids[several], df[several]
        order = np.argsort(key, kind="stable")
        key, ids, df = key[order], ids[order], df[order]
        rows = _by(hash_long(key).astype(np.int64) % parts, 0, key, ids * parts + table.column("key")[0].as_py(), df)
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _by_text(table: pa.Table) -> pa.Table:
    """For each text of a part its shingles in several documents: 64-bit hashes, in order, then 32-bit numbers of documents."""
    key, ids, df = unpack(table.column("data").to_pylist(), 3)
    order = np.argsort(ids)
    order = order[np.argsort(key[order], kind="stable")]
    key, ids, df = key[order], ids[order], df[order]
    one = _starts(key, ids)  # copies of a text come from several blocks
    key, ids, df = key[one], ids[one], df[one]
    begin = _starts(key)
    cuts = np.append(begin, len(key)).tolist()
    out = pa.table([pa.array(key[begin]), pa.array([ids[a:b].astype("<u8").tobytes() + df[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["key", "frequent"])
    give_back()
    return out


def document_frequencies(texts: DataFrame, part_bytes: int = 4 << 20) -> DataFrame:
    """Of texts(key, text) for each key that has any: the shingles that several documents hold, and in how many (all
    rows count), as _by_text packs them; exact over all texts."""
    parts = partitions_for(texts, part_bytes, 16)
    grouped_by = lambda df: df.repartition(parts, "key").groupBy("key")
    scanned = texts.select("key", "text").mapInArrow(tidy(_occurrences(parts)), PACK)
    counted = grouped_by(scanned).applyInArrow(_count(parts), PACK)
    return materialize(grouped_by(counted).applyInArrow(_by_text, "key long, frequent binary"), "op9-frequencies")


def idf(df: np.ndarray, docs: int, share: float | None) -> np.ndarray:
    """Inverse document frequency, 1 for one document, or (with a share) for up to that share of all documents."""
    return np.clip(np.log(docs / df) / np.log(1 / share if share else max(docs, 2)), LEAST, 1)


def weights(doc: np.ndarray, ids: np.ndarray, count: np.ndarray, frequent: list[bytes | None], docs: int, share: float | None) -> np.ndarray:
    """TF-IDF weight of each shingle of a run of documents, from the numbers that _by_text gives for each of these."""
    w = np.ones(len(ids))
    more = np.flatnonzero(count > 1)
    w[more] = 1 + np.log(count[more])
    own = [(i, np.frombuffer(f, "<u8", len(f) // 12), np.frombuffer(f, "<u4", len(f) // 12, len(f) // 12 * 8)) for i, f in enumerate(frequent) if f]
    if own:
        name = lambda doc, ids: doc.astype(np.uint64) << np.uint64(52) | ids
        asked = name(np.repeat([i for i, _, _ in own], [len(x) for _, x, _ in own]), np.concatenate([x for _, x, _ in own]))
        w[np.searchsorted(name(doc, ids), asked)] *= idf(np.concatenate([n for _, _, n in own]), docs, share)
    return w


def _draws(k: int):
    """Tables of r and ln c (both Gamma(2, 1)) by 16 bits of a mixed hash, and the odd factors of k samples."""
    rng = np.random.default_rng(20)
    gamma = np.sort(rng.gamma(2.0, 1.0, 1 << 16))
    return gamma.astype(np.float32), np.log(gamma).astype(np.float32), mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


_R, _LNC, _ODD = _draws(256)


def samples(doc: np.ndarray, ids: np.ndarray, w: np.ndarray, k: int, at_once: int = 1 << 15, plain: bool = False) -> tuple[np.ndarray, ...]:
    """Documents that have shingles, and their k consistent weighted samples (documents, k) as 64-bit numbers; with
    `plain` also those of unit weights, from the same hashes.

    For a shingle of weight w: t = floor(ln w / r + b), ln y = r (t - b), ln a = ln c - ln y - r; the shingle with
    the least a is drawn, together with its t. The drawn number holds ln a (order kept) above the shingle's name, which
    is made for what is drawn alone; equal ln a are ordered as the document's shingles are, by hash.
    """
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else np.zeros(0, np.int64)
    out, unit = np.empty((len(first), k), np.uint64), np.empty((len(first), k if plain else 0), np.uint64)
    # |ln a| <= |ln c| + |ln w| + 2 r, so 1024 more is positive and keeps the order as bits
    bits = lambda lna: (lna + np.float32(1024)).view(np.uint32).astype(np.uint64) << np.uint64(32)
    ends = np.append(first[1:], len(doc))
    lo = 0
    while lo < len(first):
        hi = int(np.searchsorted(ends, first[lo] + at_once, side="right"))
        hi = max(hi, lo + 1)
        a, b = first[lo], ends[hi - 1]
        s = mix(ids[a:b])
        place = np.arange(b - a, dtype=np.uint64)
        lnw = np.log(w[a:b]).astype(np.float32)
        odd = np.flatnonzero(lnw)
        starts = first[lo:hi] - a
        for j in range(k):
            x = s * _ODD[j]
            parts = x.view(np.uint16).reshape(-1, 4)
            r, lnc = _R.take(parts[:, 3]), _LNC.take(parts[:, 2])
            beta = parts[:, 1] * np.float32(2**-16)
            packed = bits(lnc - r * (1 - beta)) | place  # where ln w = 0, t is 0
            if plain:
                least = np.minimum.reduceat(packed, starts)
                unit[lo:hi, j] = least & ~np.uint64(0xFFFFFFFF) | s[(least & np.uint64(0xFFFFFFFF)).astype(np.int64)] & np.uint64(0xFFFFFFFF)
            if len(odd):
                ro, bo = r[odd], beta[odd]
                packed[odd] = bits(lnc[odd] - ro * (np.floor(lnw[odd] / ro + bo) - bo + 1)) | place[odd]
            least = np.minimum.reduceat(packed, starts)
            at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            t = np.floor(lnw[at] / r[at] + beta[at]).astype(np.int64)
            name = np.where(lnw[at] != 0, mix(s[at] + (t * 2 + 1).astype(np.uint64)), s[at])
            out[lo:hi, j] = least & ~np.uint64(0xFFFFFFFF) | name & np.uint64(0xFFFFFFFF)
        lo = hi
    return (doc[first], out, unit) if plain else (doc[first], out)


def _keys(got: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket keys (documents, bands) of the samples."""
    keys = np.zeros((len(got), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(got), b + 1, np.uint64)
        for j in range(b * rows, (b + 1) * rows):
            key = mix(key ^ (got[:, j] & np.uint64(0xFFFFFFFF)) * np.uint64(0xD1342543DE82EF95))
        keys[:, b] = key
    return keys


def _sign(docs: int, share: float | None, bands: int, rows: int, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, frequent = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, digest, doc, sh, count in _vectors(batch.column(1).to_pylist()):
                w = weights(doc, sh, count, frequent[lo : lo + len(digest)], docs, share)
                have, got, *unit = samples(doc, sh, w, bands * rows, plain=plain)
                by = dict(zip(have.tolist(), _keys(got, bands, rows).view(np.int64).tolist()))
                if plain:
                    # where all weights are 1 the samples are those of unit weights
                    other = np.zeros(len(digest), bool)
                    other[doc[w != 1]] = True
                    some = other[have]
                    for i, keys in zip(have[some].tolist(), _keys(unit[0][some], bands, rows).view(np.int64).tolist()):
                        by[i] += keys
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo : lo + len(digest)], pa.int64()), pa.array(digest, pa.binary()), pa.array([by.get(i) for i in range(len(digest))], pa.list_(pa.int64()))], names=["doc_id", "node", "bands"])

    return run


def _pack_vectors(docs: int, share: float | None):
    """Whole vectors of the documents, for comparison: their number of shingles, 52-bit hashes (7 byte planes would save
    little), and places and weights of those whose weight is not 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frequent = batch.column(1).to_pylist()
            for lo, digest, doc, sh, count in _vectors(batch.column(0).to_pylist()):
                w = weights(doc, sh, count, frequent[lo : lo + len(digest)], docs, share)
                cuts = np.searchsorted(doc, np.arange(len(digest) + 1)).tolist()
                data = []
                for a, b in zip(cuts, cuts[1:]):
                    odd = np.flatnonzero(w[a:b] != 1)
                    data.append(np.uint32(b - a).tobytes() + sh[a:b].tobytes() + odd.astype("<u4").tobytes() + w[a:b][odd].astype("<f8").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(data, pa.binary())], names=["node", "vector"])

    return run


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    odd = (len(data) - 4 - 8 * n) // 12
    w = np.ones(n)
    w[np.frombuffer(data, "<u4", odd, 4 + 8 * n)] = np.frombuffer(data, "<f8", odd, 4 + 8 * n + 4 * odd)
    return np.frombuffer(data, np.uint64, n, 4), w


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of least over sum of greatest weights; (hashes in order, weights) each."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    hit = np.flatnonzero(a[0][at] == b[0]) if len(a[0]) else np.zeros(0, np.int64)
    both = np.minimum(a[1][at[hit]], b[1][hit]).sum()
    return float(both / max(a[1].sum() + b[1].sum() - both, 1e-300))


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], plain: bool) -> float:
    """Weighted Jaccard similarity; with `plain` that of the sets of shingles if it is greater."""
    sim = weighted_jaccard(a, b)
    return max(sim, weighted_jaccard((a[0], np.ones(len(a[0]))), (b[0], np.ones(len(b[0]))))) if plain else sim


def _compare(least: float, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            sims = []
            for na, nb, va, vb in zip(a, b, batch.column("va").to_pylist(), batch.column("vb").to_pylist()):
                if nb not in known:
                    known = {nb: _unpack(vb)}  # the hub stays while its rows follow each other
                sims.append(_similarity(_unpack(va), known[nb], plain))
            ok = np.flatnonzero(np.array(sims) >= least - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in ok], pa.binary()), pa.array([b[i] for i in ok], pa.binary()), pa.array([sims[i] for i in ok], pa.float64())], names=["a", "b", "similarity"])

    return run


def _compare_blocks(least: float, plain: bool):
    """Links between nodes of different classes in two blocks of a bucket (or in one block), as far as classes need
    them: a link joins its classes at once, so later pairs of theirs are skipped. A pair is left to the least
    bucket that both nodes share."""

    def run(table: pa.Table) -> pa.Table:
        key = table.column("bucket")[0].as_py()
        alone = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        rows = sorted(zip(table.column("side").to_pylist(), table.column("label").to_pylist(), table.column("node").to_pylist(), table.column("bands").to_pylist(), table.column("vector").to_pylist()), key=lambda r: r[:3])
        up: dict = {r[1]: r[1] for r in rows}

        def top(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        vec = [_unpack(r[4]) for r in rows]
        size = [v[1].sum() for v in vec]
        near = lambda a, b: min(a, b) >= (least - 1e-9) * max(a, b)
        out = []
        # classes with many nodes first: their links settle most pairs
        many: dict = {}
        for r in rows:
            many[r[1]] = many.get(r[1], 0) + 1
        order = sorted(range(len(rows)), key=lambda i: (many[rows[i][1]], rows[i][1]))
        for x in range(len(order)):
            for y in range(len(order) - 1, x, -1):
                i, j = order[x], order[y]
                if (not alone and rows[i][0] == rows[j][0]) or top(rows[i][1]) == top(rows[j][1]) or not (near(size[i], size[j]) or (plain and near(len(vec[i][0]), len(vec[j][0])))):
                    continue
                if min(set(rows[i][3]).intersection(rows[j][3])) != key:
                    continue
                sim = _similarity(vec[i], vec[j], plain)
                if sim >= least - 1e-9:
                    up[top(rows[i][1])] = top(rows[j][1])
                    out.append((rows[i][2], rows[j][2], sim))
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.float64())], names=["a", "b", "similarity"])

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of packed vectors."""
    for batch in batches:
        node, data = batch.column("node"), batch.column("vector").to_pylist()
        many = [int.from_bytes(d[:4], "little") for d in data]
        ids = np.concatenate([np.frombuffer(d, np.int64, n, 4) for n, d in zip(many, data)]) if data else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([node.take(pa.array(np.repeat(np.arange(len(many)), many))), pa.array(ids)], names=["node", "bucket"])


def _prefix(least: float, plain: bool):
    """Of the shingles that other nodes hold too (shingle and number of nodes), those in a node's prefix.

    The order is one for all nodes: by number of nodes, then by hash. The prefix ends where what follows weighs less
    than `least` of the whole: the first shingle that a pair has in common in this order is then in both prefixes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, held in zip(batch.column("vector").to_pylist(), batch.column("held")):
                ids, w = _unpack(data)
                n = np.ones(len(ids), np.int64)
                if held.is_valid:
                    n[np.searchsorted(ids, held.values.field("bucket").to_numpy().astype(np.uint64))] = held.values.field("n").to_numpy()
                order = np.lexsort((ids, n))
                end = 0
                for x in (w, np.ones(len(ids))) if plain else (w,):
                    rest = np.cumsum(x[order][::-1])[::-1]
                    end = max(end, int((rest >= (least - 1e-6) * rest[0]).sum()))
                own = order[:end]
                out.append(ids[own[n[own] > 1]].astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.list_(pa.int64()))], names=["node", "prefix"])

    return run


def _of_bucket(members: DataFrame, stat: DataFrame, total: int) -> DataFrame:
    """Join rows of buckets with `stat` (a row for each bucket, with its number n of nodes). Buckets above one in
    HEAVIEST of all `total` rows, of which there are at most HEAVIEST, are broadcast: no task gets a large one whole."""
    large = stat.filter(F.col("n") * HEAVIEST > total)
    return members.join(F.broadcast(large), "bucket").unionByName(members.join(stat.filter(F.col("n") * HEAVIEST <= total), "bucket"))


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members with the class of each node so far: its label, or itself where it has no link."""
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, label) after more links: only the classes that these join are settled anew."""
    side = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    joined = links.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    joined = materialize(joined.filter("a != b").distinct(), "op9-joined")
    if joined.isEmpty():
        return labels
    moved = components(joined)
    known = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("new")), "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return materialize(known.unionByName(moved.join(labels, "node", "left_anti")), "op9-labels")


def classes(docs: DataFrame, least: float = 0.8, bands: int = BANDS, rows: int = ROWS, plain: bool = False, share: float | None = RARE) -> DataFrame:
    """doc_id and class_id of every row of `docs` (doc_id, text); with `plain` the similarity of a pair is no less
    than the Jaccard similarity of its sets of shingles; idf is full with `share` None, else 1 up to that share."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    frequencies = document_frequencies(texts)
    many = texts.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).count()
    counted = lambda some: some.join(frequencies, "key", "left")
    signed = materialize(counted(texts).select("doc_id", "text", "frequent").mapInArrow(tidy(_sign(many, share, bands, rows, plain)), "doc_id long, node binary, bands array<long>"), "op9-signed")
    nodes = materialize(signed.filter("bands IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")), "op9-nodes")

    # nodes that share a bucket with another
    every = nodes.select("node", F.posexplode("bands").alias("band", "bucket")).select("node", F.xxhash64(F.col("band") % bands, "bucket").alias("bucket"))
    every = every.distinct() if plain else every
    stat = materialize(every.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "op9-buckets")
    total = stat.agg(F.sum("n")).first()[0] or 0
    members = materialize(_of_bucket(every, stat, total), "op9-members")
    # copies of a text have one vector; the text with the smallest doc_id gives it
    shared = members.select("node").distinct()
    wanted = shared.join(nodes, "node").select("doc_id").distinct()
    some = texts.mapInArrow(member_filter(wanted, "doc_id"), texts.schema)
    packed = counted(some.join(wanted, "doc_id", "left_semi")).select("text", "frequent").mapInArrow(tidy(_pack_vectors(many, share)), "node binary, vector binary")
    vectors = materialize(packed.join(shared, "node", "left_semi").dropDuplicates(["node"]), "op9-vectors")
    va, vb = vectors.select(F.col("node").alias("a"), F.col("vector").alias("va")), vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"))

    def compared(pairs: DataFrame) -> DataFrame:
        return pairs.distinct().join(va, "a").join(vb, "b").mapInArrow(tidy(_compare(least, plain)), LINK)

    labels = components(materialize(compared(members.filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))), "op9-links"))
    left = members.select("node", "bucket")
    for turn in range(HUBS):
        # buckets of several classes, and another of their nodes
        left = materialize(_labelled(left, labels), "op9-left")
        hub = F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "label")).alias("hub")
        mixed = materialize(left.groupBy("bucket").agg(hub, (F.min("label") != F.max("label")).alias("mixed"), F.count("*").alias("n")).filter("mixed").drop("mixed"), "op9-mixed")
        if mixed.isEmpty():
            break
        left = materialize(_of_bucket(left, mixed, mixed.agg(F.sum("n")).first()[0]), "op9-left")
        links = materialize(compared(left.filter("label != hub.label").select(F.col("node").alias("a"), F.col("hub.node").alias("b"))), "op9-links")
        labels, left = _merged(labels, links), left.select("node", "bucket")
    else:
        # the prefixes of the nodes left, from the numbers of nodes that hold each shingle
        some = vectors.join(left.select("node").distinct(), "node", "left_semi")
        shingles = some.mapInArrow(tidy(_shingles), "node binary, bucket long")
        often = materialize(shingles.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "op9-often")
        held = _of_bucket(shingles, often, often.agg(F.sum("n")).first()[0] or 0).groupBy("node").agg(F.collect_list(F.struct("bucket", "n")).alias("held"))
        prefixes = some.join(held, "node", "left").mapInArrow(tidy(_prefix(least, plain)), "node binary, prefix array<long>")
        prefixes = materialize(prefixes.select("node", F.explode("prefix").alias("bucket")), "op9-prefixes")

        def mixed_prefixes(more: str) -> DataFrame:
            stat = _labelled(prefixes, labels).groupBy("bucket").agg(F.min("node").alias("hub"), F.min_by("label", "node").alias("first"), (F.min("label") != F.max("label")).alias("mixed"), F.count("*").alias("n"))
            stat = materialize(stat.filter("mixed").filter(more), "op9-mixed")
            return _of_bucket(prefixes, stat, stat.agg(F.sum("n")).first()[0] or 0)

        pairs = _labelled(mixed_prefixes("n > 1"), labels).filter("label != first").select(F.col("node").alias("a"), F.col("hub").alias("b"))
        labels = _merged(labels, materialize(compared(pairs), "op9-links"))
        left = left.join(mixed_prefixes("n > 2").select("node").distinct(), "node", "left_semi")
        left = materialize(_labelled(left, labels), "op9-left")
        size = left.groupBy("bucket", "label").agg(F.count("*").alias("size"))
        largest = size.groupBy("bucket").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), F.max("size").alias("most"), F.sum("size").alias("n")).filter("most < n")
        left = _of_bucket(left, materialize(largest, "op9-largest"), left.count())
        # the largest class's blocks come after those of the other nodes, and meet these alone
        blocks = lambda x: F.ceil(x / F.lit(float(BLOCK))).cast("int")
        left = left.withColumns({"others": blocks(F.col("n") - F.col("most")), "own_class": F.col("label") == F.col("largest")})
        left = left.withColumn("own", F.when(F.col("own_class"), F.col("others") + F.pmod(F.hash("node"), blocks(F.col("most")))).otherwise(F.pmod(F.hash("node"), F.col("others"))))
        meets = F.when(F.col("own_class"), F.col("others")).otherwise(F.col("others") + blocks(F.col("most")))
        left = left.withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1)))
        left = left.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "node", "label")
        left = left.join(nodes.select("node", F.transform("bands", lambda k, i: F.xxhash64(i % bands, k)).alias("bands")), "node").join(vectors, "node")
        labels = _merged(labels, materialize(left.groupBy("bucket", "i", "j").applyInArrow(_compare_blocks(least, plain), LINK), "op9-links"))
    of = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least_id = of.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    of = of.join(least_id, "label").select("node", "class_id")
    out = signed.select("doc_id", "node").join(of, "node", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def keep(docs: DataFrame, least: float = 0.8, plain: bool = False, share: float | None = RARE) -> DataFrame:
    """One document of each class, the one with the smallest doc_id (null last), with all columns.

    Rows without an id, and rows whose ids are not their own, get numbers beyond the others' for the comparison. Null
    and empty texts are alone in their class and stay; columns may have any names; an empty table stays empty.
    """
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    many = docs.groupBy("id").agg(F.count("*").alias("times"), F.max("id").alias("top"))
    odd = many.filter("id IS NULL OR times > 1").select("id")
    if odd.isEmpty():
        rows = docs.select("row", "id", F.col("id").alias("doc_id"), "text")
    else:
        low, top = many.agg(F.min("id"), F.max("id")).first()
        base, sign = ((top or 0) + 1, 1) if (top or 0) < 1 << 62 else (low - 1, -1)
        odd = odd.withColumn("odd", F.lit(True)).withColumnRenamed("id", "odd_id")
        marked = docs.join(odd, F.col("id").eqNullSafe(F.col("odd_id")), "left")
        number = F.when(F.col("odd"), F.lit(base) + F.lit(sign) * F.monotonically_increasing_id()).otherwise(F.col("id"))
        rows = materialize(marked.select("row", "id", number.alias("doc_id"), "text"), "op9-numbered")
    label = classes(rows.select("doc_id", "text"), least, plain=plain, share=share)
    ids = rows.select("doc_id", "id")
    best = label.join(ids, "doc_id").groupBy("class_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")).alias("best"))
    return rows.join(best.select(F.col("best.doc_id").alias("doc_id")), "doc_id", "left_semi").select("row.*")
