"""Substring dedup by collinear chaining: passages that repeat, also with changes, across documents.

1. Seeds are all runs of K words. They travel packed, by parts of their hash; a part keeps those that several
   documents hold. A passage of n words and identity s shares at least s n - (K - 1) ((1 - s) n + 1) seeds with its
   match (7 for 50 words at 0.8), so pairs and chains of fewer are left out.
2. Texts of the same words are one: a text is linked as a whole to its first document, first within a block of texts
   (where only that one's seeds go out), then overall; so a text that a third of all rows share is a row for a block.
3. First each occurrence of a seed is linked to the seed's occurrences in its first document (least doc_id), so a
   passage that a third of all documents hold gives one match for each of them.
4. Anchors travel packed, by buckets of their document. Those in a row on one diagonal are one segment; the segments
   of a pair of documents are chained in order of both positions with a cost for gaps: a Fenwick tree of prefix
   maxima finds each segment's best predecessor in logarithmic time. A gap of more than WIDE words ends a chain.
5. Chains are aligned by bucket: it gets the words of both stretches, with a margin, once for all its chains. They are
   compared, stretches between segments by edit distance. Passages of at least `least_words` words and `identity` are returned; a chain
   below that identity is parted at its widest gap.
6. Seeds outside these passages that stand dense enough for one are then linked to every earlier document that holds
   them, and steps 4 and 5 repeat. Seeds with more than HOT occurrences are linked there to their first document, to
   the first in which they are still outside a passage, and to every earlier document that meets theirs in JOINT rare pairs
   of words: a passage of n columns, w of them wrong and g of these missing on a side, leaves at most 2 w - g of that side's
   n - 1 - g pairs of neighbouring words unmatched, so in whatever order of pairs both sides have JOINT common ones among
   those that no more than 2 w - g + JOINT - 1 pairs precede, and one that no more than 2 w - g precede (an exact prefix filter; a pair that stands several times counts as often). Both sides give such pairs of the stretches of least_words to 2 least_words - 1 columns around
   frequent seeds, a longer passage has such a stretch or one of other seeds alone, by which its documents are linked already,
   and documents that meet or are linked by enough other seeds are linked by all frequent ones they share. The
   order is by counts in all texts: it decides how many documents meet, not which passages are found.
7. What that leaves out is found by longer seeds: of each window of `least_words` words whose seeds all stand in
   earlier documents and of which a word is in no passage, and of each of LONGER words that stands dense and outside passages, the
   first document that holds the window itself is found (a scan of the texts, and a minimum for each window), and
   steps 4 and 5 repeat with these windows' seeds. So every word of a repeat of `least_words` equal words is in a passage,
   however frequent its seeds are; where nothing is left over this step ends before the scan.

One row for each passage of a document that an earlier document also has: doc_id, start_word, end_word, match_id,
match_start, match_end, identity; words are runs without ASCII white space, positions count from 0, case doesn't
count. Of a seed that stands n times in a document and m times in its match all pairs are anchors, where these are
more than REPEATS the occurrences in turn, counted from the first and from the last. Null and empty texts and repeated
rows have no passages of their own (a row repeated under its doc_id is the same document); rows without doc_id take no
part; should different texts share a doc_id, their seeds are pooled and compared with the first of these texts.
Repeats within one document are not reported. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, hash_long, materialize, member_filter, mix, partitions_for, shingle_hashes, small_batches, tidy, word_hashes

K, GAP, MARGIN, BLOCK, HOT, REPEATS, WIDE, LONGER = 4, 0.1, 50, 256, 256, 64, 256, 16
#: Packed rows by part of the seeds' hash or by bucket of the documents.
PACK = "key int, kind int, data binary"
_PACK = pa.schema([("key", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
#: Kinds by part: occurrences of seeds (seed, doc, pos), whole texts (digest, doc, words), links of whole texts
#: (doc, match, words). Kinds by bucket: anchors (doc, match, x, y, seed), links as before, occurrences of frequent seeds
#: (doc, seed, pos, left over or not). Of documents near frequent seeds: pairs of words (pair, doc, four times their
#: number, twice whether one may be the first common one, and whether left over) by part, documents that meet (match, doc,
#: number and 256 more if one may be the first) by the match's bucket, then (match, doc) by the document's, and there once
#: what its matches hold (match, seed, y). Chains: their segments (doc, match, number of the chain, x0, y0, words).
SEEDS, TEXTS, LINKS, ANCHORS, FREQUENT, NEIGHBOURS, MEET, THEIRS, CHAINS = range(9)
#: So many pairs of words must be common at least, where so many are sure to be.
JOINT = 4
#: The order of pairs of words: by their slot's count in all texts, in steps of the mean count; slots travel in so many ranges.
SLOTS, RANGES, STEPS = 1 << 22, 16, (2, 4, 8, 32, 128, 512)
PASSAGE = "doc_id long, start_word int, end_word int, match_id long, match_start int, match_end int, identity double"


def _runs(texts: list[str], chars: int = 500_000) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (size == 0 or size + len(texts[hi]) <= chars):
            size += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as compressed byte planes of their differences."""
    n = len(columns[0])
    planes = [np.ascontiguousarray(np.diff(c.astype("<i8"), prepend=np.int64(0)).view(np.uint8).reshape(n, 8).T) for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in planes))


def unpack(rows: list[bytes], columns: int) -> list[np.ndarray]:
    """The columns of all packed rows, one row's after another's."""
    got: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(columns)]
    for data in rows:
        planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(columns, 8, -1)
        for own, p in zip(got, planes):
            own.append(np.cumsum(np.ascontiguousarray(p.T).view("<i8").ravel()))
    return [np.concatenate(own) for own in got]


def _by(keys: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple]:
    """Packed rows of the columns by key, each in the order given."""
    small = len(keys) and keys.min() >= 0 and keys.max() < 1 << 16  # such are sorted by their digits
    order = np.argsort(keys.astype(np.uint16) if small else keys, kind="stable")
    keys, columns = keys[order], [c[order] for c in columns]
    cuts = np.append(_starts(keys), len(keys)).tolist()
    return [(int(keys[a]), kind, pack(*(c[a:b] for c in columns))) for a, b in zip(cuts, cuts[1:])]


def _batch(rows: list[tuple], schema: pa.Schema = _PACK) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def _kind(table: pa.Table, kind: int) -> list[bytes]:
    return [d for k, d in zip(table.column("kind").to_pylist(), table.column("data").to_pylist()) if k == kind]


def _starts(*same: np.ndarray) -> np.ndarray:
    """Where a run of equal values (of all columns) begins."""
    return np.flatnonzero(np.concatenate(([True], np.any([c[1:] != c[:-1] for c in same], axis=0)))) if len(same[0]) else np.zeros(0, np.int64)


def _first_of(name: np.ndarray, words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each text the index of the text of the same words with the least document."""
    order = np.lexsort((doc, words, name))
    begin = _starts(name[order], words[order])
    out = np.empty(len(doc), np.int64)
    out[order] = np.repeat(order[begin], np.diff(np.append(begin, len(doc))))
    return out


def _scan(parts: int, least_words: int, most: int = 1_500_000):
    """All seeds of the texts, whole texts and links between equal ones, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: list[tuple[np.ndarray, ...]] = []
        texts: list[tuple[np.ndarray, ...]] = []
        size = held = 0

        def close() -> pa.RecordBatch:
            seed, of, pos = (np.concatenate(x) for x in zip(*seeds))
            name, words, doc = (np.concatenate(x) for x in zip(*texts))
            first = _first_of(name, words, doc)
            own = first == np.arange(len(first))
            keep = own[of]
            seed, of, pos = seed[keep], of[keep], pos[keep]
            long = words >= least_words
            rows = _by((seed % np.uint64(parts)).astype(np.int64), SEEDS, (seed // np.uint64(parts) & np.uint64(0xFFFFFFFF)).astype(np.int64), doc[of], pos)
            at = np.flatnonzero(own & long)
            rows += _by((name[at].view(np.uint64) % np.uint64(parts)).astype(np.int64), TEXTS, name[at], doc[at], words[at])
            at = np.flatnonzero(long & (doc != doc[first]))
            return _batch(rows + _by(hash_long(doc[at]).astype(np.int64) % parts, LINKS, doc[at], doc[first[at]], words[at]))

        for batch in batches:
            ids, given = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for lo, hi in _runs(given):
                h, doc, _, _ = word_hashes(given[lo:hi])
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
                raw, at = memoryview(h.tobytes()), cuts.tolist()
                name = np.frombuffer(b"".join(hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest() for a, b in zip(at, at[1:])), "<i8")
                s, d, first = shingle_hashes(h, doc, K)
                words = np.diff(cuts)
                full = words[d] >= K
                s, d, first = s[full], d[full], first[full]
                seeds.append((s, d + held, first - cuts[d]))
                texts.append((name, words, ids[lo:hi].astype("<i8")))
                held, size = held + hi - lo, size + len(s)
                if size >= most:
                    yield close()
                    seeds, texts, held, size = [], [], 0, 0
        if texts:
            yield close()

    return run


def _turns(pos: np.ndarray, base: np.ndarray, m: np.ndarray, n: np.ndarray, nth: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of occurrences: of each used one (the nth of n in its document) with those of its match, m from `base` on:
    all, or where these are more than REPEATS two in turn. Returns indices of the used and positions of the others."""
    few = n * m <= REPEATS
    reps = np.where(use, np.where(few, m, 2), 0)
    who = np.repeat(np.arange(len(n)), reps)
    step = np.arange(len(who)) - (np.cumsum(reps) - reps)[who]
    turn = np.where(step == 0, nth[who] % m[who], m[who] - 1 - (n[who] - 1 - nth[who]) % m[who])
    return who, pos[base[who] + np.where(few[who], step, turn)]


def _groups(seed: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of sorted occurrences: their seed's begin and size, their own document's stretch (index, begins, counts)."""
    begin, own = _starts(seed), _starts(seed, doc)
    size, count = (np.diff(np.append(x, len(seed))) for x in (begin, own))
    return np.repeat(begin, size), np.repeat(size, size), np.repeat(np.arange(len(own)), count), own, count


def _anchors(doc: np.ndarray, match: np.ndarray, x: np.ndarray, y: np.ndarray, seed: np.ndarray, buckets: int) -> list[tuple]:
    order = np.lexsort((y, x, match, doc))
    doc = doc[order]
    return _by(hash_long(doc).astype(np.int64) % buckets, ANCHORS, doc, match[order], x[order], y[order], seed[order])


def _share(buckets: int):
    """The occurrences of a part's seeds that several documents hold, the anchors in their first document, and links."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("key")[0].as_py()
        seed, doc, pos = unpack(_kind(table, SEEDS), 3)
        # most seeds stand once: they go before the sort of all columns
        order = np.argsort(seed.astype(np.uint32))
        s = seed[order]
        twin = np.zeros(len(s), bool)
        twin[1:] = s[1:] == s[:-1]
        twin[:-1] |= twin[1:]
        order = order[twin]
        seed, doc, pos = seed[order], doc[order], pos[order]
        order = np.lexsort((pos, doc, seed))
        seed, doc, pos = seed[order], doc[order], pos[order]
        one = _starts(seed, doc, pos)  # a row repeated under its doc_id gives no occurrences of its own
        seed, doc, pos = seed[one], doc[one], pos[one]
        rows = []
        if len(seed):
            begin = _starts(seed)
            size = np.diff(np.append(begin, len(seed)))
            several = np.repeat(doc[begin] != doc[begin + size - 1], size)
            seed, doc, pos = seed[several], doc[several], pos[several]
        if len(seed):
            first, _, of, own, count = _groups(seed, doc)
            who, y = _turns(pos, first, count[of[first]], count[of], np.arange(len(seed)) - own[of], doc != doc[first])
            rows = _anchors(doc[who], doc[first[who]], pos[who], y, seed[who] * buckets + part, buckets)
            rows.append((part, SEEDS, pack(seed, doc, pos)))
        name, d, words = unpack(_kind(table, TEXTS), 3)
        first = d[_first_of(name, words, d)]
        later = first != d
        links = unpack(_kind(table, LINKS), 3)
        links = [np.concatenate(x) for x in zip(links, (d[later], first[later], words[later]))]
        rows += _by(hash_long(links[0]).astype(np.int64) % buckets, LINKS, *links) if len(links[0]) else []
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def chains(x0: list[int], y0: list[int], size: list[int]) -> list[list[int]]:
    """Disjoint chains of segments (x0 ascending, y0, words), best first, as lists of indices.

    A segment adds its words, and each word skipped on either side costs GAP; a segment may begin up to K - 1 words
    before its predecessor's end. f + GAP (x1 + y1) is what a predecessor offers, whichever segment asks, so its
    greatest value over ends up to y0 is a prefix maximum; ends enter the tree in order of x.
    """
    n = len(x0)
    x1, y1 = ([a + s - K + 1 for a, s in zip(v, size)] for v in (x0, y0))
    rank = {v: i + 1 for i, v in enumerate(sorted({*y0, *y1}))}
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (len(rank) + 1)
    score, back = [0.0] * n, [-1] * n
    for at, begins, j in sorted([(a, 1, j) for j, a in enumerate(x0)] + [(a, 0, j) for j, a in enumerate(x1)]):
        if begins:
            best, i = (-np.inf, -1), rank[y0[j]]
            while i > 0:
                best = max(best, tree[i])
                i -= i & -i
            gain = best[0] - GAP * (x0[j] + y0[j])
            score[j] = size[j] + max(0.0, gain)
            if gain > 0:
                back[j] = best[1]
        else:
            offer, i = (score[j] + GAP * (x1[j] + y1[j]), j), rank[y1[j]]
            while i < len(tree):
                if tree[i] < offer:
                    tree[i] = offer
                i += i & -i
    used, out = [False] * n, []
    for j in sorted(range(n), key=lambda j: -score[j]):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = back[j]
        if chain:
            out.append(chain[::-1])
    return out


def least_seeds(least_words: int, identity: float) -> int:
    """Seeds that a passage of so many words and that identity shares with its match at least."""
    wrong = int(least_words * (1 - identity) + 1e-9)
    return max(1, least_words - wrong - (K - 1) * (wrong + 1))


def _segments(doc: np.ndarray, match: np.ndarray, x: np.ndarray, y: np.ndarray, need: int) -> tuple[np.ndarray, ...]:
    """Segments (doc, match, x0, y0, words) of the pairs with enough anchors, in order of pair and x0."""
    order = np.lexsort((x, y - x, match, doc))
    doc, match, x, y = doc[order], match[order], x[order], y[order]
    one = _starts(doc, match, x, y)
    doc, match, x, y = doc[one], match[one], x[one], y[one]
    pair = _starts(doc, match)
    many = np.diff(np.append(pair, len(doc)))
    keep = np.repeat(many >= need, many)
    doc, match, x, y = doc[keep], match[keep], x[keep], y[keep]
    if not len(doc):
        return doc, match, x, y, x
    # anchors of one diagonal that overlap or touch
    begin = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (match[1:] != match[:-1]) | (y[1:] - x[1:] != y[:-1] - x[:-1]) | (x[1:] - x[:-1] > K))))
    last = np.append(begin[1:], len(doc)) - 1
    doc, match, x, y, size = doc[begin], match[begin], x[begin], y[begin], x[last] - x[begin] + K
    order = np.lexsort((y, x, match, doc))
    return doc[order], match[order], x[order], y[order], size[order]


def _linked(doc: np.ndarray, match: np.ndarray, x: np.ndarray, y: np.ndarray, need: int) -> list[np.ndarray]:
    """The segments of the chains along some pairs' anchors: doc, match, whether a chain begins, x0, y0, words."""
    doc, match, x, y, size = _segments(doc, match, x, y, need)
    begin = _starts(doc, match)
    end = np.append(begin[1:], len(doc))
    one = begin[end - begin == 1]
    one = one[size[one] - K + 1 >= need]
    picked: list[int] = []
    heads: list[int] = []
    several = end - begin > 1
    for lo, hi in zip(begin[several].tolist(), end[several].tolist()):
        xs, ys, ns = x[lo:hi].tolist(), y[lo:hi].tolist(), size[lo:hi].tolist()
        for chain in chains(xs, ys, ns):
            stop = [k for k in range(1, len(chain)) if max(xs[chain[k]] - xs[chain[k - 1]] - ns[chain[k - 1]], ys[chain[k]] - ys[chain[k - 1]] - ns[chain[k - 1]]) > WIDE]
            for a, b in zip([0, *stop], [*stop, len(chain)]):
                if sum(ns[i] - K + 1 for i in chain[a:b]) >= need:
                    heads.append(len(one) + len(picked))
                    picked += [lo + i for i in chain[a:b]]
    at = np.concatenate((one, np.array(picked, np.int64)))
    head = np.zeros(len(at), np.int64)
    head[: len(one)] = 1
    head[heads] = 1
    return [doc[at], match[at], head, x[at], y[at], size[at]]


def _packed_chains(key: int, parts: list[list[np.ndarray]]) -> list[tuple]:
    doc, match, head, x, y, size = (np.concatenate(c) for c in zip(*parts))
    return [(key, CHAINS, pack(doc, match, np.cumsum(head), x, y, size))] if len(doc) else []


def _chain(least_words: int, identity: float):
    """The chains of a bucket's pairs, and the links of whole texts, whose anchors are dropped."""
    need = least_seeds(least_words, identity)

    def run(table: pa.Table) -> pa.Table:
        key = table.column("key")[0].as_py()
        doc, match, words = unpack(_kind(table, LINKS), 3)
        order = np.lexsort((match, doc))
        one = order[_starts(doc[order])]  # a document has one first text
        rows = [(key, LINKS, pack(doc[one], match[one], words[one]))] if len(one) else []
        whole = doc[one]
        doc, match, x, y, _ = unpack(_kind(table, ANCHORS), 5)
        keep = ~np.isin(doc, whole)
        rows += _packed_chains(key, [_linked(doc[keep], match[keep], x[keep], y[keep], need)])
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _ends(x: np.ndarray, size: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word, with a margin, of chains whose first segments are at `head`."""
    last = np.append(head[1:], len(x)) - 1
    return np.maximum(x[head] - MARGIN, 0), x[last] + size[last] + MARGIN


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of texts along a bucket's chains, by block, each word once."""
    for batch in batches:
        for key, kind, data in zip(*(batch.column(c).to_pylist() for c in ("key", "kind", "data"))):
            if kind != CHAINS:
                continue
            doc, match, number, x, y, size = unpack([data], 6)
            head = _starts(number)
            of = np.concatenate((doc[head], match[head]))
            lo, hi = (np.concatenate(c) for c in zip(_ends(x, size, head), _ends(y, size, head)))
            order = np.lexsort((lo, of))
            of, lo, hi = of[order], lo[order], hi[order]
            base = np.cumsum(np.diff(of, prepend=of[:1]) != 0) << 32
            reach = np.maximum.accumulate(base + hi)
            begin = np.flatnonzero(np.append(True, base[1:] + lo[1:] > reach[:-1]))
            of, lo, hi = of[begin], lo[begin], np.append(reach[begin[1:] - 1], reach[-1:]) - base[begin]
            many = (hi - 1) // BLOCK - lo // BLOCK + 1
            who = np.repeat(np.arange(len(of)), many)
            block = lo[who] // BLOCK + np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
            columns = np.full(len(who), key), of[who], block, np.maximum(lo[who], block * BLOCK), np.minimum(hi[who], (block + 1) * BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), *[pa.int32()] * 3))], names=["key", "of", "block", "lo", "hi"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes (32 bits) of the texts, by blocks of BLOCK words."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in _runs(texts):
            h, doc, _, _ = word_hashes(texts[lo:hi])
            cuts = np.searchsorted(doc, np.arange(hi - lo + 1)).tolist()
            h = (h & np.uint64(0xFFFFFFFF)).astype("<u4")
            rows = [(ids[lo + i], k, h[p : min(p + BLOCK, b)].tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) for k, p in enumerate(range(a, b, BLOCK))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=["of", "block", "words"])


def _edit(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Matches and columns of a least-cost alignment of two short stretches (most matches among these)."""
    if not len(a) or not len(b):
        return 0, max(len(a), len(b))
    unit = 1 << 24  # cost and, below it, the matches
    ramp = unit * np.arange(len(b) + 1)
    row = ramp.copy()
    for i, w in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i * unit
        np.minimum(row[:-1] + np.where(b == w, -1, unit), row[1:] + unit, out=new[1:])
        row = np.minimum.accumulate(new - ramp) + ramp
    cost = -(-int(row[-1]) // unit)
    matches = cost * unit - int(row[-1])
    return matches, cost + matches


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Words and matches by which a passage goes on along the diagonal: the best sum of matches less mismatches."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    eq = a[:n] == b[:n]
    gain = np.cumsum(np.where(eq, 1, -2))
    best = int(gain.argmax())
    return (best + 1, int(eq[: best + 1].sum())) if gain[best] > 0 else (0, 0)


def _at_best(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """No fewer matches and no more columns than _edit finds, from the words that both hold."""
    return min(int(np.isin(a, b).sum()), int(np.isin(b, a).sum())), max(len(a), len(b))


def align(a: np.ndarray, b: np.ndarray, segments: list[tuple[int, int, int]], between=_edit) -> tuple[int, int, int, int, float]:
    """Start and end in a and in b, and identity, of the passage along the segments (positions in a and b, words);
    `between` compares the stretches between segments on different diagonals."""
    i, j, _ = segments[0]
    step, matches = _extend(a[:i][::-1], b[:j][::-1])
    start_a, start_b, columns = i - step, j - step, step
    for p, q, n in segments:
        over = max(0, i - p, j - q)  # words that the segment before has taken
        if over >= n:
            continue
        p, q, n = p + over, q + over, n - over
        if p - i == q - j:
            matches, columns = matches + int((a[i:p] == b[j:q]).sum()), columns + p - i
        else:
            m, c = between(a[i:p], b[j:q])
            matches, columns = matches + m, columns + c
        i, j, matches, columns = p + n, q + n, matches + n, columns + n
    step, m = _extend(a[i:], b[j:])
    return start_a, i + step, start_b, j + step, (matches + m) / max(1, columns + step)


def _beyond(words: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """_extend for many stretches at once: from positions a and b on by `step`, at most `room` (up to MARGIN) words."""
    k = np.arange(MARGIN)
    inside = k < room[:, None]
    far = np.where(inside, k, 0) * step
    last = len(words) - 1
    eq = inside & (words[np.clip(a[:, None] + far, 0, last)] == words[np.clip(b[:, None] + far, 0, last)])
    gain = np.cumsum(np.where(eq, 1, -2), axis=1)
    best = gain.argmax(axis=1)
    row = np.arange(len(a))
    good = (gain[row, best] > 0) & (room > 0)
    return np.where(good, best + 1, 0), np.where(good, np.cumsum(eq, axis=1)[row, best], 0)


def parted(a: np.ndarray, b: np.ndarray, segments: list[tuple[int, int, int]], least_words: int, identity: float) -> list[tuple]:
    """The passages along a chain: the whole, or what its parts give where it is below the identity, parted at its
    widest gap. The stretches between segments are compared once for all parts, and only for parts that may reach it."""
    known: dict = {}

    def once(compare):
        def between(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
            key = compare, x.__array_interface__["data"][0], len(x), y.__array_interface__["data"][0], len(y)
            if key not in known:
                known[key] = compare(x, y)
            return known[key]

        return between

    out, parts = [], [segments]
    while parts:
        part = parts.pop()
        start, end, m_start, m_end, same = align(a, b, part, once(_at_best))
        if end - start < least_words:
            continue
        if same >= identity - 1e-9:
            same = align(a, b, part, once(_edit))[4]
        if same >= identity - 1e-9:
            out.append((start, end, m_start, m_end, same))
        elif len(part) > 1:
            cut = max(range(1, len(part)), key=lambda i: max(part[i][0] - part[i - 1][0] - part[i - 1][2], part[i][1] - part[i - 1][1] - part[i - 1][2]))
            parts += (part[cut:], part[:cut])
    return out


def _align(least_words: int, identity: float, at_once: int = 1 << 14):
    """The passages along a bucket's chains, from the stretches of words that these ask for, and its links as passages."""

    def run(table: pa.Table, text: pa.Table) -> pa.Table:
        doc, match, words = unpack(_kind(table, LINKS), 3)
        zero = np.zeros(len(doc), np.int64)
        rows = [[c] for c in (doc, zero, words, match, zero, words, np.ones(len(doc)))]
        doc, match, number, x, y, size = unpack(_kind(table, CHAINS), 6)
        order = pc.sort_indices(text, sort_keys=[(c, "ascending") for c in ("of", "at", "words")])
        text = text.take(order)
        of, at = (text.column(c).to_numpy().astype(np.int64) for c in ("of", "at"))
        own = _starts(of, at)  # texts that share a doc_id: the first words of a block are taken
        of, at, piece = of[own], at[own], text.column("words").combine_chunks().take(pa.array(own))
        many = pc.binary_length(piece).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        w = np.frombuffer(b"".join(piece.to_pylist()), "<u4")
        del text, piece
        begin = np.cumsum(many) - many
        run_ = _starts(of, at - begin)  # pieces that go on
        of, at, begin = of[run_], at[run_], begin[run_]
        end = at + np.append(begin[1:], len(w)) - begin
        names = np.unique(of)
        key = (np.searchsorted(names, of) << 32) + at

        def stretch(name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Where the words from lo to hi of the texts begin, and how many there are."""
            i = np.minimum(np.searchsorted(names, name), len(names) - 1)
            j = np.maximum(np.searchsorted(key, (i << 32) + lo, side="right") - 1, 0)
            held = (names[i] == name) & (of[j] == name) & (at[j] <= lo)
            return begin[j] + lo - at[j], np.where(held, np.minimum(hi, end[j]) - lo, 0)

        head = _starts(number)
        if len(head) and len(w):
            (lo_a, hi_a), (lo_b, hi_b) = _ends(x, size, head), _ends(y, size, head)
            (first_a, length_a), (first_b, length_b) = stretch(doc[head], lo_a, hi_a), stretch(match[head], lo_b, hi_b)
            last = np.append(head[1:], len(x)) - 1
            a, b = x[head] - lo_a, y[head] - lo_b
            whole = (x[last] + size[last] - lo_a <= length_a) & (y[last] + size[last] - lo_b <= length_b)
            single = np.flatnonzero(whole & (last == head))
            for lo in range(0, len(single), at_once):
                one = single[lo : lo + at_once]
                i, n = head[one], size[head[one]]
                fa, fb = first_a[one] + a[one], first_b[one] + b[one]
                left, m_left = _beyond(w, fa - 1, fb - 1, np.minimum(a[one], b[one]), -1)
                right, m_right = _beyond(w, fa + n, fb + n, np.minimum(length_a[one] - a[one], length_b[one] - b[one]) - n, 1)
                total = left + n + right
                same = (m_left + n + m_right) / np.maximum(total, 1)
                ok = (total >= least_words) & (same >= identity - 1e-9)
                for out, c in zip(rows, (doc[i], x[i] - left, x[i] + n + right, match[i], y[i] - left, y[i] + n + right, same)):
                    out.append(c[ok])
            made = []
            for c in np.flatnonzero(whole & (last > head)).tolist():
                p, q, base_a, base_b = head[c], last[c] + 1, lo_a[c], lo_b[c]
                segments = np.stack([x[p:q] - base_a, y[p:q] - base_b, size[p:q]], axis=1)
                both = (w[f : f + n] for f, n in ((first_a[c], length_a[c]), (first_b[c], length_b[c])))
                for start, stop, m_start, m_stop, same in parted(*both, [tuple(t) for t in segments.tolist()], least_words, identity):
                    made.append((doc[p], start + base_a, stop + base_a, match[p], m_start + base_b, m_stop + base_b, same))
            for out, c in zip(rows, zip(*made)):
                out.append(np.array(c))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
        got = pa.table([pa.array(np.concatenate(c), t) for c, t in zip(rows, types)], names=[c.split()[0] for c in PASSAGE.split(", ")])
        give_back()
        return got

    return run


def _found(texts: DataFrame, chained: DataFrame, buckets: int, least_words: int, identity: float, name: str) -> DataFrame:
    """The passages along packed chains, and the links of whole texts as passages. A bucket gets each word that its
    chains need once, however many of them need it."""
    grouped_by = lambda df: df.repartition(buckets, "key").groupBy("key")
    every = materialize(chained, f"op3-chains-{name}")
    asked = materialize(every.mapInArrow(tidy(_asked), "key int, of long, block int, lo int, hi int"), f"op3-asked-{name}")
    some = texts.mapInArrow(member_filter(asked.select("of"), "doc_id"), texts.schema)
    words = some.mapInArrow(_blocks, "of long, block int, words binary")
    cut = F.expr(f"substring(words, 4 * (lo - block * {BLOCK}) + 1, 4 * (hi - lo))")
    words = asked.join(words, ["of", "block"]).select("key", "of", F.col("lo").alias("at"), cut.alias("words"))
    return materialize(grouped_by(every).cogroup(grouped_by(words)).applyInArrow(_align(least_words, identity), PASSAGE), f"op3-{name}")


def _anchored(table: pa.Table, found: pa.Table, words: bool = False) -> tuple[np.ndarray, ...]:
    """The occurrences of a bucket's anchors (document, position, seed, and one key for both), in order, and whether
    no passage covers them (with `words`: and whether none covers their first, or none their last word)."""
    doc, _, x, _, seed = unpack(_kind(table, ANCHORS), 5)
    order = np.lexsort((x, doc))
    one = order[_starts(doc[order], x[order])]
    doc, x, seed = doc[one], x[one], seed[one]
    # the passages that begin at or before an occurrence: the one that reaches furthest decides
    of, start, end = (found.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "start_word", "end_word"))
    order = np.lexsort((end, start, of))
    of, start, end = of[order], start[order], end[order]
    docs = np.unique(np.concatenate((doc, of)))
    span = np.int64(1) << 32
    reach = np.maximum.accumulate(np.searchsorted(docs, of) * span + end) if len(of) else of
    key = np.searchsorted(docs, doc) * span + x
    begin = np.searchsorted(docs, of) * span + start

    def outside(key: np.ndarray, n: int) -> np.ndarray:
        at = np.searchsorted(begin, key, side="right") - 1
        return (at < 0) | (reach[np.maximum(at, 0)] < key + n) if len(of) else np.ones(len(key), bool)

    free = outside(key, K)
    return (doc, x, seed, key, free) + ((outside(key, 1) | outside(key + K - 1, 1),) if words else ())


def _dense(key: np.ndarray, width: int, need: int) -> np.ndarray:
    return np.searchsorted(key, key + width, side="right") - np.searchsorted(key, key - width) >= need


def _left(parts: int, least_words: int, identity: float):
    """The occurrences of a bucket's anchors that no passage covers, where they stand dense enough for one, by part."""
    need = least_seeds(least_words, identity)

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        doc, x, seed, key, free = _anchored(table, found)
        at = np.flatnonzero(free)
        at = at[_dense(key[at], least_words - K, need)]
        doc, x, seed = doc[at], x[at], seed[at]
        out = _by(seed % parts, SEEDS, seed // parts, doc, x) if len(seed) else []
        give_back()
        return pa.Table.from_batches([_batch(out)])

    return run


def _offsets(words: int) -> list[int]:
    """Where seeds that cover a window of so many words begin in it."""
    return [*range(0, words - K, K), words - K]


def _windows(seed: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """One number for each window that begins at the seeds `at`, from the seeds that cover it."""
    out = np.full(len(at), words, np.uint64)
    for i in _offsets(words):
        out = mix(out + seed[at + i].astype(np.uint64))
    return out.view(np.int64)


def _unlinked(lengths: list[int], least_words: int, identity: float):
    """Windows (window, of, at, words) of a bucket's documents that repeat seed by seed, but not all in passages."""
    need = least_seeds(least_words, identity)

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        doc, x, seed, key, free, bare = _anchored(table, found, words=True)
        out = []
        dense = np.zeros(len(doc), bool)
        own = np.flatnonzero(free)
        dense[own[_dense(key[own], least_words - K, need)]] = True
        some = np.isin(doc, np.unique(doc[bare | dense]))  # few documents
        doc, x, seed, key, bare, dense = (c[some] for c in (doc, x, seed, key, bare, dense))
        for words in lengths:
            n = words - K
            at = np.arange(max(0, len(doc) - n))
            at = at[key[at + n] - key[at] == n]
            # the longest are asked if a word of theirs is in no passage, shorter ones if all seeds stand outside, and dense
            sums = np.concatenate(([0], np.cumsum(bare if words == least_words else dense)))
            at = at[sums[at + n + 1] - sums[at] >= (1 if words == least_words else n + 1)]
            out.append((_windows(seed, at, words), doc[at], x[at], np.full(len(at), words)))
        give_back()
        return pa.table(dict(zip(("window", "of", "at", "words"), (np.concatenate(c).astype(np.int64) for c in zip(*out)))))

    return run


def _places(parts: int, lengths: list[int], among):
    """Where the windows that may be asked for stand in the texts."""

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, given = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for lo, hi in _runs(given):
                h, doc, _, _ = word_hashes(given[lo:hi])
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
                s, d, first = shingle_hashes(h, doc, K)
                full = np.diff(cuts)[d] >= K
                s, d, first = s[full], d[full], first[full]
                seed = (s // np.uint64(parts) & np.uint64(0xFFFFFFFF)) * np.uint64(parts) + s % np.uint64(parts)
                for words in lengths:
                    at = np.arange(max(0, len(d) - words + K))
                    at = at[d[at + words - K] == d[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(_windows(seed, at, words)), pa.array(ids[lo + d[at]], pa.int64()), pa.array(first[at] - cuts[d[at]], pa.int64())], names=["window", "doc_id", "pos"])

    return tidy(lambda batches: among(every(batches)))


def _cover(table: pa.Table) -> pa.Table:
    """The seeds of a bucket's linked windows as anchors. Windows of a pair that go on along a diagonal are one
    stretch; of stretches that overlap (in a text that repeats itself) those that reach furthest cover all their words."""
    doc, match, x, y, words = (table.column(c).to_numpy().astype(np.int64) for c in ("of", "match", "x", "y", "words"))
    order = np.lexsort((x, y - x, match, doc))
    doc, match, x, y, end = doc[order], match[order], x[order], y[order], (x + words)[order]
    begin = _starts(doc, match, y - x, np.cumsum(np.diff(x, prepend=x[:1]) > K))
    end = np.maximum.reduceat(end, begin)
    doc, match, x, y = doc[begin], match[begin], x[begin], y[begin]
    order = np.lexsort((-end, x, match, doc))
    pairs = np.append(_starts(doc[order], match[order]), len(order)).tolist()
    kept = []
    for lo, hi in zip(pairs, pairs[1:]):
        reach, best = -1, -1
        for i in order[lo:hi].tolist():
            if best >= 0 and x[i] > reach:  # nothing later begins within what is covered
                kept.append(best)
                reach, best = end[best], -1
            if x[i] > reach and best < 0:
                reach = x[i]
            if end[i] > reach and (best < 0 or end[i] > end[best]):
                best = i
        if best >= 0:
            kept.append(best)
    at = np.array(kept)
    many = -(-(end[at] - x[at]) // K)
    who = np.repeat(at, many)
    step = np.minimum((np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)) * K, end[who] - x[who] - K)
    rows = [(table.column("key")[0].as_py(), ANCHORS, pack(doc[who], match[who], x[who] + step, y[who] + step, np.zeros(len(who), np.int64)))]
    give_back()
    return pa.Table.from_batches([_batch(rows)])


def _portions(weight: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of a list that weigh no more than `most`, or are one item."""
    ends, lo = np.cumsum(weight), 0
    while lo < len(weight):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def _again(buckets: int, most: int, at_once: int = 1_000_000):
    """Anchors (without seeds) of the occurrences left over with every earlier document that holds their seed; of seeds
    with more than `most` occurrences those in two documents, and their occurrences, for the rest."""

    def run(left: pa.Table, every: pa.Table) -> pa.Table:
        rows = []
        seed, doc, pos = unpack(_kind(left, SEEDS), 3)
        if len(seed):
            part = left.column("key")[0].as_py()
            order = np.lexsort((pos, doc, seed))
            seed, doc, pos = seed[order], doc[order], pos[order]
            s, d, p = unpack(_kind(every, SEEDS), 3)  # in order of seed, document and position
            lo, hi = np.searchsorted(s, seed), np.searchsorted(s, seed, side="right")
            hot = hi - lo > most
            # up to so many occurrences: all of earlier documents
            every_cool = np.flatnonzero(~hot)
            for a, b in _portions((hi - lo)[every_cool], at_once):
                cool = every_cool[a:b]
                reps = hi[cool] - lo[cool]
                who = np.repeat(cool, reps)
                at = np.arange(len(who)) - np.repeat(np.cumsum(reps) - reps, reps) + lo[who]
                earlier = d[at] < doc[who]
                who, at = who[earlier], at[earlier]
                rows += _anchors(doc[who], d[at], pos[who], p[at], np.zeros(len(who), np.int64), buckets) if len(who) else []
            # more: those of the first document, and the first of the occurrences left over
            own = _starts(seed)
            hub = np.repeat(own, np.diff(np.append(own, len(seed))))
            at = np.flatnonzero(hot & (doc != doc[hub]))
            got = [(doc[at], doc[hub[at]], pos[at], pos[hub[at]])]
            if hot.any():
                first, _, of, begin, count = _groups(s, d)
                i = lo + _place(s, d, p, lo, hi, doc, pos)
                who, y = _turns(p, first[i], count[of[first[i]]], count[of[i]], i - begin[of[i]], hot & (doc != d[first[i]]))
                got.append((doc[who], d[first[i[who]]], pos[who], y))
                free = np.zeros(len(s), np.int64)
                free[i[hot]] = 1
                at = np.flatnonzero(np.isin(s, seed[hot]))
                rows += _by(hash_long(d[at]).astype(np.int64) % buckets, FREQUENT, d[at], s[at] * buckets + part, p[at], free[at])
            doc, match, x, y = (np.concatenate(c) for c in zip(*got))
            rows += _anchors(doc, match, x, y, np.zeros(len(doc), np.int64), buckets) if len(doc) else []
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _near(least_words: int):
    """The blocks of words that stretches around a bucket's frequent seeds may need."""

    def run(table: pa.Table) -> pa.Table:
        doc, _, pos, _ = unpack(_kind(table, FREQUENT), 4)
        reach = 2 * least_words
        of = np.tile(doc, 1 + -(-2 * reach // BLOCK))
        at = np.concatenate([np.minimum(pos - reach + step * BLOCK, pos + reach) for step in range(1 + -(-2 * reach // BLOCK))])
        keep = at + BLOCK > 0
        of, block = of[keep], np.maximum(at[keep], 0) // BLOCK
        order = np.lexsort((block, of))
        one = order[_starts(of[order], block[order])]
        return pa.table({"of": of[one], "block": pa.array(block[one], pa.int32())})

    return run


def _slot(pair: np.ndarray) -> np.ndarray:
    return (mix(pair) % np.uint64(SLOTS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the slots of pairs of neighbouring words stand in the texts, by ranges of slots."""
    out = np.zeros(SLOTS, np.int64)
    for batch in batches:
        given = batch.column(1).to_pylist()
        for lo, hi in _runs(given):
            h, doc, _, _ = word_hashes(given[lo:hi])
            h = h & np.uint64(0xFFFFFFFF)
            pair = (h[:-1] << np.uint64(32) | h[1:])[doc[1:] == doc[:-1]]
            np.add.at(out, _slot(pair), 1)
    if out.any():
        yield _batch([(i, 0, pack(c)) for i, c in enumerate(np.split(out, RANGES))])


def _counted(table: pa.Table) -> pa.Table:
    """The sum of a range's counts."""
    total = np.zeros(SLOTS // RANGES, np.int64)
    for row in table.column("data").to_pylist():
        total += unpack([row], 1)[0]
    return pa.Table.from_batches([_batch([(table.column("key")[0].as_py(), 0, pack(total))])])


def _steps(texts: DataFrame) -> np.ndarray:
    """The step of each slot, from the counts in all texts."""
    counted = texts.mapInArrow(tidy(_counts), PACK).repartition(RANGES, "key").groupBy("key").applyInArrow(_counted, PACK).toArrow()
    counts = unpack([counted.column("data")[i].as_py() for i in pc.sort_indices(counted.column("key")).to_pylist()], 1)[0]
    if not len(counts):
        return np.zeros(SLOTS, np.uint8)
    return np.searchsorted(np.array(STEPS) * max(1.0, counts.mean()), counts, side="right").astype(np.uint8)


def _spans(least_words: int, identity: float) -> list[tuple[int, int]]:
    """For stretches of least_words to 2 least_words - 1 columns: the fewest pairs of words a side has, and how many may be
    unmatched. A side that lacks g of n columns has g words fewer, and of e wrong columns these break at most g pairs
    and the others 2 (e - g); a few g in a row go together."""
    wrong: dict[int, int] = {}
    for n in range(least_words, 2 * least_words):
        wrong.setdefault(int(n * (1 - identity) + 1e-9), n)
    # a seed's own pairs are matched
    spans = {(n - 1 - min(g + e // 5, e), min(2 * e - g, n - g - K)) for e, n in wrong.items() for g in range(0, e + 1, e // 5 + 1)}
    return sorted(s for s in spans if not any(t != s and t[0] <= s[0] and t[1] >= s[1] for t in spans))


def _joint(least_words: int, identity: float) -> int:
    return min(JOINT, *(max(K - 1, n - 1 - 2 * int(n * (1 - identity) + 1e-9)) for n in range(least_words, 2 * least_words)))


def _preceded(step: np.ndarray, whole: np.ndarray, spans: list[tuple[int, int]], joint: int, at_once: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Whether a pair is in a stretch of whole pairs where few enough are of an earlier step to be among its first
    `joint` matched ones, and the same for its first one alone."""
    few, first = whole & (step == 0), whole & (step == 0)
    halo = max(n for n, _ in spans)
    for lo in range(0, len(step), at_once):
        a = max(0, lo - halo)
        own, of = step[a : lo + at_once + halo], whole[a : lo + at_once + halo]
        for s in range(1, len(STEPS) + 1):
            before = np.concatenate(([0], np.cumsum(np.where(of, own < s, 1 << 12), dtype=np.int32)))
            at = np.flatnonzero((of & (own == s))[lo - a : lo - a + at_once]) + lo - a
            for n, most in spans:
                if not len(at) or n > len(own):
                    continue
                many = before[n:] - before[:-n]  # by where the stretch begins
                hi, low = np.minimum(at, len(many) - 1) + 1, np.minimum(np.maximum(at - n + 1, 0), len(many))
                for out, more in ((few, joint - 1), (first, 0)):
                    good = np.concatenate(([0], np.cumsum(many <= most + more, dtype=np.int32)))
                    out[at[good[hi] > good[low]] + a] = True
                at = at[~first[at + a]]
    return few, first


def _neighbours(parts: int, least_words: int, identity: float, steps: bytes, most: int = 500_000):
    """The pairs of words by which a bucket's documents may meet, by part; by stretches of documents."""
    spans, joint, reach = _spans(least_words, identity), _joint(least_words, identity), 2 * least_words

    def run(words: pa.Table, every: pa.Table) -> pa.Table:
        every_doc, _, every_pos, every_free = unpack(_kind(every, FREQUENT), 4)
        of, block = words.column("of").to_numpy(), words.column("block").to_numpy().astype(np.int64)
        order = np.lexsort((block, of))
        order = order[_starts(of[order], block[order])]  # texts that share a doc_id: one of them
        begin = _starts(of[order])
        blocks = np.diff(np.append(begin, len(order)))
        rows = []
        for lo, hi in _portions(blocks * BLOCK, most):
            some = order[begin[lo] : begin[hi - 1] + blocks[hi - 1]]
            text = words.column("words").combine_chunks().take(pa.array(some))
            size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            w = np.frombuffer(b"".join(text.to_pylist()), "<u4").astype(np.uint64)
            if not len(w):
                continue
            docs = np.unique(of[some])
            key = np.repeat((np.searchsorted(docs, of[some]) << 32) + block[some] * BLOCK, size) + np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size)
            known = np.isin(every_doc, docs)
            doc, pos, free = every_doc[known], every_pos[known], every_free[known]
            at = (np.searchsorted(docs, doc) << 32) + pos

            def near(at: np.ndarray) -> np.ndarray:
                at = np.sort(at)
                return np.searchsorted(at, key + reach, side="right") > np.searchsorted(at, key - reach)  # noqa: B023

            near_some, left = near(at), near(at[free == 1])
            pair = np.append(w[:-1] << np.uint64(32) | w[1:], np.uint64(0))
            whole = near_some & np.append((key[1:] - key[:-1] == 1) & near_some[1:], False)
            step = np.frombuffer(steps, np.uint8)[_slot(pair)]
            few, first = _preceded(step, whole, spans, joint)
            keep = np.flatnonzero(few)
            pair, doc, held = pair[keep].view(np.int64), docs[key[keep] >> 32], 2 * first[keep] + left[keep]
            by = np.lexsort((doc, pair))
            one = _starts(pair[by], doc[by])
            many = np.minimum(np.diff(np.append(one, len(by))), joint)
            held = 4 * many + np.bitwise_or.reduceat(held[by], one) if len(one) else many
            pair, doc = pair[by[one]], doc[by[one]]
            rows += _by((mix(pair.view(np.uint64)) % np.uint64(parts)).astype(np.int64), NEIGHBOURS, pair, doc, held) if len(pair) else []
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _added(keys: list[np.ndarray]) -> np.ndarray:
    """Each key once, in order, with the sum (255 at most) of the numbers in its lowest 8 bits, and its 9th bit where any has it."""
    x = np.sort(np.concatenate(keys))
    one = _starts(x >> 9)
    return x[one] >> 9 << 9 | np.bitwise_or.reduceat(x & 256, one) | np.minimum(np.add.reduceat(x & 255, one), 255) if len(x) else x


def _summed(rows: list[bytes], most: int = 1_000_000) -> list[np.ndarray]:
    """Each match and document of packed rows once, in order, with their numbers as _added joins them. Row by row, so that
    what one pair has in many rows is not held at once."""
    matches, docs = (np.unique(np.concatenate(c)) for c in zip(*([np.unique(c) for c in unpack([r], 3)[:2]] for r in rows))) if rows else np.zeros((2, 0), np.int64)
    got, limit = [np.zeros(0, np.int64)], 2 * most
    for row in rows:
        match, doc, n = unpack([row], 3)
        got.append((np.searchsorted(matches, match) * len(docs) + np.searchsorted(docs, doc)) << 9 | n)
        if sum(map(len, got)) > limit:
            got = [_added(got)]
            limit = max(2 * most, 2 * len(got[0]))
    x = _added(got)
    return [matches[(x >> 9) // max(1, len(docs))], docs[(x >> 9) % max(1, len(docs))], x & 511]


def _meet(buckets: int, most: int = 1_000_000):
    """Documents with frequent seeds left over and the earlier ones that have a pair of words of a part in common."""

    def run(table: pa.Table) -> pa.Table:
        pair, doc, held = unpack(_kind(table, NEIGHBOURS), 3)
        order = np.lexsort((doc, pair))
        pair, doc, held = pair[order], doc[order], held[order]
        docs = np.unique(doc)
        of = np.searchsorted(docs, doc)
        begin = np.repeat(_starts(pair), np.diff(np.append(_starts(pair), len(pair))))
        at = np.flatnonzero(held & 1)
        many = at - begin[at]
        got, limit = [np.zeros(0, np.int64)], 2 * most
        for lo, hi in _portions(many, most):  # by stretches of pairs: frequent ones are not all held at once
            who = np.repeat(at[lo:hi], many[lo:hi])
            match = begin[who] + np.arange(len(who)) - np.repeat(np.cumsum(many[lo:hi]) - many[lo:hi], many[lo:hi])
            both = (held[match] & held[who] & 2) << 7 | np.minimum(held[match], held[who]) >> 2
            got.append(_added([(of[match] * len(docs) + of[who]) << 9 | both]))
            if sum(map(len, got)) > limit:
                got = [_added(got)]
                limit = max(2 * most, 2 * len(got[0]))
        x = _added(got)
        match, doc = (docs[c] for c in np.divmod(x >> 9, max(1, len(docs))))
        rows = _by(hash_long(match).astype(np.int64) % buckets, MEET, match, doc, x & 511) if len(x) else []
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _linked_already(buckets: int, need: int, joint: int):
    """Documents that have enough anchors of other seeds for a passage meet as well, by the match's bucket: frequent seeds
    further off may be in it."""

    def run(table: pa.Table) -> pa.Table:
        doc, match, _, _, _ = unpack(_kind(table, ANCHORS), 5)
        docs, matches = np.unique(doc), np.unique(match)
        pair, many = np.unique(np.searchsorted(docs, doc) * len(matches) + np.searchsorted(matches, match), return_counts=True)
        doc, match = docs[pair[many >= need] // len(matches)], matches[pair[many >= need] % len(matches)]
        rows = _by(hash_long(match).astype(np.int64) % buckets, MEET, match, doc, np.full(len(doc), 256 + joint)) if len(doc) else []
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _stretches(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the asked and of the equal ones among sorted keys, all pairs."""
    lo, hi = np.searchsorted(keys, asked), np.searchsorted(keys, asked, side="right")
    who = np.repeat(np.arange(len(asked)), hi - lo)
    return who, lo[who] + np.arange(len(who)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)


def _theirs(buckets: int, joint: int):
    """Documents that meet, by the later one's bucket, and once for a bucket the frequent seeds of the earlier ones."""

    def run(meet: pa.Table, every: pa.Table) -> pa.Table:
        match, doc, n = _summed(_kind(meet, MEET))
        met = ((n & 255) >= joint) & ((n & 256) > 0)
        match, doc = match[met], doc[met]
        d, s, p, _ = unpack(_kind(every, FREQUENT), 4)
        order = np.lexsort((p, s, d))
        d, s, p = d[order], s[order], p[order]
        bucket = hash_long(doc).astype(np.int64) % buckets
        rows = []
        for key in np.unique(bucket).tolist():
            own = bucket == key
            held = np.isin(d, match[own])
            rows += [(key, MEET, pack(match[own], doc[own])), (key, THEIRS, pack(d[held], s[held], p[held]))] if held.any() else []
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _rest(least_words: int, identity: float, most: int = 300_000):
    """The chains along a bucket's anchors and along those of frequent seeds left over in the documents that theirs meet,
    by stretches of pairs: their anchors are not all held at once."""
    need = least_seeds(least_words, identity)

    def run(again: pa.Table, theirs: pa.Table) -> pa.Table:
        key = (again if len(again) else theirs).column("key")[0].as_py()
        doc, match, x, y, _ = unpack(_kind(again, ANCHORS), 5)
        d, s, p, free = unpack(_kind(again, FREQUENT), 4)
        met_match, met = unpack(_kind(theirs, MEET), 2)
        docs, matches = np.unique(np.concatenate((doc, met))), np.unique(np.concatenate((match, met_match)))
        pair = np.searchsorted(docs, doc) * len(matches) + np.searchsorted(matches, match)
        order = np.argsort(pair, kind="stable")
        pair, x, y = pair[order], x[order].astype(np.int32), y[order].astype(np.int32)
        del doc, match
        met = np.sort(np.searchsorted(docs, met) * len(matches) + np.searchsorted(matches, met_match))

        order = np.lexsort((p, s, d))
        d, s, p, free = d[order], s[order], p[order], free[order]
        own = _starts(d, s)
        n = np.diff(np.append(own, len(d)))
        use = np.add.reduceat(free, own) > 0 if len(own) else np.zeros(0, bool)
        own, n = own[use], n[use]
        of_own = d[own]
        seeds, nth_seed = np.unique(s[own], return_inverse=True)
        # of what the matches hold only the seeds of this bucket's documents count
        held, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for row in _kind(theirs, THEIRS) if len(seeds) else []:
            b, t, z = unpack([row], 3)
            j = np.minimum(np.searchsorted(seeds, t), len(seeds) - 1)
            known = np.flatnonzero(seeds[j] == t)
            held.append(np.searchsorted(matches, b[known]) * len(seeds) + j[known])
            places.append(z[known].astype(np.int32))
        held, places = np.concatenate(held), np.concatenate(places)
        order = np.lexsort((places, held))
        held, places = held[order], places[order]
        base = _starts(held)
        m, held = np.diff(np.append(base, len(held))), held[base]

        def common(met: np.ndarray) -> tuple[np.ndarray, ...]:
            """For documents that meet: which, and where their common frequent seeds stand in both lists."""
            who, of = _stretches(of_own, docs[met // len(matches)])
            asked = met[who] % len(matches) * len(seeds) + nth_seed[of]
            at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            both = held[at] == asked
            return who[both], of[both], at[both]

        def frequent(met: np.ndarray, who: np.ndarray, of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
            """Pair, x and y of the anchors of these seeds: each occurrence of the document with those of its match."""
            k = np.repeat(np.arange(len(of)), n[of])
            nth = np.arange(len(k)) - np.repeat(np.cumsum(n[of]) - n[of], n[of])
            i = own[of][k] + nth
            which, there = _turns(places, base[at][k], m[at][k], n[of][k], nth, free[i] == 1)
            return met[who[k[which]]], p[i[which]], there

        def within(keys: np.ndarray, first: int, last: int) -> slice:
            return slice(np.searchsorted(keys, first), np.searchsorted(keys, last, side="right"))

        got = [[np.zeros(0, np.int64)] * 6]
        pairs = np.union1d(pair, met)
        weight = np.zeros(len(pairs), np.int64)
        theirs_ = docs[met // max(1, len(matches))]
        weight[np.searchsorted(pairs, met)] = np.searchsorted(of_own, theirs_, side="right") - np.searchsorted(of_own, theirs_)
        weight += np.searchsorted(pair, pairs, side="right") - np.searchsorted(pair, pairs)
        for first, last in _portions(weight, most):
            own_pairs, own_met = pairs[first:last], met[within(met, pairs[first], pairs[last - 1])]
            who, of, at = common(own_met) if len(held) else np.zeros((3, 0), np.int64)
            # a seed that stands several times gives more anchors: once more by stretches
            many = np.searchsorted(pair, own_pairs, side="right") - np.searchsorted(pair, own_pairs)
            np.add.at(many, np.searchsorted(own_pairs, own_met[who]), np.where(n[of] * m[at] <= REPEATS, n[of] * m[at], 2 * n[of]))
            for lo, hi in _portions(many, most):
                some, part = within(pair, own_pairs[lo], own_pairs[hi - 1]), within(own_met, own_pairs[lo], own_pairs[hi - 1])
                cut = slice(np.searchsorted(who, part.start), np.searchsorted(who, part.stop))
                parts = [(pair[some], x[some], y[some])]
                if cut.stop > cut.start:
                    parts.append(frequent(own_met, who[cut], of[cut], at[cut]))
                both, xs, ys = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
                got.append(_linked(docs[both // len(matches)], matches[both % len(matches)], xs, ys, need))
        rows = _packed_chains(key, got)
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _exactly(texts: DataFrame, again: DataFrame, parts: int, least_words: int, identity: float) -> DataFrame:
    """All earlier documents that may share a passage around frequent seeds left over, and what these hold of them."""
    grouped_by = lambda df: df.repartition(parts, "key").groupBy("key")
    every = materialize(again.filter(f"kind = {FREQUENT}"), "op3-frequent")
    if every.isEmpty():
        return every
    asked = materialize(grouped_by(every).applyInArrow(_near(least_words), "of long, block int"), "op3-near")
    some = texts.mapInArrow(member_filter(asked.select("of"), "doc_id"), texts.schema)
    words = some.mapInArrow(_blocks, "of long, block int, words binary").join(asked, ["of", "block"])
    words = words.select(F.pmod(F.hash("of"), F.lit(parts)).alias("key"), "of", "block", "words")
    joint = _joint(least_words, identity)
    linked = materialize(grouped_by(again.filter(f"kind = {ANCHORS}")).applyInArrow(_linked_already(parts, least_seeds(least_words, identity), joint), PACK), "op3-linked")
    pairs = grouped_by(words).cogroup(grouped_by(every)).applyInArrow(_neighbours(parts, least_words, identity, _steps(texts).tobytes()), PACK)
    meet = grouped_by(pairs).applyInArrow(_meet(parts), PACK).unionByName(linked)
    # what was shuffled up to here goes when this is written
    return materialize(grouped_by(meet).cogroup(grouped_by(every)).applyInArrow(_theirs(parts, joint), PACK), "op3-theirs")


def _place(s: np.ndarray, d: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Where each (doc, pos) stands among its seed's occurrences lo .. hi, which are in this order: a binary search."""
    a, b = lo.copy(), hi.copy()
    while (a < b).any():
        mid = np.minimum((a + b) // 2, len(d) - 1)
        less = (a < b) & ((d[mid] < doc) | (d[mid] == doc) & (p[mid] < pos))
        b = np.where(a < b, np.where(less, b, mid), b)
        a = np.where(less, mid + 1, a)
    return np.minimum(a, hi - 1) - lo


def passages(docs: DataFrame, least_words: int = 50, identity: float = 0.8, part_bytes: int = 4 << 20, hot: int = HOT) -> DataFrame:
    """The repeated passages of `docs` (doc_id, text); seeds with more than `hot` occurrences count as frequent."""
    small_batches(docs.sparkSession)
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = partitions_for(texts, part_bytes, 16)
    grouped_by = lambda df: df.repartition(parts, "key").groupBy("key")
    scanned = texts.mapInArrow(tidy(_scan(parts, least_words)), PACK)
    shared = materialize(grouped_by(scanned).applyInArrow(_share(parts), PACK), "op3-shared")
    chained = lambda df: grouped_by(df.filter(f"kind IN ({ANCHORS}, {LINKS})")).applyInArrow(_chain(least_words, identity), PACK)
    found = _found(texts, chained(shared), parts, least_words, identity, "first")

    anchors = shared.filter(f"kind = {ANCHORS}")
    bucket = lambda of: F.pmod(F.hash(of), F.lit(parts)).alias("key")
    covered = lambda df: grouped_by(df.select(bucket("doc_id"), "doc_id", "start_word", "end_word"))
    left = grouped_by(anchors).cogroup(covered(found)).applyInArrow(_left(parts, least_words, identity), PACK)
    again = grouped_by(left).cogroup(grouped_by(shared.filter(f"kind = {SEEDS}"))).applyInArrow(_again(parts, hot), PACK)
    again = materialize(again, "op3-again")
    theirs = _exactly(texts, again, parts, least_words, identity)
    rest = grouped_by(again).cogroup(grouped_by(theirs)).applyInArrow(_rest(least_words, identity), PACK)
    found = found.unionByName(_found(texts, rest, parts, least_words, identity, "rest"))

    lengths = sorted({min(LONGER, least_words), least_words})
    asked = grouped_by(anchors).cogroup(covered(found)).applyInArrow(_unlinked(lengths, least_words, identity), "window long, of long, at long, words long")
    asked = materialize(asked, "op3-windows")
    if asked.isEmpty():
        return found
    among = member_filter(asked.select("window"), "window")
    first = texts.mapInArrow(_places(parts, lengths, among), "window long, doc_id long, pos long").groupBy("window").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    linked = asked.join(first, "window").filter("first.doc_id < of")
    linked = linked.select(bucket("of"), "of", F.col("first.doc_id").alias("match"), F.col("at").alias("x"), F.col("first.pos").alias("y"), "words")
    return found.unionByName(_found(texts, chained(grouped_by(linked).applyInArrow(_cover, PACK)), parts, least_words, identity, "long"))
