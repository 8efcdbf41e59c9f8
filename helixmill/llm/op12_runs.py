"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words with smallest period q that is at least max(24, 3 q) words long and that no neighbour
extends. Texts are taken in batches: their words become numbers in one long array, with a number of its own after
each document, so that nothing crosses a border, and every step below is a numpy pass over that array.

- Periods under SHORT are found by direct lag scans: stretches of equal words at that lag.
- Longer periods are parted into scales [Q, R) with R = 3 Q / 2. At each position stands a hash of the K = R - 1
  words from there; a window minimum (a minimizer) is a position whose hash is the least of some window of
  W = 2 Q - K + 1 positions. In a run of period q >= Q a window and the one q later both fit, with equal hashes, so a
  minimizer repeats at distance q; and since K >= q no equal hash lies between the two. So pairs of neighbours among
  equal minimizers whose distance lies in the scale seed all runs of the scale; such a pair is a square already.
- Seeds are extended word by word, once for each stretch, which also verifies them.

A document that is too short for a scale (under 3 Q words) leaves the array. Work is linear in the words for each
scale, and there are log(n) scales; a document is in one task, as it is one row, and a batch ends when it holds
enough bytes.

Null and empty texts have no words: no runs, four nulls, and the digests of empty strings. Rows that repeat give equal
rows, a null doc_id stays null (and its text is never changed); other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, small_batches, tidy

LEAST, TIMES = 24, 3  # words and periods of a run
SHORT = 16
BYTES = 1 << 22  # of text in an array
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, with a tail that repeats in every tenth document by crc32 of the doc_id."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (1 + (n - a) // p))[: n - a]


def numbered(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all documents as numbers, each document followed by a number of its own; where they begin."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    codes = pa.array([w for d in docs for w in d], pa.binary()).dictionary_encode()
    ids = np.empty(int(sizes.sum()) + len(docs), np.int32)
    last = np.zeros(len(ids), bool)
    last[begin + sizes] = True
    ids[~last] = codes.indices.to_numpy()
    ids[last] = len(codes.dictionary) + np.arange(len(docs))
    return ids, begin


def _stretches(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the stretches of True."""
    edge = np.flatnonzero(flag[1:] != flag[:-1]) + 1
    if len(flag) and flag[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.append(edge, len(flag))
    return edge[0::2], edge[1::2]


def short_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, lag) of the stretches with a period under SHORT."""
    out = []
    for q in range(1, min(SHORT, len(ids))):
        a, b = _stretches(ids[q:] == ids[:-q])
        ok = b - a >= max(LEAST - q, (TIMES - 1) * q)
        out += [(s, e + q, q) for s, e in zip(a[ok].tolist(), b[ok].tolist())]
    return out


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Least (or most) of each `width` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    return best(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """Positions whose value is the least of some window of `width` positions."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = _sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, h.dtype)
    return np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), width, np.maximum) == h)


def _extend(ids: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The stretch of period d around the words at i and i + d: its start and end."""
    right, step = i, 64
    while right + d < len(ids):
        n = min(step, len(ids) - d - right)
        other = np.flatnonzero(ids[right : right + n] != ids[right + d : right + d + n])
        if len(other):
            right += int(other[0])
            break
        right, step = right + n, step * 2
    left, step = i, 64
    while left > 0:
        n = min(step, left)
        other = np.flatnonzero(ids[left - n : left] != ids[left - n + d : left + d])
        if len(other):
            left -= n - 1 - int(other[-1])
            break
        left, step = left - n, step * 2
    return left, right + d


def long_runs(ids: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, lag) of the runs with a period from SHORT on; sizes are the documents' words."""
    out: list[tuple[int, int, int]] = []
    low = SHORT
    at, left = np.arange(len(ids)), sizes
    block, power = mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1  # hashes of `power` words
    while True:
        long = left >= TIMES * low
        if not long.any():
            return out
        if not long.all():
            stay = np.repeat(long, left + 1)
            at, block, left = at[stay], block[stay], left[long]
        high = low * 3 // 2
        k = high - 1
        width = 2 * low - k + 1
        while power * 2 <= k:
            block = mix(block[:-power] * np.uint64(3) + block[power:]) if len(block) > power else block[:0]
            # positions at the end have no block; they keep a place, with a number of their own
            block = np.concatenate((block, mix(np.arange(len(at) - len(block), dtype=np.uint64) + np.uint64(power << 40))))
            power *= 2
        rest = k - power
        h = block[: len(block) - rest] * np.uint64(5) + block[rest:] if rest else block
        h = h[: max(0, len(at) - k + 1)]
        p = minimizers(h, width)
        order = np.argsort(h[p], kind="stable")
        p = p[order]
        d = p[1:] - p[:-1]
        ok = (d >= low) & (d < high) & (h[p[1:]] == h[p[:-1]])
        seeds = sorted(zip(d[ok].tolist(), at[p[:-1][ok]].tolist()))
        lag, upto = 0, -1
        for q, i in seeds:
            if q == lag and i < upto:
                continue
            s, e = _extend(ids, i, q)
            lag, upto = q, e - q
            if e - s >= TIMES * q:
                out.append((s, e, q))
        low = high


def find_runs(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """start, length and period of the runs of each document, by start and period."""
    ids, begin = numbered(docs)
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    smallest: dict[tuple[int, int], int] = {}
    for s, e, q in short_runs(ids) + long_runs(ids, sizes):
        smallest[s, e] = min(q, smallest.get((s, e), q))
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if smallest:
        found = sorted((s, q, e) for (s, e), q in smallest.items())
        for (s, q, e), doc in zip(found, np.searchsorted(begin, [x[0] for x in found], side="right") - 1):
            out[doc].append((int(s - begin[doc]), int(e - s), int(q)))
    return out


def _row(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    if not runs:
        return doc_id, 0, None, None, None, None, digest, hashlib.sha256(b" ".join(words)).hexdigest()
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q : s + n] = False
    s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return doc_id, len(runs), s, n, q, 1000 * n // q, digest, hashlib.sha256(b" ".join(compress(words, keep.tolist()))).hexdigest()


def _rows(ids: list, texts: list[str | None], plant: bool) -> pa.RecordBatch:
    docs = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    if plant:
        docs = [planted(w, i) for i, w in zip(ids, docs)]
    rows = [_row(i, w, r) for i, w, r in zip(ids, docs, find_runs(docs))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """n_runs, the run of the greatest exponent, and digests of all runs and of the words left without their repeats,
    for every row of docs(doc_id, text). With `plant` every tenth document's tail is made periodic before."""
    small_batches(docs.sparkSession)

    def each(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = size = 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size >= BYTES or i + 1 == len(texts):
                    yield _rows(ids[begin : i + 1], texts[begin : i + 1], plant)
                    begin, size = i + 1, 0

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(each), SCHEMA)
