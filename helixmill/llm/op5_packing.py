"""Best-fit decreasing packing of tokenised documents into sequences.

Lengths are whole numbers of at most `capacity`, so best-fit decreasing over all pieces is decided by how many
pieces there are of each length: the plan needs those counts alone (at most `capacity` rows on the driver, at
any input size). A segment tree over the remaining capacities gives the tightest open bin in logarithmic time;
a stretch of bins that stand alike is filled in one step, as piece after piece would fill it. Pieces then find
their place by their rank among those of their length; ranks come from counts by (block, length), so a length
that a third of all pieces share is ranked by many tasks.

Null texts count as empty (one piece, the end id); documents longer than the capacity are cut into full pieces
and a rest; a null doc_id stays null; repeated rows are packed as documents of their own; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import wordbpe
from .common import materialize, partitions_for, small_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


class CapacityTree:
    """Open bins by remaining capacity: the least capacity of at least `need` that has any, in logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        i = remaining + self.size
        while i:
            self.count[i] += n
            i //= 2

    def tightest(self, need: int) -> int | None:
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, pieces, first bin, pieces a bin, offset): piece of rank r goes to bin
    first bin + (r - first rank) div k at offset + ((r - first rank) mod k) x length."""
    tree, stretches = CapacityTree(capacity), {}
    rows, bins = [], 0

    def open_(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            stretches.setdefault(remaining, []).append((first, n))
            tree.add(remaining, n)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = stretches[room].pop()
                tree.add(room, -n)
            k = room // length
            full, rest = min(n, left // k), 0
            if full < n:
                rest = left - full * k
            placed = full * k + rest
            rows.append((length, rank, placed, first, k, capacity - room))
            open_(room - k * length, first, full)
            if rest:
                open_(room - rest * length, first + full, 1)
            open_(room, first + full + bool(rest), n - full - bool(rest))
            left, rank = left - placed, rank + placed
    return rows


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = wordbpe.encoder(path)
        for batch in batches:
            ids, cuts = encode(batch.column(1), end_id)
            size = np.diff(cuts)
            many = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * capacity
            length = np.minimum(size[doc] - start, capacity)
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip((cuts[doc] + start).tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *(pa.array(c, f.type) for c, f in zip((piece, start, length, crc), list(_PIECES)[1:]))], schema=_PIECES)

    return run


def pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """The pieces of every document of `docs` (doc_id, text)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.mapInArrow(_pieces(path, end_id, capacity), PIECES)


def pack(found: DataFrame, capacity: int = 2048, block_bytes: int = 2 << 20) -> DataFrame:
    """Add sequence_id and offset to pieces (a stored table with a number of its own for each row: it is read twice)."""
    spark = found.sparkSession
    blocks = partitions_for(found, block_bytes, 16)
    found = found.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    counts = found.groupBy("length", "block").agg(F.count("*").alias("n"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    rows = plan(totals, capacity)
    steps = spark.createDataFrame(rows or [(0, 0, 0, 0, 1, 0)], "length long, first_rank long, placed long, first_bin long, k long, at long")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("block", "length").orderBy("row")
    ranked = found.withColumn("own", F.row_number().over(own) - 1).join(base, ["block", "length"]).withColumn("rank", F.col("base") + F.col("own"))
    # The plan is bounded by the capacity, not by the input; it is broadcast.
    i = F.col("rank") - F.col("first_rank")
    placed = ranked.join(F.broadcast(steps), "length").filter((i >= 0) & (i < F.col("placed")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_bin") + F.floor(i / F.col("k"))).cast("long").alias("sequence_id"), (F.col("at") + i % F.col("k") * F.col("length")).cast("long").alias("offset"))


def best_fit(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    return pack(materialize(pieces(docs, path, end_id, capacity).withColumn("row", F.monotonically_increasing_id()), "op5-pieces"), capacity)
