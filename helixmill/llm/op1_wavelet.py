"""Token ids as wavelet matrix shards.

Documents are range-partitioned and sorted by doc_id; each task encodes its texts and writes the ids of a shard
as a wavelet matrix: 16 bit-planes, most significant first, each a stable partition of the one before, with a
rank directory. The files are Parquet (zstd), a file for each partition and a row for each shard, so that any
store that Spark reaches can hold them. `Wavelet` gives access, rank, select, count and whole decoding of a shard;
`count`, `access` and `locate` answer from all files, shard by shard in Spark, without decoding them.

Null texts count as empty: such a document has its end id only. Repeated rows are documents of their own, ordered
by a hash of the text where ids tie (so an id that very many rows share is split, too); rows without doc_id come
first; other columns are ignored; an empty table makes no shard. A very long text lies in one shard, however long.
`start` is the number of ids in all documents before, over all shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import wordbpe
from .common import partitions_for, small_batches, tidy

BITS, RANK_WORDS = 16, 64  # planes; bytes of a plane between two entries of its rank directory
SHARD = "shard long, part int, n long, nulls int, doc_ids binary, sizes binary, zeros binary, planes binary, ranks binary"
_SHARD = pa.schema([("shard", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("nulls", pa.int32()), *((c, pa.binary()) for c in ("doc_ids", "sizes", "zeros", "planes", "ranks"))])
DOCS = "shard long, doc_id long, at long, n_tokens long, ids_crc32 long"


class Wavelet:
    """Wavelet matrix over 16-bit symbols."""

    def __init__(self, n: int, zeros: np.ndarray, planes: np.ndarray, ranks: np.ndarray):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> Wavelet:
        a, n = ids.astype(np.uint16), len(ids)
        size = -(-n // 8)
        planes = np.zeros((BITS, size), np.uint8)
        zeros = np.zeros(BITS, np.int64)
        for level in range(BITS):
            bit = (a & np.uint16(1 << (BITS - 1 - level))) != 0
            planes[level] = np.packbits(bit)
            low = np.compress(~bit, a)
            zeros[level] = len(low)
            a = np.concatenate((low, np.compress(bit, a)))
        ones = np.bitwise_count(planes[:, : size // RANK_WORDS * RANK_WORDS]).reshape(BITS, -1, RANK_WORDS).sum(axis=2, dtype=np.int64)
        ranks = np.zeros((BITS, ones.shape[1] + 1), np.int64)
        np.cumsum(ones, axis=1, out=ranks[:, 1:])
        return cls(n, zeros, planes, ranks)

    def to_bytes(self) -> dict[str, bytes]:
        return {"zeros": self.zeros.astype("<i8").tobytes(), "planes": self.planes.tobytes(), "ranks": self.ranks.astype("<i8").tobytes()}

    @classmethod
    def from_bytes(cls, n: int, zeros: bytes, planes: bytes, ranks: bytes) -> Wavelet:
        return cls(n, np.frombuffer(zeros, "<i8"), np.frombuffer(planes, np.uint8).reshape(BITS, -1), np.frombuffer(ranks, "<i8").reshape(BITS, -1))

    def _rank1(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        byte, rest = divmod(i, 8)
        block = byte // RANK_WORDS
        out = int(self.ranks[level, block]) + int(np.bitwise_count(self.planes[level, block * RANK_WORDS : byte]).sum())
        return out + (int(self.planes[level, byte]) >> (8 - rest)).bit_count() if rest else out

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane: a binary search over rank."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._rank1(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def access(self, i: int) -> int:
        value = 0
        for level in range(BITS):
            ones = self._rank1(level, i)
            if self.planes[level, i // 8] >> (7 - i % 8) & 1:
                value, i = value << 1 | 1, int(self.zeros[level]) + ones
            else:
                value, i = value << 1, i - ones
        return value

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(BITS):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            z = int(self.zeros[level])
            lo, hi = (z + a, z + b) if symbol >> (BITS - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, symbol: int, i: int) -> int:
        """Occurrences of the symbol before position i."""
        lo, hi = self._range(symbol, 0, i)
        return hi - lo

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Position of the symbol's k-th occurrence, from 0."""
        lo, hi = self._range(symbol, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in reversed(range(BITS)):
            bit = symbol >> (BITS - 1 - level) & 1
            i = self._select(level, bit, i - int(self.zeros[level]) if bit else i)
        return i

    def locate(self, symbol: int) -> np.ndarray:
        """Positions of all occurrences of the symbol: their stretch of the last plane, led back plane by plane."""
        lo, hi = self._range(symbol, 0, self.n)
        at = np.arange(lo, hi)
        for level in reversed(range(BITS)) if hi > lo else ():
            bit = symbol >> (BITS - 1 - level) & 1
            own = np.unpackbits(self.planes[level], count=self.n).view(bool)
            at = np.flatnonzero(own if bit else ~own)[at - int(self.zeros[level]) if bit else at]
        return np.sort(at)

    def decode(self) -> np.ndarray:
        """All symbols in order: the partitions are undone from the last plane to the first."""
        if not self.n:
            return np.zeros(0, np.uint16)
        # each plane says where its two halves came from; the last needs no order, its bits are the symbols' own
        a = np.unpackbits(self.planes[BITS - 1], count=self.n).astype(np.uint16)
        for level in reversed(range(BITS - 1)):
            bit = np.unpackbits(self.planes[level], count=self.n).view(bool)
            z = int(self.zeros[level])
            before = np.empty(self.n, np.uint16)
            before[np.flatnonzero(~bit)] = a[:z]
            before[np.flatnonzero(bit)] = a[z:] | np.uint16(1 << (BITS - 1 - level))
            a = before
        return a


def _build(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = wordbpe.encoder(path)
        docs, sizes, data, total, seq = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            ids, of = np.concatenate(data), pa.concat_arrays(docs)
            w = Wavelet.build(ids).to_bytes()
            row = [part << 24 | seq, part, len(ids), of.null_count, of.fill_null(0).to_numpy().astype("<i8").tobytes(), np.concatenate(sizes).astype("<i8").tobytes(), w["zeros"], w["planes"], w["ranks"]]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARD)], schema=_SHARD)

        for batch in batches:
            ids, cuts = encode(batch.column(1), end_id)
            docs.append(batch.column(0))
            sizes.append(np.diff(cuts))
            data.append(ids)
            total += len(ids)
            if total >= shard_tokens:
                yield shard()
                docs, sizes, data, total, seq = [], [], [], 0, seq + 1
        if total:
            yield shard()

    return run


def write_shards(docs: DataFrame, out: str, path: str, end_id: int = 1, partition_bytes: int = 12 << 20, shard_tokens: int = 2_000_000) -> None:
    """Write the ids of `docs` (doc_id, text) in ascending doc_id order as wavelet matrix files under `out`."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # rows of one id are told apart by their texts' hashes: the ranges' bounds are numbers, however long the texts
    texts = texts.withColumn("hash", F.xxhash64("text"))
    ordered = texts.repartitionByRange(partitions_for(texts, partition_bytes), "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    ordered.select("doc_id", "text").mapInArrow(tidy(_build(path, end_id, shard_tokens)), SHARD).write.option("compression", "zstd").parquet(out)


def _load(row: dict) -> Wavelet:
    return Wavelet.from_bytes(row["n"], row["zeros"], row["planes"], row["ranks"])


def _owners(row: dict) -> tuple[pa.Array, np.ndarray]:
    """The doc_id of each document of a shard, and where each document begins (and the last one ends)."""
    sizes = np.frombuffer(row["sizes"], "<i8")
    return pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.arange(len(sizes)) < row["nulls"]), np.concatenate(([0], np.cumsum(sizes)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wordbpe.release()
    for batch in batches:
        for row in batch.to_pylist():
            ids = _load(row).decode().astype("<u4")
            doc, cuts = _owners(row)
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), row["shard"])), doc, pa.array(cuts[:-1]), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_bases(files: DataFrame) -> DataFrame:
    """shard, n and base: the number of ids in all shards before.

    Offsets in two steps, so that no window holds more than the shards of one partition or the partitions.
    """
    parts = files.groupBy("part").agg(F.sum("n").alias("ids"))
    parts = parts.withColumn("group", F.expr("part div 4096"))
    groups = parts.groupBy("group").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("own", F.coalesce(F.sum("ids").over(before), F.lit(0))).join(groups, "group").select("part", (F.col("base") + F.col("own")).alias("base"))
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.select("part", "shard", "n").withColumn("own", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return shards.join(parts, "part").select("shard", "n", (F.col("base") + F.col("own")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and crc32 of the ids of every document, decoded from the files at `path`."""
    files = _files(spark, path)
    return files.mapInArrow(tidy(_read), DOCS).join(shard_bases(files), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def count(spark: SparkSession, path: str, symbols: list[int]) -> DataFrame:
    """symbol and n: occurrences of each symbol in all files, by rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                w = _load(row)
                yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.int32()), pa.array([w.count(s) for s in symbols], pa.int64())], names=["symbol", "n"])

    return _files(spark, path).mapInArrow(run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def access(spark: SparkSession, path: str, positions: DataFrame, bin_size: int = 1 << 21) -> DataFrame:
    """at and id for each position `at` (from 0, over all files) of `positions`; those beyond the end have no row.

    A position finds its shard by an equi-join of bins; each shard then answers what it is asked.
    """
    files = _files(spark, path)
    shards = shard_bases(files).filter("n > 0").withColumn("bin", F.explode(F.expr(f"sequence(base div {bin_size}, (base + n - 1) div {bin_size})")))
    asked = positions.select(F.col("at").cast("long").alias("at")).distinct().withColumn("bin", F.expr(f"at div {bin_size}"))
    asked = asked.join(shards, "bin").filter("at >= base AND at < base + n").select("shard", "at", (F.col("at") - F.col("base")).alias("own"))

    def run(table: pa.Table, asked: pa.Table) -> pa.Table:
        w = _load(table.to_pylist()[0]) if table.num_rows else None
        return pa.table({"at": asked.column("at"), "id": pa.array([w.access(i) for i in asked.column("own").to_pylist()], pa.int32())})

    return _files(spark, path).groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(run, "at long, id int")


def locate(spark: SparkSession, path: str, symbol: int) -> DataFrame:
    """doc_id and start (of its document), and at: the position in all files of each occurrence of the symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = _load(row).locate(symbol)
                doc, cuts = _owners(row)
                of = np.searchsorted(cuts, at, side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["shard"])), doc.take(pa.array(of)), pa.array(cuts[of]), pa.array(at)], names=["shard", "doc_id", "start", "at"])

    files = _files(spark, path)
    found = files.mapInArrow(run, "shard long, doc_id long, start long, at long").join(shard_bases(files), "shard")
    return found.select("doc_id", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("at")).alias("at"))
