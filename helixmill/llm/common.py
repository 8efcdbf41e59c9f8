"""Helpers that the operators of this subpackage share: shared folders, partition sizes, words and hashes in numpy."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


_OWN: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables under spark.checkpoint.dir, which all executors share.

    Where that setting is absent a local temporary folder is used in local mode (tests); elsewhere that is an error,
    since executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN.get(app) or _OWN.setdefault(app, tempfile.mkdtemp(prefix="helixmill-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _shuffle_files_end_here(spark: SparkSession):
    """What a write has shuffled is removed when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs neither recompute it nor depend on an executor."""
    path = shared_dir(df.sparkSession, name)
    with _shuffle_files_end_here(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As materialize, in files bucketed by a column: a join or grouping by it needs no shuffle of this side.

    The table's name serves the write and the read alone; it is dropped at once, which leaves the files.
    """
    spark, table = df.sparkSession, f"helixmill_{uuid.uuid4().hex}"
    with _shuffle_files_end_here(spark):
        df.write.bucketBy(min(buckets, 100_000), key).option("path", shared_dir(spark, name)).option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def plan_bytes(df: DataFrame) -> int:
    """Size of the input as the optimizer knows it (file sizes); counted over the rows where it knows none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < 1 << 50:
        return size
    cols = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in df.schema.fields]
    return int(df.agg(F.sum(sum(cols, F.lit(8)))).first()[0] or 0)


def partitions_for(df: DataFrame, each: int, least: int = 1) -> int:
    """As many partitions as it takes to give each about `each` bytes of the input."""
    return max(least, -(-plan_bytes(df) // each))


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Arrow batches of few rows and bytes: texts may be long, and a batch is held whole by a Python worker.

    A setting of the session, since a plan takes it when it runs; every operator of this subpackage makes the same one.
    """
    for name, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", str(value))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: idle Python workers stay beside the next stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A mapInArrow function that gives memory back when its input ends."""

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POW = {"n": 0, "up": None, "down": None}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POW["n"] < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _P), ("down", _PINV)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _POW[name] = np.multiply.accumulate(out)
        _POW["n"] = size
    return _POW["up"][:n], _POW["down"][:n]


def span_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes: of their bytes' polynomial, from running sums."""
    up, down = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[: len(b)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (runs without ASCII white space) of lower-cased texts, computed over all bytes at once.

    Returns the 64-bit hashes, the text each word belongs to, and the words' byte starts and ends in the
    joined buffer. Every step is a numpy pass, so the cost is a few nanoseconds a byte.
    """
    raw = "\n".join(texts).lower() if texts else ""
    if raw.count("\n") != sum(t.count("\n") for t in texts) + max(0, len(texts) - 1):
        raise ValueError("lower() must keep line feeds")
    data = raw.encode("utf-8", "surrogatepass")
    sizes = np.fromiter((len(t.lower().encode("utf-8", "surrogatepass")) + 1 for t in texts), np.int64, len(texts)) if not raw.isascii() else np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    space = _SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    if not space[-1]:
        edge = np.concatenate((edge, [len(b)]))
    start, end = edge[0::2], edge[1::2]
    h = span_hashes(b, start, end)
    doc = np.searchsorted(np.cumsum(sizes), start, side="right")
    return h, doc, start, end


_K = mix(np.arange(101, 165, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_hashes(h: np.ndarray, doc: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one text; a text of fewer words (but one at least) has one shingle of them all.

    Returns hashes, texts, and the index of each shingle's first word.
    """
    n = len(h)
    if not n:
        return h, doc, doc
    first = np.concatenate(([True], doc[1:] != doc[:-1]))
    begin = np.flatnonzero(first)
    count = np.diff(np.concatenate((begin, [n])))
    out = np.zeros(n, np.uint64)
    left = np.repeat(begin + count, count) - np.arange(n)
    for i in range(k):
        ok = left > i
        out[: n - i] += np.where(ok[: n - i], h[i:] * _K[i], 0)
    keep = (left >= k) | (first & (left < k))
    at = np.flatnonzero(keep)
    return mix(out[at] + np.uint64(1)), doc[at], at


def member_filter(keys: DataFrame, column: str, bits: int = 1 << 23):
    """A mapInArrow function that keeps the rows whose `column` may be among `keys` (one long column).

    The keys go into one bitmap of fixed size (1 MB), however many there are; few others pass while they are few,
    and all rows pass when they are many, so an exact join must follow. It spares that join the other rows' texts.
    """
    own = keys.columns[0]
    bit = keys.filter(F.col(own).isNotNull()).select(F.pmod(F.hash(F.col(own).cast("long")), F.lit(bits)).alias("bit")).distinct()
    packed = bit.groupBy(F.expr("bit div 32").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("mask")).collect()
    table = np.zeros(bits // 32, np.uint32)
    for row in packed:
        table[row.slot] = row.mask
    filled = np.unpackbits(table.astype("<u4").view(np.uint8), bitorder="little").view(bool)
    small = np.packbits(filled)

    def run(batches):
        known = np.unpackbits(small, count=bits).view(bool)
        for batch in batches:
            h = np.array(batch.column(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            yield batch.filter(_as_mask(known[hash_long(h).astype(np.int64) % bits]))

    return run


def _as_mask(x: np.ndarray):
    import pyarrow as pa

    return pa.array(x, pa.bool_())


def hash_long(x: np.ndarray) -> np.ndarray:
    """Spark's hash() of one long (murmur3, 32 bits, seed 42), as signed 32 bits."""
    u = x.astype(np.int64).view(np.uint64)
    h = np.full(len(u), 42, np.uint32)
    for k in ((u & np.uint64(0xFFFFFFFF)).astype(np.uint32), (u >> np.uint64(32)).astype(np.uint32)):
        k = k * np.uint32(0xCC9E2D51)
        k = (k << np.uint32(15)) | (k >> np.uint32(17))
        k = k * np.uint32(0x1B873593)
        h ^= k
        h = (h << np.uint32(13)) | (h >> np.uint32(19))
        h = h * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h ^= h >> np.uint32(16)
    h = h * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h = h * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h.view(np.int32)
