"""BPE encoding and decoding through a distinct-word table.

1. Each task splits its texts in Arrow and numbers the words of a block of documents; a batch of documents becomes
   one row of word numbers (positions), and the block's words go out once each, by hash bucket. The block also keeps
   the bucket of each number, so that replies need not repeat the numbers. All of this is stored, bucketed by block.
2. Words meet in their bucket, where each distinct word is encoded once; ids return to every block that asked.
3. Blocks join their ids back by position, where their rows already lie (the stored side isn't shuffled again), and
   join the ids with the table of pieces, which is as large as the vocabulary, to decode them.

A word shared by all documents is one row for each block, so no key is hot. The words are stored before anything
meets, so nothing depends on the order in which a scan returns its rows. Null texts count as empty (no ids, empty
decoded text); a null doc_id stays null; repeated rows give repeated results; other columns are ignored; an empty
table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbpe
from .common import give_back, materialize_by, partitions_for, small_batches, tidy

#: bucket: of the words in data, or -1 for the word numbers of documents, or -2 for the buckets of a block's numbers
_PARTS = "block long, bucket int, docs binary, sizes binary, data binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "sizes", "data"))])
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_STEP = 200_000  # ids decoded at once


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _pack(numbers: np.ndarray, z: zstandard.ZstdCompressor) -> bytes:
    """32-bit numbers as compressed byte planes."""
    return z.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _split(buckets: int, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        z = zstandard.ZstdCompressor(level=1)
        block = TaskContext.get().partitionId() << 32
        numbers, chars = _Numbers(), 0

        def words() -> pa.RecordBatch:
            every = pa.array(list(numbers), pa.string())
            of = (wordbpe.hashes(every) % np.uint64(buckets)).astype(np.uint32)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(buckets + 1))
            rows = [(block, -2, None, None, _pack(of, z))]
            for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                own = every.take(pa.array(order[cuts[k] : cuts[k + 1]])).to_pylist()
                rows.append((block, k, None, None, z.compress("\n".join(own).encode())))
            return _rows(rows)

        for batch in batches:
            of, distinct, cuts = wordbpe.words_of(batch.column(1))
            number = np.fromiter(map(numbers.__getitem__, distinct.to_pylist()), np.uint32, len(distinct))
            doc = batch.column(0)
            ids = doc.fill_null(0).to_numpy().astype("<i8").tobytes() + np.asarray(doc.is_null()).tobytes()
            yield _rows([(block, -1, ids, _pack(np.diff(cuts), z), _pack(number[of], z))])
            chars += batch.column(1).nbytes
            if chars >= block_chars:
                yield words()
                numbers, chars, block = _Numbers(), 0, block + 1
        if numbers:
            yield words()

    return run


def _encode_bucket(path: str):
    def run(table: pa.Table) -> pa.Table:
        encoder = wordbpe.encoder(path)
        asked = [pa.array(zstandard.decompress(d).decode().split("\n"), pa.string()) for d in table.column("data").to_pylist()]
        words = pa.concat_arrays(asked).dictionary_encode()
        size, ids = encoder.encode(words.dictionary)
        at, of, z = np.cumsum(size) - size, words.indices.to_numpy(), zstandard.ZstdCompressor(level=1)
        cuts = np.cumsum([0, *map(len, asked)])
        parts = [of[a:b] for a, b in zip(cuts, cuts[1:])]
        out = pa.table([table.column("block"), table.column("bucket"), pa.nulls(len(parts), pa.binary()), pa.array([_pack(size[p], z) for p in parts], pa.binary()), pa.array([z.compress(wordbpe.gather(ids, at[p], size[p]).tobytes()) for p in parts], pa.binary())], schema=_SCHEMA)
        del asked, words, ids, parts
        give_back()
        return out

    return run


class _Pieces:
    """The id-to-piece table: each piece's bytes and a space."""

    def __init__(self, path: str):
        t = wordbpe.load(path)
        every = [(t.id_to_token(i) or "").encode() + b" " for i in range(t.get_vocab_size(with_added_tokens=True))]
        self.size = np.fromiter(map(len, every), np.int64, len(every))
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(every), np.uint8)

    def digests(self, ids: np.ndarray, cuts: list[int]) -> list[str]:
        """SHA-256 of each text's pieces, parted by spaces; a bounded number of ids is joined at once."""
        out, h, d = [], hashlib.sha256(), 0
        for lo in range(0, max(1, len(ids)), _STEP):
            own = ids[lo : lo + _STEP]
            hi, n = lo + len(own), self.size[own]
            text = memoryview(wordbpe.gather(self.flat, self.at[own], n).tobytes())
            ends = np.concatenate(([0], np.cumsum(n))).tolist()
            while d + 1 < len(cuts) and cuts[d + 1] <= hi:
                a, b = ends[max(cuts[d], lo) - lo], ends[cuts[d + 1] - lo]
                h.update(text[a : max(a, b - 1)])
                out.append(h.hexdigest())
                h, d = hashlib.sha256(), d + 1
            if d + 1 < len(cuts) and cuts[d] < hi:
                h.update(text[ends[max(cuts[d], lo) - lo] :])
        return out


def _assemble(path: str):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        pieces = _Pieces(path)
        rows = list(zip(*(docs.column(c).to_pylist() for c in ("bucket", "docs", "sizes", "data"))))
        bucket_of = next((_unpack(d) for k, _, _, d in rows if k == -2), np.zeros(0, np.uint32))
        order = np.argsort(bucket_of, kind="stable")  # the block's numbers as the replies have them
        back = sorted(zip(*(replies.column(c).to_pylist() for c in ("bucket", "sizes", "data"))))
        got = np.concatenate([np.zeros(0, np.uint32), *(_unpack(s) for _, s, _ in back)]).astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(zstandard.decompress(d), "<u2") for _, _, d in back)])
        at, size = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        at[order], size[order] = np.cumsum(got) - got, got
        out = []
        for _, doc, sizes, data in (r for r in rows if r[0] == -1):
            number = _unpack(data)
            n = len(doc) // 9
            ids = wordbpe.gather(flat, at[number], size[number])
            cuts = np.concatenate(([0], np.cumsum(size[number])))[np.concatenate(([0], np.cumsum(_unpack(sizes), dtype=np.int64)))].tolist()
            raw = memoryview(ids.astype("<u4").tobytes())
            sha = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
            of = pa.array(np.frombuffer(doc, "<i8", n), mask=np.frombuffer(doc, bool, n, 8 * n))
            out.append(pa.table([of, pa.array(np.diff(cuts), pa.int64()), pa.array(sha, pa.string()), pa.array(pieces.digests(ids, cuts), pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]))
        give_back()
        empty = pa.table([pa.nulls(0, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return pa.concat_tables([empty, *out])

    return run


def encode_decode(docs: DataFrame, path: str, block_chars: int = 16_000_000, bucket_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of every row of `docs` (doc_id, text)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    buckets = partitions_for(texts, bucket_bytes, 8)
    stored = materialize_by(texts.mapInArrow(tidy(_split(buckets, block_chars)), _PARTS), "op2-words", "block", buckets)
    encoded = stored.filter("bucket >= 0").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_encode_bucket(path), _PARTS)
    return stored.filter("bucket < 0").groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(_assemble(path), RESULT)
