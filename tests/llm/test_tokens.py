"""Token operators against the tokenizers library: exact ids, round trips, packing."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixmill.llm import op1_wavelet, op2_bpe, op5_packing, wordbpe
from helixmill.llm.common import shared_dir

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")

TEXTS = [
    None, "", "  \n\t ", "The cat, the dog.", "The cat, the dog.", "it's DON'T we'll 123 4é é ÅΣΑΣ naïve straße", "a<|endoftext|>b <|startoftext|>x <|ENDOFTEXT|> <|endof",
    "日本語 テキスト 🎉🎉 x​y a b c\x1cd\x1de\x85f", "́x ́ İstanbul ﬁ ǅ K", "x" * 3000, "word " * 5000, "$$$ *** !!! ... the... (the) \"the\" 'the' the's", "\x00 \x01a \ufffd",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)


@pytest.fixture(scope="module")
def ids():
    t = wordbpe.load(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in TEXTS]


def encoded(e, texts, end=None):
    ids, cuts = e(pa.array(texts, pa.string()), end)
    return [x.tolist() for x in np.split(ids, cuts[1:-1])] if texts else []


def test_encoder_equals_library(ids):
    e = wordbpe.Encoder(PATH)
    assert e.direct
    texts = [t or "" for t in TEXTS]
    assert encoded(e, texts) == encoded(e, texts) == ids
    assert encoded(e, texts, 1) == [[*x, 1] for x in ids]
    tiny = wordbpe.Encoder(PATH, limit=2)
    assert [encoded(tiny, [t])[0] for t in texts] == ids
    assert encoded(e, []) == [] and encoded(e, ["", ""]) == [[], []]
    whole = pa.array(["x", *texts, "y"]).slice(1, len(texts))
    assert np.split(e(whole)[0], e(whole)[1][1:-1])[3].tolist() == ids[3]


def test_encoder_on_random_text():
    rng = random.Random(5)
    letters = "aB'd\u00e9.,! \n\t9\u03a9\u00df<|>\x1c\u3000\u00b4e\u0301\u0130\u212a\u212b\xa0\x85\x0b\u00c9\u00d7\u00f7\u00de"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(600)]
    t = wordbpe.load(PATH)
    assert encoded(wordbpe.Encoder(PATH), texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 8, 513, 5000):
        ids = (rng.zipf(1.3, n) % 49408).astype(np.uint16)
        w = op1_wavelet.Wavelet.from_bytes(n, **op1_wavelet.Wavelet.build(ids).to_bytes())
        assert (w.decode() == ids).all()
        for i in rng.integers(0, n, 20) if n else ():
            assert w.access(int(i)) == ids[i] and w.rank(int(ids[i]), int(i)) == (ids[:i] == ids[i]).sum()
            assert w.select(int(ids[i]), w.rank(int(ids[i]), int(i))) == i
        if n:
            assert w.locate(int(ids[0])).tolist() == np.flatnonzero(ids == ids[0]).tolist() and w.locate(49407).tolist() == np.flatnonzero(ids == 49407).tolist()
            assert w.count(int(ids[0])) == (ids == ids[0]).sum() and w.count(49407) == (ids == 49407).sum()
            with pytest.raises(IndexError):
                w.select(int(ids[0]), n)


@pytest.mark.parametrize("shard_tokens", [1, 50, 10**6])
def test_shards(spark, docs, ids, shard_tokens):
    out = shared_dir(spark, "t1")
    op1_wavelet.write_shards(docs, out, PATH, partition_bytes=100_000, shard_tokens=shard_tokens)
    got = sorted(map(tuple, op1_wavelet.read_documents(spark, out).collect()))
    want, at = [], 0
    for doc in sorted([*range(len(TEXTS)), 3]):
        x = [*ids[doc], 1]
        want.append((doc, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert got == want


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    out = shared_dir(spark, "t1")
    op1_wavelet.write_shards(none, out, PATH)
    assert op1_wavelet.read_documents(spark, out).count() == 0
    assert op2_bpe.encode_decode(none, PATH).count() == 0 and op5_packing.best_fit(none, PATH).count() == 0


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (2, "c"), (None, "a b"), (None, None)], "doc_id long, text string")
    out = shared_dir(spark, "t1")
    op1_wavelet.write_shards(docs, out, PATH, shard_tokens=1)
    got = sorted(op1_wavelet.read_documents(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, None, 2] and sorted(r.n_tokens for r in got[:3]) == [1, 3, 3]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert {r.doc_id for r in op2_bpe.encode_decode(docs, PATH).collect()} == {r.doc_id for r in op5_packing.best_fit(docs, PATH).collect()} == {None, 2}


@pytest.mark.parametrize("shard_tokens", [50, 10**6])
def test_lookups_over_files(spark, docs, ids, shard_tokens):
    out = shared_dir(spark, "t1")
    op1_wavelet.write_shards(docs, out, PATH, partition_bytes=100_000, shard_tokens=shard_tokens)
    own = [*range(4), 3, *range(4, len(TEXTS))]
    whole = [i for d in own for i in [*ids[d], 1]]
    starts = np.cumsum([0, *(len(ids[d]) + 1 for d in own)])
    asked = [0, 5, len(whole) - 1, len(whole), 7, 7, *range(100, 3000, 71)]
    got = {r.at: r.id for r in op1_wavelet.access(spark, out, spark.createDataFrame([(i,) for i in asked], "at long"), bin_size=64).collect()}
    assert got == {i: whole[i] for i in asked if i < len(whole)}
    common = collections.Counter(whole).most_common(1)[0][0]
    assert {r.symbol: r.n for r in op1_wavelet.count(spark, out, [1, common, 49406]).collect()} == {s: whole.count(s) for s in (1, common, 49406)}
    for symbol in (1, common, 49406):
        want = [(own[k], int(starts[k]), i) for i, s in enumerate(whole) if s == symbol for k in [int(np.searchsorted(starts, i, side="right")) - 1]]
        assert sorted(map(tuple, op1_wavelet.locate(spark, out, symbol).collect())) == sorted(want)


@pytest.mark.parametrize("block_chars", [10, 10**7])
def test_encode_decode(docs, ids, block_chars):
    t = wordbpe.load(PATH)
    got = sorted(map(tuple, op2_bpe.encode_decode(docs, PATH, block_chars=block_chars).collect()))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == sorted((d, len(ids[d]), sha(np.array(ids[d], "<u4").tobytes()), sha(t.decode(ids[d], skip_special_tokens=False).encode())) for d in [*range(len(TEXTS)), 3])


def _best_fit_decreasing(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return len(room)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for capacity in (10, 37, 64):
        for _ in range(40):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(80))]
            counts = {n: lengths.count(n) for n in set(lengths)}
            bins: dict = {}
            placed = dict.fromkeys(counts, 0)
            for length, first, n, bin_, k, at in op5_packing.plan(counts, capacity):
                assert first == placed[length]
                placed[length] += n
                for r in range(n):
                    bins.setdefault(bin_ + r // k, []).append((at + r % k * length, length))
            assert placed == counts and len(bins) == _best_fit_decreasing(lengths, capacity)
            for b in bins.values():
                at = 0
                for offset, length in sorted(b):
                    assert offset == at
                    at += length
                assert at <= capacity


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(docs, ids, capacity):
    rows = op5_packing.best_fit(docs, PATH, capacity=capacity).collect()
    bins: dict = {}
    for r in rows:
        piece = [*ids[r.doc_id], 0][r.start : r.start + r.length]
        assert r.start == r.piece * capacity and len(piece) == r.length and zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(ids[d]) + 1 for d in [*range(len(TEXTS)), 3])
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == np.cumsum([0, *(n for _, n in sorted(b))])[:-1].tolist() and sum(n for _, n in b) <= capacity
    assert len(bins) == _best_fit_decreasing([r.length for r in rows], capacity)
    assert docs.select(F.count("*")).first()[0] == len({(r.doc_id, r.piece) for r in rows if r.piece == 0}) + 1


def test_blocks_of_rows_without_id(spark):
    """Rows without doc_id, of one text, are dealt to blocks by numbers of their own and packed whole."""
    docs = spark.createDataFrame([(None, "same words")] * 300 + [(7, "")] * 200, "doc_id long, text string").repartition(4)
    rows = op5_packing.best_fit(docs, PATH, capacity=16).collect()
    assert len(rows) == 500
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 16
    assert len(bins) == _best_fit_decreasing([r.length for r in rows], 16)
