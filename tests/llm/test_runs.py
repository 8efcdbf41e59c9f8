"""Periodic runs against all pairs of positions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmill.llm import op12_runs


def brute(w):
    """Every stretch at every lag, the smallest lag of each stretch."""
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] == w[i + q]:
                j = i
                while j + q < n and w[j] == w[j + q]:
                    j += 1
                if j - i + q >= max(24, 3 * q):
                    out.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, k = rng.choice([0, 1, 5, 30, 100, 300, 700]), rng.choice([1, 2, 3, 26, 1000])
    w = [b"%d" % rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n >= 10 else 0):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        for i in range(a + p, min(n, a + p * rng.randint(2, 6) + rng.randint(0, p))):
            w[i] = w[i - p]
        if rng.random() < 0.3:
            w[rng.randrange(n)] = b"x"
    return w


@pytest.mark.parametrize("seed", range(40))
def test_all_runs(seed):
    rng = random.Random(seed)
    docs = [random_words(rng) for _ in range(rng.randint(1, 8))]
    assert op12_runs.find_runs(docs) == [brute(d) for d in docs]


@pytest.mark.parametrize("period", [1, 2, 7, 15, 16, 23, 24, 35, 36, 100, 333])
def test_runs_of_exactly_three_periods(period):
    """Found in every scale at any place, one word short of three periods not."""
    rng = random.Random(period)
    unit = [b"u%d" % i for i in range(period)]
    n = max(24, 3 * period)
    for lead in (0, 1, 17):
        head, tail = [b"h%d" % i for i in range(lead)], [b"t%d" % i for i in range(rng.randint(0, 40))]
        whole = (unit * (n // period + 1))[:n]
        assert op12_runs.find_runs([head + whole + tail]) == [[(lead, n, period)]]
        assert op12_runs.find_runs([head + whole[:-1] + tail]) == [[]]


def test_nested_and_overlapping_runs():
    inner = [b"a", b"b"] * 20 + [b"c"]
    docs = [inner * 4, [b"x"] * 30 + [b"y"] * 30, ([b"p", b"q", b"r"] * 12 + [b"z"] * 25) * 3]
    assert op12_runs.find_runs(docs) == [brute(d) for d in docs]
    assert op12_runs.find_runs([]) == []


def test_one_word_in_a_long_text_and_hard_words():
    thue = np.array([bin(i).count("1") & 1 for i in range(3000)])
    docs = [[b"w"] * 50_000, [b"%d" % x for x in thue] + [b"%d" % x for x in thue[:900]] * 3]
    got = op12_runs.find_runs(docs)
    assert got[0] == [(0, 50_000, 1)] and got[1] == brute(docs[1])


def want(doc_id, text, plant):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("plant", [True, False])
def test_rows(spark, plant):
    rng = random.Random(3)
    rows = [(100 + i, " ".join(x.decode() for x in random_words(rng))) for i in range(120)]
    rows += [(None, None), (None, "a " * 40), (7, ""), (8, " \t\x0b"), (9, "é x " * 30), (9, "é x " * 30), (10, "lo ng " * 15_000), (11, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_runs": F.lit("x"), "period": F.lit(1.5), "a.b": F.lit(True)})
    key = lambda r: tuple(map(str, r))
    got = sorted(map(tuple, op12_runs.runs(df, plant).collect()), key=key)
    assert [r for r in got if r[0] != 10] == sorted((want(d, t, plant) for d, t in rows if d != 10), key=key)
    long = [r for r in got if r[0] == 10]
    assert len(long) == 1 and (plant or long[0][:6] == (10, 1, 0, 30_000, 2, 15_000_000))
    assert op12_runs.runs(df.limit(0), plant).count() == 0
