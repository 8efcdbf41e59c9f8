"""The Merkle manifest against a tree built row by row."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from helixmill.llm import op11_merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def paths(digests):
    """The root of a list of digests, and for each the siblings before and after it at each level."""
    out, where, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for i, p in enumerate(where):
            run = level[p // 8 * 8 : p // 8 * 8 + 8]
            out[i].append((run[: p % 8], run[p % 8 + 1 :]))
        level = [H(*level[i : i + 8]) for i in range(0, len(level), 8)]
        where = [p // 8 for p in where]
    return level[0], out


def brute(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    langs = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: paths([x[2] for x in sorted(by[k], key=lambda x: x[:3])]) for k in langs}
    root, above = paths([trees[k][0] for k in langs])
    out = []
    for k, up in zip(langs, above):
        for (_, _, own, r), path in zip(sorted(by[k], key=lambda x: x[:3]), trees[k][1]):
            path = path + up
            change = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            at = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])) if change else own
            for left, right in path:
                at = H(*left, at, *right)
            out.append((str(r[0]), own, trees[k][0], root, H(*(x for a, b in path for x in a + b)), at, at == root))
    return sorted(out)


ODD = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, `lo` double, `a.b` string, kept boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2.0, "x", True) for r in rows], ODD)


def run(spark, rows):
    return sorted((str(r[0]), *r[1:]) for r in op11_merkle.manifest(table(spark, rows)).collect())


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "fr": 9}, {"en": 600, None: 65, "é": 64, "z": 1, "": 3}])
def test_manifest(spark, sizes):
    rng = random.Random(4)
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7 % 1009, rng.choice(["A b É", "", None, "x" * rng.randint(1, 40), "Ünï"]), lang, rng.choice(["s", None]), rng.choice([3, None])))
    if len(sizes) > 2:
        rows += [(None, "A", "en", "s", 1), (None, None, None, None, None), (5, "Q" * 300_000, "fr", "s", 9)] + [(7, "Same", "en", "s", 4)] * 30
    got = run(spark, rows)
    assert got == brute(rows)
    if len(sizes) > 2:
        assert {r[6] for r in got} == {True, False}


def test_an_empty_table_and_many_languages(spark):
    assert op11_merkle.manifest(table(spark, []).limit(0)).count() == 0
    rows = [(i, "T", f"l{i}", "s", 1) for i in range(70)]
    assert run(spark, rows) == brute(rows)


def test_ranges_do_not_matter(spark, monkeypatch):
    """The same digests whatever the ranges that place the leaves."""
    rows = [(i % 50, f"Text {i}", "en" if i % 3 else None, "s", i) for i in range(300)]
    placed = op11_merkle.placed
    monkeypatch.setattr(op11_merkle, "placed", lambda *a, **k: placed(*a, **k, each=16))
    assert run(spark, rows) == brute(rows)


def test_intervals_are_nested(spark):
    leaves = spark.range(100).select(F.lit("t").alias("tree"), F.col("id").alias("place"), F.lit(100).cast("long").alias("total"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    trees = op11_merkle.levels(leaves, "test")
    assert [t.count() for t in trees] == [100, 13, 2, 1]
    for t in trees[1:]:
        for r in t.collect():
            assert r.kids[0].lo == r.lo and r.kids[-1].hi == r.hi and all(a.hi == b.lo for a, b in zip(r.kids, r.kids[1:])) and len(r.kids) <= 8
