"""The mix of sources against targets and streams made row by row."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from helixmill.llm import op13_mixing

ODD = "doc_id long, text string, source string, lang string, key string, size int, place double, total boolean, blocks string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", "k", 3, 1.5, True, "b") for d, t, s in rows], ODD)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """By resharing what lies above three times the size until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        more = {s for s in open_ if share[s] > 3 * sizes[s] or sizes[s] == 0}
        if not more:
            return share | {s: 3.0 * sizes[s] for s in full}
        full |= more


def rows_of(rng, sizes):
    out, i = [], 0
    for source, n in sizes.items():
        while n > 0:
            k = min(n, rng.choice([1, 3, 40, 200, 900]))
            out.append((i, rng.choice([" ", ""]) + rng.choice([" ", "\n\t "]).join("w%d" % rng.randrange(99) for _ in range(k)), source))
            n, i = n - k, i + 1
    return out


@pytest.mark.parametrize("sizes", [{"a": 9000}, {"a": 9000, "b": 700, "c": 4000, None: 3000, "": 2000, "é": 500}, {"big": 60_000, "small": 3000, "tiny": 40}])
def test_mix(spark, sizes):
    rng = random.Random(5)
    rows = rows_of(rng, sizes) + [(None, None, "a"), (3, "", "b"), (3, " \x0b ", None), (4, "é ü", "a")] + [(77, "one two three", "a")] * 40
    rng.shuffle(rows)
    got = op13_mixing.mix(table(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d, size(t)) for d, t, _ in rows)
    sums = collections.Counter()
    for _, t, s in rows:
        sums[s] += size(t)
    sums = {s: sums[s] for s in {r[2] for r in rows}}
    want = targets(sums)
    assert sorted((r.source_size, round(r.target, 6)) for r in got) == sorted((sums[s], round(want[s], 6)) for _, _, s in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    taken = collections.Counter()
    for r in got:
        taken[round(r.target, 6)] += r.taken
    for s, t in want.items():
        same = [x for x in want if round(want[x], 6) == round(t, 6)]
        assert abs(taken[round(t, 6)] - t * len(same)) <= len(same) * 2 * op13_mixing.BLOCK
    assert sorted(map(str, got)) == sorted(map(str, op13_mixing.mix(table(spark, rows[::-1]).repartition(3)).collect()))


def test_nothing_to_mix(spark):
    assert op13_mixing.mix(table(spark, []).limit(0)).count() == 0
    got = op13_mixing.mix(table(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_draws_are_multinomial_and_quotas_are_met(spark):
    quota = [5000, 300, 70, 1, 2]
    sources = spark.createDataFrame([(f"={i}", i, q, max(1, q // 2)) for i, q in enumerate(quota)], "key string, number long, quota long, blocks long")
    drawn = op13_mixing.draws(sources, shard=100).collect()
    by = collections.Counter()
    for r in drawn:
        by[r.shard] += r.n
    assert set(by.values()) <= {100, sum(quota) % 100} and len(by) == -(-sum(quota) // 100)
    counts = [r.n for r in drawn if r.number == 0]
    mean, share = sum(counts) / len(counts), quota[0] / sum(quota)
    assert abs(mean - 100 * share) < 1.5 and 0.3 < sum((c - mean) ** 2 for c in counts) / len(counts) / (100 * share * (1 - share)) < 3
    got = collections.defaultdict(list)
    per = collections.Counter()
    for r in op13_mixing.slots(sources, shard=100).collect():
        got[r.number].append(r.j)
        per[r.shard] += 1
    assert {k: sorted(v) for k, v in got.items()} == {i: list(range(q)) for i, q in enumerate(quota)} and per == by


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 226, 1000, 4097])
def test_permutations(spark, n):
    found = op13_mixing.permuted(spark.range(3 * n).select(F.lit(7).cast("long").alias("number"), F.lit(n).cast("long").alias("blocks"), F.col("id").alias("j"))).collect()
    laps = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r.j):
        laps[r.lap].append(r.block)
    assert len(laps) == 3 and all(sorted(v) == list(range(n)) for v in laps.values())
    if n > 200:
        assert laps[0] != laps[1] and sum(abs(a - b) == 1 for a, b in zip(laps[0], laps[0][1:])) < n / 10


def test_texts_of_the_mix(spark):
    rng = random.Random(6)
    rows = rows_of(rng, {"a": 1500, None: 900, "c": 200})
    plan = op13_mixing.mix(table(spark, rows)).collect()
    texts = op13_mixing.mixed_texts(table(spark, rows)).collect()
    streams = {s: [w for d, t, x in rows if x == s for w in t.split()] for s in ("a", None, "c")}
    name = {"=a": "a", "": None, "=c": "c"}
    for r in texts:
        assert r.text.split(" ") == streams[name[r.source]][r.block * 64 : r.block * 64 + 64]
    assert sum(len(r.text.split(" ")) for r in texts) == sum(r.taken for r in plan)
    assert len({(r.source, r["pass"], r.block) for r in texts}) == len(texts)
