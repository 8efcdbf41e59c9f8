"""Segments of columns, ranges of values and bins of subjects give what whole genes and subjects would."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmill.operators import candidates, profile, records, regions, specificity
from helixmill.params import STRICT, Params


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _scores(spark, sizes, seed=1):
    rng = random.Random(seed)
    made = {}
    for g, n in sizes.items():
        level, out = 0.5, []
        for _ in range(n):
            level = rng.choice([level, level, level, level, 1.0, rng.random()])
            out.append(round(level, 3))
        made[g] = out
    return made, spark.createDataFrame([(g, c, v) for g, vs in made.items() for c, v in enumerate(vs)], "gene string, col int, score double")


def _plain(values, p):
    """Windows, their quantile and the runs at or above it."""
    if len(values) < p.window_size:
        return [], []
    means = [round(sum(values[i : i + p.window_size]) / p.window_size, 12) for i in range(len(values) - p.window_size + 1)]
    limit = round(float(np.quantile(means, p.top_quantile)), 12)
    runs, i = [], 0
    while i < len(means):
        j = i
        while j < len(means) and means[j] >= limit:
            j += 1
        if j > i:
            runs.append((i, j - 1 + p.window_size, round(sum(means[i:j]) / (j - i), 9)))
        i = max(j, i + 1)
    return means, runs


@pytest.mark.parametrize("segment", [4, 5, 7, 16, 33, 1 << 16])
def test_regions_by_segments(spark, segment):
    p = Params(window_size=4, top_quantile=0.6)
    made, scores = _scores(spark, {"a": 64, "b": 33, "c": 4, "d": 3, "e": 150})
    want = {g: _plain(v, p) for g, v in made.items()}
    got = rows(regions.window_mean(scores, p, segment), "gene", "col", "window_mean")
    flat = [(g, c, m) for g, (means, _) in want.items() for c, m in enumerate(means)]
    assert [x[:2] for x in got] == [x[:2] for x in sorted(flat)] and all(abs(a[2] - b[2]) < 1e-11 for a, b in zip(got, sorted(flat)))
    found = [(*r[:4], round(r[4], 9)) for r in rows(regions.conserved_regions(scores, p, segment), "gene", "region_index", "start_col", "end_col", "mean_score")]
    assert found == sorted((g, i, *r) for g, (_, runs) in want.items() for i, r in enumerate(runs))


def test_a_run_over_many_segments(spark):
    """A gene of one value is one region, however often it is cut."""
    scores = spark.range(1000).select(F.lit("g").alias("gene"), F.col("id").cast("int").alias("col"), F.lit(0.75).alias("score"))
    assert rows(regions.conserved_regions(scores, Params(window_size=3), 8), "region_index", "start_col", "end_col", "mean_score") == [(0, 0, 1000, 0.75)]


def test_a_long_gene_spreads_over_tasks(spark):
    scores = spark.range(300_000).select(F.lit("g").alias("gene"), F.col("id").cast("int").alias("col"), (F.col("id") % 1000 / 1000).alias("score"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        parts = regions.window_mean(scores, STRICT, 1 << 12).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(parts) > 10 and max(r["count"] for r in parts) < 100_000


@pytest.mark.parametrize("segment", [6, 9, 10, 1 << 12])
def test_candidates_by_segments(spark, segment):
    rng = random.Random(2)
    base = "".join(rng.choice("ACGT") for _ in range(120))
    msa = spark.createDataFrame([("g", i, "".join(c if rng.random() < 0.95 else rng.choice("ACGT-") for c in base)) for i in range(12)], "gene string, seq_idx long, aligned string")
    prof = profile.column_profile(msa)
    reg = spark.createDataFrame([("g", 0, 0, 40), ("g", 1, 35, 81), ("g", 2, 100, 120), ("g", 3, 118, 120)], "gene string, region_index int, start_col int, end_col int")
    p = Params(min_len=5, max_len=6, min_tail3_identity=0.0, min_tail5_identity=0.0, max_high_gap_positions=6)
    got = candidates.window_candidates(prof, reg, p, segment).orderBy("ord").collect()
    cells = {r.col: r for r in prof.collect()}
    want = []
    for i, s, e in ((0, 0, 40), (1, 35, 81), (2, 100, 120), (3, 118, 120)):
        for n in (5, 6):
            for a in range(s, e - n + 1):
                own = [cells[c] for c in range(a, a + n)]
                text = "".join(c.consensus_base for c in own)
                if "N" not in text:
                    want += [(i, a, n, text, round(sum(c.identity for c in own) / n, 12), min(c.identity for c in own), o) for o in ("forward", "reverse")]
    assert [(r.region_index, r.window_start, r.length, r.template_seq, round(r.mean_conservativity, 12), r.min_conservativity, r.orientation) for r in got] == want
    assert max(r.n for r in candidates.column_segments(prof, 5, segment).select(F.size("ids").alias("n")).collect()) <= segment + 5


def test_positions_beyond_ten_million(spark):
    """Numbers of windows far to the right, and of long ones, keep the order and don't meet."""
    starts = [(r, n, s, o) for r in (0, 1, 2000) for n in (18, 1000, 1023) for s in (5, 9_999_999, 10_000_000, 2_000_000_000) for o in ("forward", "reverse")]
    df = spark.createDataFrame(starts, "region_index int, length int, window_start int, orientation string").withColumn("ord", candidates.enumeration_order())
    got = df.orderBy("ord").collect()
    assert [tuple(r)[:4] for r in got] == sorted(starts) and len({r.ord for r in got}) == len(starts) and min(r.ord for r in got) >= 0
    with pytest.raises(Exception, match="1024 columns"):
        df.withColumn("length", F.lit(1024)).withColumn("ord", candidates.enumeration_order()).collect()
    far = spark.range(12_000_000, 12_000_030).select(F.lit("g").alias("gene"), F.col("id").cast("int").alias("col"), F.lit(1.0).alias("identity"), F.lit(0.0).alias("gap_fraction"), F.expr("substr('ACGT', cast(id % 4 as int) + 1, 1)").alias("consensus_base"))
    reg = spark.createDataFrame([("g", 0, 12_000_000, 12_000_030)], "gene string, region_index int, start_col int, end_col int")
    assert candidates.window_candidates(far, reg, Params(min_len=20, max_len=21)).count() == 2 * (11 + 10)


def test_percentiles_by_ranges(spark):
    rng = np.random.default_rng(2)
    values = {"a": rng.integers(0, 9, 41).tolist(), "b": [5], "c": rng.normal(size=300).tolist()}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "gene string, v double")
    for each in (20, 100_000):
        got = dict(rows(records.exact_percentile(df, "gene", "v", F.when(F.col("gene") == "a", 0.37).otherwise(0.9), "p", each), "gene", "p"))
        assert all(abs(got[g] - np.quantile(vs, 0.37 if g == "a" else 0.9)) < 1e-12 for g, vs in values.items())


def _hits(spark, items):
    return spark.createDataFrame([(*h, True) for h in items], "query_id string, subject_id string, sstrand string, sstart int, send int, has_good_3prime_match boolean, is_off_target boolean")


def test_off_target_amplicons_against_all_pairs(spark):
    rng = random.Random(7)
    seqs = ["AC", "GT", "CA"]
    items = []
    for _ in range(400):
        lo = rng.randint(1, 3000)
        items.append((rng.choice(seqs), rng.choice(["s", "t"]), *rng.choice([("plus", lo, lo + 19), ("minus", lo + 19, lo)]), rng.random() < 0.3))
    keys = [("AC", "GT"), ("GT", "AC"), ("CA", "CA"), ("AC", "TT")]
    pair = spark.createDataFrame(keys, "forward_seq string, reverse_seq string")
    want = []
    for f, r in keys:
        spans = [(x, y) for x in items for y in items if x[0] == f and y[0] == r and x[1] == y[1] and x[2] != y[2] and 60 <= max(*x[3:5], *y[3:5]) - min(*x[3:5], *y[3:5]) + 1 <= 150]
        want.append((f, r, len(spans), sum(x[5] or y[5] for x, y in spans)))
    got = rows(specificity.pair_specificity(pair, _hits(spark, items)), "forward_seq", "reverse_seq", "potential_off_target_amplicons_count", "good_3prime_off_target_amplicons_count")
    assert got == sorted(want) and sum(w[2] for w in want) > 100


def test_a_hundred_thousand_hits_in_one_subject(spark):
    """2 * 50,000 hits, each forward one with one reverse one 80 to its right."""
    site = spark.range(50_000).select((F.col("id") * 400 + 1).cast("int").alias("at"))
    tail = [F.lit(False).alias("has_good_3prime_match"), F.lit(True).alias("is_off_target")]
    f = site.select(F.lit("AC").alias("query_id"), F.lit("s").alias("subject_id"), F.lit("plus").alias("sstrand"), F.col("at").alias("sstart"), (F.col("at") + 19).alias("send"), *tail)
    r = site.select(F.lit("GT").alias("query_id"), F.lit("s").alias("subject_id"), F.lit("minus").alias("sstrand"), (F.col("at") + 99).alias("sstart"), (F.col("at") + 80).alias("send"), *tail)
    pair = spark.createDataFrame([("AC", "GT")], "forward_seq string, reverse_seq string")
    assert specificity.pair_specificity(pair, f.unionByName(r)).first().potential_off_target_amplicons_count == 50_000
