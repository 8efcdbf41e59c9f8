"""Ranking by rounds of bounds against the ranking of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from helixmill.operators import coverage, pairs, pruning, scoring, thermo
from helixmill.params import STRICT
from helixmill.storage import stored

P = STRICT.with_(min_gc=20.0, max_gc=80.0, min_tm=30.0, max_tm=80.0, max_run=6, min_clamp=0, max_tm_diff=6.0, min_len=18, max_len=20, top_n=3, gap_mode="penalize", max_mismatches=3, max_hairpin_tm=90.0, max_homodimer_tm=90.0, max_self_dimer_3p_tm=90.0)


@pytest.fixture(scope="module")
def assay(spark):
    """Two genes whose rows differ, primers at many places, and repeats of the same sequence at another place."""
    rng = random.Random(9)
    rows, primers = [], []
    for g in ("a", "b"):
        unit = "".join(rng.choice("ACGT") for _ in range(70))
        base = unit + "".join(rng.choice("ACGT") for _ in range(80)) + unit
        rows += [(g, i, "".join(c if rng.random() < 0.97 else rng.choice("ACGT-") for c in base)) for i in range(25)]
        for at in [*range(0, 50, 7), *range(152, 196, 7)]:
            primers += [(g, base[at : at + 18], "forward", at, at + 18), (g, base[at : at + 18][::-1].translate(str.maketrans("ACGT", "TGCA")), "reverse", at, at + 18)]
    msa = stored(coverage.number_rows(spark.createDataFrame(rows, "gene string, seq_idx long, aligned string")), "msa")
    p = spark.createDataFrame([(*x, i) for i, x in enumerate(primers)], "gene string, sequence string, orientation string, msa_start int, msa_end int, ord long")
    metrics = stored(thermo.primer_metrics(p, P).filter("passed_basic_filters"), "metrics")
    masks = stored(coverage.primer_masks(metrics, msa, P), "masks")
    single = stored(metrics.select(*coverage.KEY, "ord").join(coverage.single_coverage(metrics, msa, P), coverage.KEY), "single")
    return msa, metrics, masks, single


def test_the_same_best_pairs(spark, assay):
    msa, metrics, masks, single = assay
    exact = stored(scoring.score_pairs(coverage.pair_coverage(stored(pairs.primer_pairs(metrics, P), "pairs"), masks, msa, P), metrics), "exact")
    bound = pruning.bounds(pairs.candidate_pairs(metrics, P), masks, msa, metrics).select("gene", "f_ord", "r_ord", "bound")
    both = exact.select("gene", "f_ord", "r_ord", "final_score").join(bound, ["gene", "f_ord", "r_ord"])
    assert both.agg(F.count("*"), F.count_if(F.col("bound") < F.col("final_score"))).first() == (exact.count(), 0)
    scores, counts = pruning.pruned_scores(metrics, masks, msa, P)
    got, full = (sorted(map(str, scoring.top_pairs(s, single, metrics, params=P).collect())) for s in (scores, exact))
    assert got == full and len(got) == 2 * P.top_n
    assert all(r.screened < r.pairs for r in counts.collect())


def test_fewer_pairs_than_asked_for(spark, assay):
    msa, metrics, masks, _ = assay
    few = metrics.filter("gene = 'a' AND msa_start < 50 OR gene = 'b' AND orientation = 'forward'")
    scores, counts = pruning.pruned_scores(few, masks, msa, P.with_(top_n=500), dedupe=True)
    found = counts.collect()
    assert [r.gene for r in found] == ["a"] and 0 < scores.count() <= found[0].screened == found[0].pairs
