"""Weighted scores, ranking, top-N and output assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import clip01, linear_penalty
from ..params import STRICT, Params, Scoring
from .coverage import COVERAGE_ORDER
from .pairs import order_by

RANK = [("final_score", True), ("pair_coverage_fraction", True), ("single_primer_3prime_conservation", True), ("offtarget_penalty", False), ("heterodimer_penalty", False), ("amplicon_size_penalty", False)]


def last_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The last row of each key in the given order, as a lookup that later rows overwrite would hold."""
    w = Window.partitionBy(*keys).orderBy(*order)
    last = F.row_number().over(w) == F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_last", last).filter("_last").drop("_last")


def score_pairs(coverage: DataFrame, metrics: DataFrame | None = None, specificity: DataFrame | None = None, conservation_3p: DataFrame | None = None, scoring: Scoring = Scoring()) -> DataFrame:
    """Add penalties and final_score to pair coverage.

    metrics(gene, sequence, hairpin_tm, homodimer_tm), specificity(forward_seq, reverse_seq,
    off_target_pair_risk_score) and conservation_3p(gene, sequence, conservation) are optional lookups.
    """
    none = F.lit(None).cast("double")
    p = coverage
    for side in ("forward", "reverse"):
        if metrics is None:
            p = p.withColumns({f"{side}_hairpin": none, f"{side}_homodimer": none})
        else:
            m = metrics.select("gene", F.col("sequence").alias(f"{side}_seq"), F.col("hairpin_tm").alias(f"{side}_hairpin"), F.col("homodimer_tm").alias(f"{side}_homodimer")).dropDuplicates(["gene", f"{side}_seq"])
            p = p.join(m, ["gene", f"{side}_seq"], "left")
        if conservation_3p is None:
            p = p.withColumn(f"{side}_cons", none)
        else:
            p = p.join(conservation_3p.select("gene", F.col("sequence").alias(f"{side}_seq"), F.col("conservation").alias(f"{side}_cons")), ["gene", f"{side}_seq"], "left")
    p = p.withColumn("risk", none) if specificity is None else p.join(specificity.select("forward_seq", "reverse_seq", F.col("off_target_pair_risk_score").alias("risk")), ["forward_seq", "reverse_seq"], "left")
    c = scoring
    both = F.col("forward_hairpin").isNotNull() & F.col("reverse_hairpin").isNotNull()
    hairpin = F.when(both, F.greatest("forward_hairpin", "reverse_hairpin")).otherwise(c.hairpin_good)
    homodimer = F.when(both, F.greatest("forward_homodimer", "reverse_homodimer")).otherwise(c.homodimer_good)
    n = F.col("total_sequences_count")
    fallback = F.when(n > 0, 1.0 - clip01(F.col("failed_due_to_3prime_count") / n)).otherwise(0.0)
    cons = F.when(F.col("forward_cons").isNotNull() & F.col("reverse_cons").isNotNull(), clip01((F.col("forward_cons") + F.col("reverse_cons")) / 2.0)).otherwise(fallback)
    length = F.col("amplicon_length")
    # bases beyond the preferred range, as a share of those allowed there; where none are allowed each counts 1
    size = F.greatest(F.lit(0), (c.preferred_min - length) / float(max(1, c.preferred_min - c.allowed_min)), (length - c.preferred_max) / float(max(1, c.allowed_max - c.preferred_max)))
    p = p.withColumns({
        "single_primer_3prime_conservation": cons, "tm_balance_score": 1.0 - clip01(F.col("tm_diff") / c.tm_diff_bad),
        "gc_score": 1.0 - 0.5 * clip01(F.abs(F.col("gc_forward") - F.col("gc_reverse")) / c.gc_diff_bad) - 0.5 * clip01(F.abs((F.col("gc_forward") + F.col("gc_reverse")) / 2.0 - c.gc_target) / c.gc_delta_bad),
        "hairpin_penalty": linear_penalty(hairpin, c.hairpin_good, c.hairpin_bad), "homodimer_penalty": linear_penalty(homodimer, c.homodimer_good, c.homodimer_bad),
        "heterodimer_penalty": linear_penalty(F.col("heterodimer_tm"), c.heterodimer_good, c.heterodimer_bad), "offtarget_penalty": F.when(F.col("risk").isNull(), 0.0).otherwise(clip01(F.col("risk") / c.risk_bad)),
        "amplicon_size_penalty": clip01(size.cast("double")),
    })
    thermo = clip01(c.tm_balance * F.col("tm_balance_score") + c.gc * F.col("gc_score") + c.hairpin * (1.0 - F.col("hairpin_penalty")) + c.homodimer * (1.0 - F.col("homodimer_penalty")) + c.heterodimer * (1.0 - F.col("heterodimer_penalty")))
    quality = c.coverage * clip01(F.col("pair_coverage_fraction")) + c.prime3 * F.col("single_primer_3prime_conservation") + c.specificity * (1.0 - F.col("offtarget_penalty")) + c.thermo * thermo + c.amplicon * (1.0 - F.col("amplicon_size_penalty"))
    return p.withColumn("final_score", F.round(100.0 * clip01(quality), 9)).drop("forward_hairpin", "reverse_hairpin", "forward_homodimer", "reverse_homodimer", "forward_cons", "reverse_cons", "risk")


def top_pairs(scored: DataFrame, single_coverage: DataFrame, metrics: DataFrame, specificity: DataFrame | None = None, params: Params = STRICT, dedupe: bool = False) -> DataFrame:
    """The best top_n pairs of each gene, ranked, with the coverage and metrics of their sequences.

    Repeated pairs stay unless `dedupe`; lookups by sequence hold the last row of their order.
    """
    if dedupe:
        first = Window.partitionBy("gene", "forward_seq", "reverse_seq").orderBy(*order_by(RANK + COVERAGE_ORDER))
        scored = scored.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    rank = F.row_number().over(Window.partitionBy("gene").orderBy(*order_by(RANK + COVERAGE_ORDER)))
    best = scored.withColumn("rank", rank).filter(F.col("rank") <= params.top_n).select("gene", "rank", "forward_seq", "reverse_seq", "final_score")
    pair = last_by(scored, ["gene", "forward_seq", "reverse_seq"], order_by(COVERAGE_ORDER)).drop("final_score")
    out = best.join(pair, ["gene", "forward_seq", "reverse_seq"])
    nan = F.lit(float("nan"))
    for side in ("forward", "reverse"):
        c = last_by(single_coverage, ["gene", "sequence"], [F.col("ord")]).select("gene", F.col("sequence").alias(f"{side}_seq"), F.col("coverage_fraction").alias(f"{side}_coverage"), F.col("prime3_mismatch_count").alias(f"{side}_3prime_mismatch_count"))
        m = metrics.select("gene", F.col("sequence").alias(f"{side}_seq"), F.col("hairpin_tm").alias(f"{side}_hairpin_tm"), F.col("homodimer_tm").alias(f"{side}_homodimer_tm")).dropDuplicates(["gene", f"{side}_seq"])
        out = out.join(c, ["gene", f"{side}_seq"], "left").join(m, ["gene", f"{side}_seq"], "left")
        out = out.withColumns({f"{side}_coverage": F.coalesce(f"{side}_coverage", F.lit(0.0)), f"{side}_3prime_mismatch_count": F.coalesce(f"{side}_3prime_mismatch_count", F.lit(0)), f"{side}_hairpin_tm": F.coalesce(f"{side}_hairpin_tm", nan), f"{side}_homodimer_tm": F.coalesce(f"{side}_homodimer_tm", nan)})
    out = out.withColumn("offtarget_summary", F.lit("offtarget:not_checked")) if specificity is None else out.join(specificity, ["forward_seq", "reverse_seq"], "left").withColumn("offtarget_summary", offtarget_summary())
    return out.select(
        "gene", "rank", F.upper("forward_seq").alias("forward_sequence"), F.upper("reverse_seq").alias("reverse_sequence"), F.col("forward_start").alias("forward_msa_start"), F.col("forward_end").alias("forward_msa_end"),
        F.col("reverse_start").alias("reverse_msa_start"), F.col("reverse_end").alias("reverse_msa_end"), "tm_forward", "tm_reverse", "gc_forward", "gc_reverse", "amplicon_length", "forward_coverage", "reverse_coverage",
        F.col("pair_coverage_fraction").alias("pair_coverage"), "forward_3prime_mismatch_count", "reverse_3prime_mismatch_count", "forward_hairpin_tm", "reverse_hairpin_tm", "forward_homodimer_tm", "reverse_homodimer_tm",
        "heterodimer_tm", "offtarget_summary", "final_score",
    )


def offtarget_summary():
    """One line on the off-target amplicons of a pair; pairs without a row were not checked."""
    text = F.format_string("offtarget_amplicons=%d; offtarget_amplicons_good3p=%d; offtarget_risk=%.3f", F.col("potential_off_target_amplicons_count"), F.col("good_3prime_off_target_amplicons_count"), F.col("off_target_pair_risk_score"))
    return F.when(F.col("off_target_pair_risk_score").isNull(), F.lit("offtarget:not_checked")).otherwise(text)
