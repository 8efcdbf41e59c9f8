"""The best pairs of each gene without screening all: pairs by rounds of falling bounds, until a threshold ends them.

A pair matches no more rows than either primer, fails at the 3' end in no fewer rows than either, and its
heterodimer's penalty is not below 0; the other parts of its score are known from the primers. So the score of a row
with these values bounds the pair's own (each step of the score is monotone, in floating point too). Once as many
pairs as are asked for have scores, no pair whose bound is below the last of these can be among the best.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import STRICT, Params, Scoring
from ..storage import stored
from .coverage import KEY, alignment_sizes, pair_coverage
from .pairs import candidate_pairs, heterodimer_screen
from .places import placed
from .scoring import score_pairs, top_pairs

FIRST, GROWTH = 4, 8  # the first round in units of top_n, and how rounds grow


def bounds(candidates: DataFrame, masks: DataFrame, msa: DataFrame, metrics: DataFrame | None = None, specificity: DataFrame | None = None, conservation_3p: DataFrame | None = None, scoring: Scoring = Scoring()) -> DataFrame:
    """Add `bound`, which the final score of a candidate pair can't pass, from counts of its primers alone."""
    counts = masks.groupBy(KEY).agg(F.sum(F.bit_count("ok")).alias("ok"), F.sum(F.bit_count("bad3")).alias("bad3"))
    pseudo = candidates
    for side in ("forward", "reverse"):
        own = counts.filter(F.col("orientation") == side).select("gene", F.col("sequence").alias(f"{side}_seq"), F.col("msa_start").alias(f"{side}_start"), F.col("msa_end").alias(f"{side}_end"), F.col("ok").alias(f"{side}_ok"), F.col("bad3").alias(f"{side}_bad3"))
        pseudo = pseudo.join(own, ["gene", f"{side}_seq", f"{side}_start", f"{side}_end"])
    pseudo = pseudo.join(alignment_sizes(msa), "gene").withColumns({
        "pair_coverage_fraction": F.least("forward_ok", "reverse_ok") / F.col("total_sequences_count"),
        "failed_due_to_3prime_count": F.greatest("forward_bad3", "reverse_bad3"), "heterodimer_tm": F.lit(scoring.heterodimer_good),
    })
    return score_pairs(pseudo, metrics, specificity, conservation_3p, scoring).withColumnRenamed("final_score", "bound").select(*candidates.columns, "bound")


def pruned_scores(primers: DataFrame, masks: DataFrame, msa: DataFrame, params: Params = STRICT, specificity: DataFrame | None = None, conservation_3p: DataFrame | None = None, dedupe: bool = False, scoring: Scoring = Scoring()) -> tuple[DataFrame, DataFrame]:
    """Scored pairs among which are the best top_n of each gene and all that repeat their sequences; and gene, pairs,
    screened: how many candidates there were, and how many were screened and counted.

    primers: metrics of those that passed; masks: primer_masks of the same primers and rows. With `dedupe` a pair of
    sequences counts once among the best.
    """
    found = candidate_pairs(primers, params).filter("forward_end <= reverse_start")
    columns = found.columns
    queue = stored(bounds(found, masks, msa, primers, specificity, conservation_3p, scoring), "bounds")
    queue = stored(placed(queue, ["gene"], [F.desc("bound"), F.col("f_ord"), F.col("r_ord")]), "queue")

    def screened(rows: DataFrame) -> DataFrame:
        rows = stored(rows.select(columns), "round")
        fit = rows.join(heterodimer_screen(rows), ["forward_seq", "reverse_seq"]).filter((F.col("heterodimer_tm") <= params.max_heterodimer_tm) | F.isnan("heterodimer_tm"))
        return stored(score_pairs(pair_coverage(fit, masks, msa, params), primers, specificity, conservation_3p, scoring), "scores")

    begin, end = 0, FIRST * params.top_n
    scores, limit, done = None, None, None
    while True:
        batch = queue.filter((F.col("place") >= begin) & (F.col("place") < end))
        if limit is not None:
            batch = batch.join(limit, "gene", "left").filter(F.col("limit").isNull() | (F.col("bound") >= F.col("limit"))).drop("limit")
        batch = stored(batch, "batch")
        done = batch if done is None else done.unionByName(batch)
        more = screened(batch)
        scores = more if scores is None else scores.unionByName(more)
        best = scores.groupBy("gene", "forward_seq", "reverse_seq").agg(F.max("final_score").alias("final_score")) if dedupe else scores
        place = F.row_number().over(Window.partitionBy("gene").orderBy(F.desc("final_score")))
        limit = stored(best.select("gene", "final_score", place.alias("n")).filter(F.col("n") == params.top_n).select("gene", F.col("final_score").alias("limit")), "limit")
        left = queue.filter(F.col("place") >= end).join(limit, "gene", "left").filter(F.col("limit").isNull() | (F.col("bound") >= F.col("limit")))
        if not left.head(1):
            break
        begin, end = end, end * GROWTH
    # a lookup by sequences holds the last row of its order, so rows that repeat those of the best are scored too
    last = scores.join(limit, "gene", "left").filter(F.col("limit").isNull() | (F.col("final_score") >= F.col("limit"))).select("gene", "forward_seq", "reverse_seq").distinct()
    seen = done.select("gene", "place")
    rest = stored(queue.join(last, ["gene", "forward_seq", "reverse_seq"], "left_semi").join(seen, ["gene", "place"], "left_anti"), "repeats")
    scores = scores.unionByName(screened(rest))
    total = queue.groupBy("gene").agg(F.count("*").alias("pairs"))
    used = done.select("gene").unionAll(rest.select("gene")).groupBy("gene").agg(F.count("*").alias("screened"))
    return scores, total.join(used, "gene")


def pruned_top_pairs(primers: DataFrame, masks: DataFrame, msa: DataFrame, single_coverage: DataFrame, params: Params = STRICT, specificity: DataFrame | None = None, conservation_3p: DataFrame | None = None, dedupe: bool = False, scoring: Scoring = Scoring()) -> DataFrame:
    """scoring.top_pairs of all pairs, from the scores of those that may be among the best."""
    scores, _ = pruned_scores(primers, masks, msa, params, specificity, conservation_3p, dedupe, scoring)
    return top_pairs(scores, single_coverage, primers, specificity, params, dedupe)
