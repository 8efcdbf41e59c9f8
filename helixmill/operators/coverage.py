"""Primer coverage over the alignment: by distinct windows, and as row masks for pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import STRICT, Params
from .joins import spread, spread_join

KEY = ["gene", "sequence", "orientation", "msa_start", "msa_end"]
WORD = 60  # alignment rows in one mask
STARTS, LISTS = 16, 2_000  # start columns whose spans are one list, so that its length is bounded; lists that are broadcast


def _observed() -> Column:
    """A window as the primer sees it: reverse primers read its complement, gaps and N kept."""
    return F.when(F.col("orientation") == "forward", F.col("window")).otherwise(F.reverse(F.translate("window", "ACGT", "TGCA")))


def _mismatches(df: DataFrame, p: Params) -> DataFrame:
    """Add total, prime3, weighted and gaps of `sequence` against `observed`."""
    at = lambda c: f"substr({c}, i + 1, 1)"
    idx = "sequence(0, length(sequence) - 1)"
    gap = f"{at('observed')} = '-'"
    bad = f"{at('observed')} != {at('sequence')}" + (f" AND NOT {gap}" if p.gap_mode == "ignore" else "")
    dist = "(length(sequence) - 1 - i)"
    weight = f"CASE WHEN {gap} THEN {p.gap_penalty}D WHEN {dist} < {p.strong_3p_nt} THEN {p.strong_weight}D WHEN {dist} < {p.medium_3p_nt} THEN {p.medium_weight}D ELSE {p.base_weight}D END"
    df = df.withColumn("bad", F.expr(f"filter({idx}, i -> {bad})"))
    return df.withColumns({
        "total": F.size("bad"), "prime3": F.expr(f"size(filter(bad, i -> {dist} < {p.strong_3p_nt}))"),
        "weighted": F.expr(f"aggregate(bad, 0.0D, (t, i) -> t + {weight})"), "gaps": F.expr("length(observed) - length(replace(observed, '-', ''))"),
    }).drop("bad")


def number_rows(msa: DataFrame) -> DataFrame:
    """Add `row`, a number of each alignment row's own, for masks; store the result before it is read twice."""
    return msa.withColumn("row", F.monotonically_increasing_id())


def _row(msa: DataFrame) -> Column:
    return F.col("row") if "row" in msa.columns else F.col("seq_idx")


def _word(row: Column) -> tuple[Column, Column]:
    """The mask word of an alignment row, and its bit there."""
    return F.call_function("div", row, F.lit(WORD)).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(row, F.lit(WORD)).cast("int"))


def window_masks(primers: DataFrame, msa: DataFrame) -> DataFrame:
    """gene, msa_start, msa_end, window, word and rows: which rows of WORD alignment rows show the window at a
    primer's span, as bits. Every row is cut once for each distinct span; single and pair coverage both follow from
    the result, which has a row for each distinct window and word. Rows are told apart by `row` (number_rows) or,
    where that column is missing, by seq_idx, which then must be a row's own.
    """
    spans = primers.select("gene", "msa_start", "msa_end").distinct()
    lists = spans.groupBy("gene", F.expr(f"msa_start div {STARTS}").alias("part")).agg(F.collect_list(F.struct("msa_start", "msa_end")).alias("spans")).drop("part")
    word, bit = _word(F.col("n"))
    rows = msa.select("gene", _row(msa).alias("n"), "aligned")
    cut = spread_join(rows, lists, ["gene"], most=LISTS).select("gene", "n", F.explode("spans").alias("s"), "aligned")
    cut = cut.select("gene", "s.*", F.expr("upper(substring(aligned, s.msa_start + 1, s.msa_end - s.msa_start))").alias("window"), word, bit.alias("bit"))
    return cut.groupBy("gene", "msa_start", "msa_end", "window", "word").agg(F.bit_or("bit").alias("rows"))


def violations(primers: DataFrame, msa: DataFrame) -> DataFrame:
    """Primers whose coordinates, length or letters don't fit the alignment."""
    bad = (F.col("msa_start") < 0) | (F.col("msa_end") <= F.col("msa_start")) | (F.col("msa_end") > F.coalesce("aln_len", F.lit(0))) | (F.length("sequence") != F.col("msa_end") - F.col("msa_start")) | ~F.col("sequence").rlike("^[ACGT]+$")
    return primers.join(alignment_sizes(msa), "gene", "left").filter(bad).drop("aln_len", "total_sequences_count")


def alignment_sizes(msa: DataFrame) -> DataFrame:
    """gene, aln_len and total_sequences_count: the longest row and the number of rows."""
    return msa.groupBy("gene").agg(F.max(F.length("aligned")).alias("aln_len"), F.count("*").alias("total_sequences_count"))


def _pair_fault() -> Column:
    """What is wrong with a pair's coordinates beside aln_len; null where nothing is."""
    checks = []
    for side in ("forward", "reverse"):
        start, end = F.col(f"{side}_start"), F.col(f"{side}_end")
        checks += [(start < 0, f"negative {side} start"), (end <= start, f"empty {side} primer"), (end > F.coalesce("aln_len", F.lit(0)), f"{side} primer beyond the alignment"), (F.length(f"{side}_seq") != end - start, f"{side} length differs")]
    return F.coalesce(*(F.when(bad, F.lit(text)) for bad, text in checks))


def pair_violations(pairs: DataFrame, msa: DataFrame) -> DataFrame:
    """Pairs whose coordinates don't fit the alignment or their sequences, with the first reason."""
    return pairs.join(alignment_sizes(msa), "gene", "left").withColumn("reason", _pair_fault()).filter("reason IS NOT NULL").drop("aln_len", "total_sequences_count")


def single_coverage(primers: DataFrame, msa: DataFrame, params: Params = STRICT, masks: DataFrame | None = None) -> DataFrame:
    """Coverage counts of each distinct primer; alignment rows with the same window are compared once.

    `masks`: window_masks of these primers and rows, where a stored table of them serves several calls.
    """
    masks = window_masks(primers, msa) if masks is None else masks
    counted = masks.groupBy("gene", "msa_start", "msa_end", "window").agg(F.sum(F.bit_count("rows")).alias("n"))
    keys = primers.select(*KEY).distinct()
    rows = _mismatches(spread(keys.join(counted, ["gene", "msa_start", "msa_end"]), *KEY, "window").withColumn("observed", _observed()), params)
    ok = (F.col("total") <= params.max_mismatches) & (F.col("prime3") <= params.max_3p_mismatches) & (F.col("weighted") <= params.max_weighted_score)
    if params.gap_mode == "hard_fail":
        ok &= F.col("gaps") == 0
    n = F.col("n")
    out = rows.groupBy(*KEY).agg(
        F.sum(F.when(ok, n).otherwise(0)).alias("matched_sequences_count"), F.sum(n).alias("n_rows"), F.sum(F.col("total") * n).alias("total_mismatch_count"),
        F.sum(F.col("prime3") * n).alias("prime3_mismatch_count"), F.sum(F.when(F.col("gaps") > 0, n).otherwise(0)).alias("gap_overlap_count"),
        F.sum(F.col("weighted") * n).alias("weighted_mismatch_score_sum"),
    )
    return out.withColumn("coverage_fraction", F.col("matched_sequences_count") / F.col("n_rows"))


def primer_masks(primers: DataFrame, msa: DataFrame, params: Params = STRICT, masks: DataFrame | None = None) -> DataFrame:
    """For each distinct primer and WORD alignment rows: the rows it matches (ok) and those it fails at the 3' end
    (bad3), as bits of the rows of window_masks."""
    masks = window_masks(primers, msa) if masks is None else masks
    span = ["gene", "msa_start", "msa_end"]
    seen = primers.select(*KEY).distinct().join(masks.select(*span, "window").distinct(), span)
    flags = _mismatches(spread(seen, *KEY, "window").withColumn("observed", _observed()), params)
    ok = (F.col("total") <= params.max_mismatches) & (F.col("prime3") <= params.max_3p_mismatches)
    if params.gap_mode != "ignore":
        ok &= F.col("gaps") <= (0 if params.gap_mode == "hard_fail" else params.max_gap_positions)
    flags = flags.select(*KEY, "window", ok.alias("ok"), (F.col("prime3") > params.max_3p_mismatches).alias("bad3"))
    some = lambda flag: F.bit_or(F.when(F.col(flag), F.col("rows")).otherwise(F.lit(0).cast("bigint"))).alias(flag)
    return masks.join(flags, [*span, "window"]).groupBy(*KEY, "word").agg(some("ok"), some("bad3"))


def unfit_amplicons(pairs: DataFrame, msa: DataFrame, params: Params = STRICT) -> DataFrame:
    """gene, forward_start, reverse_end, word and unfit: rows in which the amplicon is empty or has too many gaps.

    Only rows with more gaps than the shortest amplicon may have, or shorter than the longest reaches, are looked at;
    their gaps before each column are summed once, and a span's number is a difference of two.
    """
    spans = pairs.select("gene", "forward_start", "reverse_end").distinct()
    limit = spans.groupBy("gene").agg(F.min(F.col("reverse_end") - F.col("forward_start")).alias("shortest"), F.max("reverse_end").alias("reach"))
    lists = spans.groupBy("gene", F.expr(f"forward_start div {STARTS}").alias("part")).agg(F.collect_list(F.struct("forward_start", "reverse_end")).alias("spans")).drop("part")
    rows = msa.select("gene", _row(msa).alias("n"), "aligned", (F.length("aligned") - F.length(F.replace("aligned", F.lit("-"), F.lit("")))).alias("gaps"))
    odd = rows.join(limit, "gene").filter((F.col("gaps") > F.col("shortest") * params.max_amplicon_gap_fraction) | (F.length("aligned") < F.col("reach")))
    before = "aggregate(split(aligned, ''), array(0), (a, c) -> array_append(a, element_at(a, -1) + CASE WHEN c = '-' THEN 1 ELSE 0 END))"
    odd = odd.select("gene", "n", F.length("aligned").alias("size"), F.expr(before).alias("before"))
    cut = spread_join(odd, lists, ["gene"], most=LISTS).select("gene", "n", "size", "before", F.explode("spans").alias("s")).select("gene", "n", "s.*", F.expr("greatest(0, least(size, s.reverse_end) - s.forward_start)").alias("length"), F.expr("element_at(before, least(size, s.reverse_end) + 1) - element_at(before, least(size, s.forward_start) + 1)").alias("own"))
    word, bit = _word(F.col("n"))
    bad = cut.filter((F.col("length") == 0) | (F.col("own") / F.col("length") > params.max_amplicon_gap_fraction))
    return bad.groupBy("gene", "forward_start", "reverse_end", word).agg(F.bit_or(bit).alias("unfit"))


def pair_coverage(pairs: DataFrame, masks: DataFrame, msa: DataFrame, params: Params = STRICT) -> DataFrame:
    """Add the counts of rows that each pair matches or fails; pairs that overlap themselves are dropped. A pair
    whose coordinates don't fit fails the job. `masks`: primer_masks of the same rows."""
    fault = _pair_fault()
    checked = pairs.join(alignment_sizes(msa), "gene").withColumn("total_sequences_count", F.when(fault.isNull(), F.col("total_sequences_count")).otherwise(F.raise_error(F.concat(F.lit("pair_coverage: "), fault)).cast("bigint")))
    pairs = checked.filter("total_sequences_count > 0 AND forward_end <= reverse_start").drop("aln_len")
    side = lambda o, s: masks.filter(F.col("orientation") == o).select("gene", F.col("sequence").alias(f"{s}_seq"), F.col("msa_start").alias(f"{s}_start"), F.col("msa_end").alias(f"{s}_end"), "word", F.col("ok").alias(f"{s}_ok"), F.col("bad3").alias(f"{s}_bad3"))
    keys = pairs.select("gene", "forward_seq", "forward_start", "forward_end", "reverse_seq", "reverse_start", "reverse_end").distinct()
    j = keys.join(side("forward", "forward"), ["gene", "forward_seq", "forward_start", "forward_end"]).join(side("reverse", "reverse"), ["gene", "reverse_seq", "reverse_start", "reverse_end", "word"])
    j = j.join(unfit_amplicons(keys, msa, params), ["gene", "forward_start", "reverse_end", "word"], "left").withColumn("fine", F.expr("~coalesce(unfit, 0L)"))
    bits = lambda x: F.sum(F.bit_count(x)).cast("bigint")
    counts = j.groupBy(keys.columns).agg(
        bits(F.expr("forward_ok & reverse_ok & fine")).alias("fully_matched_sequences_count"), bits(F.col("forward_ok")).alias("f_ok"),
        bits(F.col("reverse_ok")).alias("r_ok"), bits(F.expr("forward_bad3 | reverse_bad3")).alias("failed_due_to_3prime_count"),
    )
    out = pairs.join(counts, keys.columns)
    n = F.col("total_sequences_count")
    return out.withColumns({"failed_forward_count": n - F.col("f_ok"), "failed_reverse_count": n - F.col("r_ok"), "pair_coverage_fraction": F.col("fully_matched_sequences_count") / n}).drop("f_ok", "r_ok")


COVERAGE_ORDER = [("pair_coverage_fraction", True), ("is_preferred_amplicon_range", True), ("tm_diff", False), ("heterodimer_tm", False), ("gc_balance_abs_diff", False), ("f_ord", False), ("r_ord", False)]
