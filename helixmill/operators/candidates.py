"""Candidate windows and single primers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement
from ..params import STRICT, Params


SEGMENT = 1 << 12  # columns in a row of arrays
REGIONS, LENGTHS = 1 << 21, 1 << 10


def column_segments(profile: DataFrame, halo: int, segment: int = SEGMENT) -> DataFrame:
    """gene, segment, from_col, ids, gaps and bases: identities, gap fractions and consensus of `segment` columns and
    the next `halo` ones, from column from_col on, so that a window that begins in a segment lies in its row."""
    own = F.expr(f"cast(col div {segment} as bigint)")
    rows = profile.withColumn("segment", F.explode(F.when((F.col("col") % segment < halo) & (F.col("col") >= segment), F.array(own, own - 1)).otherwise(F.array(own))))
    cells = F.array_sort(F.collect_list(F.struct("col", "identity", "gap_fraction", "consensus_base"))).alias("p")
    return rows.groupBy("gene", "segment").agg(cells).select("gene", "segment", F.expr("p[0].col").alias("from_col"), F.col("p.identity").alias("ids"), F.col("p.gap_fraction").alias("gaps"), F.array_join("p.consensus_base", "").alias("bases"))


def enumeration_order() -> Column:
    """A number that rises with region, length, start and orientation; one that wouldn't fit fails the job."""
    fits = (F.col("region_index") < REGIONS) & (F.col("length") < LENGTHS)
    number = F.expr(f"((cast(region_index as bigint) * {LENGTHS} + length) * {1 << 31} + window_start) * 2 + CASE WHEN orientation = 'reverse' THEN 1 ELSE 0 END")
    return F.when(fits, number).otherwise(F.raise_error(F.lit(f"a gene has {REGIONS} regions or a window {LENGTHS} columns")).cast("bigint"))


def window_candidates(profile: DataFrame, regions: DataFrame, params: Params = STRICT, segment: int = SEGMENT) -> DataFrame:
    """Every window of every allowed length in every region, forward and reverse, that meets the limits.

    `ord` keeps the enumeration order: region, length, start, forward before reverse. A region meets the segments of
    columns in which its windows begin, so no row is longer than a segment, and a gene is spread over its segments.
    """
    size = max(segment, params.max_len)
    columns = column_segments(profile, params.max_len - 1, size)
    w = regions.withColumn("segment", F.explode(F.expr(f"sequence(cast(start_col div {size} as bigint), cast((end_col - 1) div {size} as bigint))"))).join(columns, ["gene", "segment"])
    w = w.withColumn("length", F.explode(F.sequence(F.lit(params.min_len), F.lit(params.max_len))))
    w = w.withColumns({"_first": F.expr(f"greatest(start_col, cast(segment * {size} as int))"), "_last": F.expr(f"least(end_col - length, cast((segment + 1) * {size} - 1 as int))")}).filter("_first <= _last")
    w = w.withColumn("window_start", F.explode(F.expr("sequence(_first, _last)"))).withColumn("_at", F.expr("window_start - from_col + 1"))
    w = w.withColumn("template_seq", F.expr("substring(bases, _at, length)")).filter((F.length("template_seq") == F.col("length")) & ~F.contains("template_seq", F.lit(params.unsuitable_char)))
    w = w.withColumn("i", F.expr("slice(ids, _at, length)")).withColumn("g", F.expr("slice(gaps, _at, length)"))
    mean = "aggregate({a}, 0.0D, (t, v) -> t + v, t -> t / size({a}))"
    w = w.select(
        "gene", "region_index", "window_start", (F.col("window_start") + F.col("length")).alias("window_end"), "length", "template_seq", "i",
        F.expr(mean.format(a="i")).alias("mean_conservativity"), F.array_min("i").alias("min_conservativity"),
        F.size(F.filter("i", lambda x: (1.0 - x) > params.variability_threshold)).alias("n_variable_positions"),
        F.size(F.filter("g", lambda x: x > params.gap_fraction_threshold)).alias("n_high_gap_positions"),
    )
    w = w.filter((F.col("n_variable_positions") <= params.max_variable_positions) & (F.col("n_high_gap_positions") <= params.max_high_gap_positions))
    w = w.withColumn("orientation", F.explode(F.array(F.lit("forward"), F.lit("reverse"))))
    t = params.tail_len
    tail = lambda n: F.expr(f"CASE WHEN length < {t} THEN 0.0D WHEN orientation = 'forward' THEN {mean.format(a=f'slice(i, -{n}, {n})')} ELSE {mean.format(a=f'slice(i, 1, {n})')} END")
    w = w.withColumn("tail3_identity", F.round(tail(3), 12)).withColumn("tail5_identity", F.round(tail(t), 12))
    w = w.filter((F.col("tail3_identity") >= params.min_tail3_identity) & (F.col("tail5_identity") >= params.min_tail5_identity))
    primer = F.when(F.col("orientation") == "forward", F.col("template_seq")).otherwise(reverse_complement("template_seq"))
    return w.drop("i").withColumn("primer_seq", primer).withColumn("ord", enumeration_order())


def single_primers(windows: DataFrame, unsuitable: str = "N") -> DataFrame:
    """gene, sequence, orientation, msa_start, msa_end, ord; sequences with other than ACGT or an unsuitable
    character are dropped, repeats are kept."""
    own = windows.withColumn("template", F.upper("template_seq"))
    ok = (F.length("template") == F.col("window_end") - F.col("window_start")) & F.col("template").rlike("^[ACGT]+$")
    for c in unsuitable:
        ok &= ~F.contains("template", F.lit(c))
    primer = F.when(F.col("orientation") == "forward", F.col("template")).otherwise(reverse_complement("template"))
    return own.filter(ok).select("gene", primer.alias("sequence"), "orientation", F.col("window_start").alias("msa_start"), F.col("window_end").alias("msa_end"), "ord")
