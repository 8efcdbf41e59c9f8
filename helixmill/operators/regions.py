"""Conserved regions: sliding means, a quantile threshold, runs of windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import STRICT, Params
from ..storage import stored
from .places import placed
from .records import exact_percentile

SEGMENT = 1 << 16  # columns that a task holds at once


def window_mean(scores: DataFrame, params: Params = STRICT, segment: int = SEGMENT) -> DataFrame:
    """Mean score of each full window; genes shorter than the window have none. Rounded to 12 decimals, so that
    equal windows stay equal whatever the order of summation.

    Columns are numbered from 0 without holes. A gene is cut into segments of columns, each with a halo: the first
    columns of the next one, as many as its last windows need. So a task holds a segment, not a gene.
    """
    w, size = params.window_size, max(segment, params.window_size)
    own = F.expr(f"cast(col div {size} as bigint)")
    with_halo = F.when((F.col("col") % size < w - 1) & (F.col("col") >= size), F.array(own, own - 1)).otherwise(F.array(own))
    window = Window.partitionBy("gene", "segment").orderBy("col").rowsBetween(0, w - 1)
    out = scores.select("gene", "col", "score", F.explode(with_halo).alias("segment"))
    out = out.select("gene", "col", "segment", F.round(F.avg("score").over(window), 12).alias("window_mean"), F.count("*").over(window).alias("n"))
    return out.filter((F.col("n") == w) & (own == F.col("segment"))).select("gene", "col", "window_mean")


def stitched(flagged: DataFrame, size: int) -> DataFrame:
    """Runs of consecutive columns of flagged(gene, col, window_mean): gene, first, last, total and n.

    Runs are found within segments of columns; only those that touch a border of their segment, two a segment at
    most, are compared with their neighbours.
    """
    rows = flagged.withColumn("segment", F.expr(f"cast(col div {size} as bigint)"))
    island = F.col("col") - F.row_number().over(Window.partitionBy("gene", "segment").orderBy("col"))
    runs = rows.withColumn("island", island).groupBy("gene", "segment", "island").agg(F.min("col").alias("first"), F.max("col").alias("last"), F.sum("window_mean").alias("total"), F.count("*").alias("n"))
    low = F.col("segment") * size
    runs = runs.withColumn("border", (F.col("first") == low) | (F.col("last") == low + size - 1)).drop("island", "segment")
    by = Window.partitionBy("gene").orderBy("first")
    new = F.coalesce(F.lag("last").over(by) + 1 != F.col("first"), F.lit(True)).cast("int")
    edge = runs.filter("border").withColumn("new", new).withColumn("chain", F.sum("new").over(by))
    whole = edge.groupBy("gene", "chain").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("total").alias("total"), F.sum("n").alias("n")).drop("chain")
    return runs.filter(~F.col("border")).select(whole.columns).unionByName(whole)


def conserved_regions(scores: DataFrame, params: Params = STRICT, segment: int = SEGMENT) -> DataFrame:
    """gene, region_index, start_col, end_col, mean_score of runs of windows at or above the quantile.

    The quantile comes from counts of equal means, ranked by ranges of their values; the runs are stitched at the
    borders of segments; so no step holds a gene's columns in one task.
    """
    means = stored(window_mean(scores, params, segment), "means")
    limit = exact_percentile(means, "gene", "window_mean", params.top_quantile, "threshold").withColumn("threshold", F.round("threshold", 12))
    flagged = means.join(limit, "gene").filter("window_mean >= threshold").drop("threshold")
    found = stitched(flagged, max(segment, params.window_size)).select("gene", F.col("first").alias("start_col"), (F.col("last") + params.window_size).alias("end_col"), (F.col("total") / F.col("n")).alias("mean_score"))
    if params.min_region_len is not None:
        found = found.filter(F.col("end_col") - F.col("start_col") >= params.min_region_len)
    placed_ = placed(stored(found, "runs"), ["gene"], [F.col("start_col")], out="region_index")
    return placed_.select("gene", F.col("region_index").cast("int").alias("region_index"), "start_col", "end_col", "mean_score")


def violations(regions: DataFrame, consensus_aligned: DataFrame) -> DataFrame:
    """Regions out of range, empty, or all gaps in the aligned consensus, with the reason."""
    c = regions.join(consensus_aligned, "gene", "left")
    part = F.expr("substring(consensus_aligned, start_col + 1, end_col - start_col)")
    reason = (
        F.when(F.col("start_col") < 0, "negative start").when(F.col("end_col") <= F.col("start_col"), "empty")
        .when(F.coalesce(F.length("consensus_aligned"), F.lit(0)) < F.col("end_col"), "beyond the alignment").when(~part.rlike("[^-]"), "all gaps")
    )
    return c.withColumn("reason", reason).filter("reason IS NOT NULL").select("gene", "region_index", "start_col", "end_col", "reason")
